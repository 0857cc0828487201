"""Business definitions on customer columns, written once and shared."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tenure bands (right-closed upper bounds in months, then the open band).
TENURE_BANDS = ((6, "0-6mo"), (12, "7-12mo"), (24, "13-24mo"), (48, "25-48mo"))
OPEN_BAND = "49mo+"

# Service texts that only say the parent service is absent.
NOT_APPLICABLE = ("No internet service", "No phone service")


def band(column: Column, bands=TENURE_BANDS, last=OPEN_BAND, missing: str | None = None) -> Column:
    """Right-closed bands; the last one is open. ``missing`` labels NULL if given."""
    expr = None
    for upper, label in bands:
        test = column <= upper
        expr = F.when(test, label) if expr is None else expr.when(test, label)
    expr = expr.otherwise(last)
    return expr if missing is None else F.when(column.isNull(), missing).otherwise(expr)


def collapse(column: Column, values=NOT_APPLICABLE) -> Column:
    """Replace the given texts by plain ``No``; NULL stays NULL."""
    return F.when(column.isin(*values), "No").otherwise(column)


def count_yes(names: Sequence[str]) -> Column:
    """Number of the named columns that say Yes in a row; NULL counts as no."""
    return F.expr(" + ".join(f"int(`{n}` <=> 'Yes')" for n in names))
