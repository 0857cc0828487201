"""Number parsing, guarded ratios and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict_money(column: Column) -> Column:
    """Blank or missing text is 0.00; text that is not a number fails the job (ANSI cast)."""
    return F.coalesce(
        F.nullif(F.trim(column.cast("string")), F.lit("")).cast("decimal(10,2)"),
        F.lit(0).cast("decimal(10,2)"),
    ).cast("decimal(10,2)")


def lenient_number(column: Column) -> Column:
    """Text that is not a finite-or-infinite number becomes 0.0 instead of failing."""
    parsed = F.trim(column.cast("string")).try_cast("double")
    return F.coalesce(F.nanvl(parsed, F.lit(0.0)), F.lit(0.0))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient; NULL when the denominator is zero or missing."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def rate(condition: Column) -> Column:
    """Share of rows where a condition holds; a missing condition counts as false."""
    return F.avg(F.when(condition, 1).otherwise(0))


def rate_where(condition: Column, subset: Column) -> Column:
    """Share of a subset where a condition holds; NULL for an empty subset."""
    return F.avg(F.when(subset, F.when(condition, 1).otherwise(0)))


def is_true(column: Column) -> Column:
    return F.coalesce(column, F.lit(False))
