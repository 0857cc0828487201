"""Deterministic pseudo-random order built on md5.

md5 exists with identical output in every SQL engine, so an assignment made here
can be recomputed and audited elsewhere. The digest is uniform whatever the ids
look like, so cutting its range into cells cuts any group into even pieces.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HEX_DIGITS = 13  # 52 bits: exact as a double
_RANGE = float(16**_HEX_DIGITS)


def shuffle_key(id_col: str | Column, seed: int | str = 0) -> Column:
    """32 hex digits that order ids pseudo-randomly for one seed."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(f"{seed}:"), column.cast("string")))


def digest_number(digest: Column) -> Column:
    """The leading 52 bits of a hex digest as BIGINT; keeps the digest order."""
    return F.conv(F.substring(digest, 1, _HEX_DIGITS), 16, 10).cast("bigint")


def cell_of(digest: Column, cells: int | Column) -> Column:
    """Order-preserving cell 0..cells-1 of a digest."""
    cells = F.lit(cells) if isinstance(cells, int) else cells
    share = digest_number(digest).cast("double") / F.lit(_RANGE)
    return F.floor(share * cells).cast("bigint")


def slot_of(digest: Column, slots: int | Column) -> Column:
    """Uniform slot 0..slots-1 drawn from a digest."""
    slots = F.lit(slots) if isinstance(slots, int) else slots
    return F.pmod(digest_number(digest), slots.cast("bigint"))
