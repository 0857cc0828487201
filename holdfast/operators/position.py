"""Exact global positions without a global sort on one task.

``Window.orderBy`` without a partition moves every row to one task. Here rows are cut
into cells that follow the wanted order: first the levels of a low-cardinality order
key, then even pieces of the id digest inside each level. A level that holds a third
of all rows therefore spreads over as many tasks as its size asks for. Cells are
functions of the row alone, so a lost executor recomputes the same cells, and their
number is fixed, so the rows need not be counted first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from holdfast.functions.hashing import cell_of, shuffle_key

#: Pieces of a level's digests; at ten billion rows a piece has some 600,000.
CELLS = 16_384
#: Names for the added columns that no table of customers has.
PRIVATE = ("_position", "_level_start", "_group_rows")


def with_position(
    df: DataFrame,
    id_col: str,
    order: Sequence[tuple[str, str]] = (),
    within: Sequence[str] = (),
    seed: int | str = 0,
    rows_per_cell: int | None = None,
    rows: int | None = None,
    names: Sequence[str] = ("position", "level_start", "group_rows"),
) -> DataFrame:
    """Add the 0-based ``position`` of each row in its ``within`` group.

    ``order`` lists (column, "asc"|"desc") keys with few distinct values (scores of a
    rule, rounded probabilities, class labels); rows equal in all of them follow the
    digest of ``(seed, id)``, then the id. Also adds ``level_start`` (rows strictly
    before this row's level) and ``group_rows`` (rows in the group).

    Ids must be unique. Rows without an id are kept too: they come last in their level, by
    the digest of their whole content and then the content, and are cut into as many cells
    of their own; equal ones are interchangeable. ``names`` are the three added columns.

    The base is shuffled and sorted once, by cell: the join with the cell offsets uses the
    same key. Offsets are prefix sums over the cells of one level and over the levels of
    one group, never over both at once. ``rows_per_cell`` with a known row count ``rows``
    asks for fewer cells.
    """
    cells = CELLS
    if rows_per_cell is not None:
        wanted = df.count() if rows is None else rows
        cells = max(1, -(-wanted // rows_per_cell))
    keyed = _in_cells(df, id_col, order, within, seed, cells)

    # the numeric cell leads, so most comparisons of the sort are of one long
    without_id = F.when(F.col(id_col).isNull(), _content(df))
    in_cell = Window.partitionBy("_cell", "_key").orderBy("_digest", id_col, without_id)
    placed = keyed.withColumn("_nth", F.row_number().over(in_cell))
    offsets = _cell_offsets(keyed, order, within)
    position, level_start, group_rows = names
    return placed.join(offsets, ["_cell", "_key"]).select(
        *(F.col(f"`{c}`") for c in df.columns),
        (F.col("_before") + F.col("_nth") - 1).alias(position),
        F.col("_start").alias(level_start),
        F.col("_group").alias(group_rows),
    )


def _content(df: DataFrame) -> Column:
    return F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)))


def _in_cells(
    df: DataFrame,
    id_col: str,
    order: Sequence[tuple[str, str]],
    within: Sequence[str],
    seed: int | str,
    cells: int,
) -> DataFrame:
    """Rows with ``_digest``, ``_cell`` and ``_key``, their group and level as one struct."""
    missing = F.col(id_col).isNull()
    own = F.coalesce(shuffle_key(id_col, seed), F.when(missing, F.md5(_content(df))))
    keyed = df.withColumn("_digest", own)
    # a second range of cells, after the first, for rows without id
    after = F.when(missing, cells).otherwise(0)
    keyed = keyed.withColumn("_cell", cell_of(F.col("_digest"), cells) + after)
    # equal structs match also where a field is NULL
    return keyed.withColumn("_key", F.struct(*within, *(name for name, _ in order), F.lit(0).alias("_")))


def _cell_counts(
    keyed: DataFrame, order: Sequence[tuple[str, str]], within: Sequence[str]
) -> DataFrame:
    fields = [*within, *(name for name, _ in order)]
    return (
        keyed.groupBy("_cell", "_key")
        .agg(F.count("*").alias("_rows"))
        .select("_cell", "_key", "_rows", *(F.col(f"_key.{f}").alias(f) for f in fields))
    )


def group_sizes(
    df: DataFrame, id_col: str, within: Sequence[str], seed: int | str = 0, rows: str = "rows"
) -> DataFrame:
    """Rows of each ``within`` group, from the cells that :func:`with_position` counts.

    Beside a ``with_position`` of the same rows and arguments the counts are made once.
    """
    counts = _cell_counts(_in_cells(df, id_col, (), within, seed, CELLS), (), within)
    return counts.groupBy(*within).agg(F.sum("_rows").alias(rows))


def _cell_offsets(
    keyed: DataFrame, order: Sequence[tuple[str, str]], within: Sequence[str]
) -> DataFrame:
    """``_cell, _key, _before, _start, _group`` for every occupied cell."""
    levels = [name for name, _ in order]
    counts = _cell_counts(keyed, order, within)
    in_level = Window.partitionBy(*within, *levels).orderBy("_cell")
    before = F.sum("_rows").over(in_level.rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.withColumn("_inside", F.coalesce(before, F.lit(0)))
    if order:
        directed = [F.col(c).desc() if way == "desc" else F.col(c).asc() for c, way in order]
        in_group = Window.partitionBy(*within).orderBy(*directed)
        earlier = F.sum("_n").over(in_group.rowsBetween(Window.unboundedPreceding, -1))
        starts = (
            counts.groupBy(*within, *levels)
            .agg(F.sum("_rows").alias("_n"))
            .withColumn("_start", F.coalesce(earlier, F.lit(0)))
            .withColumn("_group", F.sum("_n").over(Window.partitionBy(*within)))
            .drop("_n")
        )
        counts = null_safe_join(counts, starts, [*within, *levels])
    else:
        in_group = Window.partitionBy(*within)
        counts = counts.withColumn("_start", F.lit(0).cast("bigint")).withColumn(
            "_group", F.sum("_rows").over(in_group)
        )
    return counts.select(
        "_cell",
        "_key",
        (F.col("_start") + F.col("_inside")).alias("_before"),
        "_start",
        "_group",
    )


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how="inner"):
    """Equi join that also matches NULL keys; keeps the left copy of the keys."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, condition, how).drop(*(f"_r_{k}" for k in keys))


def tile(position: Column, rows: Column, tiles: int) -> Column:
    """NTILE from a 0-based position: the first ``rows % tiles`` tiles hold one row more."""
    size = F.floor(rows / tiles).cast("bigint")
    larger = (rows % tiles).cast("bigint")
    head = larger * (size + 1)
    return (
        F.when(position < head, F.floor(position / (size + 1)) + 1)
        .otherwise(larger + F.floor((position - head) / F.greatest(size, F.lit(1))) + 1)
        .cast("int")
    )
