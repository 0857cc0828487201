"""Running totals and exact quantiles over value histograms of any size.

A histogram with one row per distinct value can be as large as the base. Its running
sums are taken in two levels: inside slabs of neighbouring values, each of them one
window partition, and across the few slab totals. Slab edges are approximate quantiles
of the values, fixed as literals before the main job, so every row's slab depends on
its value alone. A value shared by very many rows is a single histogram row, so no slab
holds more histogram rows than its share of the base.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType
from pyspark.sql.window import Window

ROWS_PER_SLAB = 500_000
MAX_SLABS = 16_384
SAMPLE_PER_SLAB = 200


def slab_edges(
    df: DataFrame, value: str, rows_per_slab: int = ROWS_PER_SLAB, levels: int | None = None
) -> list[float]:
    """Increasing cut points, one less than the slabs the row count asks for.

    ``levels``, a known bound on distinct values (a rule score, a rounded probability),
    stands in for the row count and saves counting.

    Edges come from a sample of bounded size, since they only balance the work: any
    edges give the same sums. An input of one slab needs no edges and no second job.
    """
    column = df.select(F.col(value).cast("double").alias("v"))
    column = column.where(F.col("v").isNotNull() & ~F.isnan("v"))
    rows = column.count() if levels is None else levels
    slabs = min(MAX_SLABS, -(-rows // rows_per_slab))
    if slabs <= 1:
        return []
    share = min(1.0, SAMPLE_PER_SLAB * slabs / rows)
    sample = column.sample(share, seed=1) if share < 1.0 else column
    cuts = [i / slabs for i in range(1, slabs)]
    found = sample.agg(F.percentile_approx("v", cuts, 10 * slabs).alias("e")).first()["e"]
    return sorted(set(float(x) for x in found or []))


def cut_index(df: DataFrame, value: str, cuts: Sequence[float], name: str) -> DataFrame:
    """Number of cuts at or below the value (binary search in the JVM)."""
    if not cuts:
        return df.withColumn(name, F.lit(0))
    splits = [float("-inf"), *cuts, float("inf")]
    bucketed = Bucketizer(
        splits=splits, inputCol=value, outputCol="_bucket", handleInvalid="keep"
    ).transform(df)
    return bucketed.withColumn(name, F.col("_bucket").cast("int")).drop("_bucket")


def cumulate(
    hist: DataFrame,
    value: str,
    sums: Sequence[str],
    edges: Sequence[float],
    by: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """Add ``<sum>_before`` (strictly before this value) and ``<sum>_total`` per group."""
    if not edges:
        # one slab: its running sums are those of the group
        inside = Window.partitionBy(*by)
        order = F.col(value).desc() if descending else F.col(value).asc()
        earlier = inside.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return hist.select(
            "*",
            *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in sums),
            *(F.sum(c).over(inside).alias(f"{c}_total") for c in sums),
        )
    slabbed = cut_index(hist, value, edges, "_slab")

    def directed(name: str) -> Column:
        return F.col(name).desc() if descending else F.col(name).asc()

    over_slabs = Window.partitionBy(*by).orderBy(directed("_slab"))
    before_slab = over_slabs.rowsBetween(Window.unboundedPreceding, -1)
    totals = slabbed.groupBy(*by, "_slab").agg(*(F.sum(c).alias(c) for c in sums))
    totals = totals.select(
        *(F.col(c).alias(f"_k_{c}") for c in (*by, "_slab")),
        *(F.coalesce(F.sum(c).over(before_slab), F.lit(0)).alias(f"_b_{c}") for c in sums),
        *(F.sum(c).over(Window.partitionBy(*by)).alias(f"{c}_total") for c in sums),
    )
    in_slab = Window.partitionBy(*by, "_slab").orderBy(directed(value))
    before_value = in_slab.rowsBetween(Window.unboundedPreceding, -1)
    match = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in (*by, "_slab")]
    return slabbed.join(totals, match).select(
        *hist.columns,
        *(
            (F.col(f"_b_{c}") + F.coalesce(F.sum(c).over(before_value), F.lit(0))).alias(
                f"{c}_before"
            )
            for c in sums
        ),
        *(f"{c}_total" for c in sums),
    )


def value_histogram(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows ``n`` per (group, value); NULL and NaN are no values."""
    number = F.col(value).cast("double")
    present = df.where(number.isNotNull() & ~F.isnan(number))
    return present.groupBy(*by, number.alias(value)).agg(F.count("*").alias("n"))


def quantiles_of(
    hist: DataFrame,
    value: str,
    shares: Sequence[float],
    edges: Sequence[float],
    by: Sequence[str] = (),
) -> DataFrame:
    """Linearly interpolated quantiles ``q0, q1, ...`` per group, plus the row count ``n``."""
    placed = cumulate(hist, value, ["n"], edges, by)

    def value_at(index: Column) -> Column:
        here = (F.col("n_before") <= index) & (index < F.col("n_before") + F.col("n"))
        return F.max(F.when(here, F.col(value)))

    picks = []
    for i, share in enumerate(shares):
        place = F.lit(float(share)) * (F.col("n_total") - 1)
        picks += [
            value_at(F.floor(place)).alias(f"_lo{i}"),
            value_at(F.ceil(place)).alias(f"_hi{i}"),
        ]
    ends = placed.groupBy(*by).agg(F.max("n_total").alias("n"), *picks)

    def interpolated(i: int, share: float) -> Column:
        place = F.lit(float(share)) * (F.col("n") - 1)
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        return low + (high - low) * (place - F.floor(place))

    return ends.select(
        *by, "n", *(interpolated(i, s).alias(f"q{i}") for i, s in enumerate(shares))
    )


def exact_quantiles(
    df: DataFrame,
    value: str,
    shares: Sequence[float],
    by: Sequence[str] = (),
    rows_per_slab: int = ROWS_PER_SLAB,
) -> DataFrame:
    """:func:`quantiles_of` the rows of a frame."""
    edges = slab_edges(df, value, rows_per_slab)
    return quantiles_of(value_histogram(df, value, by), value, shares, edges, by)


# ------------------------------------------------------------------ many columns at once

#: Digest accuracy of the brackets, and how far a bracket reaches on each side of a share.
BRACKET_ACCURACY = 10_000
BRACKET_REACH = 3e-4
#: Rows up to which a bracket is the whole range: a narrow one would be a row or two wide.
BRACKET_ROWS = 20_000


@dataclass(frozen=True)
class _Bracket:
    """Bounds that enclose the wanted places of one column in one group."""

    group: tuple
    column: int
    share: int
    wanted: float
    rows: int
    low: float
    high: float

    @property
    def places(self) -> tuple[int, int, float]:
        """0-based places below and above the share, and how far it is between them."""
        place = self.wanted * (self.rows - 1)
        return math.floor(place), math.ceil(place), place - math.floor(place)


def _brackets(
    df: DataFrame, numbers: dict[str, Column], shares: Sequence[float], by: Sequence[str]
) -> list[_Bracket]:
    """One aggregate: rows of each column and group, and bounds around every share."""
    around = [0.0, 1.0]
    for s in shares:
        around += [max(0.0, s - BRACKET_REACH), min(1.0, s + BRACKET_REACH)]
    found = df.groupBy(*by).agg(
        *(F.count(x).alias(f"n{i}") for i, x in enumerate(numbers.values())),
        *(
            F.percentile_approx(x, around, BRACKET_ACCURACY).alias(f"b{i}")
            for i, x in enumerate(numbers.values())
        ),
    )
    out = []
    for row in found.collect():
        for i in range(len(numbers)):
            n, bounds = row[f"n{i}"], row[f"b{i}"]
            for j, share in enumerate(shares):
                if n:
                    wide = n <= BRACKET_ROWS
                    low, high = bounds[:2] if wide else bounds[2 + 2 * j : 4 + 2 * j]
                    group = tuple(row[c] for c in by)
                    out.append(_Bracket(group, i, j, float(share), n, low, high))
    return out


def column_quantiles(
    df: DataFrame, columns: Sequence[str], shares: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact interpolated quantiles of many columns: ``by, feature, n, q0, q1, ...``.

    Three scans and no row per (row, column). The first finds, per column and group, a bracket of
    values that encloses each wanted place. The second counts the rows below and on the
    bracket's ends. Only values strictly inside, some thousandth of the rows, are gathered in the third,
    as a histogram. Brackets that are one value, as in columns of few values, need no more.
    The driver holds one row per group. NULL and NaN are no values; a column without values in a group has no row.
    """
    numbers = {}
    for c in columns:
        x = F.col(f"`{c}`").cast("double")
        numbers[c] = F.when(~F.isnan(x), x)
    brackets = _brackets(df, numbers, shares, by)
    spark, names = df.sparkSession, list(numbers)
    fields = [df.schema[c] for c in by]
    result = StructType(
        [*fields, StructField("feature", StringType()), StructField("n", LongType())]
        + [StructField(f"q{j}", DoubleType()) for j in range(len(shares))]
    )
    if not brackets:
        return spark.createDataFrame([], result)
    groups = sorted({b.group for b in brackets}, key=repr)
    ends: dict[tuple, dict] = {}
    for b in brackets:
        ends.setdefault(b.group, {})[b.column, b.share] = (b.low, b.high)
    order = [(i, j) for i in range(len(names)) for j in range(len(shares))]
    table = [
        (*g, *([ends[g].get(key, (None, None))[end] for key in order] for end in (0, 1))) for g in groups
    ]
    doubles = ArrayType(DoubleType())
    schema = StructType([*fields, StructField("_low", doubles), StructField("_high", doubles)])
    if by:
        # one row per group of the aggregate above
        bounds = F.broadcast(
            spark.createDataFrame(table, schema).withColumnsRenamed({c: f"_r_{c}" for c in by})
        )
        placed = df.join(bounds, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in by])
    else:
        low, high = (F.array(*(F.lit(v).cast("double") for v in side)) for side in table[0])
        placed = df.withColumn("_low", low).withColumn("_high", high)
    placed = placed.select(*by, F.array(*numbers.values()).alias("_x"), "_low", "_high")
    at = [(i, j, k) for k, (i, j) in enumerate(order)]
    low, high, x = F.col("_low"), F.col("_high"), F.col("_x")
    counted = placed.groupBy(*by).agg(
        *(F.count_if(x[i] < low[k]).alias(f"below{k}") for i, _, k in at),
        *(F.count_if(x[i] == low[k]).alias(f"low{k}") for i, _, k in at),
        *(F.count_if((x[i] > low[k]) & (x[i] < high[k])).alias(f"in{k}") for i, _, k in at),
        *(F.count_if(x[i] == high[k]).alias(f"high{k}") for i, _, k in at),
    )
    unequal = {(b.column, b.share) for b in brackets if b.low < b.high}
    cells = []
    for i, j, k in at:
        if (i, j) in unequal:
            strictly = (x[i] > low[k]) & (x[i] < high[k])
            cells.append(F.when(strictly, F.struct(F.lit(k).alias("k"), x[i].alias("v"))))
    counts = {tuple(r[c] for c in by): r for r in counted.collect()}
    picked: dict[tuple, list] = {}
    if cells:
        inside = F.filter(F.array(*cells), lambda c: c.isNotNull())
        cells = (
            placed.select(*by, F.explode(inside).alias("_c"))
            .groupBy(*by, F.col("_c.k").alias("k"), F.col("_c.v").alias("v"))
            .agg(F.count("*").alias("n"))
        )
        wanted = []
        for b in brackets:
            k, row = b.column * len(shares) + b.share, counts[b.group]
            before = row[f"below{k}"] + row[f"low{k}"]
            for place in sorted(set(b.places[:2])):
                if before <= place < before + row[f"in{k}"]:
                    wanted.append((*b.group, k, place - before))
        if wanted:
            ask = StructType([*fields, StructField("k", IntegerType()), StructField("place", LongType())])
            picked = _inner_places(cells, spark.createDataFrame(wanted, ask), by)
    rows: dict[tuple, list] = {}
    for b in brackets:
        k, row = b.column * len(shares) + b.share, counts[b.group]
        below, on_low = row[f"below{k}"], row[f"low{k}"]

        within, on_high = row[f"in{k}"], row[f"high{k}"]
        first, second, part = b.places
        ends_at = (below, below + on_low, below + on_low + within, below + on_low + within + on_high)

        def value(place: int, b=b, k=k, ends_at=ends_at) -> float:
            if not ends_at[0] <= place < ends_at[3]:
                raise ArithmeticError("a bracket misses its place")
            if place < ends_at[1] or b.low == b.high:
                return b.low
            if place < ends_at[2]:
                return picked[(*b.group, k, place - ends_at[1])]
            return b.high

        left, right = value(first), value(second)
        held = rows.setdefault((*b.group, b.column), [None] * (len(shares) + 1))
        held[0], held[1 + b.share] = b.rows, left + (right - left) * part
    return spark.createDataFrame(
        [(*key[:-1], names[key[-1]], *held) for key, held in rows.items()], result
    )


def _inner_places(cells: DataFrame, wanted: DataFrame, by: Sequence[str]) -> dict[tuple, float]:
    """The value at each wanted place of its (group, bracket) histogram."""
    keys = [*by, "k"]
    running = Window.partitionBy(*keys).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    upto = cells.withColumn("upto", F.sum("n").over(running))
    asked = F.broadcast(wanted.withColumnsRenamed({c: f"_r_{c}" for c in keys}))
    match = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in keys]
    hit = (F.col("place") >= F.col("upto") - F.col("n")) & (F.col("place") < F.col("upto"))
    found = upto.join(asked, [*match, hit]).select(*keys, "place", "v").collect()
    return {(*(r[c] for c in keys), r["place"]): r["v"] for r in found}
