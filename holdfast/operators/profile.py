"""Exploration tables: class balance, rates per category, correlations, distributions."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from holdfast.functions.customer import count_yes
from holdfast.functions.numeric import rate, rate_where, ratio
from holdfast.operators.cumulative import column_quantiles
from holdfast.operators.features import category_counts, numeric_pairs
from holdfast.operators.position import null_safe_join
from holdfast.sources.contract import ADDON_COLUMNS

DIGITS = 6


def class_balance(df: DataFrame, target: str, positive: str) -> DataFrame:
    """Class counts, rate and imbalance ratio."""
    hit = F.col(target) == positive
    return df.agg(
        F.count("*").alias("rows"),
        F.count_if(~hit).alias("stayed"),
        F.count_if(hit).alias("churned"),
        F.round(rate(hit), DIGITS).alias("churn_rate"),
        F.round(ratio(F.count_if(~hit), F.count_if(hit)), DIGITS).alias("imbalance_ratio"),
    )


def numeric_by_class(df: DataFrame, columns: Sequence[str], hit: Column) -> DataFrame:
    """Mean of each numeric column per class, and the difference; one aggregate."""
    wide = df.agg(
        *(F.avg(F.when(hit, F.col(c).cast("double"))).alias(f"y{i}") for i, c in enumerate(columns)),
        *(F.avg(F.when(~hit, F.col(c).cast("double"))).alias(f"n{i}") for i, c in enumerate(columns)),
    )
    cells = F.array(
        *(
            F.struct(
                F.lit(c).alias("feature"),
                F.round(F.col(f"n{i}"), DIGITS).alias("mean_stayed"),
                F.round(F.col(f"y{i}"), DIGITS).alias("mean_churned"),
                F.round(F.col(f"y{i}") - F.col(f"n{i}"), DIGITS).alias("difference"),
            )
            for i, c in enumerate(columns)
        )
    )
    return wide.select(F.explode(cells).alias("r")).select("r.*")


# Closed tenure buckets of the exploration; months beyond the last drop out.
TENURE_BUCKETS = (
    (0, 6, "0-6 mo"),
    (7, 12, "7-12 mo"),
    (13, 24, "13-24 mo"),
    (25, 48, "25-48 mo"),
    (49, 72, "49-72 mo"),
)


def tenure_table(df: DataFrame, hit: Column, months: str = "tenure") -> DataFrame:
    bucket = F.lit(None).cast("string")
    for low, high, label in TENURE_BUCKETS:
        bucket = F.when(F.col(months).between(low, high), label).otherwise(bucket)
    return (
        df.groupBy(bucket.alias("bucket"))
        .agg(F.count("*").alias("customers"), F.round(rate(hit), DIGITS).alias("churn_rate"))
        .where(F.col("bucket").isNotNull())
    )


def category_rates(
    df: DataFrame, columns: Sequence[str], hit: Column, flag_factor: float = 1.4
) -> DataFrame:
    """Rows and rate of every value of every column, flagged if far above the overall rate.

    One scan: the columns are turned into (column, value) pairs and combined map-side.
    """
    overall = df.agg(rate(hit)).scalar()
    pairs = F.array(
        *(
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
            for c in columns
        )
    )
    return (
        df.select(hit.alias("_hit"), F.explode(pairs).alias("p"))
        .groupBy(F.col("p.column").alias("column"), F.col("p.value").alias("value"))
        .agg(F.count("*").alias("n"), rate(F.col("_hit")).alias("_rate"))
        .where(F.col("value").isNotNull())
        .select(
            "column",
            "value",
            "n",
            F.round("_rate", DIGITS).alias("rate"),
            (F.col("_rate") > overall * flag_factor).alias("flagged"),
        )
    )


def category_spread(rates: DataFrame, n: int | None = None) -> DataFrame:
    """Highest minus lowest rate per column, widest first; optionally only the top n."""
    spread = (
        rates.groupBy("column")
        .agg(F.round(F.max("rate") - F.min("rate"), DIGITS).alias("spread"))
        .orderBy(F.col("spread").desc(), "column")
    )
    return spread if n is None else spread.limit(n)


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, one aggregate."""
    pairs = list(combinations(columns, 2))
    wide = df.select(*(F.col(c).cast("double").alias(c) for c in columns)).agg(
        *(F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs))
    )
    cells = F.array(
        *(
            F.struct(
                F.lit(a).alias("first"),
                F.lit(b).alias("second"),
                F.round(F.col(f"c{i}"), DIGITS).alias("correlation"),
            )
            for i, (a, b) in enumerate(pairs)
        )
    )
    return wide.select(F.explode(cells).alias("r")).select("r.*")


def redundancy(df: DataFrame, product: Column, column: Column) -> DataFrame:
    """Correlation of a derived product with a stored column."""
    return df.agg(
        F.round(F.corr(product.cast("double"), column.cast("double")), DIGITS).alias(
            "redundancy"
        )
    )


def vocabulary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values per column, one row each, with their row counts."""
    return category_counts(df, columns).where(F.col("value").isNotNull())


def simpson_table(df: DataFrame, hit: Column, subset: Column) -> DataFrame:
    """Rate per add-on count over everyone and inside a subset, side by side.

    ``rises`` marks a count whose overall rate is above that of the count before, which
    is where the unconditioned trend turns against the conditioned one.
    """
    counted = df.withColumn("n_addons", count_yes(ADDON_COLUMNS))
    table = counted.groupBy("n_addons").agg(
        F.count("*").alias("customers_all"),
        F.round(rate(hit), DIGITS).alias("rate_all"),
        F.count_if(subset).alias("customers_subset"),
        F.round(rate_where(hit, subset), DIGITS).alias("rate_subset"),
    )
    # at most one row per number of add-ons
    before = F.lag("rate_all").over(Window.orderBy("n_addons"))
    return table.withColumn("rises", F.coalesce(F.col("rate_all") > before, F.lit(False)))


def zero_addon_breakdown(df: DataFrame, hit: Column, by: str = "InternetService") -> DataFrame:
    """Who sits in the bucket of customers without any add-on."""
    none = count_yes(ADDON_COLUMNS) == 0
    return (
        df.where(none)
        .groupBy(by)
        .agg(F.count("*").alias("customers"), F.round(rate(hit), DIGITS).alias("churn_rate"))
    )


def histogram(df: DataFrame, columns: Sequence[str], group: str, bins: int = 30) -> DataFrame:
    """Equal-width bins over the pooled range of each column, with density per group.

    The bin of the maximum is the last one. Empty bins are absent.
    """
    pairs = numeric_pairs(df, columns, by=[group]).where(F.col("value").isNotNull())
    ranges = pairs.groupBy("feature").agg(
        F.min("value").alias("_low"), F.max("value").alias("_high")
    )
    width = (F.col("_high") - F.col("_low")) / F.lit(float(bins))
    index = F.when(width == 0, 0).otherwise(
        F.least(F.floor((F.col("value") - F.col("_low")) / width), F.lit(bins - 1))
    )
    # one row per feature: bounded by the column list
    counts = (
        pairs.join(F.broadcast(ranges), "feature")
        .groupBy("feature", group, index.cast("int").alias("bin"))
        .agg(F.count("*").alias("rows"), F.max(width).alias("_width"))
    )
    sizes = counts.groupBy("feature", group).agg(F.sum("rows").alias("_size"))
    return null_safe_join(counts, sizes, ["feature", group]).select(
        "feature",
        group,
        "bin",
        "rows",
        F.round(ratio(F.col("rows"), F.col("_size") * F.col("_width")), 9).alias("density"),
    )


def box_stats(df: DataFrame, columns: Sequence[str], group: str) -> DataFrame:
    """Quartiles, and the farthest values within 1.5 interquartile ranges, per group.

    The quartiles are exact; whiskers and outliers then come from one aggregate over the rows, with no
    row per (row, column). A column without values in a group has no row.
    """
    quartiles = column_quantiles(df, columns, [0.25, 0.5, 0.75], by=[group])
    reach = 1.5 * (F.col("q2") - F.col("q0"))
    place = F.create_map(*(F.lit(x) for i, c in enumerate(columns) for x in (c, i)))
    # one row per group and column
    found = quartiles.withColumns(
        {"_low": F.col("q0") - reach, "_high": F.col("q2") + reach, "_at": place[F.col("feature")]}
    )
    fences = found.groupBy(group).agg(
        *(
            F.max(F.when(F.col("_at") == i, F.col(end))).alias(f"{end}{i}")
            for i in range(len(columns))
            for end in ("_low", "_high")
        )
    )
    fenced = null_safe_join(df, F.broadcast(fences), [group])
    sides = []
    for i, c in enumerate(columns):
        x = F.col(f"`{c}`").cast("double")
        value = F.when(~F.isnan(x), x)
        inside = value.between(F.col(f"_low{i}"), F.col(f"_high{i}"))
        sides += [
            F.min(F.when(inside, value)).alias(f"_from{i}"),
            F.max(F.when(inside, value)).alias(f"_to{i}"),
            F.count_if(value.isNotNull() & ~inside).alias(f"_out{i}"),
        ]
    wide = fenced.groupBy(group).agg(*sides)
    cells = F.array(
        *(
            F.struct(
                F.lit(c).alias("feature"),
                F.col(f"_from{i}").alias("low"),
                F.col(f"_to{i}").alias("high"),
                F.col(f"_out{i}").alias("outliers"),
            )
            for i, c in enumerate(columns)
        )
    )
    whiskers = wide.select(group, F.inline(cells))
    return null_safe_join(quartiles, whiskers, ["feature", group]).select(
        "feature",
        group,
        F.col("n").alias("rows"),
        F.round("low", DIGITS).alias("whisker_low"),
        F.round("q0", DIGITS).alias("q1"),
        F.round("q1", DIGITS).alias("median"),
        F.round("q2", DIGITS).alias("q3"),
        F.round("high", DIGITS).alias("whisker_high"),
        "outliers",
    )
