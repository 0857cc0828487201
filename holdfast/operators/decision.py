"""From probabilities to contacts: thresholds, tiers, worklists."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from holdfast.functions.hashing import shuffle_key
from holdfast.functions.numeric import rate, ratio
from holdfast.operators.metrics import (
    ACCEPTANCE_RATES,
    METRIC_DIGITS,
    Costs,
    contact_capacity,
    sweep_values,
)
from holdfast.operators.position import PRIVATE, with_position

# Fixed value: the high tier starts at this multiple of the operating threshold.
HIGH_TIER_FACTOR = 1.5


def operating_threshold(sweep: DataFrame) -> DataFrame:
    """The threshold of highest value (the lowest one on a tie) and its gain over 0.5.

    Works on the rows of a sweep, one per grid point. The threshold is the grid's own
    number: rounded, it would flag other rows than the sweep did. Counts of the sweep, where it
    has them, come along.
    """
    counts = [c for c in ("contacted", "n") if c in sweep.columns]
    best = F.min(
        F.struct(
            (-F.col("value_per_1000")).alias("loss"),
            F.col("threshold"),
            F.col("contacted_share"),
            F.col("recall"),
            *counts,
        )
    )
    default = F.min(
        F.struct(
            F.abs(F.col("threshold") - 0.5).alias("away"),
            F.col("threshold"),
            F.col("value_per_1000").alias("value"),
        )
    )
    return sweep.agg(best.alias("b"), default.alias("d")).select(
        F.col("b.threshold").alias("operating_threshold"),
        (-F.col("b.loss")).alias("value_per_1000"),
        F.col("b.contacted_share").alias("contacted_share"),
        F.col("b.recall").alias("recall"),
        F.col("d.value").alias("value_at_half"),
        F.round(-F.col("b.loss") - F.col("d.value"), METRIC_DIGITS).alias("gain_over_half"),
        *(F.col(f"b.{c}").alias(c) for c in counts),
    )


def sensitivity(
    counts: DataFrame, costs: Costs = Costs(), rates: Sequence[float] = ACCEPTANCE_RATES
) -> DataFrame:
    """Best threshold per assumed acceptance rate, from one set of threshold counts.

    The rates multiply the grid-sized counts (190 rows), never the scored base.
    """
    assumed = [replace(costs, acceptance_rate=r) for r in rates]
    scenario = F.array(
        *(
            F.struct(
                F.lit(float(a.acceptance_rate)).alias("acceptance_rate"),
                F.lit(a.break_even).cast("double").alias("theoretical_threshold"),
                F.lit(float(a.gain_per_hit)).alias("gain"),
                F.lit(a.gain_per_hit > 0).alias("programme_viable"),
            )
            for a in assumed
        )
    )
    fields = ["acceptance_rate", "theoretical_threshold", "gain", "programme_viable"]
    each = counts.withColumn("s", F.explode(scenario)).select(*counts.columns, "s.*")
    sweeps = sweep_values(each, F.col("gain"), F.lit(costs.gain_per_miss), by=fields)
    best = F.min(
        F.struct(
            (-F.col("value_per_1000")).alias("loss"), F.col("threshold"), F.col("recall")
        )
    )
    return (
        sweeps.groupBy("acceptance_rate", "theoretical_threshold", "programme_viable")
        .agg(best.alias("b"))
        .select(
            "acceptance_rate",
            F.round("theoretical_threshold", METRIC_DIGITS).alias("theoretical_threshold"),
            F.col("b.threshold").alias("empirical_threshold"),
            F.col("b.recall").alias("recall"),
            (-F.col("b.loss")).alias("value_per_1000"),
            "programme_viable",
        )
    )


def capacity_binding(best: DataFrame, costs: Costs, population: Column) -> DataFrame:
    """Does the flagged share exceed what the team can contact? Shares are rounded for display only."""
    share = F.lit(float(costs.capacity)) / population
    more = F.col("contacted") * population > F.lit(costs.capacity).cast("bigint") * F.col("n")
    return best.select(
        F.col("contacted_share").alias("flagged_share"),
        F.round(share, METRIC_DIGITS).alias("capacity_share"),
        more.alias("capacity_binds"),
    )


def risk_tier(probability: Column, threshold: float) -> Column:
    return (
        F.when(probability >= F.lit(threshold * HIGH_TIER_FACTOR), "high")
        .when(probability >= F.lit(threshold), "medium")
        .otherwise("low")
    )


def value_of_contact(probability: Column, costs: Costs = Costs()) -> Column:
    return probability * F.lit(costs.acceptance_rate) * F.lit(costs.clv) - F.lit(costs.offer_cost)


def decide(
    df: DataFrame,
    probability: str,
    costs: Costs = Costs(),
    threshold: float | None = None,
) -> DataFrame:
    """Add the decision columns; tier and contact use the unrounded probability."""
    threshold = costs.break_even if threshold is None else threshold
    p = F.col(probability)
    return df.withColumns(
        {
            "churn_probability": F.round(p, 4),
            "risk_tier": risk_tier(p, threshold),
            "should_contact": p >= F.lit(float(threshold)),
            "decision_threshold": F.round(F.lit(float(threshold)), 4),
            "expected_value_of_contact": F.round(value_of_contact(p, costs), 2),
        }
    )


def worklist(decided: DataFrame, id_col: str, seed: int = 0, size: str | None = None) -> DataFrame:
    """Add ``rank`` 1..n by rounded probability; ties follow the id digest.

    Probabilities of four decimals have at most 10,001 levels, so the positions need no
    global sort. ``size`` names a further column for n.
    """
    order = [("churn_probability", "desc")]
    placed = with_position(decided, id_col, order=order, seed=seed, names=PRIVATE)
    placed = placed.withColumn("rank", F.col("_position") + 1)
    if size is not None:
        placed = placed.withColumn(size, F.col("_group_rows"))
    return placed.drop(*PRIVATE)


def worklist_top(decided: DataFrame, id_col: str, k: int, seed: int = 0) -> DataFrame:
    """The first ``k`` rows of :func:`worklist`: each task keeps its best k, no base is ranked.

    For a k that a team can call; the k rows are numbered in one task.
    """
    keys = [F.col("churn_probability").desc(), shuffle_key(id_col, seed), F.col(id_col)]
    best = decided.orderBy(*keys).limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*keys)).cast("bigint"))


def batch_summary(decided: DataFrame) -> DataFrame:
    return decided.agg(
        F.count("*").alias("count"),
        F.count_if("should_contact").alias("contact_recommended"),
    )


def worklist_quality(
    ranked: DataFrame,
    label: str,
    costs: Costs = Costs(),
    population: int | None = None,
    size: str | None = None,
) -> DataFrame:
    """Hit rate among the ranks the team can contact, against the base rate.

    ``size`` is the column in which :func:`worklist` left the number of ranked rows;
    without it they are counted.
    """
    hit = F.col(label) == 1
    rows = F.col(size) if size else ranked.agg(F.count("*")).scalar()
    capacity = contact_capacity(costs, rows, F.lit(population) if population else rows)
    top = F.col("rank") <= capacity
    return ranked.agg(
        F.count("*").alias("scored"),
        F.count_if(top).alias("contacted"),
        ratio(F.count_if(top & hit), F.count_if(top)).alias("_hit"),
        rate(hit).alias("_base"),
    ).select(
        "scored",
        "contacted",
        F.round("_hit", METRIC_DIGITS).alias("hit_rate"),
        F.round("_base", METRIC_DIGITS).alias("base_rate"),
        F.round(ratio(F.col("_hit"), F.col("_base")), METRIC_DIGITS).alias("lift"),
    )
