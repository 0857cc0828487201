"""Linear explanations and sliced performance."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.functions.numeric import ratio
from holdfast.operators.cumulative import ROWS_PER_SLAB, slab_edges
from holdfast.operators.metrics import (
    METRIC_DIGITS,
    Costs,
    evaluate_curve,
    measurable,
    score_curve,
)


@dataclass(frozen=True)
class LinearTerm:
    """One feature of a linear model: its weight and its mean in the training data."""

    feature: str
    coefficient: float
    mean: float = 0.0


def linear_terms(model, feature_names: Sequence[str], means: dict[str, float]) -> list[LinearTerm]:
    weights = model.coefficients.toArray()
    return [
        LinearTerm(name, float(w), float(means.get(name, 0.0)))
        for name, w in zip(feature_names, weights, strict=True)
    ]


def feature_means(prepared: DataFrame, names: Sequence[str]) -> dict[str, float]:
    """Exact training means of the prepared features: the background of the explanation."""
    row = prepared.agg(*(F.avg(F.col(f"`{n}`")).alias(n) for n in names)).first()
    return row.asDict()


def coefficient_table(
    spark: SparkSession, terms: Sequence[LinearTerm], n: int | None = 15
) -> DataFrame:
    """Weights and odds ratios, largest absolute weight first."""
    rows = [(t.feature, t.coefficient) for t in terms]
    weight = F.col("coefficient")
    table = (
        spark.createDataFrame(rows, "feature string, coefficient double")
        .withColumns({"odds_ratio": F.exp(weight), "abs_coefficient": F.abs(weight)})
        .orderBy(F.col("abs_coefficient").desc(), "feature")
    )
    return table if n is None else table.limit(n)


def attribution(term: LinearTerm) -> Column:
    """Exact additive contribution of a feature in log-odds."""
    value = F.col(f"`{term.feature}`").cast("double")
    return (value - F.lit(term.mean)) * F.lit(term.coefficient)


def attributions(df: DataFrame, terms: Sequence[LinearTerm], keep: Sequence[str]) -> DataFrame:
    """One contribution column per feature; a row's sum is its distance from the mean row."""
    return df.select(*keep, *(attribution(t).alias(t.feature) for t in terms))


def top_drivers(terms: Sequence[LinearTerm], n: int = 5) -> Column:
    """The n largest contributions of a row, as an array of structs.

    Structs sort field by field, so the sort needs no comparator function: largest
    absolute value first, then declaration order.
    """
    entries = F.array(
        *(
            F.struct(
                (-F.abs(attribution(t))).alias("order"),
                F.lit(i).alias("place"),
                F.lit(t.feature).alias("feature"),
                attribution(t).alias("value"),
            )
            for i, t in enumerate(terms)
        )
    )
    best = F.slice(F.array_sort(entries), 1, n)
    return F.transform(
        best,
        lambda e: F.struct(
            e["feature"].alias("feature"),
            F.round(e["value"], 4).alias("contribution"),
            F.when(e["value"] > 0, "increases risk").otherwise("reduces risk").alias("direction"),
        ),
    )


def global_importance(df: DataFrame, terms: Sequence[LinearTerm], n: int | None = 15) -> DataFrame:
    """Mean absolute contribution per feature from one aggregate, largest first."""
    wide = df.agg(*(F.avg(F.abs(attribution(t))).alias(f"f{i}") for i, t in enumerate(terms)))
    cells = F.array(
        *(
            F.struct(
                F.lit(t.feature).alias("feature"),
                F.round(F.col(f"f{i}"), METRIC_DIGITS).alias("mean_abs_contribution"),
            )
            for i, t in enumerate(terms)
        )
    )
    ranked = (
        wide.select(F.explode(cells).alias("r"))
        .select("r.*")
        .orderBy(F.col("mean_abs_contribution").desc(), "feature")
    )
    return ranked if n is None else ranked.limit(n)


def extreme_customers(
    df: DataFrame,
    terms: Sequence[LinearTerm],
    id_col: str,
    probability: str = "p",
    n: int = 2,
    drivers: int = 6,
) -> DataFrame:
    """The n highest and n lowest scored rows with their strongest contributions."""
    p = F.col(probability)
    highest = df.orderBy(p.desc(), id_col).limit(n).withColumn("example", F.lit("highest risk"))
    lowest = df.orderBy(p.asc(), id_col).limit(n).withColumn("example", F.lit("lowest risk"))
    return highest.unionByName(lowest).select(
        "example", id_col, p.alias("probability"), top_drivers(terms, drivers).alias("top_drivers")
    )


# ------------------------------------------------------------------ fairness

# Columns checked for unequal treatment, and the least support of a slice.
FAIRNESS_SLICES = ("gender", "SeniorCitizen", "Partner", "Dependents")
MIN_POSITIVES = 5
MIN_ROWS = 30
GAP_ALERT = 0.10


def fairness(
    df: DataFrame,
    label: str,
    score: str,
    threshold: float,
    slices: Sequence[str] = FAIRNESS_SLICES,
    rows_per_slab: int = ROWS_PER_SLAB,
    levels: int | None = None,
) -> DataFrame:
    """Selection rate, recall, precision and ranking quality per slice.

    The rows are combined to counts per score before they are unfolded into one copy
    per slice, so the copies are made of histogram rows, not of the base.
    """
    hit = F.col(label) == 1
    counts = measurable(df, label, score).groupBy(*slices, F.col(score).cast("double").alias("score")).agg(
        F.count_if(hit).alias("pos"), F.count_if(~hit).alias("neg")
    )
    named = F.array(
        *(
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
            for c in slices
        )
    )
    hist = (
        counts.select("score", "pos", "neg", F.explode(named).alias("s"))
        .groupBy(F.col("s.column").alias("column"), F.col("s.value").alias("value"), "score")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .where(F.col("value").isNotNull())
    )
    by = ["column", "value"]
    curve = score_curve(hist, slab_edges(df, score, rows_per_slab, levels), by)
    metrics = evaluate_curve(curve, Costs(), threshold, None, by)
    n, positives = F.col("n"), F.col("tp") + F.col("fn")
    return metrics.where((positives >= MIN_POSITIVES) & (n >= MIN_ROWS)).select(
        F.concat("column", F.lit("="), "value").alias("slice"),
        "n",
        F.round(ratio(positives, n), METRIC_DIGITS).alias("base_rate"),
        F.round(ratio(F.col("tp") + F.col("fp"), n), METRIC_DIGITS).alias("selection_rate"),
        "recall",
        "precision",
        "roc_auc",
        "pr_auc",
    )


def fairness_gap(report: DataFrame, alert: float = GAP_ALERT) -> DataFrame:
    """Widest difference in ROC-AUC between slices."""
    gap = F.max("roc_auc") - F.min("roc_auc")
    return report.agg(F.round(gap, METRIC_DIGITS).alias("roc_auc_gap")).withColumn(
        "alert", F.col("roc_auc_gap") > alert
    )


def explained_stages(model: PipelineModel):
    """(feature stages, linear model) of a fitted pipeline; None if it is not linear."""
    last = model.stages[-1]
    return (model.stages[:-1], last) if hasattr(last, "coefficients") else None
