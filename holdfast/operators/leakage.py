"""What balancing before the split costs: both orders of the same two steps."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions.numeric import lenient_number, ratio
from holdfast.operators.features import dummies
from holdfast.operators.forest import forest_scores
from holdfast.operators.metrics import evaluate
from holdfast.operators.split import oversample, seen_in_training, stratified_split
from holdfast.session import materialize

# Inputs of the audit model.
NUMERIC = ("tenure", "MonthlyCharges", "TotalCharges", "SeniorCitizen")
CATEGORICAL = ("Contract", "InternetService", "PaymentMethod", "PaperlessBilling")


def audit_features(raw: DataFrame, id_col: str, target: str, positive: str) -> DataFrame:
    """Numeric columns plus first-level-dropped dummies; nothing is fitted on labels."""
    prepared = raw.withColumn("TotalCharges", lenient_number(F.col("TotalCharges")))
    numeric = [F.col(c).cast("double").alias(c) for c in NUMERIC]
    label = (F.col(target) == positive).cast("int").alias("label")
    return dummies(prepared, CATEGORICAL, keep=[id_col, label, *numeric])


def balance_then_split(df: DataFrame, id_col: str, label: str = "label", seed: int = 42):
    """The mistake: copies of one customer land on both sides of the split."""
    copies = oversample(df, label, id_col, seed)
    row_key = F.concat_ws("#", F.col(id_col), F.col("draw").cast("string"))
    keyed = copies.withColumn("row_key", row_key)
    return stratified_split(keyed, "row_key", label, test=0.2, val=0.0, seed=seed)


def split_then_balance(df: DataFrame, id_col: str, label: str = "label", seed: int = 42):
    """The right order: only training rows are copied."""
    parts = stratified_split(df, id_col, label, test=0.2, val=0.0, seed=seed)
    train = oversample(parts.where(F.col("split") == "train"), label, id_col, seed)
    test = parts.where(F.col("split") == "test")
    return train.unionByName(test.withColumn("draw", F.lit(None).cast("bigint")))


def _forest_scores(df: DataFrame, trees: int, depth: int, seed: int) -> DataFrame:
    names = [c for c in df.columns if c not in ("customerID", "label", "draw", "row_key", "split")]
    matrix = VectorAssembler(inputCols=names, outputCol="features").transform(df)
    matrix = matrix.select("label", "split", vector_to_array("features").alias("x"))
    scored = forest_scores(matrix, "x", "label", "split", trees, depth, seed)
    return evaluate(scored, "label", "p").select("roc_auc", "pr_auc").first()


def leakage_audit(
    raw: DataFrame,
    id_col: str = "customerID",
    target: str = "Churn",
    positive: str = "Yes",
    trees: int = 200,
    depth: int = 30,
    seed: int = 42,
) -> DataFrame:
    """One row: contamination of the leaky split and the scores of both arms."""
    # both arms read these rows several times, so they are stored once
    features = materialize(audit_features(raw, id_col, target, positive), "audit-features")
    leaky_rows = materialize(balance_then_split(features, id_col, seed=seed), "leaky-rows")
    honest = _forest_scores(split_then_balance(features, id_col, seed=seed), trees, depth, seed)
    leaky = _forest_scores(leaky_rows, trees, depth, seed)

    def inflation(name: str):
        value = ratio(F.lit(leaky[name]), F.lit(honest[name])) - 1
        return F.round(value * 100.0, 1)

    return seen_in_training(leaky_rows, id_col).select(
        "customers_in_both_splits",
        "share_of_test_seen_in_training",
        F.lit(leaky["roc_auc"]).alias("leaky_roc_auc"),
        F.lit(leaky["pr_auc"]).alias("leaky_pr_auc"),
        F.lit(honest["roc_auc"]).alias("honest_roc_auc"),
        F.lit(honest["pr_auc"]).alias("honest_pr_auc"),
        inflation("roc_auc").alias("roc_auc_inflation_pct"),
        inflation("pr_auc").alias("pr_auc_inflation_pct"),
    )
