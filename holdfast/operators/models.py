"""Baselines, tuned model families and their selection, on pyspark.ml."""

from __future__ import annotations

import json
import math
import random
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from holdfast.operators.boosting import LeafwiseBoosting, LeafwiseModel, boost
from holdfast.operators.features import feature_stages
from holdfast.operators.metrics import evaluate
from holdfast.session import materialize

# ------------------------------------------------------------------ baselines


def _with_probability(df: DataFrame, p: Column, prediction: Column) -> DataFrame:
    return df.withColumn("probability", array_to_vector(F.array(1.0 - p, p))).withColumn(
        "prediction", prediction.cast("double")
    )


class _LabelParams(Params):
    labelCol = Param(Params._dummy(), "labelCol", "0/1 label", TypeConverters.toString)


class PriorClassifier(Estimator, _LabelParams, DefaultParamsReadable, DefaultParamsWritable):
    """Every row gets the positive rate of the training data."""

    @keyword_only
    def __init__(self, *, labelCol: str = "label"):
        super().__init__()
        self._setDefault(labelCol="label")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> PriorModel:
        share = dataset.agg(F.avg(self.getOrDefault(self.labelCol))).first()[0]
        return PriorModel(rate=float(share))


class PriorModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    rate = Param(Params._dummy(), "rate", "positive rate", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, rate: float | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        p = F.lit(self.getOrDefault(self.rate))
        return _with_probability(dataset, p, p >= 0.5)


class _RuleParams(_LabelParams):
    contractValue = Param(
        Params._dummy(), "contractValue", "flagged contract", TypeConverters.toString
    )
    tenureBelow = Param(
        Params._dummy(), "tenureBelow", "flagged below this tenure", TypeConverters.toInt
    )

    def flag(self) -> Column:
        in_contract = F.col("Contract") == self.getOrDefault(self.contractValue)
        early = F.col("tenure") < self.getOrDefault(self.tenureBelow)
        return F.coalesce(in_contract & early, F.lit(False))


class ContractRule(Estimator, _RuleParams, DefaultParamsReadable, DefaultParamsWritable):
    """The incumbent rule: monthly contract and short tenure.

    Scores are the positive rates observed in each branch of the training data; an
    empty branch takes the overall rate. The prediction is the rule itself.
    """

    @keyword_only
    def __init__(
        self,
        *,
        labelCol: str = "label",
        contractValue: str = "Month-to-month",
        tenureBelow: int = 6,
    ):
        super().__init__()
        self._setDefault(labelCol="label", contractValue="Month-to-month", tenureBelow=6)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> ContractRuleModel:
        flag, y = self.flag(), F.col(self.getOrDefault(self.labelCol))
        row = dataset.agg(
            F.avg(y).alias("overall"),
            F.avg(F.when(flag, y)).alias("flagged"),
            F.avg(F.when(~flag, y)).alias("other"),
        ).first()
        return ContractRuleModel(
            contractValue=self.getOrDefault(self.contractValue),
            tenureBelow=self.getOrDefault(self.tenureBelow),
            rateFlagged=row["overall"] if row["flagged"] is None else row["flagged"],
            rateOther=row["overall"] if row["other"] is None else row["other"],
        )


class ContractRuleModel(Model, _RuleParams, DefaultParamsReadable, DefaultParamsWritable):
    rateFlagged = Param(Params._dummy(), "rateFlagged", "rate if flagged", TypeConverters.toFloat)
    rateOther = Param(Params._dummy(), "rateOther", "rate if not", TypeConverters.toFloat)

    @keyword_only
    def __init__(
        self,
        *,
        contractValue: str | None = None,
        tenureBelow: int | None = None,
        rateFlagged: float | None = None,
        rateOther: float | None = None,
    ):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def score_column(self) -> Column:
        return F.when(self.flag(), F.lit(self.getOrDefault(self.rateFlagged))).otherwise(
            F.lit(self.getOrDefault(self.rateOther))
        )

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return _with_probability(dataset, self.score_column(), self.flag())


# ------------------------------------------------------------------ model families

# Distributions of the randomized search, per family.
SEARCH_SPACES = {
    "logistic_regression": {
        "C": ("log", 1e-3, 1e2),
        "class_weight": ("choice", ["balanced", None]),
    },
    "random_forest": {
        "n_estimators": ("int", 200, 800),
        "max_depth": ("choice", [None, 6, 10, 16, 24]),
        "min_samples_leaf": ("int", 1, 40),
        "max_features": ("choice", ["sqrt", "log2", 0.3, 0.5]),
        "class_weight": ("choice", ["balanced", "balanced_subsample", None]),
    },
    "hist_gradient_boosting": {
        "learning_rate": ("log", 0.01, 0.3),
        "max_iter": ("int", 100, 500),
        "max_leaf_nodes": ("int", 8, 64),
        "min_samples_leaf": ("int", 5, 60),
        "l2_regularization": ("log", 1e-4, 10),
        "class_weight": ("choice", ["balanced", None]),
    },
}

# Simplest family first, for the one-standard-error rule.
COMPLEXITY = {"logistic_regression": 1, "hist_gradient_boosting": 2, "random_forest": 3}

DEEPEST_TREE = 30  # the library's limit; stands in for unlimited depth


def sample_candidates(space: dict, n: int, seed: int = 42) -> list[dict]:
    """n parameter settings drawn independently from the distributions."""
    draw = random.Random(seed)

    def one(kind: str, *args):
        if kind == "log":
            low, high = args
            return math.exp(draw.uniform(math.log(low), math.log(high)))
        if kind == "int":
            low, high = args
            return draw.randrange(low, high)
        return draw.choice(args[0])

    return [{name: one(*spec) for name, spec in space.items()} for _ in range(n)]


def class_weight(df: DataFrame, label: str = "label") -> DataFrame:
    """Add ``weight`` = n / (2 x rows of the class): both classes weigh the same."""
    row = df.agg(F.count("*").alias("n"), F.sum(label).alias("pos")).first()
    n, pos = row["n"], row["pos"] or 0
    of_pos, of_neg = n / (2.0 * max(pos, 1)), n / (2.0 * max(n - pos, 1))
    return df.withColumn("weight", F.when(F.col(label) == 1, of_pos).otherwise(of_neg))


def class_weighting(params: dict) -> str | None:
    """How a candidate weighs its classes: not at all, balanced, or balanced inside each tree's sample."""
    wanted = params.get("class_weight")
    if wanted not in (None, "balanced", "balanced_subsample"):
        raise ValueError(f"unknown class_weight '{wanted}'")
    return wanted


def build_estimator(family: str, params: dict, rows: int, seed: int = 42) -> Estimator:
    """The pyspark.ml estimator of one candidate, on ``features``/``label``/``weight``.

    The penalty of the logistic family is stated per summed loss; the library averages
    the loss, hence the division by the number of training rows. Features are already
    scaled, so the library's own standardization is off.
    """
    weighted = {"weightCol": "weight"} if class_weighting(params) else {}
    if family == "logistic_regression":
        return LogisticRegression(
            regParam=1.0 / (params["C"] * rows),
            elasticNetParam=0.0,
            standardization=False,
            maxIter=params.get("max_iter", 500),
            **weighted,
        )
    if family == "random_forest":
        features = params.get("max_features", "sqrt")
        return RandomForestClassifier(
            numTrees=params["n_estimators"],
            maxDepth=params.get("max_depth") or DEEPEST_TREE,
            minInstancesPerNode=params.get("min_samples_leaf", 1),
            featureSubsetStrategy=str(features),
            seed=seed,
            **weighted,
        )
    if family == "hist_gradient_boosting":
        return LeafwiseBoosting(
            learningRate=params["learning_rate"],
            maxIter=params["max_iter"],
            maxLeafNodes=params["max_leaf_nodes"],
            minSamplesLeaf=params["min_samples_leaf"],
            l2=params.get("l2_regularization", 0.0),
            **weighted,
        )
    raise ValueError(f"unknown family '{family}'")


def positive_probability(scored: DataFrame, name: str = "p") -> DataFrame:
    """P(positive) of a scored frame as a plain double column."""
    return scored.withColumn(name, vector_to_array("probability")[1])


ROWS_PER_FIT_PARTITION = 100_000
#: Folds of a search that are cached and fitted at a time.
FOLDS_AT_ONCE = 3


def for_fitting(df: DataFrame, rows: int) -> DataFrame:
    """Few, even partitions: an iterative fit pays for each of them in every iteration.

    A shuffle, so that the scan and the preparation before it keep their own parallelism.
    """
    return df.repartition(max(1, -(-rows // ROWS_PER_FIT_PARTITION)))


def average_precisions(scored: DataFrame, by: Sequence[str], rows: int) -> DataFrame:
    """Average precision, unrounded, of every (model, fold, part) group from one histogram."""
    found = evaluate(scored, "label", "p", by=by, levels=rows, digits=None)
    return found.select(*by, "pr_auc")


def scores_of_many(models: dict[tuple, Model], df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep, scores``: the probabilities of all models for a row, as one array in the order of ``models``.

    One pass over the rows, however many models there are.
    """
    scored = df
    for i, model in enumerate(models.values()):
        extra = [c for c in ("rawPrediction", "probability", "prediction") if c in scored.columns]
        scored = positive_probability(model.transform(scored.drop(*extra)), f"_p{i}")
    return scored.select(*keep, F.array(*(F.col(f"_p{i}") for i in range(len(models)))).alias("scores"))


def unfolded(scored: DataFrame, fold: int) -> DataFrame:
    """One row per (row, model), ``at`` being the model's place in the array of scores; counted, not stored."""
    each = scored.select("held_out", "label", F.posexplode("scores").alias("at", "p"))
    return each.withColumn("fold", F.lit(fold))


HISTORY_SCHEMA = (
    "family string, candidate int, fold int, params map<string,string>, "
    "train_ap double, test_ap double"
)


def _history(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), HISTORY_SCHEMA)


def _paired(each: DataFrame, rows: int) -> dict[tuple, tuple[float, float]]:
    """(fold, at) -> (train, test) average precision; one small collect.

    Groups are numbers, not names: a score that few rows share makes about as many groups as rows.
    """
    aps = average_precisions(each, ["fold", "at", "held_out"], rows)
    found = {(r["fold"], r["at"], r["held_out"]): r["pr_auc"] for r in aps.collect()}
    return {(fold, at): (found.get((fold, at, False)), found.get((fold, at, True))) for fold, at, _ in found}


def _with_held_out(df: DataFrame, fold_col: str, fold: int) -> DataFrame:
    return df.withColumn("held_out", F.coalesce(F.col(fold_col) == fold, F.lit(False)))


def cross_validate(
    estimators: dict[str, Estimator], df: DataFrame, fold_col: str = "fold", k: int = 5
) -> DataFrame:
    """Average precision of whole estimators (raw records in) on each held-out fold.

    All fitted models are scored and evaluated together, grouped by model and fold.
    """
    scored = None
    for fold in range(k):
        train = df.where(F.col(fold_col) != fold)
        models = {(name, 0): e.fit(train) for name, e in estimators.items()}
        parted = _with_held_out(df, fold_col, fold)
        one = unfolded(scores_of_many(models, parted, ["held_out", "label"]), fold)
        scored = one if scored is None else scored.unionByName(one)
    pairs = _paired(scored, df.count() * k * len(estimators))
    names = list(estimators)
    rows = sorted((names[at], 0, fold, {}, *pair) for (fold, at), pair in pairs.items())
    return _history(df.sparkSession, rows)


def fit_candidates(
    weighted: DataFrame, rows: int, tasks: Sequence[tuple], parallelism: int, seed: int
) -> dict[tuple, Model]:
    """(family, index) -> model of every candidate, on ``features``, ``label`` and ``weight``.

    All boosting settings grow together and share each pass over the rows; the other
    families are fitted one candidate at a time, as concurrent Spark jobs.
    """
    boosted = [t for t in tasks if t[0] == "hist_gradient_boosting"]
    single = [t for t in tasks if t[0] != "hist_gradient_boosting"]

    def fit(task):
        family, _, params = task
        return build_estimator(family, params, rows, seed).fit(weighted)

    with ThreadPoolExecutor(parallelism) as pool:
        models = dict(zip([t[:2] for t in single], pool.map(fit, single), strict=True))
    if boosted:
        factors = {
            (r["y"] == 1): r["w"]
            for r in weighted.groupBy((F.col("label") == 1).cast("int").alias("y"))
            .agg(F.max("weight").alias("w"))
            .collect()
        }
        balanced = (factors.get(False, 1.0), factors.get(True, 1.0))
        runs = [
            replace(
                build_estimator(family, params, rows, seed).run(),
                factors=balanced if class_weighting(params) else (1.0, 1.0),
            )
            for family, _, params in boosted
        ]
        learned = boost(weighted, runs)
        models |= {t[:2]: LeafwiseModel(learned=json.dumps(m)) for t, m in zip(boosted, learned)}
    return models


def randomized_search(
    df: DataFrame,
    families: dict[str, Sequence[dict]],
    fold_col: str = "fold",
    k: int = 5,
    parallelism: int = 4,
    keep: Sequence[str] = ("customerID", "label"),
    seed: int = 42,
) -> DataFrame:
    """History of every candidate on every fold, preprocessing refitted per fold.

    The columns of the features are made once. The preparation depends on the fold only, so it is fitted
    once per fold and its result shared by all candidates. A fold's rows are scored by all candidates in one pass,
    as an array, which is stored, and evaluated together; only two numbers per candidate come back. Up to
    ``FOLDS_AT_ONCE`` folds run side by side: a fit is many short jobs that leave cores free.
    """
    tasks = [
        (family, i, params)
        for family, candidates in families.items()
        for i, params in enumerate(candidates)
    ]
    rows_in = df.count()
    domain, *learned = feature_stages([*keep, fold_col])
    flat = materialize(domain.transform(df), "domain")

    def search(fold: int) -> list[tuple]:
        stages = Pipeline(stages=learned).fit(flat.where(F.col(fold_col) != fold))
        matrix = for_fitting(stages.transform(flat), rows_in).persist()
        weighted = class_weight(matrix.where(F.col(fold_col) != fold)).persist()
        models = fit_candidates(weighted, weighted.count(), tasks, parallelism, seed)
        weighted.unpersist()
        parted = _with_held_out(matrix, fold_col, fold)
        # the edges of the slabs and the histogram both read the scores
        scored = materialize(scores_of_many(models, parted, ["held_out", "label"]), "scores")
        matrix.unpersist()
        pairs = _paired(unfolded(scored, fold), rows_in * len(tasks))
        at = {key: i for i, key in enumerate(models)}
        return [
            (family, i, fold, {name: str(v) for name, v in params.items()}, *pairs[(fold, at[family, i])])
            for family, i, params in tasks
        ]

    with ThreadPoolExecutor(FOLDS_AT_ONCE) as pool:
        rows = [row for found in pool.map(search, range(k)) for row in found]
    return _history(df.sparkSession, rows)


def summarize_history(history: DataFrame) -> DataFrame:
    """Mean and population deviation over folds per candidate, and the train gap."""
    return history.groupBy("family", "candidate").agg(
        F.avg("test_ap").alias("mean_ap"),
        F.stddev_pop("test_ap").alias("std_ap"),
        F.avg("train_ap").alias("mean_train_ap"),
        F.count("*").alias("folds"),
    )


def one_se_select(history: DataFrame, complexity: dict[str, int] = COMPLEXITY) -> DataFrame:
    """One row: the simplest family whose best candidate is within one standard error.

    Works on a search history, one row per candidate and fold.
    """
    unknown = F.concat(F.lit("no complexity is given for family "), F.col("family"))
    rank = F.raise_error(unknown).cast("int")
    for family, order in complexity.items():
        rank = F.when(F.col("family") == family, order).otherwise(rank)
    best_of_family = Window.partitionBy("family").orderBy(F.col("mean_ap").desc(), "candidate")
    best = (
        summarize_history(history)
        .withColumn("_nth", F.row_number().over(best_of_family))
        .where(F.col("_nth") == 1)
        .withColumn("_complexity", rank)
    )
    top = F.max_by(
        F.struct("family", "mean_ap", "std_ap", "folds"), F.struct("mean_ap", -F.col("_complexity"))
    ).over(Window.partitionBy())
    ranked = best.withColumn("t", top).withColumn(
        "se", F.col("t.std_ap") / F.sqrt(F.col("t.folds").cast("double"))
    )
    within = ranked.where(F.col("mean_ap") >= F.col("t.mean_ap") - F.col("se"))
    chosen = within.orderBy("_complexity", "family").limit(1)
    return chosen.select(
        F.col("family").alias("selected"),
        F.col("candidate"),
        F.round("mean_ap", 6).alias("selected_ap"),
        F.col("t.family").alias("top_family"),
        F.round("t.mean_ap", 6).alias("top_ap"),
        F.round("se", 6).alias("standard_error"),
        F.when(F.col("family") == F.col("t.family"), "best mean score")
        .otherwise("simpler than the best and within one standard error of it")
        .alias("reason"),
    )


