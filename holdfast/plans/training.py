"""Split, search, select, fit and evaluate once on the sealed part."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.operators import metrics as M
from holdfast.operators.decision import operating_threshold, sensitivity
from holdfast.operators.explain import LinearTerm, explained_stages, feature_means, linear_terms
from holdfast.operators.features import feature_stages, with_label
from holdfast.operators.models import (
    COMPLEXITY,
    SEARCH_SPACES,
    ContractRule,
    build_estimator,
    class_weight,
    for_fitting,
    one_se_select,
    positive_probability,
    randomized_search,
    sample_candidates,
    summarize_history,
)
from holdfast.operators.split import require_sealed, stratified_folds, stratified_split
from holdfast.session import materialize
from holdfast.sources import readers, writers
from holdfast.sources.contract import TELCO, Contract


@dataclass
class TrainedModel:
    family: str
    model: PipelineModel
    feature_names: list[str]
    terms: list[LinearTerm] | None

    @property
    def means(self) -> dict[str, float] | None:
        return {t.feature: t.mean for t in self.terms} if self.terms else None


def labelled_split(raw: DataFrame, contract: Contract = TELCO, seed: int = 42) -> DataFrame:
    """Raw records with label and split, before anything is learned from them."""
    parts = stratified_split(raw, contract.id_column, contract.target, seed=seed)
    return with_label(parts, contract)


def fit_family(
    train: DataFrame, family: str, params: dict, contract: Contract = TELCO, seed: int = 42
) -> TrainedModel:
    """Fit preparation and model on training rows; the result takes raw records."""
    # the feature columns are read by every scan of the fit, so they are made once
    domain, *learned = feature_stages([contract.id_column, "label"])
    flat = materialize(domain.transform(train), "domain")
    stages = Pipeline(stages=learned).fit(flat)
    rows = flat.count()
    weighted = class_weight(for_fitting(stages.transform(flat), rows)).persist()
    model = build_estimator(family, params, rows, seed).fit(weighted)
    weighted.unpersist()
    prepare = stages.stages[0]
    names = prepare.feature_names
    fitted = PipelineModel(stages=[domain, *stages.stages, model])
    terms = None
    if explained_stages(fitted):
        terms = linear_terms(model, names, feature_means(prepare.transform(flat), names))
    return TrainedModel(family, fitted, names, terms)


def search_space(n_iter: int = 30, seed: int = 42) -> dict[str, list[dict]]:
    """``n_iter`` settings of each family, drawn from the published distributions."""
    return {name: sample_candidates(space, n_iter, seed) for name, space in SEARCH_SPACES.items()}


def search_and_select(
    train: DataFrame,
    families: dict[str, Sequence[dict]] | None = None,
    contract: Contract = TELCO,
    k: int = 5,
    seed: int = 42,
    complexity: dict[str, int] = COMPLEXITY,
) -> tuple[DataFrame, DataFrame]:
    """(history, one-row selection) of a randomized search on the training rows.

    Without ``families`` the candidates are drawn by :func:`search_space`.
    """
    families = search_space(seed=seed) if families is None else families
    # read by every fit, so it is stored once instead of being recomputed
    folded = materialize(stratified_folds(train, contract.id_column, "label", k, seed), "folds")
    keep = [contract.id_column, "label"]
    history = randomized_search(folded, families, k=k, keep=keep, seed=seed)
    return history, one_se_select(history, complexity)


def final_evaluation(
    parts: DataFrame, trained: TrainedModel, costs: M.Costs = M.Costs()
) -> dict[str, DataFrame]:
    """Threshold from validation, then one look at the test part next to the old rule.

    ``parts`` holds labelled raw records with their split; each part is filtered before
    it is scored, so nothing has to be joined back.
    """

    def part(name: str) -> DataFrame:
        return parts.where(F.col("split") == name)

    def scored(name: str) -> DataFrame:
        return positive_probability(trained.model.transform(part(name))).select("label", "p")

    population = parts.count()
    val, test = scored("val"), scored("test")
    sweep = M.threshold_sweep(val, "label", "p", costs)
    best = operating_threshold(sweep)
    chosen = best.first()["operating_threshold"]
    rule = ContractRule().fit(part("train"))
    by_rule = part("test").select("label", rule.score_column().alias("p"))

    def row(df: DataFrame, name: str) -> DataFrame:
        found = M.evaluate(df, "label", "p", costs, chosen, population)
        return found.withColumn("model", F.lit(name))

    table = row(val, "validation").unionByName(row(by_rule, "rule on test"))
    table = table.unionByName(row(test, "test"))
    return {
        "threshold": best,
        "sweep": sweep,
        "metrics": table,
        "sensitivity": sensitivity(M.threshold_counts(val, "label", "p"), costs),
        "acceptance": M.acceptance(table.where(F.col("model") == "test")),
        "uplift": M.uplift(table, "model", "test", "rule on test"),
    }


def split_job(raw: DataFrame, base: str, contract: Contract = TELCO, seed: int = 42) -> DataFrame:
    """Splits and their seal below ``base``; the manifest. Refuses to touch an existing split."""
    parts = stratified_split(raw, contract.id_column, contract.target, seed=seed)
    return writers.save_splits(parts, base, contract, seed)


def training_job(
    raw: DataFrame,
    out: str,
    families: dict[str, Sequence[dict]] | None = None,
    contract: Contract = TELCO,
    costs: M.Costs = M.Costs(),
    k: int = 5,
    seed: int = 42,
) -> dict:
    """Raw customers to a published model: :func:`split_job`, then :func:`train_on_split`."""
    split_job(raw, out, contract, seed)
    return train_on_split(raw.sparkSession, out, out, families, contract, costs, k, seed)


def train_on_split(
    spark: SparkSession,
    base: str,
    out: str,
    families: dict[str, Sequence[dict]] | None = None,
    contract: Contract = TELCO,
    costs: M.Costs = M.Costs(),
    k: int = 5,
    seed: int = 42,
) -> dict:
    """Train on the split stored in ``base``; every artifact lands below ``out``.

    The split is read, and verified against the stored manifest before anything is learned
    from it and again before its test part is read, once. Search history, one logged run per
    family, the selected pipeline with metadata and explanation background, and the
    final report are written. It can be repeated on the same split: runs
    accumulate, and the selected one takes the next version.
    """
    manifest = readers.read_manifest(spark, base)
    stored = readers.read_splits(spark, base, contract)
    require_sealed(stored, manifest, contract.id_column)
    parts = with_label(stored, contract)
    train = parts.where(F.col("split") == "train").drop("split")
    val = parts.where(F.col("split") == "val")
    population = parts.count()
    families = search_space(seed=seed) if families is None else families

    history, selection = search_and_select(train, families, contract, k, seed)
    writers.append_history(history, f"{out}/history")
    chosen = selection.first()
    best_of = {
        r["family"]: r
        for r in summarize_history(history)
        .groupBy("family")
        .agg(F.max_by(F.struct("candidate", "mean_ap", "std_ap"), "mean_ap").alias("best"))
        .select("family", "best.*")
        .collect()
    }
    fitted = {}
    for family, candidates in families.items():
        best = best_of[family]
        index = chosen["candidate"] if family == chosen["selected"] else best["candidate"]
        params = candidates[index]
        trained = fit_family(train, family, params, contract, seed)
        on_val = positive_probability(trained.model.transform(val))
        found = M.evaluate(on_val, "label", "p", costs, None, population).first().asDict()
        scores = {f"val_{m}": found[m] for m in ("pr_auc", "roc_auc", "brier", "recall")}
        scores |= {"cv_pr_auc": best["mean_ap"], "cv_pr_auc_std": best["std_ap"]}
        scores["val_value_per_1000"] = found["value_per_1000"]
        writers.log_run(
            spark, f"{out}/runs", family, params, scores,
            tags={"seed": seed, "folds": k}, register=family == chosen["selected"],
        )
        fitted[family] = (trained, params)

    trained, params = fitted[chosen["selected"]]
    require_sealed(parts, manifest, contract.id_column)
    evaluation = final_evaluation(parts, trained, costs)
    threshold = evaluation["threshold"].first()["operating_threshold"]
    facts = {
        "family": trained.family,
        "reason": chosen["reason"],
        "cv_pr_auc": chosen["selected_ap"],
        "decision_threshold": threshold,
        "features": len(trained.feature_names),
        "seed": seed,
        **{f"param_{name}": value for name, value in params.items()},
    }
    writers.save_model(trained.model, out, spark, facts, trained.means)
    for name in ("metrics", "sensitivity", "acceptance", "uplift"):
        writers.write_report(evaluation[name], f"{out}/report/{name}")
    return facts
