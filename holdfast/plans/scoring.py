"""Raw records to decisions: validate, score, explain, decide, rank."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.operators.decision import decide, worklist
from holdfast.operators.explain import (
    LinearTerm,
    explained_stages,
    feature_means,
    linear_terms,
    top_drivers,
)
from holdfast.operators.features import PrepareModel, coerce_records
from holdfast.operators.metrics import Costs
from holdfast.operators.models import positive_probability
from holdfast.operators.quality import require_rows, split_valid
from holdfast.sources.contract import TELCO, Contract
from holdfast.sources.writers import load_model

@dataclass
class Scorer:
    """A published model with what serving needs: weights, threshold, provenance."""

    model: PipelineModel
    terms: list[LinearTerm] | None
    threshold: float
    facts: dict

    def score(self, records: DataFrame, **options) -> DataFrame:
        return score_records(records, self.model, self.terms, threshold=self.threshold, **options)


def load_scorer(
    spark: SparkSession, path: str, train: DataFrame | None = None, costs: Costs = Costs()
) -> Scorer:
    """Load a published model.

    The threshold is the one found in evaluation, else the break-even of the costs.
    Explanations use the stored background means; if there are none they are taken from
    ``train`` (raw records), and without either, records are scored unexplained.
    """
    model, facts, means = load_model(spark, path)
    found = explained_stages(model)
    terms = None
    if found:
        stages, linear = found
        names = stages[1].feature_names
        if not means and train is not None:
            flat = train
            for stage in stages[:2]:
                flat = stage.transform(flat)
            means = feature_means(flat, names)
        if means:
            terms = linear_terms(linear, names, means)
    threshold = float(facts.get("decision_threshold") or costs.break_even)
    return Scorer(model, terms, threshold, facts)


NO_DRIVERS = "array<struct<feature:string,contribution:double,direction:string>>"


def _drivers(terms: Sequence[LinearTerm] | None, n: int) -> Column:
    """Explanations are optional: without a linear model the array is empty."""
    return top_drivers(terms, n) if terms else F.array().cast(NO_DRIVERS)


def score_records(
    records: DataFrame,
    model: PipelineModel,
    terms: Sequence[LinearTerm] | None = None,
    id_col: str = "customerID",
    costs: Costs = Costs(),
    threshold: float | None = None,
    drivers: int = 5,
) -> DataFrame:
    """Decision record per raw record. Row-wise, so it runs unchanged on a stream.

    Takes any fitted pipeline whose last stage gives probabilities: a tuned model, the
    incumbent rule or the prior. Stages that name the columns they keep are told to keep the
    id and the drivers. Drivers are read between preparation and assembly, where the
    features still have columns of their own.
    """
    scored = records
    for stage in model.stages:
        if stage.hasParam("keep"):
            carried = [c for c in (id_col, "top_drivers") if c in scored.columns]
            stage = stage.copy({stage.keep: carried})
        scored = stage.transform(scored)
        if terms and isinstance(stage, PrepareModel):
            scored = scored.select("*", _drivers(terms, drivers).alias("top_drivers"))
    if "top_drivers" not in scored.columns:
        scored = scored.withColumn("top_drivers", _drivers(None, drivers))
    decided = decide(positive_probability(scored), "p", costs, threshold)
    return decided.select(
        id_col,
        "churn_probability",
        "risk_tier",
        "should_contact",
        "decision_threshold",
        "expected_value_of_contact",
        "top_drivers",
    )


def ranked_batch(
    records: DataFrame,
    model: PipelineModel,
    contract: Contract = TELCO,
    coerce: bool = False,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """(ranked worklist of the valid records, quarantine of the others).

    With ``coerce``, loosely typed records are cast first; without it they must already
    meet the record contract. An empty batch is refused.
    """
    require_rows(records)
    valid, quarantine = split_valid(coerce_records(records) if coerce else records, contract)
    scored = score_records(valid, model, id_col=contract.id_column, **options)
    return worklist(scored, contract.id_column), quarantine
