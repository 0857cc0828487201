"""One callable per operator of the inventory, each over whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.operators import decision as D
from holdfast.operators import explain as X
from holdfast.operators import features as FE
from holdfast.operators import leakage as L
from holdfast.operators import marts, quality
from holdfast.operators import metrics as M
from holdfast.operators import models as E
from holdfast.operators import profile as P
from holdfast.operators import split as S
from holdfast.operators.boosting import LeafwiseBoosting
from holdfast.operators.levels import fit_levels_table
from holdfast.operators.silver import silver_customers
from holdfast.plans import training, warehouse
from holdfast.plans.scoring import load_scorer, ranked_batch, score_records
from holdfast.session import materialize, scratch_path
from holdfast.sources import commits, readers, writers
from holdfast.sources.contract import ADDON_COLUMNS, TELCO
from holdfast.sources.testtables import (
    scored_documents,
    scored_lineitems,
    subscribers,
    table,
)
from holdfast.streaming.score import read_record_stream, score_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType)


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and integers as longs, so engines compare like with like."""

    def cast(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            return c.cast("double").alias(field.name)
        return c.cast("bigint").alias(field.name) if isinstance(field.dataType, _WHOLE) else c

    return df.select(*(cast(f) for f in df.schema.fields))


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = lambda spark, sf_dir: plain(fn(spark, sf_dir))
    return fn


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_customers(subscribers(spark, sf_dir))


def _hit():
    return F.col(TELCO.target) == TELCO.positive


# the rule points add up to whole numbers from -10 to 110
RULE_LEVELS = 121


def scored_subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Churn labels against the rule score as a probability: heavily tied."""
    v = _silver(spark, sf_dir).withColumn("risk_score", marts.risk_score())
    return v.select(
        "customer_id",
        F.col("has_churned").cast("int").alias("label"),
        ((F.col("risk_score") + 10).cast("double") / F.lit(120.0)).alias("score"),
        "gender",
        "is_senior",
        "has_partner",
        "has_dependents",
        "contract_type",
    )


def _splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.stratified_split(subscribers(spark, sf_dir), TELCO.id_column, TELCO.target)


# ------------------------------------------------------------------ layers and marts


@query
def silver(spark, sf_dir):
    return _silver(spark, sf_dir)


@query
def kpi_summary(spark, sf_dir):
    return marts.kpi_summary(_silver(spark, sf_dir))


@query
def churn_by_segment(spark, sf_dir):
    return marts.churn_by_segment(_silver(spark, sf_dir))


@query
def top_segments(spark, sf_dir):
    return marts.top_segments(marts.churn_by_segment(_silver(spark, sf_dir)))


@query
def retention_curve(spark, sf_dir):
    return marts.retention_curve(_silver(spark, sf_dir))


@query
def revenue_at_risk(spark, sf_dir):
    return marts.revenue_at_risk(_silver(spark, sf_dir))


@query
def addon_paradox(spark, sf_dir):
    return marts.addon_paradox(_silver(spark, sf_dir))


@query
def customer_risk(spark, sf_dir):
    return marts.risk_mart(_silver(spark, sf_dir))


@query
def decile_summary(spark, sf_dir):
    return marts.decile_summary(marts.risk_mart(_silver(spark, sf_dir)))


@query
def detail_extract(spark, sf_dir):
    return marts.detail_extract(_silver(spark, sf_dir))


@query
def warehouse_sql(spark, sf_dir):
    """Layers registered as views, then ad-hoc SQL over them."""
    warehouse.build_layers(spark, subscribers(spark, sf_dir))
    return readers.ask(
        spark,
        "SELECT contract_type, count(*) AS customers, sum(annual_revenue) AS annual_revenue "
        "FROM v_customers WHERE has_churned GROUP BY contract_type",
    )


# What the report query shows of each section: the item it is about, and its measures.
REPORT = {
    "kpis": (
        (),
        ("total_customers", "churn_rate", "monthly_revenue_lost", "avg_tenure_churned"),
    ),
    "segments": (
        ("contract_type", "internet_service"),
        ("customers", "churn_rate", "annual_revenue_at_risk", "churn_index"),
    ),
    "retention": (("tenure_band",), ("customers", "churn_rate", "retention_rate", "pct_of_base")),
    "revenue": (
        ("contract_type", "payment_method"),
        ("customers", "annual_revenue_lost", "risk_rank", "cumulative_pct_of_loss"),
    ),
    "paradox": (
        ("addon_service_count",),
        ("customers_all", "churn_rate_all", "customers_with_internet"),
    ),
    "deciles": (("risk_decile",), ("customers", "actual_churn_rate", "annual_revenue")),
}


@query
def warehouse_report(spark, sf_dir):
    """All six sections of the report job in one table, a row per item and measure."""
    warehouse.build_layers(spark, subscribers(spark, sf_dir))
    shown = []
    for section, df in warehouse.report(spark).items():
        item, measures = REPORT[section]
        cells = F.array(
            *(
                F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("amount"))
                for m in measures
            )
        )
        about = F.concat_ws(" / ", *(F.col(c).cast("string") for c in item))
        shown.append(
            df.select(
                F.lit(section).alias("section"),
                (about if item else F.lit("all")).alias("item"),
                F.inline(cells),
            )
        )
    return reduce(DataFrame.unionByName, shown)


# ------------------------------------------------------------------ contract


#: A row count that the table does not have, so that the rule has something to say.
EXPECTED_ROWS = 1_000


@query
def contract_report(spark, sf_dir):
    return quality.check_table(subscribers(spark, sf_dir), expected_rows=EXPECTED_ROWS)


@query
def stray_fields(spark, sf_dir):
    """Fields of JSON records that the contract does not know; every fifth has one."""
    raw = subscribers(spark, sf_dir)
    stray = F.when(F.col("customerID").cast("bigint") % 5 == 0, F.col("tenure"))
    lines = raw.select(
        "customerID", F.to_json(F.struct(*raw.columns, stray.alias("Tenure"))).alias("value")
    )
    unknown = quality.unknown_json_fields(F.col("value"))
    return lines.select("customerID", F.concat_ws(",", unknown).alias("unknown"))


@query
def constraint_report(spark, sf_dir):
    strict = TELCO.narrowed(
        tenure={"low": 3}, Contract={"allowed": ("Month-to-month", "One year")}
    )
    return quality.constraint_report(subscribers(spark, sf_dir), strict)


@query
def null_blank_report(spark, sf_dir):
    return quality.null_blank_report(subscribers(spark, sf_dir))


@query
def duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), "l_orderkey")


@query
def unexpected_values(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return quality.unexpected_values(events, "event_type", ("click", "view"))


@query
def target_balance(spark, sf_dir):
    return quality.class_balance_of(subscribers(spark, sf_dir))


NARROW = TELCO.narrowed(
    tenure={"high": 60},
    MonthlyCharges={"high": 100},
    TotalCharges={"high": 5000},
    InternetService={"allowed": ("DSL", "Fiber optic")},
)


@query
def quarantine(spark, sf_dir):
    _, rejected = quality.split_valid(subscribers(spark, sf_dir), NARROW)
    return rejected.select("customerID", F.concat_ws(",", "errors").alias("errors"))


@query
def accepted_records(spark, sf_dir):
    accepted, _ = quality.split_valid(subscribers(spark, sf_dir), NARROW)
    return accepted.select("customerID", "tenure", "MonthlyCharges")


@query
def rate_reconciliation(spark, sf_dir):
    raw = subscribers(spark, sf_dir)
    return quality.rate_reconciliation(raw, silver_customers(raw))


@query
def leftover_categories(spark, sf_dir):
    return quality.leftover_categories(_silver(spark, sf_dir))


@query
def uniqueness(spark, sf_dir):
    return quality.uniqueness(subscribers(spark, sf_dir), "customerID")


@query
def sanity_checks(spark, sf_dir):
    return quality.sanity_checks(_silver(spark, sf_dir))


# ------------------------------------------------------------------ splits and samples


@query
def split_assignment(spark, sf_dir):
    return _splits(spark, sf_dir).select("customerID", "split")


@query
def split_manifest(spark, sf_dir):
    return S.split_manifest(_splits(spark, sf_dir), "customerID", "Churn", "Yes")


@query
def split_overlap(spark, sf_dir):
    return S.overlap_report(_splits(spark, sf_dir), "customerID", "split")


@query
def seal_check(spark, sf_dir):
    """Splits stored with their manifest, read back, and compared with the seal."""
    base = scratch_path(spark, "splits")
    manifest = writers.save_splits(_splits(spark, sf_dir), base)
    parts = [readers.read_split(spark, base, name) for name in readers.SPLITS]
    stored = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return S.seal_check(stored, manifest, "customerID")


@query
def broken_seal(spark, sf_dir):
    """The same check after one customer of the test part has left."""
    parts = _splits(spark, sf_dir)
    base = scratch_path(spark, "splits")
    manifest = writers.save_splits(parts, base)
    stored = readers.read_splits(spark, base)
    gone = stored.where("split = 'test'").agg(F.min("customerID")).scalar()
    return S.seal_check(stored.where(F.col("customerID") != gone), manifest, "customerID").select(
        "split", "sealed"
    )


@query
def split_tree(spark, sf_dir):
    """Roots of the trees of digests that seal the splits, checked after a shuffle of the rows."""
    parts = _splits(spark, sf_dir)
    manifest = S.split_manifest(parts, "customerID", "Churn", "Yes", mode=S.MERKLE_MODE)
    checked = S.seal_check(parts.repartition(5), manifest, "customerID")
    return manifest.join(checked.select("split", "sealed"), "split")


@query
def split_tree_difference(spark, sf_dir):
    """The blocks that tell where a customer has left the test part and another came into training."""
    parts = _splits(spark, sf_dir)
    gone = parts.where("split = 'test'").agg(F.min("customerID")).scalar()
    left = parts.where(F.col("customerID") != gone).select("customerID", "split")
    came = parts.limit(1).select(F.lit("a new one").alias("customerID"), F.lit("train").alias("split"))
    blocks = (S.merkle_blocks(p, "customerID", "split") for p in (left.unionByName(came), parts))
    return S.merkle_difference(*blocks)


@query
def split_missing_ids(spark, sf_dir):
    """Sizes of the split when a part of the customers has no id."""
    key = F.col("customerID").cast("bigint")
    raw = subscribers(spark, sf_dir).withColumn(
        "customerID", F.when(key % 7 != 0, F.col("customerID"))
    )
    parts = S.stratified_split(raw, "customerID", "Churn")
    return parts.groupBy("Churn", "split").agg(F.count("*").alias("rows"))


@query
def folds(spark, sf_dir):
    found = S.stratified_folds(subscribers(spark, sf_dir), "customerID", "Churn")
    return found.select("customerID", "Churn", "fold")


@query
def sample_rows(spark, sf_dir):
    return S.sample_n(subscribers(spark, sf_dir), "customerID", 300).select("customerID")


@query
def oversample(spark, sf_dir):
    labelled = subscribers(spark, sf_dir).select("customerID", _hit().cast("int").alias("label"))
    return S.oversample(labelled, "label", "customerID")


@query
def leakage_overlap(spark, sf_dir):
    labelled = subscribers(spark, sf_dir).select("customerID", _hit().cast("int").alias("label"))
    return S.seen_in_training(L.balance_then_split(labelled, "customerID"), "customerID")


# ------------------------------------------------------------------ features


@query
def domain_features(spark, sf_dir):
    return FE.domain_features(subscribers(spark, sf_dir), keep=["customerID"])


@query
def labelled_records(spark, sf_dir):
    labelled = FE.with_label(subscribers(spark, sf_dir))
    return FE.widen_integers(labelled).select("customerID", "tenure", "SeniorCitizen", "label")


@query
def dummies(spark, sf_dir):
    return FE.dummies(subscribers(spark, sf_dir), L.CATEGORICAL, keep=["customerID"])


@query
def prepare_stats(spark, sf_dir):
    """What the preparation learns from the train part, one row per statistic."""
    parts = materialize(_splits(spark, sf_dir), "parts")
    train = parts.where(F.col("split") == "train")
    learned = FE.prepare_statistics(
        FE.domain_features(train), FE.NUMERIC_FEATURES, FE.CATEGORICAL_FEATURES
    )
    rows = [
        (s["name"], kind, f"{s[kind]:.6f}")
        for s in learned["numeric"]
        for kind in ("median", "mean", "scale")
    ]
    rows += [(s["name"], "mode", s["mode"]) for s in learned["categorical"]]
    rows += [(s["name"], "levels", "|".join(s["levels"])) for s in learned["categorical"]]
    return spark.createDataFrame(rows, "feature string, statistic string, value string")


@query
def prepared_features(spark, sf_dir):
    """All 35 prepared columns of every row, fitted on the train part only."""
    parts = materialize(_splits(spark, sf_dir), "parts")
    domain = FE.DomainFeatures(keep=["customerID"])
    train = domain.transform(parts.where(F.col("split") == "train"))
    model = FE.Prepare(keep=["customerID"]).fit(train)
    prepared = model.transform(domain.transform(parts))
    names = model.feature_names
    return prepared.select(
        "customerID", *(F.round(F.col(f"`{n}`"), 6).alias(n) for n in names)
    )


# ------------------------------------------------------------------ exploration


@query
def class_balance(spark, sf_dir):
    return P.class_balance(subscribers(spark, sf_dir), TELCO.target, TELCO.positive)


_MEASURES = ("tenure", "MonthlyCharges", "TotalCharges")


def _measured(spark, sf_dir):
    raw = subscribers(spark, sf_dir)
    return raw.withColumn("TotalCharges", FE.lenient_number(F.col("TotalCharges")))


@query
def numeric_by_class(spark, sf_dir):
    return P.numeric_by_class(_measured(spark, sf_dir), _MEASURES, _hit())


@query
def tenure_table(spark, sf_dir):
    return P.tenure_table(subscribers(spark, sf_dir), _hit())


_CATEGORICAL = [c for c in TELCO.text_columns if c not in ("customerID", "TotalCharges", "Churn")]


@query
def category_rates(spark, sf_dir):
    return P.category_rates(subscribers(spark, sf_dir), _CATEGORICAL, _hit())


@query
def category_spread(spark, sf_dir):
    rates = P.category_rates(subscribers(spark, sf_dir), _CATEGORICAL, _hit())
    return P.category_spread(rates)


@query
def top_category_spread(spark, sf_dir):
    rates = P.category_rates(subscribers(spark, sf_dir), _CATEGORICAL, _hit())
    return P.category_spread(rates, 6)


@query
def correlations(spark, sf_dir):
    work = _measured(spark, sf_dir).withColumn("churn_flag", _hit().cast("int"))
    columns = [*_MEASURES, "SeniorCitizen", "churn_flag"]
    return P.correlations(work, columns)


@query
def correlations_lineitem(spark, sf_dir):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return P.correlations(table(spark, sf_dir, "lineitem"), columns)


@query
def redundancy(spark, sf_dir):
    implied = F.col("tenure") * F.col("MonthlyCharges")
    return P.redundancy(_measured(spark, sf_dir), implied, F.col("TotalCharges"))


@query
def vocabulary(spark, sf_dir):
    return P.vocabulary(subscribers(spark, sf_dir), ADDON_COLUMNS)


@query
def simpson_table(spark, sf_dir):
    return P.simpson_table(subscribers(spark, sf_dir), _hit(), F.col("InternetService") != "No")


@query
def zero_addon_breakdown(spark, sf_dir):
    return P.zero_addon_breakdown(subscribers(spark, sf_dir), _hit())


@query
def histogram(spark, sf_dir):
    return P.histogram(_measured(spark, sf_dir), _MEASURES, "Churn")


@query
def box_stats(spark, sf_dir):
    return P.box_stats(_measured(spark, sf_dir), _MEASURES, "Churn")


@query
def box_stats_lineitem(spark, sf_dir):
    columns = ["l_quantity", "l_extendedprice"]
    return P.box_stats(table(spark, sf_dir, "lineitem"), columns, "l_returnflag")


@query
def sparse_levels(spark, sf_dir):
    """Positions of every line item's levels: learned from lines 1 to 6, with prices in cents as levels."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string").alias("price"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag"),
        F.col("l_linestatus").alias("status"),
    )
    encoder = fit_levels_table(lines.where("l_linenumber < 7"), ["flag", "price", "status"])
    return encoder.indices(lines).select(
        "l_orderkey", "l_linenumber", F.concat_ws(" ", F.col("indices").cast("array<string>")).alias("indices")
    )


# ------------------------------------------------------------------ metrics


@query
def metrics_subscribers(spark, sf_dir):
    scored = scored_subscribers(spark, sf_dir)
    return M.evaluate(scored, "label", "score", levels=RULE_LEVELS)


@query
def metrics_by_model(spark, sf_dir):
    """Two score columns over the same rows, evaluated as two models in one pass."""
    base = scored_subscribers(spark, sf_dir)
    monthly = F.when(F.col("contract_type") == "Month-to-month", 0.4).otherwise(0.1)
    pairs = F.array(
        F.struct(F.lit("rule score").alias("model"), F.col("score").alias("p")),
        F.struct(F.lit("contract only").alias("model"), monthly.alias("p")),
    )
    long = base.select("label", F.explode(pairs).alias("m")).select("label", "m.*")
    return M.evaluate(long, "label", "p", by=["model"], levels=RULE_LEVELS + 2)


@query
def metrics_lineitem(spark, sf_dir):
    return M.evaluate(
        scored_lineitems(spark, sf_dir), "label", "score", threshold=0.6, by=["linestatus"]
    )


@query
def metrics_documents(spark, sf_dir):
    return M.evaluate(
        scored_documents(spark, sf_dir), "label", "score", threshold=0.5, by=["lang"]
    )


def _gappy(spark, sf_dir):
    """Line items with missing labels, missing scores and scores that are no number."""
    part = F.round(F.col("score") * 100003).cast("bigint")
    return scored_lineitems(spark, sf_dir).select(
        F.when(part % 11 != 0, F.col("label")).alias("label"),
        F.when(part % 7 == 0, F.lit(None))
        .when(part % 5 == 0, F.lit(float("nan")))
        .otherwise(F.col("score"))
        .alias("score"),
        "linestatus",
    )


@query
def set_aside_gaps(spark, sf_dir):
    return M.set_aside(_gappy(spark, sf_dir), "label", "score", by=["linestatus"])


@query
def metrics_gaps(spark, sf_dir):
    return M.evaluate(_gappy(spark, sf_dir), "label", "score", threshold=0.6, by=["linestatus"])


@query
def confusion_gaps(spark, sf_dir):
    return M.confusion(_gappy(spark, sf_dir), "label", "score", 0.5)


@query
def threshold_sweep_gaps(spark, sf_dir):
    return M.threshold_sweep(_gappy(spark, sf_dir), "label", "score").drop("n")


@query
def fairness_gaps(spark, sf_dir):
    return X.fairness(_gappy(spark, sf_dir), "label", "score", 0.5, slices=["linestatus"])


@query
def confusion_value(spark, sf_dir):
    matrix = M.confusion(scored_lineitems(spark, sf_dir), "label", "score", 0.5)
    return M.expected_value(matrix)


@query
def precision_at_k(spark, sf_dir):
    scored = scored_subscribers(spark, sf_dir)
    return M.precision_at_k(scored, "label", "score", "customer_id", levels=RULE_LEVELS)


@query
def roc_points(spark, sf_dir):
    scored = scored_subscribers(spark, sf_dir)
    return M.roc_points(scored, "label", "score", levels=RULE_LEVELS)


@query
def roc_points_lineitem(spark, sf_dir):
    return M.roc_points(scored_lineitems(spark, sf_dir), "label", "score")


@query
def pr_points(spark, sf_dir):
    scored = scored_subscribers(spark, sf_dir)
    return M.pr_points(scored, "label", "score", levels=RULE_LEVELS)


@query
def calibration(spark, sf_dir):
    return M.calibration(scored_subscribers(spark, sf_dir), "label", "score")


@query
def calibration_lineitem(spark, sf_dir):
    return M.calibration(scored_lineitems(spark, sf_dir), "label", "score")


@query
def threshold_sweep(spark, sf_dir):
    return M.threshold_sweep(scored_subscribers(spark, sf_dir), "label", "score").drop("n")


@query
def threshold_sweep_lineitem(spark, sf_dir):
    return M.threshold_sweep(scored_lineitems(spark, sf_dir), "label", "score").drop("n")


@query
def acceptance(spark, sf_dir):
    scored = scored_subscribers(spark, sf_dir)
    return M.acceptance(M.evaluate(scored, "label", "score", levels=RULE_LEVELS))


@query
def uplift(spark, sf_dir):
    return M.uplift(metrics_by_model(spark, sf_dir), "model", "rule score", "contract only")


# ------------------------------------------------------------------ decisions


def _shown(df: DataFrame, column: str) -> DataFrame:
    """A threshold rounded for display only."""
    return df.withColumn(column, F.round(column, M.METRIC_DIGITS))


@query
def operating_threshold(spark, sf_dir):
    sweep = M.threshold_sweep(scored_subscribers(spark, sf_dir), "label", "score")
    return _shown(D.operating_threshold(sweep).drop("contacted", "n"), "operating_threshold")


@query
def sensitivity(spark, sf_dir):
    counts = M.threshold_counts(scored_subscribers(spark, sf_dir), "label", "score")
    return _shown(D.sensitivity(counts), "empirical_threshold")


@query
def sensitivity_lineitem(spark, sf_dir):
    counts = M.threshold_counts(scored_lineitems(spark, sf_dir), "label", "score")
    return _shown(D.sensitivity(counts), "empirical_threshold")


@query
def capacity_binding(spark, sf_dir):
    scored = scored_subscribers(spark, sf_dir)
    best = D.operating_threshold(M.threshold_sweep(scored, "label", "score"))
    return D.capacity_binding(best, M.Costs(), scored.agg(F.count("*")).scalar())


def _decided(spark, sf_dir):
    return D.decide(scored_subscribers(spark, sf_dir), "score")


_DECISION = (
    "customer_id",
    "churn_probability",
    "risk_tier",
    "should_contact",
    "decision_threshold",
    "expected_value_of_contact",
)


@query
def decisions(spark, sf_dir):
    return _decided(spark, sf_dir).select(*_DECISION)


@query
def worklist(spark, sf_dir):
    ranked = D.worklist(_decided(spark, sf_dir), "customer_id")
    return ranked.select("rank", *_DECISION)


@query
def worklist_top(spark, sf_dir):
    """The rows the team can call: rank within the capacity."""
    top = D.worklist_top(_decided(spark, sf_dir), "customer_id", M.Costs().capacity)
    return top.select("rank", "customer_id", "churn_probability")


@query
def worklist_quality(spark, sf_dir):
    ranked = D.worklist(_decided(spark, sf_dir), "customer_id", size="ranked_rows")
    return D.worklist_quality(ranked, "label", size="ranked_rows")


@query
def batch_summary(spark, sf_dir):
    return D.batch_summary(_decided(spark, sf_dir))


# ------------------------------------------------------------------ explanations

# Weights of a given linear model on the domain features.
WEIGHTS = {
    "tenure": -0.031,
    "MonthlyCharges": 0.012,
    "SeniorCitizen": 0.21,
    "num_addon_services": -0.17,
    "avg_charges_per_month": 0.004,
    "has_internet": 0.83,
    "is_automatic_payment": -0.42,
}


def _explained(spark, sf_dir):
    df = FE.domain_features(subscribers(spark, sf_dir), keep=["customerID"])
    means = X.feature_means(df, list(WEIGHTS))
    return df, [X.LinearTerm(name, w, means[name]) for name, w in WEIGHTS.items()]


@query
def linear_attributions(spark, sf_dir):
    df, terms = _explained(spark, sf_dir)
    wide = X.attributions(df, terms, ["customerID"])
    return wide.select("customerID", *(F.round(n, 6).alias(n) for n in WEIGHTS))


@query
def top_drivers(spark, sf_dir):
    df, terms = _explained(spark, sf_dir)
    drivers = df.select("customerID", F.posexplode(X.top_drivers(terms)).alias("place", "d"))
    return drivers.select("customerID", "place", "d.feature", "d.contribution", "d.direction")


@query
def global_importance(spark, sf_dir):
    return X.global_importance(*_explained(spark, sf_dir))


@query
def extreme_customers(spark, sf_dir):
    df, terms = _explained(spark, sf_dir)
    total = sum((X.attribution(t) for t in terms), F.lit(0.0))
    # six decimals: the order of the rows must not hang on the order of a double sum
    p = F.round(1 / (1 + F.exp(-total)), 6)
    picked = X.extreme_customers(df.withColumn("p", p), terms, "customerID")
    return picked.select(
        "example", "customerID", "probability", F.posexplode("top_drivers").alias("place", "d")
    ).select("example", "customerID", "probability", "place", "d.feature", "d.contribution")


_SLICES = ("gender", "is_senior", "has_partner", "has_dependents")


@query
def fairness(spark, sf_dir):
    scored = scored_subscribers(spark, sf_dir)
    return X.fairness(scored, "label", "score", 0.4, _SLICES, levels=RULE_LEVELS)


@query
def fairness_documents(spark, sf_dir):
    return X.fairness(scored_documents(spark, sf_dir), "label", "score", 0.5, ["lang"])


@query
def fairness_gap(spark, sf_dir):
    scored = scored_subscribers(spark, sf_dir)
    return X.fairness_gap(X.fairness(scored, "label", "score", 0.4, _SLICES, levels=RULE_LEVELS))


# ------------------------------------------------------------------ models


def _labelled(spark, sf_dir):
    return training.labelled_split(subscribers(spark, sf_dir))


def _part(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col("split") == name)


@query
def prior_baseline(spark, sf_dir):
    parts = materialize(_labelled(spark, sf_dir), "parts")
    model = E.PriorClassifier().fit(_part(parts, "train"))
    scored = E.positive_probability(model.transform(_part(parts, "val")))
    return M.evaluate(scored, "label", "p", levels=1)


@query
def rule_baseline(spark, sf_dir):
    parts = materialize(_labelled(spark, sf_dir), "parts")
    model = E.ContractRule().fit(_part(parts, "train"))
    scored = E.positive_probability(model.transform(_part(parts, "val")))
    return M.evaluate(scored, "label", "p", levels=2)


RULE_TENURES = (6, 25, 49)


def _rule_history(spark, sf_dir):
    train = _part(_labelled(spark, sf_dir), "train")
    folded = S.stratified_folds(train, "customerID", "label").select(
        "customerID", "Contract", "tenure", "label", "fold"
    )
    folded = materialize(folded, "folds")
    rules = {f"rule below {t}": E.ContractRule(tenureBelow=t) for t in RULE_TENURES}
    return E.cross_validate({"prior": E.PriorClassifier(), **rules}, folded)


@query
def cv_history(spark, sf_dir):
    history = _rule_history(spark, sf_dir)
    aps = (F.round(c, M.METRIC_DIGITS).alias(c) for c in ("train_ap", "test_ap"))
    return history.select("family", "fold", *aps)


@query
def one_se_selection(spark, sf_dir):
    complexity = {"prior": 1} | {f"rule below {t}": 2 + i for i, t in enumerate(RULE_TENURES)}
    return E.one_se_select(_rule_history(spark, sf_dir), complexity).drop("reason", "candidate")


# A small search, one setting per tree family and two linear ones.
SMALL_SEARCH = {
    "logistic_regression": [
        {"C": 0.1, "class_weight": None, "max_iter": 100},
        {"C": 10.0, "class_weight": "balanced", "max_iter": 100},
    ],
    "random_forest": [{"n_estimators": 20, "max_depth": 6, "min_samples_leaf": 5}],
    "hist_gradient_boosting": [
        {"learning_rate": 0.1, "max_iter": 10, "max_leaf_nodes": 8, "min_samples_leaf": 10}
    ],
}


@query
def search_selection(spark, sf_dir):
    """Randomized-search history of three families, and the family it selects."""
    train = materialize(_part(_labelled(spark, sf_dir), "train"), "train")
    history, chosen = training.search_and_select(train, SMALL_SEARCH, k=3)
    means = E.summarize_history(history)
    won = chosen.select(F.col("selected").alias("family"), "candidate", "reason")
    return means.join(won, ["family", "candidate"], "left")


def _fitted(spark, sf_dir):
    parts = materialize(_labelled(spark, sf_dir), "parts")
    params = {"C": 1.0, "class_weight": "balanced", "max_iter": 200}
    return parts, training.fit_family(_part(parts, "train"), "logistic_regression", params)


@query
def model_scores(spark, sf_dir):
    """Saved and reloaded model scoring every record, with drivers."""
    parts, trained = _fitted(spark, sf_dir)
    path = scratch_path(spark, "model")
    writers.save_model(trained.model, path, spark, {"family": trained.family}, trained.means)
    model, _, means = writers.load_model(spark, path)
    terms = X.linear_terms(model.stages[-1], trained.feature_names, means)
    scored = score_records(parts.drop("split", "label"), model, terms)
    return scored.withColumn("top_drivers", F.to_json("top_drivers"))


@query
def coefficients(spark, sf_dir):
    _, trained = _fitted(spark, sf_dir)
    return X.coefficient_table(spark, trained.terms)


@query
def final_evaluation(spark, sf_dir):
    parts, trained = _fitted(spark, sf_dir)
    return training.final_evaluation(parts, trained)["metrics"]


@query
def ranked_batch_scores(spark, sf_dir):
    parts, trained = _fitted(spark, sf_dir)
    records = parts.drop("split", "label")
    ranked, _ = ranked_batch(records, trained.model, coerce=True, terms=trained.terms)
    return ranked.drop("top_drivers")


@query
def published_scores(spark, sf_dir):
    """The training job on two linear candidates, then the published model scoring every record."""
    raw = materialize(subscribers(spark, sf_dir), "raw")
    out = scratch_path(spark, "training")
    linear = {"logistic_regression": SMALL_SEARCH["logistic_regression"]}
    training.training_job(raw, out, linear, k=3)
    scorer = load_scorer(spark, out)
    return scorer.score(FE.coerce_records(raw)).drop("top_drivers")


# three features whose every value has a bin of its own
TREE_FEATURES = ("tenure", "num_addon_services", "SeniorCitizen")


@query
def boosted_leaves(spark, sf_dir):
    """The first boosted tree over three features, grown best first: rows and value of each leaf."""
    train = FE.domain_features(_part(_labelled(spark, sf_dir), "train"), ["label"])
    x = F.array(*(F.col(c) for c in TREE_FEATURES))
    train = materialize(train.select(array_to_vector(x).alias("features"), "label", x.alias("x")), "tree")
    booster = LeafwiseBoosting(maxIter=1, maxLeafNodes=4, minSamplesLeaf=20, l2=1.0)
    leaf = F.lit(None).cast("string")
    value = F.lit(None).cast("double")
    for found in booster.fit(train).leaves():
        steps = [(F.col("x")[f] <= cut) if side == "<=" else (F.col("x")[f] > cut) for f, side, cut in found["path"]]
        here = reduce(lambda a, b: a & b, steps, F.lit(True))
        path = " ".join(f"{TREE_FEATURES[f]}{side}{cut:g}" for f, side, cut in found["path"])
        leaf, value = F.when(here, path).otherwise(leaf), F.when(here, found["value"]).otherwise(value)
    rows = train.groupBy(leaf.alias("leaf"), F.round(value, 6).alias("value"))
    return rows.agg(F.count("*").alias("rows"), F.sum(F.col("label").cast("bigint")).alias("churned"))


LOGISTIC_SETTINGS = (("balanced", 1.0), (None, 1.0), ("balanced", 0.01), (None, 0.001))


@query
def logistic_weights(spark, sf_dir):
    """Coefficient tables of the linear family at four settings: one feature, penalised, to convergence."""
    train = FE.domain_features(_part(_labelled(spark, sf_dir), "train"), ["label"])
    x = array_to_vector(F.array(F.col("tenure") / F.lit(72.0)))
    weighted = materialize(E.class_weight(train.select(x.alias("features"), "label")), "weighted")
    rows, out = weighted.count(), None
    for kind, c in LOGISTIC_SETTINGS:
        fitted = E.build_estimator("logistic_regression", {"C": c, "class_weight": kind}, rows).fit(weighted)
        table = X.coefficient_table(spark, X.linear_terms(fitted, ["tenure"], {}))
        one = table.select(
            F.lit(kind or "none").alias("class_weight"),
            F.lit(c).alias("C"),
            "feature",
            *(F.round(n, 3).alias(n) for n in ("coefficient", "odds_ratio", "abs_coefficient")),
            F.round(F.lit(float(fitted.intercept)), 3).alias("intercept"),
        )
        out = one if out is None else out.unionByName(one)
    return out


@query
def coerced_records(spark, sf_dir):
    """Loosely typed records, as a form sends them, cast to the types that scoring takes."""
    key = F.col("customerID").cast("bigint")
    loose = subscribers(spark, sf_dir).select(
        "customerID",
        F.when(key % 13 == 0, "abc").otherwise(F.col("tenure").cast("string")).alias("tenure"),
        F.when(key % 11 == 0, "yes").otherwise(F.col("SeniorCitizen").cast("string")).alias("SeniorCitizen"),
        F.when(key % 7 == 0, "n/a").otherwise(F.col("TotalCharges")).alias("TotalCharges"),
    )
    return FE.coerce_records(loose)


@query
def column_check(spark, sf_dir):
    """Columns that a table with a lost and a renamed column lacks, or has beyond the contract."""
    raw = subscribers(spark, sf_dir).drop("tenure").withColumnRenamed("Churn", "churned")
    problems = [("missing", c) for c in quality.missing_columns(raw)]
    problems += [("unknown", c) for c in quality.unknown_columns(raw)]
    cells = F.array(*(F.struct(F.lit(p).alias("problem"), F.lit(c).alias("column")) for p, c in problems))
    return raw.agg(F.count("*").alias("rows")).select("rows", F.inline(cells))


@query
def batch_refusals(spark, sf_dir):
    """Which batches, by their number of lapsed months, are refused as empty before scoring."""
    scorer, records = _published_rule(spark, sf_dir)
    rows = None
    for months in (0, 36, 72, 73):
        batch = records.where(F.col("tenure") >= months)
        try:
            ranked, _ = ranked_batch(batch, scorer.model)
            one = ranked.agg(F.count("*").alias("ranked")).withColumn("refused", F.lit(False))
        except quality.ContractViolation:
            one = batch.agg(F.count("*").alias("ranked")).withColumn("refused", F.lit(True))
        one = one.withColumn("from_month", F.lit(months))
        rows = one if rows is None else rows.unionByName(one)
    return rows


@query
def saved_report(spark, sf_dir):
    """A nested report written as JSON and read back."""
    by = subscribers(spark, sf_dir).groupBy("Contract", "PaymentMethod").agg(
        F.count("*").alias("customers"), F.count_if(_hit()).alias("churned")
    )
    cell = F.struct("PaymentMethod", "customers", "churned")
    report = by.groupBy("Contract").agg(
        F.struct(F.sum("customers").alias("customers"), F.max("churned").alias("worst")).alias("summary"),
        F.sort_array(F.collect_list(cell)).alias("methods"),
    )
    path = scratch_path(spark, "report")
    writers.write_report(report, path)
    stored = spark.read.schema(report.schema).json(path)
    return stored.select("Contract", "summary.customers", "summary.worst", F.inline("methods").alias("method", "n", "lost"))


@query
def saved_history(spark, sf_dir):
    """A search history appended in two batches and read back."""
    history = _rule_history(spark, sf_dir)
    path = scratch_path(spark, "history")
    writers.append_history(history, path)
    writers.append_history(history.where("family = 'prior'").withColumn("family", F.lit("again")), path)
    stored = spark.read.schema(E.HISTORY_SCHEMA).parquet(path)
    return stored.groupBy("family").agg(
        F.count("*").alias("folds"), F.round(F.max("test_ap"), M.METRIC_DIGITS).alias("best_ap")
    )


@query
def background_means(spark, sf_dir):
    """The means that explanations need, stored beside a model and loaded with it."""
    parts = materialize(_labelled(spark, sf_dir), "parts")
    train = _part(parts, "train")
    means = X.feature_means(FE.domain_features(train), FE.NUMERIC_FEATURES)
    path = scratch_path(spark, "background")
    fitted = PipelineModel(stages=[E.ContractRule().fit(train)])
    writers.save_model(fitted, path, spark, {"family": "rule"}, means)
    _, facts, loaded = writers.load_model(spark, path)
    rows = [(feature, facts["family"], mean) for feature, mean in loaded.items()]
    table = spark.createDataFrame(rows, "feature string, family string, mean double")
    return table.withColumn("mean", F.round("mean", 6))


@query
def leakage_audit(spark, sf_dir):
    raw = materialize(subscribers(spark, sf_dir), "audit")
    return L.leakage_audit(raw)


# ------------------------------------------------------------------ sinks and streams


@query
def stream_scores(spark, sf_dir):
    """Every subscriber through the stream job; what it wrote is read back."""
    _, trained = _fitted(spark, sf_dir)
    inbox, out = scratch_path(spark, "inbox"), scratch_path(spark, "stream")
    subscribers(spark, sf_dir).write.parquet(inbox)
    records = read_record_stream(spark, inbox)
    job = score_stream(records, trained.model, out, f"{out}/checkpoint", trained.terms)
    job.awaitTermination()
    written = spark.read.parquet(f"{out}/scored")
    return written.drop("batch", "top_drivers")


def _published_rule(spark, sf_dir):
    """The incumbent rule as a pipeline, saved and loaded again; and all raw records."""
    parts = materialize(_labelled(spark, sf_dir), "parts")
    fitted = PipelineModel(stages=[E.ContractRule().fit(_part(parts, "train"))])
    path = scratch_path(spark, "rule")
    writers.save_model(fitted, path, spark, {"family": "rule"})
    return load_scorer(spark, path), parts.drop("split", "label")


@query
def rule_decisions(spark, sf_dir):
    """Decisions of the published rule for every record."""
    scorer, records = _published_rule(spark, sf_dir)
    return scorer.score(records).withColumn("drivers", F.size("top_drivers")).drop("top_drivers")


@query
def rule_stream(spark, sf_dir):
    """Every record through the stream: decisions of the accepted, errors of the others."""
    scorer, records = _published_rule(spark, sf_dir)
    inbox, out = scratch_path(spark, "inbox"), scratch_path(spark, "stream")
    records.write.parquet(inbox)
    stream = read_record_stream(spark, inbox)
    score_stream(stream, scorer.model, out, f"{out}/checkpoint").awaitTermination()
    good = spark.read.parquet(f"{out}/scored").select(
        "customerID", "churn_probability", F.lit("").alias("errors")
    )
    bad = spark.read.parquet(f"{out}/quarantine").select(
        "customerID",
        F.lit(None).cast("double").alias("churn_probability"),
        F.concat_ws(",", "errors").alias("errors"),
    )
    return good.unionByName(bad)


@query
def exports(spark, sf_dir):
    """Rows per exported CSV folder, counted from the files."""
    path = scratch_path(spark, "exports")
    written = warehouse.export_all(spark, subscribers(spark, sf_dir), path)
    counts = None
    for name, target in written.items():
        found = spark.read.option("header", True).csv(target)
        one = found.agg(F.count("*").alias("rows")).withColumns(
            {"export": F.lit(name), "columns": F.lit(len(found.columns))}
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts


@query
def loaded_csv(spark, sf_dir):
    """Raw rows through the CSV source and the checked append."""
    path = scratch_path(spark, "csv")
    subscribers(spark, sf_dir).write.options(**writers.CSV_VERBATIM).csv(path)
    raw = readers.read_customers(spark, path)
    stored = scratch_path(spark, "bronze")
    writers.append_checked(raw, stored)
    return commits.read_committed(spark, stored, TELCO.schema).drop("_version")


@query
def committed_batches(spark, sf_dir):
    """Rows per published version after two good appends, a bad one and a late one between them."""
    raw = materialize(subscribers(spark, sf_dir), "raw")
    third = F.col("customerID").cast("bigint") % 3
    path = scratch_path(spark, "committed")
    writers.append_checked(raw.where(third == 0), path)
    late, _ = commits.stage(raw.where(third == 2), path)
    for bad in (raw.where(third == 2).withColumn("Churn", F.lit("Maybe")), raw.where(third == 0)):
        try:
            writers.append_checked(bad, path)
        except quality.ContractViolation:
            pass
    writers.append_checked(raw.where(third == 1), path)
    try:
        commits.publish(spark, path, late, 0, 1)
    except commits.LateWriter:
        pass
    rows = commits.read_committed(spark, path, TELCO.schema)
    return rows.groupBy(F.col("_version").alias("version")).agg(
        F.count("*").alias("rows"), F.sum("MonthlyCharges").alias("charges")
    )


@query
def run_log(spark, sf_dir):
    """Two logged runs of the incumbent rule; the second is registered."""
    parts = materialize(_labelled(spark, sf_dir), "runs")
    path = scratch_path(spark, "runlog")
    for t, register in ((6, False), (25, True)):
        model = E.ContractRule(tenureBelow=t).fit(_part(parts, "train"))
        scored = E.positive_probability(model.transform(_part(parts, "val")))
        found = M.evaluate(scored, "label", "p", levels=2).first().asDict()
        metrics = {k: found[k] for k in ("pr_auc", "roc_auc", "recall", "value_per_1000")}
        writers.log_run(spark, path, "rule", {"tenureBelow": t}, metrics, register=register)
    runs = writers.read_runs(spark, path)
    return runs.select(
        "family",
        F.col("params")["tenureBelow"].alias("tenure_below"),
        F.col("metrics")["pr_auc"].alias("pr_auc"),
        F.col("metrics")["recall"].alias("recall"),
        "version",
    )
