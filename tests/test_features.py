"""Feature projections on single rows; fitted preparation on the train part only."""

import math

import pytest
from conftest import customer, unserved
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from holdfast.operators import features as FE
from holdfast.operators import profile as P
from holdfast.operators import levels
from holdfast.operators.levels import LevelEncoder, fit_levels_table
from holdfast.plans.training import labelled_split
from holdfast.session import scratch_path


def features_of(df):
    return FE.domain_features(df).first()


def test_order_and_identifier(table_of):
    out = FE.domain_features(table_of(unserved()).withColumn("stray", F.lit(1)))
    assert out.columns == FE.NUMERIC_FEATURES + FE.CATEGORICAL_FEATURES
    assert (len(FE.NUMERIC_FEATURES), len(FE.CATEGORICAL_FEATURES)) == (8, 16)


def test_new_customer(table_of):
    row = features_of(table_of(unserved()))
    assert row["TotalCharges"] == 0.0
    assert math.isfinite(row["avg_charges_per_month"])
    assert {row[c] for c in ("OnlineSecurity", "TechSupport", "MultipleLines")} == {"No"}
    assert row["has_internet"] == 0.0


@pytest.mark.parametrize(
    ("text", "value"),
    [("abc", 0.0), ("", 0.0), (None, 0.0), ("NaN", 0.0), (" 12.5 ", 12.5), ("1e3", 1000.0)],
)
def test_lenient_totals(table_of, text, value):
    assert features_of(table_of(customer(TotalCharges=text)))["TotalCharges"] == value


def test_missing_values_differ_from_the_cleaned_view(table_of):
    row = features_of(table_of(customer(InternetService=None, PaymentMethod=None, tenure=None)))
    assert row["has_internet"] == 1.0
    assert row["is_automatic_payment"] == 0.0
    assert row["tenure_bucket"] == "nan"
    assert row["avg_charges_per_month"] is None


@pytest.mark.parametrize("method", ["Bank transfer (automatic)", "Card (AUTOMATIC)"])
def test_automatic_payment_in_any_case(table_of, method):
    assert features_of(table_of(customer(PaymentMethod=method)))["is_automatic_payment"] == 1.0


def test_long_tenure_and_addons(table_of):
    row = features_of(table_of(customer(tenure=500, OnlineSecurity="Yes", TechSupport="Yes")))
    assert row["tenure_bucket"] == "49mo+"
    assert row["num_addon_services"] == 2.0


def test_coercion_of_loose_records(table_of):
    row = FE.coerce_records(table_of(unserved())).first()
    assert (row["TotalCharges"], row["tenure"]) == (0.0, 0)


@pytest.fixture(scope="module")
def parts(raw):
    return labelled_split(raw).cache()


@pytest.fixture(scope="module")
def fitted(parts):
    return FE.feature_pipeline().fit(parts.where("split = 'train'"))


def test_statistics_come_from_train_alone(parts, fitted):
    domain = FE.domain_features(parts.where("split = 'train'"))
    learned = {s["name"]: s for s in fitted.stages[1].learned["numeric"]}
    row = domain.agg(
        *(F.avg(c).alias(f"m_{c}") for c in FE.NUMERIC_FEATURES),
        *(F.stddev_pop(c).alias(f"s_{c}") for c in FE.NUMERIC_FEATURES),
        *(F.median(c).alias(f"q_{c}") for c in FE.NUMERIC_FEATURES),
    ).first()
    everything = FE.domain_features(parts).agg(F.avg("tenure")).first()[0]
    for c in FE.NUMERIC_FEATURES:
        assert learned[c]["mean"] == pytest.approx(row[f"m_{c}"], rel=1e-9)
        assert learned[c]["scale"] == pytest.approx(row[f"s_{c}"] or 1.0, rel=1e-9)
        assert learned[c]["median"] == pytest.approx(row[f"q_{c}"], rel=1e-9)
    assert learned["tenure"]["mean"] != pytest.approx(everything, rel=1e-9)


def test_train_columns_are_centred_and_there_are_35(parts, fitted):
    flat = parts.where("split = 'train'")
    for stage in fitted.stages[:2]:
        flat = stage.transform(flat)
    names = fitted.stages[1].feature_names
    assert len(names) == 35
    assert flat.columns == ["customerID", "label", *names]
    assert {t for c, t in flat.dtypes if c in names} == {"double"}
    assert abs(flat.agg(F.avg("tenure")).first()[0]) < 1e-10
    assert "Partner_Yes" in names and "Partner_No" not in names
    assert "Contract_Month-to-month" in names


def test_unknown_category_is_all_zero(table_of, fitted):
    row = table_of(customer(Contract="Three year"))
    for stage in fitted.stages[:2]:
        row = stage.transform(row)
    out = row.first()
    assert [out[c] for c in row.columns if c.startswith("Contract_")] == [0.0, 0.0, 0.0]


def test_imputation_uses_median_and_mode(spark):
    df = spark.createDataFrame(
        [(1.0, "b"), (2.0, "a"), (10.0, "a"), (None, "b"), (5.0, None)], "x double, c string"
    )
    model = FE.Prepare(numeric=["x"], categorical=["c"]).fit(df)
    learned = model.learned
    assert learned["numeric"][0]["median"] == 3.5
    assert learned["categorical"][0]["mode"] == "a"  # tie: the smaller value
    out = [r["c_b"] for r in model.transform(df).collect()]
    assert out == [1.0, 0.0, 0.0, 1.0, 0.0]


def test_constant_column_scales_by_one(spark):
    df = spark.createDataFrame([(3.0, "a"), (3.0, "b")], "x double, c string")
    model = FE.Prepare(numeric=["x"], categorical=["c"]).fit(df)
    assert [r["x"] for r in model.transform(df).collect()] == [0.0, 0.0]


def test_saved_pipeline_gives_the_same_matrix(parts, fitted, tmp_path):
    fitted.write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    val = parts.where("split = 'val'")
    first = fitted.transform(val).select("customerID", F.col("features").cast("string"))
    second = again.transform(val).select("customerID", F.col("features").cast("string"))
    assert first.exceptAll(second).count() == 0


def test_label_and_widening(table_of):
    out = FE.widen_integers(FE.with_label(table_of(customer(), customer(Churn="No"))))
    assert [r["label"] for r in out.collect()] == [1.0, 0.0]
    assert "Churn" not in out.columns
    assert dict(out.dtypes)["tenure"] == "double"


def test_too_many_levels_are_refused(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError, match="too many"):
        FE.fit_levels(df, ["c"], limit=10)


def test_paradox_turns_when_conditioned(table_of):
    rows = [customer(customerID=f"i{i}", Churn="Yes") for i in range(3)]
    rows += [unserved(customerID=f"n{i}") for i in range(9)]
    rows += [customer(customerID=f"a{i}", TechSupport="Yes", Churn="Yes" if i else "No") for i in range(2)]
    df = table_of(*rows)
    out = {
        r["n_addons"]: r
        for r in P.simpson_table(df, F.col("Churn") == "Yes", F.col("InternetService") != "No").collect()
    }
    assert out[0]["rate_all"] < out[1]["rate_all"]
    assert out[0]["rate_subset"] > out[1]["rate_subset"]


# ------------------------------------------------------------------ many levels


def test_levels_are_placed_in_order_whatever_their_number(spark):
    df = spark.range(30_000).select(
        F.concat(F.lit("v"), (F.col("id") % 25_000).cast("string")).alias("many"),
        F.when(F.col("id") % 3 > 0, F.when(F.col("id") % 3 == 1, "yes").otherwise("no")).alias("two"),
        F.lit(None).cast("string").alias("none"),
    )
    encoder = fit_levels_table(df, ["many", "two", "none"])
    assert encoder.sizes == {"many": 25_000, "two": 2, "none": 0} and encoder.size == 25_001
    places = {r["value"]: r["place"] for r in encoder.levels.where("column = 'many'").collect()}
    assert [v for v, _ in sorted(places.items(), key=lambda x: x[1])] == sorted(f"v{i}" for i in range(25_000))
    assert sorted(places.values()) == list(range(25_000))
    assert encoder.modes == {"many": "v0", "two": "no", "none": None}


def test_sparse_vectors_have_ones_at_the_indices(spark):
    rows = [(1, "a", "x"), (2, "b", "y"), (3, None, "x"), (4, "c", None), (5, "b", "x")]
    df = spark.createDataFrame(rows, "id int, letter string, two string")
    encoder = fit_levels_table(df, ["letter", "two"])
    path = scratch_path(spark, "levels")
    encoder.save(path)
    again = LevelEncoder.load(spark, path)
    fresh = spark.createDataFrame([*rows, (6, "zz", "y"), (7, "a", "other")], df.schema)
    want = {1: [0], 2: [1, 3], 3: [1], 4: [2], 5: [1], 6: [3], 7: [0]}
    for e in (encoder, again):
        assert {r["id"]: r["indices"] for r in e.indices(fresh).collect()} == want
        vectors = {r["id"]: r["features"] for r in e.transform(fresh).collect()}
        assert all(v.size == 4 and [i for i in range(4) if v[i]] == want[k] for k, v in vectors.items())


def test_few_levels_are_joined_without_a_shuffle_of_the_rows(spark):
    df = spark.range(40).selectExpr("CAST(id % 3 AS STRING) AS letter", "id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with a large table of levels
    try:
        plan = fit_levels_table(df, ["letter"]).indices(df)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_frequent_levels_have_the_same_places_as_by_one_join(spark, monkeypatch):
    df = spark.range(60).selectExpr("IF(id % 2 = 0, 'most', IF(id % 11 = 0, NULL, CAST(id AS STRING))) AS v", "id")
    encoder = fit_levels_table(df.where("id < 50"), ["v"])
    want = sorted(map(str, encoder.indices(df).collect()))
    monkeypatch.setattr(levels, "FEW_LEVELS", 0)
    for many in (1, 10, 100):
        monkeypatch.setattr(levels, "MANY_ROWS", many)
        assert sorted(map(str, encoder.indices(df).collect())) == want
