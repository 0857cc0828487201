"""Baselines, selection, training, explanations, storage and streams."""

import json

import numpy as np
import pytest
from conftest import customer
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from holdfast.operators import explain as X
from holdfast.operators import features as FE
from holdfast.operators import forest as FO
from holdfast.operators import models as E
from holdfast.operators import split as S
from holdfast.operators.quality import ContractViolation, split_valid
from holdfast.operators.features import coerce_records
from holdfast.plans import training, warehouse
from holdfast.plans.scoring import load_scorer, ranked_batch, score_records
from holdfast.session import scratch_path, shared_dir
from holdfast.sources import commits, readers, writers
from holdfast.sources.contract import TELCO
from holdfast.streaming import score as stream


@pytest.fixture(scope="module")
def parts(raw):
    return training.labelled_split(raw).cache()


@pytest.fixture(scope="module")
def trained(parts):
    train = parts.where("split = 'train'")
    params = {"C": 1.0, "class_weight": "balanced", "max_iter": 60}
    return training.fit_family(train, "logistic_regression", params)


def test_rule_scores_are_branch_rates(parts):
    train = parts.where("split = 'train'")
    model = E.ContractRule(tenureBelow=30).fit(train)
    flagged = train.where(model.flag())
    assert flagged.where("Contract <> 'Month-to-month' OR tenure >= 30").count() == 0
    want = flagged.agg(F.avg("label")).first()[0]
    assert model.getOrDefault(model.rateFlagged) == pytest.approx(want)
    scored = E.positive_probability(model.transform(train))
    assert scored.select("p").distinct().count() == 2
    assert scored.where("(prediction = 1) <> (Contract = 'Month-to-month' AND tenure < 30)").count() == 0


def test_empty_branch_falls_back_to_the_overall_rate(parts):
    train = parts.where("split = 'train'")
    model = E.ContractRule(tenureBelow=0).fit(train)
    overall = train.agg(F.avg("label")).first()[0]
    assert model.getOrDefault(model.rateFlagged) == pytest.approx(overall)


def test_baselines_survive_saving(parts, tmp_path):
    train = parts.where("split = 'train'")
    for name, estimator in (("rule", E.ContractRule(tenureBelow=9)), ("prior", E.PriorClassifier())):
        model = PipelineModel(stages=[estimator.fit(train)])
        model.write().save(str(tmp_path / name))
        again = PipelineModel.load(str(tmp_path / name))
        a = E.positive_probability(model.transform(train)).select("customerID", "p")
        b = E.positive_probability(again.transform(train)).select("customerID", "p")
        assert a.exceptAll(b).count() == 0


def test_balanced_weights(parts):
    weighted = E.class_weight(parts)
    per_class = [r["w"] for r in weighted.groupBy("label").agg(F.sum("weight").alias("w")).collect()]
    assert per_class[0] == pytest.approx(per_class[1])
    assert sum(per_class) == pytest.approx(parts.count())


def test_candidates_are_reproducible_and_in_range():
    space = E.SEARCH_SPACES["hist_gradient_boosting"]
    first, second = E.sample_candidates(space, 30), E.sample_candidates(space, 30)
    assert first == second
    assert all(0.01 <= c["learning_rate"] <= 0.3 and 100 <= c["max_iter"] < 500 for c in first)
    for family, spec in E.SEARCH_SPACES.items():
        for params in E.sample_candidates(spec, 3):
            E.build_estimator(family, params, rows=100)


def history(spark, table):
    rows = [(f, 0, i, {}, None, ap) for f, aps in table.items() for i, ap in enumerate(aps)]
    return spark.createDataFrame(rows, E.HISTORY_SCHEMA)


def test_simplest_family_within_one_standard_error(spark):
    near = history(
        spark,
        {
            "random_forest": [0.70, 0.64, 0.67, 0.69, 0.65],
            "logistic_regression": [0.66, 0.66, 0.67, 0.66, 0.66],
            "hist_gradient_boosting": [0.50] * 5,
        },
    )
    row = E.one_se_select(near).first()
    assert (row["selected"], row["top_family"]) == ("logistic_regression", "random_forest")
    assert row["standard_error"] == pytest.approx(0.022804 / 5**0.5, abs=1e-5)
    assert "within one standard error" in row["reason"]
    far = history(spark, {"random_forest": [0.7] * 5, "logistic_regression": [0.6] * 5})
    assert E.one_se_select(far).first()["selected"] == "random_forest"


def test_cross_validation_has_every_fold(parts):
    train = parts.where("split = 'train'").select("customerID", "Contract", "tenure", "label")
    folded = S.stratified_folds(train, "customerID", "label", 3)
    found = E.cross_validate({"prior": E.PriorClassifier()}, folded, k=3)
    rows = found.collect()
    assert sorted(r["fold"] for r in rows) == [0, 1, 2]
    assert all(0 < r["test_ap"] < 1 and 0 < r["train_ap"] < 1 for r in rows)


def test_search_on_whole_pipelines(parts):
    families = {
        "logistic_regression": [{"C": 0.5, "class_weight": None, "max_iter": 20}],
        "random_forest": [{"n_estimators": 4, "max_depth": 3, "min_samples_leaf": 2}],
    }
    train = parts.where("split = 'train'")
    found, chosen = training.search_and_select(train, families, k=2)
    assert found.count() == 4
    assert chosen.first()["selected"] in families
    assert found.where("train_ap IS NULL OR test_ap IS NULL").count() == 0


def test_search_makes_feature_columns_once_and_stores_scores(parts, monkeypatch):
    made, stored = [], []
    inner, write = FE.domain_features, E.materialize
    monkeypatch.setattr(FE, "domain_features", lambda *a: made.append(1) or inner(*a))
    monkeypatch.setattr(E, "materialize", lambda df, name: stored.append(name) or write(df, name))
    folded = S.stratified_folds(parts.where("split = 'train'"), "customerID", "label", 2)
    families = {"logistic_regression": [{"C": c, "max_iter": 5} for c in (0.1, 1.0)]}
    found = E.randomized_search(folded, families, k=2, keep=["customerID", "label"])
    assert len(made) == 1 and sorted(stored) == ["domain", "scores", "scores"]
    # the same numbers as whole pipelines fitted fold by fold
    for r in found.collect():
        train = folded.where(F.col("fold") != r["fold"])
        trained = training.fit_family(train, r["family"], families[r["family"]][r["candidate"]])
        for part, want in ((train, r["train_ap"]), (folded.where(F.col("fold") == r["fold"]), r["test_ap"])):
            scored = E.positive_probability(trained.model.transform(part))
            assert E.evaluate(scored, "label", "p", digits=None).first()["pr_auc"] == pytest.approx(want, abs=1e-9)


def test_contributions_add_up_to_the_log_odds(parts, trained):
    flat = parts.limit(20)
    for stage in trained.model.stages[:2]:
        flat = stage.transform(flat)
    phi = X.attributions(flat, trained.terms, ["customerID"])
    total = sum((F.col(f"`{t.feature}`") for t in trained.terms), F.lit(0.0))
    sums = {r["customerID"]: r["s"] for r in phi.select("customerID", total.alias("s")).collect()}
    base = trained.model.stages[-1].intercept + sum(t.coefficient * t.mean for t in trained.terms)
    scored = E.positive_probability(trained.model.transform(parts.limit(20)))
    for r in scored.select("customerID", F.log(F.col("p") / (1 - F.col("p"))).alias("z")).collect():
        assert sums[r["customerID"]] + base == pytest.approx(r["z"], abs=1e-6)


def test_drivers_are_sorted_and_signed(spark):
    terms = [X.LinearTerm("a", 1.0, 0.5), X.LinearTerm("b", -2.0), X.LinearTerm("c", 0.1)]
    df = spark.createDataFrame([(1.0, 1.0, 1.0)], "a double, b double, c double")
    got = df.select(X.top_drivers(terms, 2).alias("d")).first()["d"]
    assert [(d["feature"], d["contribution"], d["direction"]) for d in got] == [
        ("b", -2.0, "reduces risk"),
        ("a", 0.5, "increases risk"),
    ]
    table = X.coefficient_table(spark, terms, 2).collect()
    assert [r["feature"] for r in table] == ["b", "a"]
    assert table[1]["odds_ratio"] == pytest.approx(2.718281828)


def test_final_evaluation_opens_test_once(parts, trained):
    out = training.final_evaluation(parts, trained)
    names = [r["model"] for r in out["metrics"].collect()]
    assert names == ["validation", "rule on test", "test"]
    assert out["acceptance"].count() == 3
    assert out["sweep"].count() == 190


def test_training_job_publishes_a_model(spark, raw):
    out = scratch_path(spark, "job")
    families = {
        "logistic_regression": [{"C": 1.0, "class_weight": None, "max_iter": 20}],
        "random_forest": [{"n_estimators": 3, "max_depth": 2, "min_samples_leaf": 5}],
    }
    facts = training.training_job(raw, out, families, k=2)
    runs = writers.read_runs(spark, f"{out}/runs").collect()
    assert {r["family"] for r in runs} == set(families)
    assert [r["family"] for r in runs if r["version"] == 1] == [facts["family"]]
    assert spark.read.parquet(f"{out}/history").count() == 4
    assert spark.read.json(f"{out}/report/metrics").count() == 3
    assert spark.read.json(f"{out}/report/sensitivity").count() == 6
    scorer = load_scorer(spark, out)
    assert scorer.facts["features"] == "35"
    assert scorer.threshold == facts["decision_threshold"]
    rows = scorer.score(raw.limit(5)).collect()
    assert all(r["decision_threshold"] == round(scorer.threshold, 4) for r in rows)


def test_training_again_on_a_sealed_split(spark, raw):
    base, out = scratch_path(spark, "sealed"), scratch_path(spark, "again")
    training.split_job(raw, base)
    families = {"logistic_regression": [{"C": 1.0, "class_weight": None, "max_iter": 20}]}
    for _ in range(2):
        training.train_on_split(spark, base, out, families, k=2)
    runs = writers.read_runs(spark, f"{out}/runs").collect()
    assert sorted(r["version"] for r in runs) == [1, 2]
    extra = spark.read.parquet(f"{base}/splits").where("split = 'test'").limit(1)
    extra.write.mode("append").partitionBy("split").parquet(f"{base}/splits")
    with pytest.raises(ContractViolation, match="test"):
        training.train_on_split(spark, base, out, families, k=2)


def test_search_space_draws_every_family():
    space = training.search_space(n_iter=4)
    assert {name: len(drawn) for name, drawn in space.items()} == dict.fromkeys(E.SEARCH_SPACES, 4)


def test_explanations_fall_back_to_train_or_stay_empty(spark, parts, trained):
    path = scratch_path(spark, "nobackground")
    writers.save_model(trained.model, path, spark, {"family": trained.family})
    assert load_scorer(spark, path).terms is None
    assert load_scorer(spark, path).threshold == pytest.approx(1 / 3)
    again = load_scorer(spark, path, train=parts.where("split = 'train'")).terms
    assert [t.feature for t in again] == [t.feature for t in trained.terms]
    assert [t.mean for t in again] == pytest.approx([t.mean for t in trained.terms])


def test_risky_profile_scores_above_a_loyal_one(table_of, trained, parts):
    risky = customer(customerID="risky")
    loyal = customer(
        customerID="loyal", tenure=70, Contract="Two year", InternetService="DSL",
        PaymentMethod="Credit card (automatic)", TotalCharges="4949",
    )
    table = table_of(risky, loyal).drop("Churn")
    rows = {r["customerID"]: r for r in score_records(table, trained.model, trained.terms).collect()}
    assert rows["risky"]["churn_probability"] > rows["loyal"]["churn_probability"]
    for r in rows.values():
        assert 0 <= r["churn_probability"] <= 1
        assert len(r["top_drivers"]) == 5
        if r["should_contact"]:
            assert r["expected_value_of_contact"] > 0
    alone = score_records(table.where("customerID = 'risky'"), trained.model, trained.terms).first()
    assert alone == rows["risky"]
    bare = score_records(table, trained.model).first()
    assert bare["top_drivers"] == []


def test_ranked_batch_keeps_keys_and_quarantine(raw, trained):
    records = raw.drop("Churn")
    ranked, bad = ranked_batch(records, trained.model, terms=trained.terms)
    good = raw.where("tenure > 0").count()
    assert ranked.count() == good
    assert bad.count() == raw.count() - good
    assert ranked.agg(F.max("rank")).first()[0] == good
    everyone, none = ranked_batch(records, trained.model, coerce=True)
    assert (everyone.count(), none.count()) == (raw.count(), 0)


def test_saved_model_scores_alike_and_keeps_its_facts(spark, parts, trained):
    path = scratch_path(spark, "model-test")
    writers.save_model(trained.model, path, spark, {"family": trained.family}, trained.means)
    model, facts, means = writers.load_model(spark, path)
    assert facts["family"] == "logistic_regression"
    assert means == pytest.approx(trained.means)
    a = score_records(parts, trained.model)
    b = score_records(parts, model)
    assert a.drop("top_drivers").exceptAll(b.drop("top_drivers")).count() == 0


def test_stream_equals_batch_and_quarantines(spark, raw, trained):
    inbox, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    raw.write.parquet(inbox)
    job = stream.score_stream(
        stream.read_record_stream(spark, inbox), trained.model, out, f"{out}/ck", trained.terms
    )
    job.awaitTermination()
    scored = spark.read.parquet(f"{out}/scored").drop("batch", "top_drivers")
    good, bad = split_valid(raw)
    batch = score_records(good, trained.model, trained.terms).drop("top_drivers")
    assert scored.exceptAll(batch).count() == batch.exceptAll(scored).count() == 0
    assert spark.read.parquet(f"{out}/quarantine").count() == bad.count()
    # a second run finds nothing new
    again = stream.score_stream(
        stream.read_record_stream(spark, inbox), trained.model, out, f"{out}/ck", trained.terms
    )
    again.awaitTermination()
    assert spark.read.parquet(f"{out}/scored").count() == good.count()


def test_json_records_name_their_errors(spark):
    fine = {k: (float(v) if k == "MonthlyCharges" else v) for k, v in customer().items()}
    cases = {
        "ok": fine,
        "type": fine | {"tenure": "two"},
        "domain": fine | {"InternetService": "Fibre"},
        "extra": fine | {"Tenure2": 5},
        "missing": {k: v for k, v in fine.items() if k != "Contract"},
        "range": fine | {"tenure": -5},
    }
    rows = [(json.dumps(v | {"customerID": k}),) for k, v in cases.items()]
    lines = spark.createDataFrame([*rows, ("not json",)], "value string")
    got = {r["customerID"]: r["errors"] for r in stream.parse_json_records(lines).collect()}
    assert got["ok"] == []
    assert got["type"] == ["tenure"]
    assert got["domain"] == ["InternetService"]
    assert got["extra"] == ["Tenure2"]
    assert got["missing"] == ["Contract"]
    assert got["range"] == ["tenure"]
    assert len(got[None]) == len(TELCO.record_rules)


def test_coerced_records_pass_where_blanks_would_not(raw):
    good, bad = split_valid(coerce_records(raw))
    assert bad.count() == 0
    assert good.count() == raw.count()


# ------------------------------------------------------------------ sources and sinks


def test_checked_append_refuses_bad_and_repeated_rows(spark, table_of):
    path = scratch_path(spark, "append")
    first = table_of(customer(customerID="1"), customer(customerID="2"))
    assert writers.append_checked(first, path) == 2
    with pytest.raises(ContractViolation, match="already stored"):
        writers.append_checked(table_of(customer(customerID="2")), path)
    with pytest.raises(ContractViolation, match="Churn"):
        writers.append_checked(table_of(customer(customerID="3", Churn="Maybe")), path)
    assert writers.append_checked(table_of(customer(customerID="3")), path) == 1
    rows = commits.read_committed(spark, path, TELCO.schema)
    assert {(r["customerID"], r["_version"]) for r in rows.collect()} == {("1", 1), ("2", 1), ("3", 2)}
    assert commits.read_committed(spark, path, TELCO.schema, 1).count() == 2
    assert commits.read_committed(spark, path + "-none", TELCO.schema).count() == 0


def test_a_late_writer_is_refused_by_name(spark, table_of):
    path = scratch_path(spark, "late")
    name, _ = commits.stage(table_of(customer(customerID="8")), path)
    assert writers.append_checked(table_of(customer(customerID="1")), path) == 1
    with pytest.raises(commits.LateWriter, match="version 1"):
        commits.publish(spark, path, name, 1, 0)
    assert [c["rows"] for c in commits.commits(spark, path)] == [1]
    assert commits.publish(spark, path, name, 1, 1) == 2 == commits.version(spark, path)
    assert commits.read_committed(spark, path, TELCO.schema).count() == 2


def test_csv_is_read_verbatim(spark, raw):
    path = scratch_path(spark, "csv")
    raw.write.options(**writers.CSV_VERBATIM).csv(path)
    back = readers.read_customers(spark, path, expected_rows=raw.count())
    assert back.exceptAll(raw).count() == raw.exceptAll(back).count() == 0
    with pytest.raises(ContractViolation, match="row_count"):
        readers.read_customers(spark, path, expected_rows=7)


def test_splits_are_stored_sealed_and_pruned(spark, raw):
    base = scratch_path(spark, "splits")
    parts = S.stratified_split(raw, "customerID", "Churn")
    manifest = writers.save_splits(parts, base)
    val = readers.read_split(spark, base, "val")
    assert val.count() == manifest.where("split = 'val'").first()["rows"]
    assert "PartitionFilters: [isnotnull(split" in val._jdf.queryExecution().executedPlan().toString()
    stored = readers.read_manifest(spark, base)
    assert stored.first()["total_rows"] == raw.count()
    S.require_sealed(parts, stored, "customerID")
    with pytest.raises(ContractViolation, match="unknown split"):
        readers.read_split(spark, base, "holdout")


def test_splits_are_placed_once(spark, raw, monkeypatch):
    seen = []
    check = writers.require_disjoint
    monkeypatch.setattr(writers, "require_disjoint", lambda df, *a: seen.append(df) or check(df, *a))
    training.split_job(raw, scratch_path(spark, "split"))
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "holdfast-parts" in plan


def test_a_fit_makes_its_feature_columns_once(parts, monkeypatch):
    made, inner = [], FE.domain_features
    monkeypatch.setattr(FE, "domain_features", lambda *a: made.append(1) or inner(*a))
    params = {"C": 1.0, "max_iter": 3}
    trained = training.fit_family(parts.where("split = 'train'"), "logistic_regression", params)
    assert len(made) == 1 and len(trained.terms) == len(trained.feature_names)
    assert trained.model.transform(parts).count() == parts.count()


def test_run_log_numbers_registered_versions(spark):
    path = scratch_path(spark, "runs")
    writers.log_run(spark, path, "a", {"C": 1}, {"ap": 0.5})
    writers.log_run(spark, path, "a", {"C": 2}, {"ap": 0.6}, register=True)
    writers.log_run(spark, path, "b", {"C": 3}, {"ap": 0.7}, register=True)
    runs = writers.read_runs(spark, path)
    assert sorted(r["version"] for r in runs.collect() if r["version"]) == [1, 2]
    assert runs.select("run_id").distinct().count() == 3


def test_reports_history_and_exports(spark, raw):
    path = scratch_path(spark, "report")
    nested = spark.createDataFrame([("x", [("f", 1.0)])], "name string, d array<struct<a:string,b:double>>")
    writers.write_report(nested, path)
    assert spark.read.json(path).first()["d"][0]["a"] == "f"
    runs = scratch_path(spark, "history")
    writers.append_history(history(spark, {"a": [0.1]}), runs)
    writers.append_history(history(spark, {"b": [0.2, 0.3]}), runs)
    assert spark.read.parquet(runs).count() == 3
    written = warehouse.export_all(spark, raw, scratch_path(spark, "exports"))
    assert set(written) == {"customers", *warehouse.MARTS}
    detail = spark.read.option("header", True).csv(written["customers"])
    assert (detail.count(), len(detail.columns)) == (raw.count(), 31)
    assert set(r["churned"] for r in detail.select("churned").distinct().collect()) == {"Yes", "No"}


def test_layers_answer_sql_and_the_report_has_six_sections(spark, raw):
    layers = warehouse.build_layers(spark, raw)
    assert len(layers) == 9
    total = readers.ask(spark, "SELECT customers FROM v_churn_by_segment WHERE aggregation_level = 3")
    assert total.first()["customers"] == raw.count()
    sections = warehouse.report(spark)
    assert {k: d.count() > 0 for k, d in sections.items()} == dict.fromkeys(
        ["kpis", "segments", "retention", "revenue", "paradox", "deciles"], True
    )


def test_scratch_follows_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def brute_tree(bins, pos, neg, depth):
    """P(positive) of each row by a plain recursive tree over all features."""
    out = np.zeros(len(bins))

    def purity(rows):
        return (pos[rows].sum() ** 2 + neg[rows].sum() ** 2) / (pos[rows].sum() + neg[rows].sum())

    def grow(rows, left):
        out[rows] = pos[rows].sum() / (pos[rows].sum() + neg[rows].sum())
        best = (1e-9, None)
        for f in range(bins.shape[1]) if left else ():
            for cut in range(bins[rows, f].max()):
                low, high = rows[bins[rows, f] <= cut], rows[bins[rows, f] > cut]
                if (pos + neg)[low].sum() and (pos + neg)[high].sum():
                    drop = purity(low) + purity(high) - purity(rows)
                    if drop > best[0] + 1e-9:
                        best = (drop, (low, high))
        if best[1]:
            for side in best[1]:
                grow(side, left - 1)

    grow(np.arange(len(bins)), depth)
    return out


@pytest.mark.parametrize("depth", [0, 1, 3, 30])
def test_forest_tree_equals_recursive_tree(depth):
    draw = np.random.default_rng(depth)
    # drops that are no whole numbers, so that no two splits tie
    bins = draw.integers(0, 6, (60, 3)).astype(np.uint8)
    pos, neg = draw.integers(0, 999, 60), draw.integers(0, 999, 60)
    pos[:5] = neg[:5] = 0
    pos[5:30:2] = 0
    found = FO.tree_probabilities(bins, pos, neg, depth, 3, np.random.default_rng(1))
    # small nodes can tie, which only shows in rows that do not count
    counted = pos + neg > 0 if depth == 30 else slice(None)
    np.testing.assert_allclose(found[counted], brute_tree(bins, pos, neg, depth)[counted])


def test_forest_scores_separate_classes_and_ignore_partitions(spark):
    rows = spark.range(600).selectExpr(
        "CAST(id % 2 AS INT) AS label",
        "IF(id % 5 = 0, 'test', 'train') AS split",
        "array(double(id % 2) * 40 + id % 11, double(id % 7), double(id % 3)) AS x",
    )
    scored = FO.forest_scores(rows, "x", "label", "split", trees=7, depth=30)
    again = FO.forest_scores(rows.repartition(5), "x", "label", "split", trees=7, depth=30)
    found = sorted((r.label, r.p) for r in scored.collect())
    assert found == sorted((r.label, r.p) for r in again.collect())
    assert len(found) == 120 and all((p > 0.5) == (y == 1) for y, p in found)


def test_leakage_audit_jobs_do_not_grow_with_depth_or_trees(spark, sf):
    from holdfast.operators import leakage
    from holdfast.session import materialize
    from holdfast.sources.testtables import subscribers

    raw = materialize(subscribers(spark, sf), "audit")
    tracker, found = spark.sparkContext.statusTracker(), {}
    for trees, depth in ((4, 2), (40, 30)):
        spark.sparkContext.setJobGroup(f"audit-{trees}", "audit")
        leakage.leakage_audit(raw, trees=trees, depth=depth).collect()
        found[trees] = len(tracker.getJobIdsForGroup(f"audit-{trees}"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # adaptive joins cost a job more or less
    assert abs(found[40] - found[4]) <= 6
