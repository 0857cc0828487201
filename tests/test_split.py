"""Splits, folds, samples, seals and oversampling."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from holdfast.operators import leakage as L
from holdfast.operators import split as S
from holdfast.operators.quality import ContractViolation


@pytest.fixture(scope="module")
def base(spark):
    """7,043 ids with 1,869 positives, the sizes of the published split."""
    return spark.range(7043).select(
        F.format_string("%05d", "id").alias("id"),
        F.when(F.col("id") * 7 % 7043 < 1869, "Yes").otherwise("No").alias("y"),
    ).cache()


@pytest.fixture(scope="module")
def parts(base):
    return S.stratified_split(base, "id", "y", rows_per_cell=500).cache()


def test_published_sizes_and_rates(parts):
    found = {r["split"]: r for r in S.split_manifest(parts, "id", "y", "Yes").collect()}
    assert {k: r["rows"] for k, r in found.items()} == {"train": 4929, "val": 1057, "test": 1057}
    assert {k: r["share"] for k, r in found.items()} == {"train": 0.6998, "val": 0.1501, "test": 0.1501}
    assert found["train"]["churn_rate"] == 0.2654
    rates = [r["churn_rate"] for r in found.values()]
    assert max(rates) - min(rates) < 0.02


def test_disjoint_and_complete(base, parts):
    assert all(r["shared"] == 0 for r in S.overlap_report(parts, "id", "split").collect())
    S.require_disjoint(parts, "id", "split")
    assert parts.select("id").distinct().count() == base.count()
    leaky = parts.unionByName(parts.where("split = 'test'").limit(3).withColumn("split", F.lit("train")))
    with pytest.raises(ContractViolation, match="3 ids"):
        S.require_disjoint(leaky, "id", "split")


def test_same_assignment_for_any_partitioning_but_not_any_seed(base, parts):
    again = S.stratified_split(base.repartition(17), "id", "y", rows_per_cell=64)
    assert again.select("id", "split").exceptAll(parts.select("id", "split")).count() == 0
    other = S.stratified_split(base, "id", "y", seed=43)
    assert other.select("id", "split").exceptAll(parts.select("id", "split")).count() > 1000


@settings(max_examples=200, deadline=None)
@given(
    st.dictionaries(st.text(max_size=3), st.integers(1, 10_000), min_size=1, max_size=6),
    st.floats(0, 1),
)
def test_quotas_are_whole_and_near_proportion(counts, share):
    total = sum(counts.values())
    wanted = int(total * share)
    quota = S.allocate(counts, wanted)
    assert sum(quota.values()) == wanted
    for k, n in counts.items():
        assert 0 <= quota[k] <= n
        assert abs(quota[k] - n * wanted / total) < 1


def test_folds_spread_every_class(base):
    folds = S.stratified_folds(base, "id", "y", 5, rows_per_cell=300)
    sizes = [r["count"] for r in folds.groupBy("y", "fold").count().where("y = 'Yes'").collect()]
    assert len(sizes) == 5
    assert max(sizes) - min(sizes) <= 1


def test_sample_is_exact_and_stable(base):
    first = S.sample_n(base, "id", 200)
    second = S.sample_n(base.repartition(9), "id", 200)
    assert first.count() == 200
    assert first.exceptAll(second).count() == 0
    large = S.sample_n(base, "id", 20_000)
    assert large.count() == 7043


def test_sample_shuffles_only_the_cells_it_needs(spark, base):
    plan = S.sample_n(base, "id", 200)
    rows = sorted(base.collect(), key=lambda r: hashlib.md5(f"sample-42:{r['id']}".encode()).hexdigest())
    assert {r["id"] for r in plan.collect()} == {r["id"] for r in rows[:200]}
    assert S.sample_n(base, "id", 0).count() == 0 and S.sample_n(base.limit(0), "id", 5).count() == 0
    mixed = base.withColumn("id", F.when(F.col("id") > "5", F.col("id")))
    assert S.sample_n(mixed, "id", 6000).count() == 6000


def tree_root(ids, depth=4):
    """Plain form of the tree of digests."""
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    level = {}
    for i in ids:
        level.setdefault(digest(i)[:depth], []).append(i)
    level = {block: digest("|".join(sorted(own))) for block, own in level.items()}
    for length in range(depth - 1, -1, -1):
        above = {}
        for block in sorted(level):
            above.setdefault(block[:length], []).append(block[length] + level[block])
        level = {block: digest("".join(own)) for block, own in above.items()}
    return level[""][:16]


def test_tree_seal_names_the_block_that_changed(parts):
    manifest = S.split_manifest(parts, "id", "y", "Yes", mode=S.MERKLE_MODE).cache()
    ids = {}
    for r in parts.collect():
        ids.setdefault(r["split"], []).append(r["id"])
    assert {r["split"]: r["id_fingerprint"] for r in manifest.collect()} == {k: tree_root(v) for k, v in ids.items()}
    S.require_sealed(parts.repartition(5), manifest, "id")
    gone = ids["test"][0]
    lost = parts.where(F.col("id") != gone)
    with pytest.raises(ContractViolation, match="test"):
        S.require_sealed(lost, manifest, "id")
    blocks = [S.merkle_blocks(p, "id", "split") for p in (lost, parts)]
    (found,) = S.merkle_difference(*blocks).collect()
    assert (found["split"], found["block"]) == ("test", hashlib.sha256(gone.encode()).hexdigest()[:4])
    assert found["rows_then"] == found["rows_now"] + 1
    unknown = manifest.withColumn("fingerprint_mode", F.lit("other"))
    assert not any(r["sealed"] for r in S.seal_check(parts, unknown, "id").collect())
    with pytest.raises(ValueError, match="unknown fingerprint mode"):
        S.split_manifest(parts, "id", "y", "Yes", mode="other")


def test_seal_breaks_when_one_id_changes(parts):
    manifest = S.split_manifest(parts, "id", "y", "Yes").cache()
    S.require_sealed(parts.repartition(5), manifest, "id")
    lost = parts.where(~((F.col("split") == "test") & (F.col("id") == parts.where("split='test'").first()["id"])))
    with pytest.raises(ContractViolation, match="test"):
        S.require_sealed(lost, manifest, "id")
    renamed = parts.withColumn(
        "id", F.when(F.col("id") == parts.where("split='val'").first()["id"], "x").otherwise(F.col("id"))
    )
    checks = {r["split"]: r["sealed"] for r in S.seal_check(renamed, manifest, "id").collect()}
    assert checks == {"train": True, "val": False, "test": True}


def test_oversampling_balances_with_copies_of_positives_only(base):
    labelled = base.select("id", (F.col("y") == "Yes").cast("int").alias("label"))
    out = S.oversample(labelled, "label", "id", rows_per_cell=100).cache()
    counts = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    assert counts[0] == counts[1] == 7043 - 1869
    copies = out.where("draw IS NOT NULL")
    assert copies.where("label = 0").count() == 0
    assert copies.select("draw").distinct().count() == copies.count() == 7043 - 2 * 1869
    assert out.where("draw IS NULL").count() == 7043
    # with replacement: some rows are drawn more than once, some never
    per_id = copies.groupBy("id").count()
    assert per_id.where("count > 1").count() > 0
    assert per_id.count() < 1869


def test_oversampling_needs_positives_and_skips_balanced_data(spark):
    even = spark.createDataFrame([("a", 1), ("b", 0)], "id string, label int")
    assert S.oversample(even, "label", "id").count() == 2
    none = spark.createDataFrame([("a", 0), ("b", 0)], "id string, label int")
    with pytest.raises(ValueError, match="no positive"):
        S.oversample(none, "label", "id")


def test_only_the_wrong_order_contaminates(base):
    labelled = base.select("id", (F.col("y") == "Yes").cast("int").alias("label"))
    wrong = S.seen_in_training(L.balance_then_split(labelled, "id"), "id").first()
    right = S.seen_in_training(L.split_then_balance(labelled, "id"), "id").first()
    assert wrong["customers_in_both_splits"] > 500
    assert wrong["share_of_test_seen_in_training"] > 0.3
    assert right["customers_in_both_splits"] == 0
    assert right["share_of_test_seen_in_training"] == 0.0
