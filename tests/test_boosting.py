"""Leaf-wise boosting against a plain search over all splits."""

import math
import subprocess
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from holdfast.operators import boosting as B
from holdfast.operators.models import positive_probability
from holdfast.session import scratch_path


def data(n=400, seed=1):
    rng = np.random.default_rng(seed)
    x = np.column_stack(
        [rng.integers(0, 30, n), rng.integers(-9, 9, n) / 4, rng.integers(0, 2, n), np.full(n, 3.0)]
    ).astype(float)
    z = (x[:, 0] > 14) * 1.5 - (x[:, 1] > 0) * x[:, 2] * 2 + rng.normal(size=n) * 0.7
    return x, (z > 0.2).astype(float)


def frame(spark, x, y, w=None):
    w = np.ones(len(y)) if w is None else w
    rows = [(a.tolist(), None if b is None else float(b), float(c)) for a, b, c in zip(x, y, w)]
    made = spark.createDataFrame(rows, "x array<double>, label double, weight double")
    return made.select(array_to_vector("x").alias("features"), "label", "weight", "x")


def plain_trees(x, y, w, run):
    """Margins after all trees, grown by trying every split of every leaf."""
    share = (w * y).sum() / w.sum()
    margin = np.full(len(y), math.log(share / (1 - share)))
    sizes = []
    for _ in range(run.max_iter):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)
        leaves = [np.arange(len(y))]
        while len(leaves) < run.max_leaf_nodes:
            best = None
            for at, rows in enumerate(leaves):
                for f in range(x.shape[1]):
                    for cut in np.unique(x[rows, f])[:-1]:
                        low = x[rows, f] <= cut
                        parts = rows[low], rows[~low]
                        if min(map(len, parts)) < run.min_samples_leaf:
                            continue
                        if min(h[r].sum() for r in parts) < B.MIN_HESSIAN:
                            continue
                        loss = lambda r: g[r].sum() ** 2 / (h[r].sum() + run.l2)
                        gain = loss(parts[0]) + loss(parts[1]) - loss(rows)
                        if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                            best = gain, at, parts
            if best is None:
                break
            leaves[best[1] : best[1] + 1] = best[2]
        for rows in leaves:
            margin[rows] -= run.learning_rate * g[rows].sum() / (h[rows].sum() + run.l2)
        sizes.append(sorted(map(len, leaves)))
    return margin, sizes


def margins(model, x):
    return model["baseline"] + B._margins(x, model["trees"], "threshold")


RUNS = [
    B.Run(0.3, 3, 5, 20, 1.0),
    B.Run(0.1, 2, 9, 5, 0.0),
    B.Run(0.5, 1, 100, 40, 10.0),
]


@pytest.fixture(scope="module")
def learned(spark):
    x, y = data()
    return B.boost(frame(spark, x, y).repartition(3), RUNS)


@pytest.mark.parametrize("k", range(len(RUNS)))
def test_trees_are_those_of_a_search_over_all_splits(learned, k):
    x, y = data()
    want, sizes = plain_trees(x, y, np.ones(len(y)), RUNS[k])
    assert np.allclose(margins(learned[k], x), want, atol=1e-7)
    for tree, size in zip(learned[k]["trees"], sizes):
        at = B._route(x, tree, "threshold")
        assert sorted(np.unique(at, return_counts=True)[1]) == size
        assert len(size) <= RUNS[k].max_leaf_nodes and min(size) >= RUNS[k].min_samples_leaf


def test_runs_together_equal_runs_alone_on_any_partitions(spark, learned):
    x, y = data()
    alone = B.boost(frame(spark, x, y).repartition(7, "x"), RUNS[1:2])
    assert alone[0] == learned[1]


def test_class_factors_and_row_weights_are_weights(spark):
    x, y = data(200, 3)
    w = np.where(np.arange(200) % 3 == 0, 2.0, 0.5)
    run = B.Run(0.2, 2, 4, 10, 0.5)
    factored = B.boost(frame(spark, x, y, w), [B.Run(0.2, 2, 4, 10, 0.5, (1.0, 3.0))], weight="weight")
    weighted = B.boost(frame(spark, x, y, w * np.where(y > 0, 3.0, 1.0)), [run], weight="weight")
    want, _ = plain_trees(x, y, w * np.where(y > 0, 3.0, 1.0), run)
    assert np.allclose(margins(factored[0], x), want, atol=1e-6)
    assert np.allclose(margins(weighted[0], x), want, atol=1e-6)


def test_margins_that_are_written_down_change_nothing(spark, monkeypatch):
    x, y = data(150, 5)
    run = [B.Run(0.3, 4, 3, 10, 0.0)]
    whole = B.boost(frame(spark, x, y), run)
    monkeypatch.setattr(B, "TREES_PER_STATE", 1)
    assert B.boost(frame(spark, x, y), run) == whole


def test_stage_scores_saves_and_loads(spark):
    x, y = data(200, 7)
    df = frame(spark, x, y)
    stage = B.LeafwiseBoosting(maxIter=2, maxLeafNodes=4, minSamplesLeaf=10, l2=1.0, learningRate=0.3)
    model = stage.fit(df)
    path = scratch_path(spark, "booster")
    PipelineModel(stages=[model]).write().overwrite().save(path)
    again = PipelineModel.load(path)
    scores = [[r.p for r in positive_probability(m.transform(df)).collect()] for m in (model, again)]
    want, _ = plain_trees(x, y, np.ones(200), B.Run(0.3, 2, 4, 10, 1.0))
    assert np.allclose(scores[0], 1 / (1 + np.exp(-want)), atol=1e-7) and scores[0] == scores[1]
    held = model.leaves()
    assert {r["tree"] for r in held} == {0, 1} and len(held) <= 8
    loaded = B.LeafwiseBoosting().copy({})
    assert loaded.run() == B.Run()


def test_odd_rows(spark):
    nan = float("nan")
    x = np.array([[1.0], [2.0], [3.0], [nan], [nan], [2.0]] * 5)
    y = [0, 0, 1, 1, 1, None] * 5
    run = [B.Run(0.5, 1, 3, 2, 0.0)]
    model = B.boost(frame(spark, x, y), run)[0]
    seen = margins(model, np.array([[1.0], [2.0], [nan], [9.0], [-9.0]]))
    assert seen[0] == seen[1] == seen[4] < seen[2] == seen[3]  # a missing value is larger than any
    one = B.boost(frame(spark, x, [1.0] * 30), run)[0]
    assert [t["feature"] for t in one["trees"]] == [[-1]]  # nothing to split
    scored = B.LeafwiseBoosting(maxIter=1, minSamplesLeaf=2).fit(frame(spark, x, y))
    assert scored.transform(frame(spark, x, y).limit(0)).count() == 0
    with pytest.raises(ValueError):
        B.boost(frame(spark, x, [None] * 30), run)
    with pytest.raises(ValueError):
        B.LeafwiseBoosting(maxBins=300)


def test_bins_of_many_values_are_quantiles(spark):
    df = spark.range(5000).select(F.array(F.col("id").cast("double"), F.lit(1.0)).alias("x"))
    cuts = B.bin_cuts(df, "x", 2)
    assert len(cuts[0]) == B.MAX_BINS - 1 and cuts[1] == []
    assert max(np.diff(cuts[0])) <= 2 * 5000 / 254
    assert B.bin_cuts(df.where("id < 4"), "x", 1) == [[0.0, 1.0, 2.0]]


def test_splits_of_a_round_shuffle_the_sums_once(spark):
    cells = spark.range(40).selectExpr(
        "CAST(id DIV 100 AS INT) AS run", "CAST(id % 2 AS INT) AS node", "CAST(id % 4 AS INT) AS feature",
        "CAST(id % 5 AS INT) AS bin", "id - 20 AS g", "id + 1 AS h", "id AS n",
    )
    splits = B.best_splits(cells, [B.Run(min_samples_leaf=1)], 1.0)
    plan = splits._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # by feature, then the best of each node
    few = B.best_splits(cells, [B.Run(min_samples_leaf=1)], 1.0, 100)  # no more partitions than the groups fill
    assert ", 2), REPARTITION_BY_NUM" in few._jdf.queryExecution().executedPlan().toString()
    assert sorted(few.collect()) == sorted(splits.collect()) and splits.count() == 2


def test_rows_are_routed_alike_whole_or_in_part():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 3))
    x[::7, 1] = np.nan
    tree = {
        "feature": [1, 0, 2, -1, -1, -1, -1], "threshold": [0.1, -0.2, 0.3, 0, 0, 0, 0],
        "left": [1, 3, 5, 0, 0, 0, 0], "right": [2, 4, 6, 0, 0, 0, 0], "value": [0, 0, 0, 1.0, 2.0, 4.0, 8.0],
    }
    want = []
    for row in x:
        at = 0
        while tree["feature"][at] >= 0:
            low = row[tree["feature"][at]] <= tree["threshold"][at]
            at = tree["left" if low else "right"][at]
        want.append(at)
    assert B._route(x, tree, "threshold").tolist() == want
    some = np.array([5, 0, 199, 7])
    sums = B._margins(np.asfortranarray(x), [tree, tree], "threshold", some)
    assert sums[some].tolist() == [2 * tree["value"][want[i]] for i in some] and np.count_nonzero(sums) == 4


def test_task_functions_need_no_installed_package(tmp_path):
    grown = [B.Growth(B.Run(), 0.0)]
    wanted = {0: grown[0].begin()}
    made = [B._blocks([[1.0]]), B._with_margins(1, grown), B._histograms(1, grown, wanted, 1.0)]
    file = tmp_path / "functions"
    file.write_bytes(cloudpickle.dumps(made))
    code = f"import pickle; pickle.load(open({str(file)!r}, 'rb'))"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": ""}, check=True)
