"""Gradient boosting on histograms with best-first (leaf-wise) trees, for several settings at once.

Features are cut into at most 255 bins once. Rows then live in blocks in the shared folder:
bins as bytes, label, weight, and the margin of every run (a run is one parameter setting). One Spark job
sums gradients, hessians and rows per (run, node, feature, bin), finds each node's best split and
returns one row per node; trees grow on the driver from these rows. All runs share each
pass, so thirty settings cost as many scans as the slowest of them alone.

A tree always splits the leaf of highest gain next, up to ``max_leaf_nodes``. The splits that
could come next are looked at together, so a tree takes about as many jobs as it is deep
and not one per split. Sums are of whole numbers (gradients in steps of a power of two), so
they are exact and do not depend on how rows are dealt to tasks.
"""

from __future__ import annotations

import heapq
import json
import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from holdfast.session import materialize

# task functions travel by value: executors need no installed copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_BINS = 255
BLOCK_ROWS = 1 << 14
#: Least sum of hessians on each side of a split.
MIN_HESSIAN = 1e-3
#: Trees that passes evaluate anew before margins are written down.
TREES_PER_STATE = 8
QUANTILE_ACCURACY = 10_000
#: Features of nodes whose sums meet in one partition, at most 255 bins each.
GROUPS_PER_PARTITION = 64


@dataclass(frozen=True)
class Run:
    """One parameter setting; a row weighs its own weight times the factor of its class."""

    learning_rate: float = 0.1
    max_iter: int = 100
    max_leaf_nodes: int = 31
    min_samples_leaf: int = 20
    l2: float = 0.0
    factors: tuple[float, float] = (1.0, 1.0)


@dataclass
class Node:
    parent: int
    gradient: float
    hessian: float
    rows: int
    best: tuple | None = None  # gain, feature, bin and the left side's gradient, hessian, rows
    known: bool = False
    children: tuple[int, int] | None = None
    split: bool = False


@dataclass
class Growth:
    """The tree of one run that is growing, and those it has grown."""

    run: Run
    baseline: float
    trees: list[dict] = field(default_factory=list)
    fresh: list[dict] = field(default_factory=list)  # not yet part of the stored margins
    nodes: list[Node] = field(default_factory=list)
    heap: list[tuple] = field(default_factory=list)
    leaves: int = 0

    @property
    def done(self) -> bool:
        return len(self.trees) >= self.run.max_iter

    def begin(self) -> list[int]:
        self.nodes, self.heap, self.leaves = [Node(-1, 0.0, 0.0, 0)], [], 1
        return [0]

    def _expand(self, at: int) -> list[int]:
        """Children of a node by its best split; those that must be looked at."""
        node = self.nodes[at]
        _, _, _, g, h, n = node.best
        sides = ((g, h, n), (node.gradient - g, node.hessian - h, node.rows - n))
        first = len(self.nodes)
        node.children = (first, first + 1)
        self.nodes += [Node(at, *side) for side in sides]
        fresh = []
        for child in node.children:
            if self.nodes[child].rows >= 2 * self.run.min_samples_leaf:
                fresh.append(child)
            else:
                self.nodes[child].known = True
        return fresh

    def _push(self, at: int) -> None:
        if self.nodes[at].best is not None:
            heapq.heappush(self.heap, (-self.nodes[at].best[0], at))

    def told(self, found: dict[int, tuple]) -> None:
        """Sums and best splits of the nodes that were looked at."""
        for at, (g, h, n, best) in found.items():
            node = self.nodes[at]
            node.gradient, node.hessian, node.rows = g, h, n
            node.best, node.known = best, True
            if at == 0 or self.nodes[node.parent].split:
                self._push(at)

    def advance(self) -> list[int]:
        """Splits best first as far as the gains are known; nodes to look at, none at the end."""
        wanted = []
        while self.leaves < self.run.max_leaf_nodes and self.heap:
            _, at = heapq.heappop(self.heap)
            node = self.nodes[at]
            if node.children is None:
                wanted += self._expand(at)
            node.split = True
            self.leaves += 1
            left = self.run.max_leaf_nodes - self.leaves
            if not left:
                return []
            for child in node.children:
                if self.nodes[child].known:
                    self._push(child)
            if not all(self.nodes[child].known for child in node.children):
                for _, other in heapq.nsmallest(left, self.heap):
                    if self.nodes[other].children is None:
                        wanted += self._expand(other)
                return wanted
        return []

    def finish(self) -> None:
        """The grown tree as arrays: only splits that were taken, leaves with their values."""
        order, place = [0], {}
        for at in order:
            place[at] = len(place)
            if self.nodes[at].split:
                order += self.nodes[at].children
        tree = {"feature": [], "bin": [], "left": [], "right": [], "value": []}
        for at in order:
            node = self.nodes[at]
            _, feature, cut = node.best[:3] if node.split else (0.0, -1, 0)
            left, right = (place[c] for c in node.children) if node.split else (0, 0)
            value = -self.run.learning_rate * node.gradient / max(node.hessian + self.run.l2, 1e-12)
            for name, entry in zip(tree, (feature, cut, left, right, 0.0 if node.split else value)):
                tree[name].append(entry)
        self.trees.append(tree)
        self.fresh.append(tree)

    def partial(self) -> dict:
        """The growing tree with everything that is expanded, for routing rows."""
        cuts = [(n.best[1], n.best[2]) if n.children else (-1, 0) for n in self.nodes]
        return {
            "feature": [f for f, _ in cuts],
            "bin": [b for _, b in cuts],
            "left": [n.children[0] if n.children else 0 for n in self.nodes],
            "right": [n.children[1] if n.children else 0 for n in self.nodes],
        }


def _ends(values: np.ndarray, tree: dict, cut: str, rows: np.ndarray | None = None):
    """(node, rows that end there) of a tree; ``rows`` are the positions that are routed, else all.

    Positions are parted column by column, which is quick where ``values`` holds its columns together.
    """
    stack = [(0, np.arange(len(values)) if rows is None else rows)]
    while stack:
        at, own = stack.pop()
        feature = tree["feature"][at]
        if feature < 0 or not len(own):
            yield at, own
            continue
        low = values[:, feature].take(own) <= tree[cut][at]
        stack += [(tree["left"][at], own[low]), (tree["right"][at], own[~low])]


def _route(values: np.ndarray, tree: dict, cut: str = "bin") -> np.ndarray:
    """The node where each row (of bins, or of values) ends."""
    node = np.zeros(len(values), dtype=np.int64)
    for at, own in _ends(values, tree, cut):
        node[own] = at
    return node


def _margins(
    values: np.ndarray, trees: Sequence[dict], cut: str = "bin", rows: np.ndarray | None = None
) -> np.ndarray:
    """Sums of the trees for each row; 0 outside ``rows``, if they are given."""
    out = np.zeros(len(values))
    for tree in trees:
        for at, own in _ends(values, tree, cut, rows):
            out[own] += tree["value"][at]
    return out


# ------------------------------------------------------------------ rows in blocks


def bin_cuts(df: DataFrame, vector: str, width: int, max_bins: int = MAX_BINS) -> list[list[float]]:
    """Increasing upper ends of the bins of each feature but the last bin's, from one aggregate."""
    shares = [i / (max_bins - 1) for i in range(max_bins)]
    x = F.col(vector)
    present = lambda i: F.when(~F.isnan(x[i]), x[i])
    found = df.agg(
        *(F.percentile_approx(present(i), shares, QUANTILE_ACCURACY).alias(f"c{i}") for i in range(width))
    ).first()
    return [sorted(set(found[f"c{i}"] or []))[:-1] for i in range(width)]


def _blocks(cuts: list[list[float]]):
    edges = [np.array(c) for c in cuts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                x = part.column("x").flatten().to_numpy(zero_copy_only=False)
                x = x.reshape(part.num_rows, len(edges))
                bins = np.empty(x.shape[::-1], dtype=np.uint8)  # a feature's bins lie together
                for k, edge in enumerate(edges):
                    bins[k] = np.searchsorted(edge, x[:, k], side="left")
                label = part.column("label").to_numpy(zero_copy_only=False) > 0.5
                weight = part.column("weight").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([v.tobytes()], pa.binary())
                        for v in (bins, label, weight.astype(float), np.zeros(0))
                    ],
                    names=["bins", "label", "weight", "margin"],
                )

    return run


def _unpacked(batch: pa.RecordBatch, width: int, runs: int):
    """(bins, label, weight, margin per run or None) of each block."""
    for bins, label, weight, margin in zip(*(batch.column(k) for k in range(4))):
        bins = np.frombuffer(bins.as_buffer(), dtype=np.uint8).reshape(width, -1).T
        margin = np.frombuffer(margin.as_buffer())
        yield (
            bins,
            np.frombuffer(label.as_buffer(), dtype=bool),
            np.frombuffer(weight.as_buffer()),
            margin.reshape(runs, -1) if len(margin) else None,
        )


def _with_margins(width: int, grown: list[Growth]):
    """Blocks whose margins hold all trees grown so far."""
    fresh = [(g.baseline, g.fresh) for g in grown]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for bins, _, _, margin in _unpacked(batch, width, len(fresh)):
                rows = [
                    (base if margin is None else margin[k]) + _margins(bins, trees)
                    for k, (base, trees) in enumerate(fresh)
                ]
                out.append(np.concatenate(rows).tobytes())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(3)), pa.array(out, pa.binary())],
                names=["bins", "label", "weight", "margin"],
            )

    return run


def _histograms(width: int, grown: list[Growth], wanted: dict[int, list[int]], scale: float):
    """Sums per (run, node, feature, bin) over the rows of a task, for the wanted nodes."""
    plans = {
        k: (grown[k].run.factors, grown[k].baseline, list(grown[k].fresh), grown[k].partial(), len(grown[k].nodes), nodes)
        for k, nodes in wanted.items()
    }
    runs = len(grown)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {k: np.zeros((3, width, len(plan[5]), 256), dtype=np.int64) for k, plan in plans.items()}
        for batch in batches:
            for bins, label, weight, margin in _unpacked(batch, width, runs):
                sizes = bins.max(axis=0).astype(int) + 1
                for k, (factors, base, trees, tree, size, nodes) in plans.items():
                    slot = np.full(size, -1)
                    slot[nodes] = np.arange(len(nodes))
                    ends = [(slot[at], own) for at, own in _ends(bins, tree, "bin") if slot[at] >= 0]
                    here = np.concatenate([own for _, own in ends] or [np.zeros(0, dtype=np.int64)])
                    if not len(here):
                        continue
                    at = np.repeat([s for s, _ in ends], [len(own) for _, own in ends])
                    score = (base if margin is None else margin[k][here]) + _margins(bins, trees, rows=here)[here]
                    hit = label[here]
                    p = 1.0 / (1.0 + np.exp(-score))
                    w = weight[here] * np.where(hit, factors[1], factors[0])
                    g = np.rint(w * (p - hit) * scale)
                    h = np.rint(w * p * (1.0 - p) * scale)
                    # feature by feature: the keys and sums of one stay in the cache
                    for f, bins_of in enumerate(sizes):
                        key = at * bins_of + bins[:, f].take(here)
                        most, shape = len(nodes) * bins_of, (len(nodes), bins_of)
                        into = totals[k][:, f, :, :bins_of]
                        # sums of a block stay below 2**53, so they are exact in doubles as well
                        into[0] += np.bincount(key, g, most).astype(np.int64).reshape(shape)
                        into[1] += np.bincount(key, h, most).astype(np.int64).reshape(shape)
                        into[2] += np.bincount(key, minlength=most).reshape(shape)
        for k, (*_, nodes) in plans.items():
            feature, slot, cell = full = np.nonzero(totals[k][2])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(cell), k, dtype=np.int32)),
                    pa.array(np.array(nodes, dtype=np.int32)[slot]),
                    pa.array(feature.astype(np.int32)),
                    pa.array(cell.astype(np.int32)),
                    *(pa.array(totals[k][j][full]) for j in range(3)),
                ],
                names=["run", "node", "feature", "bin", "g", "h", "n"],
            )

    return run


def best_splits(cells: DataFrame, runs: Sequence[Run], scale: float, groups: int | None = None) -> DataFrame:
    """``run, node, g, h, n, best`` of every node, from its (feature, bin) sums.

    A split sends bins up to ``bin`` left. Its gain is the drop of the penalised loss; only gains above
    zero count, with enough rows and hessian on both sides. The first feature and the lowest bin win a tie.
    ``groups``, the (run, node, feature) there are, asks for no more partitions than they fill.
    """
    own = lambda name: F.get(F.lit([float(getattr(r, name)) for r in runs]), F.col("run"))
    feature = Window.partitionBy("run", "node", "feature")
    upto = feature.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    # dealt by feature once, for the sums and for the running sums
    parts = [] if groups is None else [-(-groups // GROUPS_PER_PARTITION)]
    dealt = cells.repartition(*parts, "run", "node", "feature")
    sums = dealt.groupBy("run", "node", "feature", "bin").agg(*(F.sum(c).alias(c) for c in "ghn"))
    sides = sums.select(
        "run", "node", "feature", "bin",
        *(F.sum(c).over(upto).alias(f"{c}_left") for c in "ghn"),
        *(F.sum(c).over(feature).alias(c) for c in "ghn"),
        own("l2").alias("l2"),
        own("min_samples_leaf").alias("least"),
    )

    def loss(g, h):
        return (F.lit(1.0 / scale) * g) * (F.lit(1.0 / scale) * g) / (F.lit(1.0 / scale) * h + F.col("l2"))

    g2, h2, n2 = (F.col(c) - F.col(f"{c}_left") for c in "ghn")
    enough = (F.col("n_left") >= F.col("least")) & (n2 >= F.col("least"))
    solid = F.least(F.col("h_left"), h2) >= F.lit(MIN_HESSIAN * scale)
    drop = loss(F.col("g_left"), F.col("h_left")) + loss(g2, h2) - loss(F.col("g"), F.col("h"))
    gain = F.when(enough & solid, drop)
    split = F.when(gain > 0, F.struct(gain.alias("gain"), "feature", "bin", "g_left", "h_left", "n_left"))
    return (
        sides.withColumn("split", split)
        .groupBy("run", "node")
        .agg(
            *(F.max(c).alias(c) for c in "ghn"),
            F.max_by("split", F.struct("split.gain", -F.col("feature"), -F.col("bin"))).alias("best"),
        )
    )


def boost(
    df: DataFrame,
    runs: Sequence[Run],
    features: str = "features",
    label: str = "label",
    weight: str | None = None,
    max_bins: int = MAX_BINS,
) -> list[dict]:
    """A fitted model, baseline and trees with real thresholds, for each run.

    Rows without a label or a positive weight are left out. The driver holds the trees and one row for
    each node that is looked at; histograms stay in Spark.
    """
    own = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    rows = df.select(
        vector_to_array(features).alias("x"),
        F.col(label).cast("double").alias("label"),
        own.alias("weight"),
    ).where("label is not null and weight > 0")
    hit = F.col("label") > 0.5
    facts = rows.agg(
        F.count("*").alias("n"),
        F.max("weight").alias("most"),
        F.sum(F.when(hit, F.col("weight")).otherwise(0.0)).alias("pos"),
        F.sum(F.when(hit, 0.0).otherwise(F.col("weight"))).alias("neg"),
        F.max(F.size("x")).alias("width"),
    ).first()
    if not facts["n"]:
        raise ValueError("no labelled row to learn from")
    width = facts["width"]
    cuts = bin_cuts(rows, "x", width, max_bins)
    blocks = materialize(
        rows.mapInArrow(_blocks(cuts), "bins binary, label binary, weight binary, margin binary"),
        "boosting-blocks",
    )
    most = facts["most"] * max(max(r.factors) for r in runs)
    bits = min(36, 61 - math.ceil(math.log2(facts["n"] + 1))) - math.ceil(math.log2(most))
    scale = 2.0**bits
    grown = []
    for r in runs:
        pos, neg = facts["pos"] * r.factors[1], facts["neg"] * r.factors[0]
        share = min(max(pos / (pos + neg), 1e-9), 1 - 1e-9)
        grown.append(Growth(r, math.log(share / (1 - share))))
    wanted = {k: g.begin() for k, g in enumerate(grown) if not g.done}
    while wanted:
        cells = blocks.mapInArrow(
            _histograms(width, grown, wanted, scale),
            "run int, node int, feature int, bin int, g long, h long, n long",
        )
        found: dict[int, dict] = {k: {} for k in wanted}
        groups = width * sum(len(nodes) for nodes in wanted.values())
        for row in best_splits(cells, runs, scale, groups).collect():
            b = row["best"]
            best = b and (b["gain"], b["feature"], b["bin"], b["g_left"] / scale, b["h_left"] / scale, b["n_left"])
            found[row["run"]][row["node"]] = (row["g"] / scale, row["h"] / scale, row["n"], best)
        asked, wanted = wanted, {}
        for k in asked:
            grown[k].told(found[k])
            more = grown[k].advance()
            if not more:
                grown[k].finish()
                more = [] if grown[k].done else grown[k].begin()
            if more:
                wanted[k] = more
        if wanted and max(len(grown[k].fresh) for k in wanted) >= TREES_PER_STATE:
            blocks = materialize(
                blocks.mapInArrow(
                    _with_margins(width, grown), "bins binary, label binary, weight binary, margin binary"
                ),
                "boosting-blocks",
            )
            for g in grown:
                g.fresh = []
    models = []
    for g in grown:
        trees = [
            {
                **{k: tree[k] for k in ("feature", "left", "right", "value")},
                "threshold": [cuts[f][b] if f >= 0 else 0.0 for f, b in zip(tree["feature"], tree["bin"])],
            }
            for tree in g.trees
        ]
        models.append({"baseline": g.baseline, "trees": trees})
    return models


# ------------------------------------------------------------------ pipeline stages


class _BoostingParams(Params):
    featuresCol = Param(Params._dummy(), "featuresCol", "feature vector", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "0/1 label", TypeConverters.toString)
    weightCol = Param(Params._dummy(), "weightCol", "row weight", TypeConverters.toString)
    learningRate = Param(Params._dummy(), "learningRate", "step of a tree", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "trees", TypeConverters.toInt)
    maxLeafNodes = Param(Params._dummy(), "maxLeafNodes", "leaves of a tree", TypeConverters.toInt)
    minSamplesLeaf = Param(Params._dummy(), "minSamplesLeaf", "rows of a leaf", TypeConverters.toInt)
    l2 = Param(Params._dummy(), "l2", "penalty of leaf values", TypeConverters.toFloat)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature", TypeConverters.toInt)


class LeafwiseBoosting(Estimator, _BoostingParams, DefaultParamsReadable, DefaultParamsWritable):
    """Binary classifier; see :func:`boost`."""

    @keyword_only
    def __init__(
        self,
        *,
        featuresCol: str = "features",
        labelCol: str = "label",
        weightCol: str | None = None,
        learningRate: float = 0.1,
        maxIter: int = 100,
        maxLeafNodes: int = 31,
        minSamplesLeaf: int = 20,
        l2: float = 0.0,
        maxBins: int = MAX_BINS,
    ):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        self._setDefault(
            learningRate=0.1, maxIter=100, maxLeafNodes=31, minSamplesLeaf=20, l2=0.0, maxBins=MAX_BINS
        )
        if not 2 <= self.getOrDefault(self.maxBins) <= MAX_BINS:
            raise ValueError(f"maxBins must be between 2 and {MAX_BINS}")

    def run(self) -> Run:
        names = (self.learningRate, self.maxIter, self.maxLeafNodes, self.minSamplesLeaf, self.l2)
        return Run(*(self.getOrDefault(n) for n in names))

    def _fit(self, dataset: DataFrame) -> LeafwiseModel:
        weight = self.getOrDefault(self.weightCol) if self.isSet(self.weightCol) else None
        features = self.getOrDefault(self.featuresCol)
        label, bins = self.getOrDefault(self.labelCol), self.getOrDefault(self.maxBins)
        learned = boost(dataset, [self.run()], features, label, weight, bins)[0]
        return LeafwiseModel(learned=json.dumps(learned), featuresCol=features)


class LeafwiseModel(Model, _BoostingParams, DefaultParamsReadable, DefaultParamsWritable):
    learned = Param(Params._dummy(), "learned", "baseline and trees as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, learned: str | None = None, featuresCol: str = "features"):
        super().__init__()
        self._setDefault(featuresCol="features")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @property
    def trees(self) -> list[dict]:
        return json.loads(self.getOrDefault(self.learned))["trees"]

    def leaves(self) -> list[dict]:
        """Paths of all leaves: tree, leaf, value, and the (feature, side, threshold) steps to it."""
        out = []
        for number, tree in enumerate(self.trees):
            stack = [(0, [])]
            while stack:
                at, path = stack.pop()
                if tree["feature"][at] < 0:
                    out.append({"tree": number, "leaf": at, "value": tree["value"][at], "path": path})
                    continue
                step = (tree["feature"][at], tree["threshold"][at])
                stack.append((tree["left"][at], [*path, (step[0], "<=", step[1])]))
                stack.append((tree["right"][at], [*path, (step[0], ">", step[1])]))
        return sorted(out, key=lambda r: (r["tree"], r["leaf"]))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        learned = json.loads(self.getOrDefault(self.learned))

        def score(vectors: pd.Series) -> pd.Series:
            x = np.asfortranarray(np.stack(vectors.to_numpy())) if len(vectors) else np.zeros((0, 1))
            margin = learned["baseline"] + _margins(x, learned["trees"], "threshold")
            return pd.Series(1.0 / (1.0 + np.exp(-margin)))

        x = vector_to_array(self.getOrDefault(self.featuresCol))
        p = F.pandas_udf(score, "double")(x)
        scored = dataset.withColumn("probability", p)
        return scored.withColumn(
            "prediction", (F.col("probability") >= 0.5).cast("double")
        ).withColumn("probability", array_to_vector(F.array(1.0 - F.col("probability"), F.col("probability"))))
