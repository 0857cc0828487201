"""A random forest on the distinct binned rows of a table; its trees never leave the tasks.

Fully grown trees have about as many nodes as there are rows, too many for a model on the driver. A
forest sees no more of a row than its bins, so rows are counted into cells (equal bins) by Spark first.
A bootstrap draws each training row a Poisson number of times; for a cell that is one Poisson number with the
cell's rows as its mean. Trees are dealt to tasks, each of which grows its trees on the cells and returns what they
say of each cell with rows to score. So a task holds as many cells as the bins allow, however many rows there are.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.operators.boosting import bin_cuts
from holdfast.session import materialize

# task functions travel by value: executors need no installed copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_BINS = 32
TREES_PER_TASK = 4
#: Probabilities are summed in these steps, so sums do not depend on the order of the trees.
STEPS = 1 << 40
#: A smaller drop of the impurity (of all rows of a node) is rounding.
LEAST_GAIN = 1e-9


def _best_splits(bins, node, pos, neg, of_pos, of_neg, tries, rng):
    """(gain, feature, bin) of each node's best split by Gini over ``tries`` features drawn per node."""
    nodes, width = len(of_pos), bins.shape[1]
    drawn = np.argsort(rng.random((nodes, width)), axis=1)[:, :tries]
    gain, feature, cut = np.zeros(nodes), np.zeros(nodes, dtype=np.int64), np.zeros(nodes, dtype=np.int64)
    mixed = (of_pos > 0) & (of_neg > 0)
    used = np.flatnonzero((pos + neg > 0) & mixed[node])
    if not len(used):
        return gain, feature, cut
    whole = (of_pos**2 + of_neg**2) / np.maximum(of_pos + of_neg, 1)
    own, own_pos, own_neg = node[used], pos[used], neg[used]
    for k in range(drawn.shape[1]):
        key = own * MAX_BINS + bins[used, drawn[own, k]]
        order = np.argsort(key, kind="stable")
        key = key[order]
        last = np.append(key[1:] != key[:-1], True)
        at, value = np.divmod(key[last], MAX_BINS)
        head = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        sizes = np.diff(np.append(head, len(at)))
        sides = []
        for counts in (own_pos, own_neg):
            upto = np.cumsum(counts[order])[last]
            sides.append(upto - np.repeat(np.append(0, upto)[head], sizes))
        lp, ln = sides
        rp, rn = of_pos[at] - lp, of_neg[at] - ln
        left, right = lp + ln, rp + rn
        drop = (lp**2 + ln**2) / left + (rp**2 + rn**2) / np.maximum(right, 1) - whole[at]
        drop[right == 0] = 0.0
        top = np.maximum.reduceat(drop, head)
        hits = np.flatnonzero(drop == np.repeat(top, sizes))
        hits = hits[np.append(True, at[hits][1:] != at[hits][:-1])]
        here = at[head]
        better = top > np.maximum(gain[here], LEAST_GAIN)
        gain[here[better]], cut[here[better]] = top[better], value[hits][better]
        feature[here[better]] = drawn[here[better], k]
    return gain, feature, cut


def tree_probabilities(
    bins: np.ndarray, pos: np.ndarray, neg: np.ndarray, depth: int, tries: int, rng
) -> np.ndarray:
    """P(positive) of each row of ``bins`` by one tree grown on rows that count ``pos`` and ``neg`` times.

    Rows that count for nothing are only routed. Every leaf holds a row that counts.
    """
    pos, neg = pos.astype(float), neg.astype(float)
    p = np.zeros(len(bins))
    here, node = np.arange(len(bins)), np.zeros(len(bins), dtype=np.int64)
    for level in range(depth + 1):
        nodes = int(node.max()) + 1
        of_pos, of_neg = np.bincount(node, pos[here], nodes), np.bincount(node, neg[here], nodes)
        split = np.zeros(nodes, dtype=bool)
        if level < depth:
            gain, feature, cut = _best_splits(bins[here], node, pos[here], neg[here], of_pos, of_neg, tries, rng)
            split = gain > 0
        done = ~split[node]
        p[here[done]] = (of_pos / (of_pos + of_neg))[node[done]]
        here, node = here[~done], node[~done]
        if not len(here):
            break
        right = bins[here, feature[node]] > cut[node]
        node = 2 * (np.cumsum(split) - 1)[node] + right
    return p


def _grow(width: int, trees: int, depth: int, seed: int):
    tries = int(np.ceil(np.sqrt(width)))

    def run(cells: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(cells))
        bins = table.column("bins").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        bins = bins.reshape(-1, width).astype(np.uint8)
        # one order of the cells, whatever tasks they come from
        order = np.lexsort(bins.T)
        cell, pos, neg, scored = (table.column(c).to_numpy()[order] for c in ("cell", "pos", "neg", "scored"))
        bins, first = bins[order], table.column("group")[0].as_py() * TREES_PER_TASK
        total = np.zeros(len(bins), dtype=np.int64)
        for tree in range(first, min(first + TREES_PER_TASK, trees)):
            rng = np.random.default_rng([seed, tree])
            drawn_pos, drawn_neg = rng.poisson(pos), rng.poisson(neg)
            if not (drawn_pos.any() or drawn_neg.any()):  # a bootstrap of very few rows can be empty
                drawn_pos, drawn_neg = pos, neg
            total += np.rint(tree_probabilities(bins, drawn_pos, drawn_neg, depth, tries, rng) * STEPS).astype(np.int64)
        wanted = scored > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(cell[wanted]), pa.array(total[wanted])], names=["cell", "total"]
        )

    return run


def forest_scores(
    df: DataFrame, vector: str, label: str, part: str, trees: int, depth: int, seed: int = 42
) -> DataFrame:
    """``label, p`` of every row whose ``part`` is "test", by a forest grown on those with "train".

    ``vector`` is an array of doubles of one length. Features are cut into at most 32 bins; a node looks at the root
    of their number, rounded up. A tree stops where a node is pure, where no split helps, or at ``depth``.
    """
    of_train, of_test = F.col(part) == "train", F.col(part) == "test"
    rows = materialize(df.select(label, part, vector), "forest-rows")
    width = rows.where(of_train).select(F.size(vector)).first()
    if width is None:
        raise ValueError("no training row")
    width = width[0]
    cuts = bin_cuts(rows.where(of_train), vector, width, MAX_BINS)
    x = F.col(vector)

    def place(i: int):
        ends = F.lit(cuts[i]).cast("array<double>")
        return F.size(F.filter(ends, lambda end: end < x[i])).cast("tinyint")

    binned = rows.select(label, part, F.array(*(place(i) for i in range(width))).alias("bins"))
    positive = F.col(label) == 1
    cells = binned.groupBy("bins").agg(
        F.count_if(of_train & positive).alias("pos"),
        F.count_if(of_train & ~positive).alias("neg"),
        F.count_if(of_test).alias("scored"),
    )
    cells = materialize(cells.withColumn("cell", F.monotonically_increasing_id()), "forest-cells")
    groups = -(-trees // TREES_PER_TASK)
    dealt = cells.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    told = dealt.repartition(groups, "group").groupBy("group").applyInArrow(
        _grow(width, trees, depth, seed), "cell long, total long"
    )
    means = told.groupBy("cell").agg((F.sum("total") / F.lit(float(trees * STEPS))).alias("p"))
    by_bins = materialize(means.join(cells.select("cell", "bins"), "cell").select("bins", "p"), "forest-scores")
    return binned.where(of_test).join(by_bins, "bins").select(label, "p")
