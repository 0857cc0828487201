"""Packing: length buckets with the least padding, and token-budget batches inside each.

All lengths are counted into one global histogram. Lengths under ``EXACT`` have a cell each; above, an octave has
``EXACT / 2`` cells, so the histogram has at most some 30,000 cells whatever the data, and
a cell remembers its longest member. A dynamic programme over the cells chooses the upper bounds that
minimise the total padding. A batch holds as many documents of one bucket as fit into the
token budget when padded to the bucket's bound; a document over the budget is a batch of its own.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from holdfast.llm.rows import named_id, packed
from holdfast.session import materialize

BUCKETS = 16
TOKEN_BUDGET = 32_768
EXACT = 1024
#: Rows numbered by one task.
ROWS_PER_CELL = 100_000


def word_count(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long")
    )


def cell_of(length: Column) -> Column:
    """The histogram cell of a length: itself under ``EXACT``, then ``EXACT / 2`` to an octave."""
    octave = F.greatest(F.floor(F.log2(F.greatest(length, F.lit(1)).cast("double"))), F.lit(0))
    bits = EXACT.bit_length() - 1
    shift = F.greatest(octave - F.lit(bits - 1), F.lit(0)).cast("int")
    return shift.cast("long") * F.lit(EXACT) + F.call_function("shiftright", length, shift)


def best_bounds(lengths, counts, totals, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least padding.

    ``lengths`` are the ascending longest members of the histogram's cells, ``counts`` and ``totals``
    their documents and tokens. The cost of a bucket over cells i..j-1 is count x longest - tokens. It
    satisfies the quadrangle inequality, so the best split point never moves left and
    a layer is found by divide and conquer. Fewer buckets are taken if more gain nothing.
    """
    cells = len(lengths)
    if not cells:
        return []
    lengths = np.asarray(lengths, dtype=np.float64)
    count = np.concatenate([[0.0], np.cumsum(np.asarray(counts, dtype=np.float64))])
    total = np.concatenate([[0.0], np.cumsum(np.asarray(totals, dtype=np.float64))])

    def cost(i, j):
        return (count[j] - count[i]) * lengths[j - 1] - (total[j] - total[i])

    best = np.concatenate([[0.0], cost(np.zeros(cells, dtype=int), np.arange(1, cells + 1))])
    choices = []
    for _ in range(min(buckets, cells) - 1):
        layer, choice = best.copy(), np.zeros(cells + 1, dtype=int)
        stack = [(1, cells, 0, cells - 1)]
        while stack:
            lo, hi, left, right = stack.pop()
            if lo > hi:
                continue
            j = (lo + hi) // 2
            i = np.arange(left, min(right, j - 1) + 1)
            costs = best[i] + cost(i, j)
            k = int(costs.argmin())
            layer[j], choice[j] = costs[k], i[k]
            stack += [(lo, j - 1, left, int(i[k])), (j + 1, hi, int(i[k]), right)]
        if layer[cells] >= best[cells]:
            break
        best = layer
        choices.append(choice)
    bounds, end = [], cells
    for choice in reversed(choices):
        bounds.append(int(lengths[end - 1]))
        end = int(choice[end])
        if end == 0:
            break
    if end:
        bounds.append(int(lengths[end - 1]))
    return sorted(bounds)


def histogram(lengths: DataFrame) -> DataFrame:
    """``longest, docs, tokens`` of each occupied cell of ``lengths(n_tokens)``."""
    return (
        lengths.groupBy(cell_of(F.col("n_tokens")).alias("cell"))
        .agg(
            F.max("n_tokens").alias("longest"),
            F.count("*").alias("docs"),
            F.sum("n_tokens").alias("tokens"),
        )
        .drop("cell")
        .orderBy("longest")
    )


def pack(
    docs: DataFrame,
    buckets: int = BUCKETS,
    token_budget: int = TOKEN_BUDGET,
    length=word_count,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, bucket, batch, slot``.

    ``bucket`` is the length the document is padded to, ``batch`` numbers the batches of a bucket
    from 0, ``slot`` the documents of a batch. ``length`` gives the tokens of a text column.
    Empty documents pad like any other. Documents of a bucket are dealt by the hash of their id,
    then id, then text; repeated rows take slots of their own. An empty table has no buckets.
    """
    rows = packed(docs.select(id_col, text_col), id_col, text_col)
    rows = materialize(
        rows.select("_id", "_key", length(F.col(f"row.{text_col}")).alias("n_tokens")), "lengths"
    )
    cells = histogram(rows).toPandas()
    bounds = best_bounds(cells["longest"], cells["docs"], cells["tokens"], buckets)
    if not bounds:
        bounds = [0]
    over = F.array(*(F.lit(b).cast("long") for b in bounds))
    bucket = F.element_at(F.filter(over, lambda b: b >= F.col("n_tokens")), 1)
    n_cells = max(1, -(-int(cells["docs"].sum()) // ROWS_PER_CELL))
    placed = rows.withColumn("bucket", bucket).withColumn("deal", F.xxhash64("_id"))
    placed = placed.withColumn(
        "cell", F.floor((F.col("deal") / F.lit(2.0**64) + F.lit(0.5)) * n_cells).cast("int")
    )
    # a bucket's rows are numbered cell by cell, so no bucket is one task
    sizes = placed.groupBy("bucket", "cell").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("bucket").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "bucket", "cell", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start")
    )
    inside = Window.partitionBy("bucket", "cell").orderBy("deal", "_id", "_key")
    place = F.col("start") + F.row_number().over(inside) - 1
    fits = F.greatest(
        F.floor(F.lit(token_budget) / F.greatest("bucket", F.lit(1))).cast("long"), F.lit(1)
    )
    return (
        placed.join(starts, ["bucket", "cell"])
        .withColumn("place", place)
        .select(
            named_id(id_col),
            "n_tokens",
            "bucket",
            F.floor(F.col("place") / fits).cast("long").alias("batch"),
            (F.col("place") % fits).alias("slot"),
        )
    )


def op9_packing(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` in length buckets and token-budget batches."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack(docs)
