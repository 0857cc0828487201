"""Filter interaction audit: what each of five filters removes in every order, and its Shapley share.

A row counts only through the set of filters it fails. Per part, the rows are combined into what each
of the 32 coalitions of filters removes together; every figure of all 120 orders is a difference of
two such numbers. Shapley values are the efficiency-constrained least-squares fit of the
coalition table under the Shapley kernel, its normal equations solved exactly in rationals. The
fit is linear in the table, so it is solved once, and its whole-number coefficients are applied
as column expressions.
"""

from __future__ import annotations

import json
from fractions import Fraction
from functools import reduce
from itertools import permutations
from math import comb, factorial
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.session import materialize

FILTERS = "ABCDE"
COALITIONS = 1 << len(FILTERS)
MIN_WORDS = 200
#: Percent of distinct words, and of capital letters.
MIN_DISTINCT, MAX_CAPITALS = 50, 2
SEPARATORS = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#$%&*|]"


# --- exact least squares -----------------------------------------------------------------


def solve(matrix: list[list[Fraction]], sides: list[list[Fraction]]) -> list[list[Fraction]]:
    """X of ``matrix X = sides`` by Gauss-Jordan elimination in rationals."""
    n = len(matrix)
    rows = [[*map(Fraction, a), *map(Fraction, b)] for a, b in zip(matrix, sides, strict=True)]
    for k in range(n):
        pivot = next(r for r in range(k, n) if rows[r][k])
        rows[k], rows[pivot] = rows[pivot], rows[k]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for r in range(n):
            if r != k and rows[r][k]:
                rows[r] = [x - rows[r][k] * y for x, y in zip(rows[r], rows[k])]
    return [row[n:] for row in rows]


def kernel_weight(size: int, players: int) -> Fraction:
    """Shapley kernel of a coalition that is neither empty nor whole."""
    return Fraction(players - 1, comb(players, size) * size * (players - size))


def shapley_coefficients(players: int = len(FILTERS)) -> list[list[int]]:
    """Row f: what each coalition's removals count, summed over all orders, for filter f.

    Minimises the kernel-weighted squares of v(S) - sum of phi over S, where the phi must add up to
    v of all filters (nothing is removed without a filter). The stationary point of the
    Lagrangian is linear in v: the normal equations, bordered by the constraint, have one
    right side per coalition.
    """
    every = (1 << players) - 1
    inner = range(1, every)
    weight = {s: kernel_weight(s.bit_count(), players) for s in inner}
    normal = [
        [sum(weight[s] for s in inner if s >> i & 1 and s >> j & 1) for j in range(players)] + [1]
        for i in range(players)
    ]
    normal.append([1] * players + [0])
    sides = [
        [weight[s] if s in weight and s >> i & 1 else Fraction(0) for s in range(every + 1)]
        for i in range(players)
    ]
    sides.append([Fraction(int(s == every)) for s in range(every + 1)])
    orders = factorial(players)
    found = [[x * orders for x in row] for row in solve(normal, sides)[:players]]
    assert all(x.denominator == 1 for row in found for x in row)
    return [[int(x) for x in row] for row in found]


# --- failures of each row ----------------------------------------------------------------


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SEPARATORS), "")


def text_failures(text: Column) -> Column:
    """Bits 0 to 3: filters A to D that a text without null fails."""
    return F.transform(F.array(F.struct(words(text).alias("w"), text.alias("t"))), _bits)[0]


def _bits(x: Column) -> Column:
    n = F.size(x["w"]).cast("long")
    capitals = F.length(F.regexp_replace(x["t"], "[^A-Z]+", ""))
    fails = [
        n < MIN_WORDS,
        F.lit(100) * F.size(F.array_distinct(x["w"])) < F.lit(MIN_DISTINCT) * n,
        F.lit(100) * capitals.cast("long") > F.lit(MAX_CAPITALS) * F.length(x["t"]),
        F.regexp_like(x["t"], F.lit(SYMBOLS)),
    ]
    return reduce(add, (F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)))


def failures(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
) -> DataFrame:
    """``part, mask, n, good, toxic``: rows of each part by the set of filters they fail.

    E compares ids of equal texts over the whole table. Rows are first combined by (text, id, part),
    so neither a group of copies nor a repeated row is ever gathered, and a text's smallest id meets its
    rows on (text, id), which spreads the group. Texts travel as digests.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    counted = (
        docs.select(
            F.col(id_col).cast("bigint").alias("id"),
            F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
            text_failures(text).alias("fails"),
        )
        .groupBy("digest", "id", "part", "fails")
        .agg(F.count("*").alias("n"))
    )
    # a missing id is smaller than any other and has no label; it gets a key of its text
    known = F.col("id").isNotNull()
    rows = materialize(counted, "filter-failures").select(
        "*",
        F.struct(known.alias("known"), F.coalesce("id", F.lit(0)).alias("id")).alias("place"),
        F.coalesce("id", F.xxhash64("digest")).alias("key"),
        known.alias("known"),
    )
    marks = (
        labels.select(
            F.col("doc_id").cast("bigint").alias("key"),
            F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int").alias("good"),
            F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int").alias("toxic"),
        )
        .where("key is not null")
        .groupBy("key")
        .agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
        .withColumn("known", F.lit(True))
    )
    firsts = rows.groupBy("digest").agg(F.min("place").alias("place")).withColumn("first", F.lit(0))
    copy = F.coalesce("first", F.lit(1 << 4))
    return (
        rows.join(firsts, ["digest", "place"], "left")
        .join(marks, ["key", "known"], "left")
        .groupBy("part", (F.col("fails") + copy).alias("mask"))
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
            F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
        )
    )


# --- orders ------------------------------------------------------------------------------


def coalition_table(found: DataFrame) -> DataFrame:
    """``part, n, removed, good, toxic``: arrays of what each of the 32 coalitions removes.

    ``found`` has one row of (part, mask, n, good, toxic) per part and mask, 32 for a part at most.
    """
    cells = F.collect_list(F.struct("mask", "n", "good", "toxic"))
    table = found.groupBy("part").agg(F.sum("n").alias("n"), cells.alias("cells"))

    def removed(column: str) -> Column:
        def by(coalition: Column) -> Column:
            hit = F.filter("cells", lambda c: c["mask"].bitwiseAND(coalition) != 0)
            return F.aggregate(hit, F.lit(0).cast("long"), lambda total, c: total + c[column])

        return F.transform(F.sequence(F.lit(0), F.lit(COALITIONS - 1)), by)

    return table.select(
        "part", "n", removed("n").alias("removed"), removed("good").alias("good"), removed("toxic").alias("toxic")
    )


def _constant(value, schema: str) -> Column:
    """A nested literal."""
    return F.from_json(F.lit(json.dumps(value)), schema)


def order_steps() -> list[dict]:
    """Every step of every order: the filter, its bit, the coalitions before and after it."""
    steps = []
    for order in permutations(range(len(FILTERS))):
        before, name = 0, "".join(FILTERS[k] for k in order)
        for step, f in enumerate(order, 1):
            after = before | 1 << f
            steps.append(
                {"filter_order": name, "step": step, "f": f, "bit": 1 << f, "before": before, "after": after}
            )
            before = after
    return steps


def audit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
) -> DataFrame:
    """One row per part, order of the five filters and step.

    A null text is empty (and fails A); a null part is the empty string, like an empty one. Rows of
    one id count each; none of them is a copy of another. A null id is smaller than any other and
    has no label. A document is good or toxic if any of its label rows says so. No documents, no rows.
    """
    table = coalition_table(failures(docs, labels, id_col, text_col, part_col))
    every = COALITIONS - 1
    steps = _constant(
        order_steps(),
        "array<struct<filter_order string, step int, f int, bit int, before int, after int>>",
    )

    def share(coefficients: Column) -> Column:
        terms = F.zip_with("removed", coefficients, lambda v, c: v * c)
        return F.aggregate(terms, F.lit(0).cast("long"), lambda total, x: total + x)

    shares = F.transform(_constant(shapley_coefficients(), "array<array<long>>"), share)
    alone, others = F.get("removed", F.col("bit")), F.get("removed", F.lit(every) - F.col("bit"))
    gone = F.get("removed", F.col("after")) - F.get("removed", F.col("before"))
    return (
        table.select("*", shares.alias("shares"))
        .select("*", F.inline(steps))
        .select(
            "part",
            "filter_order",
            "step",
            (F.col("n") - F.get("removed", F.col("after"))).alias("kept"),
            gone.alias("removed"),
            (alone - gone).alias("redundant"),
            (F.get("removed", F.lit(every)) - others).alias("unique_fails"),
            (F.get("good", F.col("after")) - F.get("good", F.col("before"))).alias("good_lost"),
            (F.get("toxic", F.col("after")) - F.get("toxic", F.col("before"))).alias("toxic_lost"),
            F.get("shares", F.col("f")).alias("shapley"),
        )
    )


def op12_filter_audit(spark, sf_dir: str) -> DataFrame:
    """Removals of five filters over all ``documents``, by source and order."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return audit(docs, labels)
