"""Sealed stratified splits, folds, samples and oversampling.

Every assignment follows the digest order of ``(seed, id)`` inside a stratum: it does
not depend on input order, partitioning or cluster size, and any SQL engine with md5
can recompute it.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from holdfast.functions.hashing import cell_of, digest_number, shuffle_key, slot_of
from holdfast.functions.numeric import rate
from holdfast.operators.position import CELLS, PRIVATE, group_sizes, null_safe_join, with_position
from holdfast.operators.quality import ContractViolation

#: How a manifest's fingerprints were made: sums of sha256 lanes, see :func:`fingerprint`.
FINGERPRINT_MODE = "sha256-lane-sums"
#: Levels of the tree of digests: 16**4 blocks, some 150,000 ids each at ten billion.
MERKLE_DEPTH = 4
MERKLE_MODE = f"sha256-tree-{MERKLE_DEPTH}"
MODES = (FINGERPRINT_MODE, MERKLE_MODE)


def allocate(counts: Mapping, wanted: int) -> dict:
    """Share ``wanted`` rows over strata in proportion: floors, then largest remainders."""
    total = sum(counts.values())
    whole = {k: n * wanted // total for k, n in counts.items()}
    left = wanted - sum(whole.values())
    by_remainder = sorted(counts, key=lambda k: (-(counts[k] * wanted % total), str(k)))
    for k in by_remainder[:left]:
        whole[k] += 1
    return whole


def _share_out(strata: str, size: str, wanted: Column, name: str, table: DataFrame) -> DataFrame:
    """Add ``name``: ``wanted`` rows shared over the strata of a table as :func:`allocate` does."""
    everything = Window.partitionBy()
    total = F.sum(size).over(everything).cast("decimal(38,0)")
    exact = F.col(size).cast("decimal(19,0)") * F.col("_wanted")
    table = table.withColumn("_wanted", wanted.cast("decimal(19,0)")).withColumn("_total", total)
    table = table.withColumn("_whole", F.floor(F.try_divide(exact, F.col("_total"))).cast("bigint"))
    table = table.withColumn("_rest", exact - F.col("_whole") * F.col("_total"))
    spare = F.col("_wanted") - F.sum("_whole").over(everything)
    by_rest = Window.orderBy(
        F.col("_rest").desc(), F.coalesce(F.col(strata).cast("string"), F.lit("None"))
    )
    extra = (F.row_number().over(by_rest) <= spare).cast("bigint")
    return table.withColumn(name, F.coalesce(F.col("_whole") + extra, F.lit(0))).drop(
        "_wanted", "_total", "_whole", "_rest"
    )


def split_quotas(counts: DataFrame, strata: str, test: float, val: float) -> DataFrame:
    """``strata, _in_test, _in_val`` of every stratum, from its rows ``_n``; one row per class label."""
    rows = F.sum("_n").over(Window.partitionBy())
    n_test = F.ceil(F.lit(float(test)) * rows)
    n_val = F.ceil(F.lit(val / (1.0 - test)) * (rows - n_test))
    counts = counts.withColumns({"_n_test": n_test, "_n_val": n_val})
    counts = _share_out(strata, "_n", F.col("_n_test"), "_in_test", counts)
    counts = counts.withColumn("_left", F.col("_n") - F.col("_in_test"))
    counts = _share_out(strata, "_left", F.col("_n_val"), "_in_val", counts)
    return counts.select(strata, "_in_test", "_in_val")


def stratified_split(
    df: DataFrame,
    id_col: str,
    strata: str,
    test: float = 0.15,
    val: float = 0.15,
    seed: int = 42,
    **cells,
) -> DataFrame:
    """Add ``split`` in {train, val, test} with exact sizes.

    Sizes round up as a two-stage hold-out does: test from everything, then validation
    from the rest with the fraction ``val / (1 - test)``. The quotas are a table with a row per
    stratum, joined to the placed rows. Rows without an id are split like any other.
    """
    placed = with_position(df, id_col, within=[strata], seed=seed, names=PRIVATE, **cells)
    # the cells that were counted for the positions also give the strata's sizes
    counts = group_sizes(df, id_col, [strata], seed, "_n")
    joined = null_safe_join(placed, split_quotas(counts, strata, test, val), [strata])
    part = (
        F.when(F.col("_position") < F.col("_in_test"), "test")
        .when(F.col("_position") < F.col("_in_test") + F.col("_in_val"), "val")
        .otherwise("train")
    )
    return joined.select(*(F.col(f"`{c}`") for c in df.columns), part.alias("split"))


def stratified_folds(
    df: DataFrame, id_col: str, strata: str, k: int = 5, seed: int = 42, **cells
) -> DataFrame:
    """Add ``fold`` 0..k-1; every stratum is spread evenly over the folds."""
    placed = with_position(
        df, id_col, within=[strata], seed=f"fold-{seed}", names=PRIVATE, **cells
    )
    return placed.withColumn("fold", (F.col("_position") % k).cast("int")).drop(*PRIVATE)


def sample_n(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly n rows (or all), the same ones for any partitioning of the input.

    A histogram of the digests, of fixed size, tells the cell in which the n-th smallest lies. Only rows up to it
    are shuffled and placed: n, and at most the rows of one cell more.
    """
    name = f"sample-{seed}"
    cell = F.coalesce(cell_of(shuffle_key(id_col, name), CELLS), F.lit(CELLS))
    counts = df.groupBy(cell.alias("_cell")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_cell")) - F.col("_n")  # over CELLS rows
    last = counts.withColumn("_before", before).where(F.col("_before") < n).agg(F.max("_cell"))
    near = df.where(cell <= last.scalar())
    placed = with_position(near, id_col, seed=name, names=PRIVATE)
    return placed.where(F.col("_position") < n).drop(*PRIVATE)


def oversample(df: DataFrame, label: str, id_col: str, seed: int = 42, **cells) -> DataFrame:
    """Original rows plus positive rows drawn with replacement until the classes match.

    ``draw`` is NULL for original rows and the number of the draw for copies. Draws are
    the large side when positives are rare; the positives are then small enough for
    the adaptive join to broadcast, so no positive row becomes a hot key.
    """
    positive = F.col(label) == 1
    sizes = df.agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    ).first()
    needed = max(0, sizes["neg"] - sizes["pos"])
    if needed and not sizes["pos"]:
        raise ValueError("no positive row to draw from")
    originals = df.withColumn("draw", F.lit(None).cast("bigint"))
    if not needed:
        return originals
    draws = df.sparkSession.range(needed).select(
        F.col("id").alias("draw"),
        slot_of(shuffle_key("id", f"draw-{seed}"), sizes["pos"]).alias("_position"),
    )
    pool = with_position(df.where(positive), id_col, seed=f"pool-{seed}", names=PRIVATE, **cells)
    copies = draws.join(pool, "_position").select(*df.columns, "draw")
    return originals.unionByName(copies)


# ------------------------------------------------------------------ integrity


def overlap_report(
    df: DataFrame, id_col: str, part: str, parts: Sequence[str] = ("train", "val", "test")
) -> DataFrame:
    """Ids shared by each pair of parts, from one shuffle on the id."""
    seen = df.groupBy(id_col).agg(
        *(F.max((F.col(part) == p).cast("int")).alias(f"in_{p}") for p in parts)
    )
    pairs = list(combinations(parts, 2))
    wide = seen.agg(
        *(
            F.count_if((F.col(f"in_{a}") == 1) & (F.col(f"in_{b}") == 1)).alias(f"{a}_{b}")
            for a, b in pairs
        )
    )
    cells = [
        F.struct(
            F.lit(a).alias("first"), F.lit(b).alias("second"), F.col(f"{a}_{b}").alias("shared")
        )
        for a, b in pairs
    ]
    return wide.select(F.explode(F.array(*cells)).alias("r")).select("r.*")


def require_disjoint(df: DataFrame, id_col: str, part: str, parts=("train", "val", "test")):
    bad = overlap_report(df, id_col, part, parts).where(F.col("shared") > 0).collect()
    if bad:
        raise ContractViolation(
            "; ".join(f"{r['shared']} ids in both {r['first']} and {r['second']}" for r in bad)
        )


def seen_in_training(df: DataFrame, id_col: str, part: str = "split") -> DataFrame:
    """Ids on both sides, and the share of test rows whose id is also in train."""
    per_id = df.groupBy(id_col).agg(
        F.count_if(F.col(part) == "train").alias("train"),
        F.count_if(F.col(part) == "test").alias("test"),
    )
    both = (F.col("train") > 0) & (F.col("test") > 0)
    return per_id.agg(
        F.count_if(both).alias("customers_in_both_splits"),
        F.round(
            F.try_divide(
                F.sum(F.when(both, F.col("test")).otherwise(0)).cast("double"),
                F.sum("test").cast("double"),
            ),
            4,
        ).alias("share_of_test_seen_in_training"),
    )


def fingerprint(id_col: str) -> Column:
    """Order-free aggregate over a set of ids: 16 hex digits.

    Two 52-bit lanes of each id's sha256 are summed and hashed with the row count. The
    sums combine map-side, so a split of any size leaves each task as one row; adding,
    dropping or changing an id changes the result.
    """
    digest = F.sha2(F.col(id_col).cast("string"), 256)

    def lane(start: int) -> Column:
        return F.sum(digest_number(F.substring(digest, start, 13)).cast("decimal(38,0)"))

    parts = F.concat_ws(
        "|", F.count("*").cast("string"), lane(1).cast("string"), lane(14).cast("string")
    )
    return F.substring(F.sha2(parts, 256), 1, 16)


def merkle_blocks(df: DataFrame, id_col: str, part: str, depth: int = MERKLE_DEPTH) -> DataFrame:
    """``split, block, rows, digest``: the ids of each part in 16**depth blocks by their sha256.

    A block's digest is the sha256 of its ids in ascending order, joined by ``|``; missing
    ids count as an empty one. Which block an id belongs to depends on the id alone, and a
    block holds its share of the ids whatever they look like.
    """
    own = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    ids = df.select(F.col(part).alias("split"), own.alias("id"))
    block = F.substring(F.sha2("id", 256), 1, depth)
    digest = F.sha2(F.concat_ws("|", F.sort_array(F.collect_list("id"))), 256)
    return ids.groupBy("split", block.alias("block")).agg(
        F.count("*").alias("rows"), digest.alias("digest")
    )


def merkle_roots(blocks: DataFrame, depth: int = MERKLE_DEPTH) -> DataFrame:
    """``split, rows, root``: digests of sixteen children at a time, up to one per part.

    A node is the sha256 of its occupied children, each as its hex digit and digest, in order.
    """
    level = blocks.withColumnRenamed("digest", "root")
    for length in range(depth - 1, -1, -1):
        child = F.struct(
            F.substring("block", length + 1, 1).alias("digit"), F.col("root").alias("root")
        )
        children = F.sort_array(F.collect_list(child))  # sixteen at most
        text = F.concat_ws("", F.transform(children, lambda c: F.concat(c["digit"], c["root"])))
        level = level.groupBy("split", F.substring("block", 1, length).alias("block")).agg(
            F.sum("rows").alias("rows"), F.sha2(text, 256).alias("root")
        )
    return level.select("split", "rows", F.substring("root", 1, 16).alias("root"))


def merkle_difference(now: DataFrame, then: DataFrame) -> DataFrame:
    """``split, block, rows_then, rows_now`` of the blocks whose ids are not the same any more."""
    before = then.select("split", "block", F.col("rows").alias("rows_then"), F.col("digest").alias("then"))
    after = now.select("split", "block", F.col("rows").alias("rows_now"), F.col("digest").alias("now"))
    both = before.join(after, ["split", "block"], "full")
    return both.where(~F.col("then").eqNullSafe(F.col("now"))).select(
        "split",
        "block",
        *(F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("rows_then", "rows_now")),
    )


def _fingerprints(df: DataFrame, id_col: str, part: str, mode: str) -> DataFrame:
    """``split, id_fingerprint`` of every part in one of the two modes."""
    if mode == MERKLE_MODE:
        roots = merkle_roots(merkle_blocks(df, id_col, part))
        return roots.select("split", F.col("root").alias("id_fingerprint"))
    if mode != FINGERPRINT_MODE:
        raise ValueError(f"unknown fingerprint mode '{mode}'")
    return df.groupBy(F.col(part).alias("split")).agg(fingerprint(id_col).alias("id_fingerprint"))


def split_manifest(
    df: DataFrame,
    id_col: str,
    target: str,
    positive: str,
    part: str = "split",
    mode: str = FINGERPRINT_MODE,
) -> DataFrame:
    """Rows, share, positive rate and fingerprint per part.

    One aggregate in the default mode. :data:`MERKLE_MODE` seals with the root of a tree, whose blocks
    (:func:`merkle_blocks`) name the part of a split that has changed.
    """
    total = F.sum("rows").over(Window.partitionBy())
    own = [fingerprint(id_col).alias("id_fingerprint")] if mode == FINGERPRINT_MODE else []
    table = df.groupBy(F.col(part).alias("split")).agg(
        F.count("*").alias("rows"),
        F.round(rate(F.col(target) == positive), 4).alias("churn_rate"),
        *own,
    )
    if not own:
        table = null_safe_join(table, _fingerprints(df, id_col, part, mode), ["split"])
    return table.select(
        "split",
        "rows",
        F.round(F.col("rows") / total, 4).alias("share"),
        "churn_rate",
        "id_fingerprint",
        F.lit(mode).alias("fingerprint_mode"),
    )


def seal_check(df: DataFrame, manifest: DataFrame, id_col: str, part: str = "split") -> DataFrame:
    """Fingerprint now against fingerprint in the manifest, per part, in the manifest's own mode.

    A manifest without a mode has the default one; a part with an unknown mode is never sealed.
    """
    mode = F.lit(FINGERPRINT_MODE)
    if "fingerprint_mode" in manifest.columns:
        mode = F.col("fingerprint_mode")
    expected = manifest.select("split", F.col("id_fingerprint").alias("expected"), mode.alias("_mode"))
    now = None
    # a manifest has one row per part
    for found in sorted({r["_mode"] for r in expected.select("_mode").collect()} & set(MODES)):
        one = _fingerprints(df, id_col, part, found).select(
            "split", F.col("id_fingerprint").alias("actual"), F.lit(found).alias("_mode")
        )
        now = one if now is None else now.unionByName(one)
    if now is None:
        return expected.select(
            "split", "expected", F.lit(None).cast("string").alias("actual"), F.lit(False).alias("sealed")
        )
    return expected.join(now, ["split", "_mode"], "left").select(
        "split", "expected", "actual", F.col("expected").eqNullSafe(F.col("actual")).alias("sealed")
    )


def require_sealed(df: DataFrame, manifest: DataFrame, id_col: str, part: str = "split") -> None:
    broken = seal_check(df, manifest, id_col, part).where(~F.col("sealed")).collect()
    if broken:
        names = [r["split"] for r in broken]
        raise ContractViolation(f"splits changed since they were sealed: {names}")
