"""SimHash near-dedup: 64-bit fingerprints, linked at two or fewer differing bits.

Candidates come from a pigeonring filter. A fingerprint is a ring of eight 8-bit segments. If two
fingerprints differ in at most two bits, then from some segment on every chain of l consecutive
segments differs in at most 2 l / 8 bits: none in the first three, at most one in the first seven,
at most two in all. What these budgets force to be equal is the index key of a chain: the
first three segments and all but one of the next four. Fingerprints that share a key differ in
two segments at most, so a key never holds more than 2**16 of them, whatever the corpus.
Inside a key the cumulative budgets and the Hamming distance are checked, and each member is tied to one
representative of its links, not to all partners.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.graph import components
from holdfast.llm.rows import NO_ID, keyed, named_id, packed
from holdfast.llm.text import pieces
from holdfast.session import materialize

SHINGLE_WORDS = 3
MAX_BITS = 2
SEGMENTS = 8
SEGMENT_BITS = 64 // SEGMENTS
SEED = 42
_CHUNK = 1 << 16
#: Members of a key up to which all their differences are looked at in one matrix.
_PAIRWISE = 128


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """A bit is set if it is set in over half of the shingle hashes, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words))))
    hashes = np.fromiter(
        (xxhash.xxh64_intdigest(s, SEED) for s in shingles), dtype=np.uint64
    )
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = hashes[at : at + _CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column("text")):
                found = [fingerprint(piece.text(r), shingle_words) for r in range(piece.rows)]
                part = slice(piece.first, piece.first + piece.rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_id")[part],
                        batch.column("_key")[part],
                        pa.array(np.array(found, dtype=np.uint64).view(np.int64)),
                    ],
                    names=["_id", "_key", "fp"],
                )

    return run


def fingerprints(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """``_id, _key, fp``: the fingerprint of each whole text as a signed long."""
    return materialize(
        keyed(docs, id_col, text_col).mapInArrow(
            _fingerprints(SHINGLE_WORDS), "_id long, _key long, fp long"
        ),
        "fingerprints",
    )


def chains() -> list[tuple[int, int]]:
    """(loose, last) segments of each chain: every other segment must be equal."""
    return [
        ((start + 3 + skip) % SEGMENTS, (start + 7) % SEGMENTS)
        for start in range(SEGMENTS)
        for skip in range(4)
    ]


def _viable() -> list[int]:
    """Differences of a loose (high byte) and a last segment that keep all budgets."""
    singles = [1 << i for i in range(SEGMENT_BITS)]
    pairs = [a | b for a, b in combinations(singles, 2)]
    last = [0, *singles, *pairs]
    return [m for m in last if m] + [(s << SEGMENT_BITS) | x for s in singles for x in [0, *singles]]


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ties of each key's members to the smallest member they reach inside the key."""
    differences = np.array(_viable(), dtype=np.int64)
    allowed = np.zeros(1 << (2 * SEGMENT_BITS), dtype=bool)
    allowed[differences] = True
    pairs = np.array(chains(), dtype=np.int64) * SEGMENT_BITS

    def codes(fps, chain):
        u = fps.view(np.uint64)
        byte = np.uint64((1 << SEGMENT_BITS) - 1)
        loose, last = (pairs[chain][..., k].astype(np.uint64) for k in (0, 1))
        high = (u >> loose) & byte
        return ((high << np.uint64(SEGMENT_BITS)) | ((u >> last) & byte)).astype(np.int64)

    for batch in batches:
        members = batch.column("members")
        flat = members.flatten().to_numpy()
        chain = batch.column("chain").to_numpy()
        sizes = np.diff(members.offsets.to_numpy())
        heads = np.cumsum(sizes) - sizes
        two = heads[sizes == 2]
        left, right, of = flat[two], flat[two + 1], chain[sizes == 2]
        close = allowed[codes(left, of) ^ codes(right, of)]
        out = [(left[close], right[close])]
        for row in np.flatnonzero(sizes > 2):
            fps = np.sort(flat[heads[row] : heads[row] + sizes[row]])
            code = codes(fps, int(chain[row]))
            label = np.arange(len(fps))
            if len(fps) <= _PAIRWISE:
                close = allowed[code[:, None] ^ code]
                near = [np.where(close, label, label[:, None])]
            else:
                place = np.full(1 << (2 * SEGMENT_BITS), -1, dtype=np.int64)
                place[code] = label
                near = [np.where(n >= 0, n, label) for n in (place[code ^ d] for d in differences)]
            while True:
                before = label
                for n in near:
                    low = before[n]
                    label = np.minimum(label, low if low.ndim == 1 else low.min(axis=1))
                if (label == before).all():
                    break
            moved = label != np.arange(len(fps))
            out.append((fps[moved], fps[label[moved]]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([o[k] for o in out])) for k in (0, 1)], names=["a", "b"]
        )


def linked_fingerprints(prints: DataFrame) -> DataFrame:
    """``fp, low, component, root`` of each distinct fingerprint: its smallest id, its class's smallest id and fingerprint."""
    distinct = materialize(
        prints.groupBy("fp").agg(F.min("_id").alias("low")), "distinct-fingerprints"
    )
    masks = []
    for loose, last in chains():
        free = (0xFF << (loose * SEGMENT_BITS)) | (0xFF << (last * SEGMENT_BITS))
        kept = ~free & ((1 << 64) - 1)
        masks.append(kept - (1 << 64) if kept >> 63 else kept)
    # a few megabytes of fingerprints become many rows: spread them before they do
    tasks = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = distinct.repartition(tasks, "fp").select(
        "fp", F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(m)) for m in masks)))
    ).toDF("fp", "chain", "bits")
    buckets = (
        keys.groupBy("chain", "bits")
        .agg(F.collect_list("fp").alias("members"))
        .where(F.size("members") > 1)
        .select("chain", "members")
    )
    tied = components(buckets.mapInArrow(_linked, "a long, b long"))
    roots = tied.join(distinct.withColumnRenamed("fp", "node"), "node")
    lows = roots.groupBy("root").agg(F.min("low").alias("component"))
    linked = roots.join(lows, "root").select(F.col("node").alias("fp"), "component", "root")
    return materialize(
        distinct.join(linked, "fp", "left").select(
            "fp", "low", F.coalesce("component", "low").alias("component"), F.coalesce("root", "fp").alias("root")
        ),
        "fingerprint-classes",
    )


def near_duplicate_classes(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``.

    The component is the smallest id reachable over links. Texts without words have fingerprint
    zero and are linked like any other. A null text has no words. A null id counts as smaller than any other
    and comes back as null. Repeated rows come back as often as they came in.
    """
    prints = fingerprints(docs, id_col, text_col)
    classes = linked_fingerprints(prints)
    return prints.join(classes, "fp").select(
        named_id(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("component") != F.lit(NO_ID), F.col("component")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each near-duplicate class, the one with the smallest id; all columns stay.

    Rows of one id are told apart by text, repeated rows by their other columns, the smallest first.
    """
    prints = fingerprints(docs, id_col, text_col)
    classes = linked_fingerprints(prints)
    keepers = (
        prints.join(classes.select("fp", "component"), "fp")
        .groupBy("component")
        .agg(F.min(F.struct("_id", "_key")).alias("kept"))
        .select("kept.*")
    )
    keepers = materialize(keepers, "keepers")
    rows = packed(docs, id_col, text_col).join(keepers, ["_id", "_key"])
    return rows.groupBy("_id", "_key").agg(F.min("row").alias("row")).select("row.*")


def op6_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicate_classes(docs)
