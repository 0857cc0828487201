"""Substring dedup: Rabin-Karp hashes of all word windows, counted in Spark.

A window is ``window`` consecutive words of one document. Every window that also starts in
a document with a smaller id is marked; marked windows merge into maximal removal spans.

Counting every window of a corpus would shuffle one row per word. Two equal windows hold the
same words, so they also have the same *anchor*: the smallest hash among their half-length
subwindows. Anchors are fewer than a tenth of the words. Only windows whose anchor occurs in
two documents can repeat; their full 128-bit Rabin-Karp hashes are counted. No window is
left out by this: a window with an anchor of its own is unique. A document that says the same as
an earlier one is settled by its digest and takes no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.rows import keyed, named_id
from holdfast.llm.text import (
    U64,
    WORD_POWERS,
    list_array,
    mix,
    pieces,
    prefix,
    runs,
    signed,
    sliding_min,
    window_hash,
)
from holdfast.session import materialize

WINDOW = 50
_KEY = ["_id", "_key"]
_SPANS = "array<struct<start:int,end:int>>"


def _windows(piece, window: int):
    """Word borders, row borders, word hashes, and the first word of each window of a piece."""
    starts, ends, first = piece.words()
    hashes = piece.word_hashes(starts, ends)
    owner = np.repeat(np.arange(piece.rows), np.diff(first))
    count = max(len(hashes) - window + 1, 0)
    whole = np.flatnonzero(owner[:count] == owner[window - 1 :]) if count else np.zeros(0, np.int64)
    return first, hashes, owner, whole


def _anchors(hashes: np.ndarray, window: int) -> np.ndarray:
    """For each window the smallest hash of its subwindows of half the length."""
    half = max(window // 2, 1)
    small = mix(window_hash(prefix(hashes, WORD_POWERS[0]), half, WORD_POWERS[0]))
    return sliding_min(small, window - half + 1)


def _sketch(window: int):
    """Words, digest of all words, and the distinct neighbouring anchors of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column("text")):
                first, hashes, owner, whole = _windows(piece, window)
                anchors = _anchors(hashes, window)[whole]
                rows = owner[whole]
                new = np.ones(len(whole), dtype=bool)
                new[1:] = (anchors[1:] != anchors[:-1]) | (rows[1:] != rows[:-1])
                edges = np.searchsorted(rows[new], np.arange(piece.rows + 1))
                digests = [
                    hashlib.sha256(b" ".join(piece.text(r).split())).hexdigest()
                    for r in range(piece.rows)
                ]
                part = slice(piece.first, piece.first + piece.rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_id")[part],
                        batch.column("_key")[part],
                        pa.array(np.diff(first)),
                        pa.array(digests, pa.string()),
                        list_array(signed(anchors[new]), edges, pa.int64()),
                    ],
                    names=["_id", "_key", "n_words", "kept_sha256", "anchors"],
                )

    return run


def _suspects(window: int):
    """The windows whose anchor is in ``wanted``: first word and two 64-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column("wanted")
            for piece in pieces(batch.column("text")):
                part = slice(piece.first, piece.first + piece.rows)
                first, hashes, owner, whole = _windows(piece, window)
                anchors = signed(_anchors(hashes, window)[whole])
                # one look-up for the piece; an anchor wanted by another row of the piece
                # only adds windows that the count then finds to be unique
                asked = np.unique(wanted[part].flatten().to_numpy(zero_copy_only=False))
                hit = whole[np.isin(anchors, asked)]
                full = [
                    window_hash(prefix(hashes, powers), window, powers) for powers in WORD_POWERS
                ]
                edges = np.searchsorted(owner[hit], np.arange(piece.rows + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c)[part] for c in (*_KEY, "text")),
                        list_array(
                            (hit - first[owner[hit]]).astype(np.int32), edges, pa.int32()
                        ),
                        list_array(signed(mix(full[0][hit])), edges, pa.int64()),
                        list_array(signed(mix(full[1][hit])), edges, pa.int64()),
                    ],
                    names=[*_KEY, "text", "position", "h1", "h2"],
                )

    return run


def _cut(window: int):
    """Removal spans, and the digest of the words outside them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, marked in zip(batch.column("text"), batch.column("marked")):
                words = text.as_py().encode().split()
                starts, ends = runs(np.sort(np.asarray(marked.as_py(), dtype=np.int64)), window)
                kept, at = [], 0
                for start, end in zip(starts, ends):
                    kept += words[at:start]
                    at = end
                kept += words[at:]
                out.append(
                    (
                        [{"start": int(s), "end": int(e)} for s, e in zip(starts, ends)],
                        hashlib.sha256(b" ".join(kept)).hexdigest(),
                    )
                )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    batch.column("_key"),
                    pa.array(
                        [s for s, _ in out],
                        pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])),
                    ),
                    pa.array([d for _, d in out], pa.string()),
                ],
                names=[*_KEY, "spans", "cut_sha256"],
            )

    return run


def repeated_spans(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id, n_words, spans, kept_sha256``.

    ``spans`` are the maximal runs of words, [start, end) counted from 0, that repeat a
    window of a document with a smaller id; the digest is of the words outside them, joined
    by one space. A null text has no words. A null id counts as smaller than any other and
    comes back as null. Repeated rows of one id do not repeat each other. Other columns are
    ignored; an empty table gives an empty result.
    """
    base = keyed(docs, id_col, text_col)
    sketch = materialize(
        base.mapInArrow(
            _sketch(window),
            "_id long, _key long, n_words long, kept_sha256 string, anchors array<long>",
        ),
        "window-anchors",
    )
    # a document that says the same as an earlier one is settled as a whole
    earliest = materialize(
        sketch.groupBy("kept_sha256").agg(F.min("_id").alias("earliest")), "distinct-documents"
    )
    is_copy = F.col("_id") > F.col("earliest")
    sketch = materialize(
        sketch.join(earliest, "kept_sha256").select(
            *_KEY,
            "n_words",
            "kept_sha256",
            (is_copy & (F.col("n_words") >= window)).alias("copied"),
            F.when(~is_copy, F.col("anchors")).alias("anchors"),
        ),
        "window-copies",
    )
    anchors = sketch.select(*_KEY, F.explode("anchors").alias("anchor"))
    shared = materialize(
        anchors.groupBy("anchor")
        .agg(F.min("_id").alias("lo"), F.max("_id").alias("hi"))
        .where("lo < hi")
        .select("anchor"),
        "shared-anchors",
    )
    wanted = (
        anchors.join(shared, "anchor").groupBy(*_KEY).agg(F.collect_set("anchor").alias("wanted"))
    )
    suspects = materialize(
        base.join(wanted, _KEY).mapInArrow(
            _suspects(window),
            "_id long, _key long, text string, position array<int>, h1 array<long>, h2 array<long>",
        ),
        "suspects",
    )
    windows = suspects.select(
        *_KEY, F.explode(F.arrays_zip("position", "h1", "h2")).alias("w")
    ).select(*_KEY, "w.*")
    repeated = materialize(
        windows.groupBy("h1", "h2")
        .agg(F.min("_id").alias("lo"), F.max("_id").alias("hi"))
        .where("lo < hi")
        .select("h1", "h2", "lo"),
        "repeated-windows",
    )
    marked = (
        windows.join(repeated, ["h1", "h2"])
        .where("_id > lo")
        .groupBy(*_KEY)
        .agg(F.collect_set("position").alias("marked"))
    )
    cut = (
        suspects.select(*_KEY, "text")
        .dropDuplicates(_KEY)
        .join(marked, _KEY)
        .mapInArrow(
            _cut(window),
            f"_id long, _key long, spans {_SPANS}, cut_sha256 string",
        )
    )
    none = F.array().cast(_SPANS)
    everything = F.array(F.struct(F.lit(0), F.col("n_words"))).cast(_SPANS)
    nothing = F.sha2(F.lit(""), 256)
    return (
        sketch.drop("anchors")
        .join(cut, _KEY, "left")
        .select(
            named_id(id_col),
            "n_words",
            F.when(F.col("copied"), everything)
            .otherwise(F.coalesce("spans", none))
            .alias("spans"),
            F.when(F.col("copied"), nothing)
            .otherwise(F.coalesce("cut_sha256", "kept_sha256"))
            .alias("kept_sha256"),
        )
    )


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Every word window of ``documents``; what repeats an earlier document is removed."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.end - s.start)
    return repeated_spans(docs).select(
        "doc_id",
        "n_words",
        removed.alias("n_removed"),
        "kept_sha256",
        F.size("spans").cast("long").alias("n_spans"),
    )
