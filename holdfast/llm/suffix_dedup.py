"""Suffix-array dedup: distributed prefix doubling over byte positions.

A byte is removed if some ``length``-byte string that covers it starts at two positions of
the corpus. Prefix doubling ranks positions by prefixes of growing length: the rank of a
longer prefix is named after the pair of two shorter ranks, the second at an offset.
Positions whose rank is unique are done; positions that share a rank over the full length
are repeats.

Ranks are names (hashes of pairs), so a task ranks its own positions, 1, 2, 4, ... bytes, without
asking others. Spark then brings equal ranks together, drops what is unique, and what is left
goes into the next round with a longer prefix. Sorting one row per byte in every
round would move the corpus many times over, so two things keep the table of ranks small:

* **Sampled ranks.** In a round of prefix length k, neighbouring windows of ``length`` bytes whose
  smallest k-byte rank is at one and the same place are a *run* of positions, named by that rank. Equal
  windows have equal names, so a run with a name of its own cannot repeat. Runs depend
  on content only and are cut alike in every copy.
* **Whole runs.** A run whose whole string (first to last window) occurs twice is past
  the threshold at once. Only one copy of it goes on, as a partner for others.

In the last round the prefix is the window, and every window left is a row of its own. Ranks
only filter (64 bits); equality is decided on 128-bit hashes of the strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.rows import keyed, named_id
from holdfast.llm.text import (
    BYTE_POWERS,
    U64,
    Powers,
    list_array,
    mix,
    pieces,
    prefix,
    signed,
    sliding_min,
    span_hash,
)
from holdfast.session import materialize

LENGTH = 400
_KEY = ["_id", "_key"]
_SECOND = Powers(0xD6E8FEB86659FD93)
#: Ranks of single bytes, and the factor that tells the first of a pair from the second.
_OF_BYTE = mix(np.arange(1, 257, dtype=U64))
_PAIR, _SPREAD = U64(0xC2B2AE3D27D4EB4F), U64(0xFF51AFD7ED558CCD)
#: Bytes worked on at a time: a dozen arrays of eight times the size then stay in the cache.
_PIECE = 1 << 17
_RUN = "struct<name:long,c1:long,c2:long,start:int,size:int,open:boolean>"


def rounds(length: int) -> list[int]:
    """Prefix lengths of the rounds before the last: a half, then closer to the full length."""
    steps = {length // 2, length - length // 5, length - length // 20}
    return sorted(k for k in steps if 1 <= k < length)


def ranks(data: np.ndarray, k: int) -> np.ndarray:
    """Rank of the k-byte prefix at every position that has one, by doubling.

    The offset grows with the length reached; the last step overlaps if k is no power of two.
    """
    found, reached = _OF_BYTE[data], 1
    while reached < k and len(found):
        offset = min(reached, k - reached)
        pair = found[: max(len(found) - offset, 0)] * _PAIR
        pair += found[offset:]
        pair ^= pair >> U64(29)
        pair *= _SPREAD
        found, reached = pair, reached + offset
    return mix(found)


def _names(data: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of ``length`` bytes its smallest k-byte rank, and whether a run begins.

    A run ends where the name changes, and where the window that held the name at its first
    byte moves on: then the same name is found at a later place, which is a run of its own.
    """
    found = ranks(data, k)
    names = sliding_min(found, length - k + 1)
    new = np.ones(len(names), dtype=bool)
    before = names[:-1]
    new[1:] = (names[1:] != before) | (found[: len(before)] == before)
    return names, new


def _run_columns(sums, second, names, heads, sizes, length):
    """Name and 128-bit hash of the whole string of each run of windows."""
    tails = heads + sizes - 1 + length
    c1 = mix(span_hash(sums, heads, tails, BYTE_POWERS) + sizes.astype(U64))
    c2 = mix(span_hash(second, heads, tails, _SECOND) + sizes.astype(U64))
    return [signed(names[heads]), signed(c1), signed(c2)]


def _run_list(columns, starts, sizes, is_open, edges) -> pa.ListArray:
    values = pa.StructArray.from_arrays(
        [
            *(pa.array(c, pa.int64()) for c in columns),
            pa.array(starts.astype(np.int32)),
            pa.array(sizes.astype(np.int32)),
            pa.array(is_open),
        ],
        names=["name", "c1", "c2", "start", "size", "open"],
    )
    return pa.ListArray.from_arrays(pa.array(np.asarray(edges, dtype=np.int32)), values)


def _first_round(length: int, k: int):
    """All runs of every document, its bytes and their digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column("text"), _PIECE):
                values = piece.data.astype(U64)
                sums, second = prefix(values, BYTE_POWERS), prefix(values, _SECOND)
                names, begins = _names(piece.data, length, k)
                owner = np.repeat(np.arange(piece.rows), np.diff(piece.edges))
                count = len(names)
                if not count:
                    owner = owner[:0]
                whole = owner[:count] == owner[length - 1 :]
                new = whole.copy()
                new[1:] &= begins[1:] | (owner[:count][1:] != owner[:count][:-1])
                heads = np.flatnonzero(new)
                # a run ends at the next run of its document or at the last whole window
                sizes = np.add.reduceat(whole.astype(np.int64), heads) if len(heads) else heads
                rows = owner[heads]
                edges = np.searchsorted(rows, np.arange(piece.rows + 1))
                part = slice(piece.first, piece.first + piece.rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c)[part] for c in _KEY),
                        pa.array(np.diff(piece.edges)),
                        pa.array(
                            [hashlib.sha256(piece.text(r)).hexdigest() for r in range(piece.rows)],
                            pa.string(),
                        ),
                        _run_list(
                            _run_columns(sums, second, names, heads, sizes, length),
                            heads - piece.edges[rows],
                            sizes,
                            np.ones(len(heads), dtype=bool),
                            edges,
                        ),
                    ],
                    names=[*_KEY, "n_bytes", "kept_sha256", "runs"],
                )

    return run


def _next_round(length: int, k: int):
    """The runs of a longer prefix, inside the positions that are left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = batch.column("live")
            for piece in pieces(batch.column("text"), _PIECE):
                columns, starts, sizes_all, opens, edges = [], [], [], [], [0]
                for row in range(piece.rows):
                    data = piece.data[piece.edges[row] : piece.edges[row + 1]]
                    values = data.astype(U64)
                    sums, second = prefix(values, BYTE_POWERS), prefix(values, _SECOND)
                    names, begins = _names(data, length, k)
                    live = left[piece.first + row].values
                    first, size = (live.field(f).to_numpy() for f in ("start", "size"))
                    state = live.field("open").to_numpy(zero_copy_only=False)
                    of = np.full(len(names) + 1, -1, dtype=np.int64)
                    at = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
                    of[at] = np.repeat(np.arange(len(first)), size)
                    new = np.ones(len(names) + 1, dtype=bool)
                    new[1:-1] = begins[1:] | (of[1:-1] != of[:-2])
                    heads = np.flatnonzero(new)
                    sizes = np.diff(heads)
                    heads = heads[:-1]
                    alive = of[heads] >= 0
                    heads, sizes = heads[alive], sizes[alive]
                    columns.append(_run_columns(sums, second, names, heads, sizes, length))
                    starts.append(heads)
                    sizes_all.append(sizes)
                    opens.append(state[of[heads]])
                    edges.append(edges[-1] + len(heads))
                part = slice(piece.first, piece.first + piece.rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c)[part] for c in _KEY),
                        _run_list(
                            [np.concatenate(c) for c in zip(*columns)],
                            np.concatenate(starts),
                            np.concatenate(sizes_all),
                            np.concatenate(opens),
                            edges,
                        ),
                    ],
                    names=[*_KEY, "runs"],
                )

    return run


def _cut(length: int):
    """Maximal removed spans, and the digest of the bytes outside them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, digests = [], []
            for text, marked in zip(batch.column("text"), batch.column("marked")):
                data, kept, at, own = text.as_py().encode(), hashlib.sha256(), 0, []
                for start, end in sorted(
                    (m["start"], m["start"] + m["size"] - 1 + length) for m in marked.as_py()
                ):
                    if own and start <= own[-1]["end"]:
                        own[-1]["end"] = max(own[-1]["end"], end)
                    else:
                        own.append({"start": start, "end": end})
                for span in own:
                    kept.update(data[at : span["start"]])
                    at = span["end"]
                kept.update(data[at:])
                spans.append(own)
                digests.append(kept.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in _KEY),
                    pa.array(
                        spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
                    ),
                    pa.array(digests, pa.string()),
                ],
                names=[*_KEY, "spans", "cut_sha256"],
            )

    return run


def _ranked(runs: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """The open runs whose whole string repeats, and the runs that need a longer prefix."""
    same = ["name", "c1", "c2"]
    groups = materialize(
        runs.groupBy(*same).agg(
            F.count("*").alias("n"),
            F.min(F.struct(*_KEY, "start", "size", "open")).alias("one"),
        ),
        f"ranks-{k}",
    )
    is_open = (F.col("n") == 1) & F.col("one.open")
    # a name stays while an undecided run has a partner of the same name
    wanted = (
        groups.groupBy("name")
        .agg(F.sum("n").alias("total"), F.count(F.when(is_open, 1)).alias("undecided"))
        .where("total > 1 and undecided > 0")
        .select("name")
    )
    wanted = materialize(wanted, f"undecided-{k}")
    live = groups.join(wanted, "name").select("one.*", is_open.alias("still"))
    live = live.select(*_KEY, "start", "size", F.col("still").alias("open"))
    past = (
        runs.where("open")
        .join(groups.where("n > 1").select(*same), same)
        .select(*_KEY, "start", "size")
    )
    return past, live


def repeated_byte_spans(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, spans, kept_sha256``.

    ``spans`` are the maximal removed runs of UTF-8 bytes, [start, end); the digest is of the
    bytes outside them. A string that starts anywhere else counts, in the same document
    and in repeated rows too. A null text is empty; a null id comes back as null.
    Texts shorter than ``length`` keep everything. Other columns are ignored.
    """
    base = keyed(docs, id_col, text_col)
    steps = rounds(length)
    sketch = materialize(
        base.mapInArrow(
            _first_round(length, steps[0]),
            f"_id long, _key long, n_bytes long, kept_sha256 string, runs array<{_RUN}>",
        ),
        "byte-runs",
    )
    runs = sketch.select(*_KEY, F.inline("runs"))
    shared = materialize(
        runs.groupBy("name").count().where("count > 1").select("name"), "shared-names"
    )
    runs = materialize(runs.join(shared, "name"), "shared-runs")
    suspects = materialize(
        base.join(runs.select(*_KEY).distinct(), _KEY).dropDuplicates(_KEY), "byte-suspects"
    )
    past = []
    for k, longer in zip(steps, [*steps[1:], length]):
        done, live = _ranked(runs, k)
        past.append(done)
        left = live.groupBy(*_KEY).agg(F.collect_list(F.struct("start", "size", "open")).alias("live"))
        found = (
            suspects.join(left, _KEY)
            .mapInArrow(_next_round(length, longer), f"_id long, _key long, runs array<{_RUN}>")
            .select(*_KEY, F.inline("runs"))
        )
        runs = materialize(found, f"byte-runs-{longer}")
    past.append(_ranked(runs, length)[0])
    marked = (
        reduce(DataFrame.union, past)
        .groupBy(*_KEY)
        .agg(F.collect_set(F.struct("start", "size")).alias("marked"))
    )
    cut = suspects.join(marked, _KEY).mapInArrow(
        _cut(length),
        "_id long, _key long, spans array<struct<start:int,end:int>>, cut_sha256 string",
    )
    none = F.array().cast("array<struct<start:int,end:int>>")
    return (
        sketch.drop("runs")
        .join(cut, _KEY, "left")
        .select(
            named_id(id_col),
            "n_bytes",
            F.coalesce("spans", none).alias("spans"),
            F.coalesce("cut_sha256", "kept_sha256").alias("kept_sha256"),
        )
    )


def op10_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Every byte of ``documents`` inside a 400-byte string that also starts elsewhere is removed."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.end - s.start)
    return repeated_byte_spans(docs).select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        "kept_sha256",
    )
