"""Benchmark decontamination by q-gram lemma filtering.

An item of m characters that occurs in a document with at most e edits shares at least
m - q + 1 - q e q-grams with it, and all of them lie within e + 1 neighbouring diagonals (document position
minus item position). Shared q-grams are counted in bands of 2 (e + 1) diagonals that overlap by half,
so one band holds them all. Bands that reach the bound are verified by banded alignment.

Items are a stated query set: they are taken in blocks of bounded size, each broadcast as one
q-gram index, and every document is held against every block. Besides the whole item its first,
middle and last half are looked for where a half has ``MIN_PART`` characters; any run of three
quarters of an item holds one of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.rows import NO_ID, keyed, named_id
from holdfast.llm.text import BYTE_POWERS, U64, mix, prefix, window_hash

Q = 12
EDIT_SHARE = 0.05
#: Least characters of half an item that counts by itself.
MIN_PART = 60
#: Characters of items in one broadcast block; an item longer than that is a block of its own.
BLOCK_CHARS = 1 << 20
_FILTER_BITS = 22
_GROUP_CHARS = 1 << 19


def normalise(text: str) -> str:
    """Lower case, and one space for each run of white space."""
    return " ".join(text.lower().split())


def budget(chars: int, q: int = Q, share: float = EDIT_SHARE) -> int:
    """Edits allowed to an item: a share of its length, and few enough for the lemma to bind."""
    return max(0, min(int(chars * share), (chars - q) // q))


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def grams(values: np.ndarray, q: int) -> np.ndarray:
    """Hash of every run of ``q`` characters."""
    return mix(window_hash(prefix(values.astype(U64), BYTE_POWERS), q, BYTE_POWERS))


def halves(text: np.ndarray, least: int = MIN_PART) -> list[tuple[float, np.ndarray]]:
    """The item with share 1, then its halves with share 0.5 where they are long enough."""
    half, quarter = len(text) // 2, len(text) // 4
    parts = [(1.0, text)]
    if half >= least:
        parts += [(0.5, text[at : at + half]) for at in (0, quarter, len(text) - half)]
    return parts


@dataclass
class Block:
    """Some items or parts of items, and the sorted index of their q-grams."""

    ids: list[int]
    parts: list[float]
    items: list[np.ndarray]
    q: int
    share: float

    def __post_init__(self):
        self.widths = np.array(
            [min(self.q, len(x)) for x in self.items], dtype=np.int64
        )  # a shorter item is one gram
        self.edits = np.array([budget(len(x), self.q, self.share) for x in self.items])
        self.needed = np.array(
            [len(x) - w + 1 - w * e for x, w, e in zip(self.items, self.widths, self.edits)]
        )
        self.index = {}
        for width in np.unique(self.widths):
            own = np.flatnonzero(self.widths == width)
            found = [grams(self.items[k], int(width)) for k in own]
            hashes = np.concatenate(found)
            item = np.repeat(own, [len(f) for f in found])
            place = np.concatenate([np.arange(len(f)) for f in found])
            order = np.argsort(hashes, kind="stable")
            table = np.zeros(1 << _FILTER_BITS, dtype=bool)
            table[hashes >> U64(64 - _FILTER_BITS)] = True
            self.index[int(width)] = (hashes[order], item[order], place[order], table)

    def candidates(self, text: np.ndarray, width: int, edges: np.ndarray):
        """(row, item, band) with enough shared grams; bands are in the row's own diagonals."""
        hashes, item, place, table = self.index[width]
        own = grams(text, width)
        at = np.flatnonzero(table[own >> U64(64 - _FILTER_BITS)])
        lo = np.searchsorted(hashes, own[at], side="left")
        n = np.searchsorted(hashes, own[at], side="right") - lo
        at, lo, n = at[n > 0], lo[n > 0], n[n > 0]
        entry = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        at = np.repeat(at, n)
        row = np.searchsorted(edges, at, side="right") - 1
        inside = at + width <= edges[row + 1]
        at, entry, row = at[inside], entry[inside], row[inside]
        k, p = item[entry], place[entry]
        half = self.edits[k] + 1
        band = (at - edges[row] - p) // half
        # each diagonal lies in two bands, its own and the one before
        key = np.stack([np.tile(row, 2), np.tile(k, 2), np.concatenate([band, band - 1])])
        cells = np.unique(np.concatenate([key, np.tile(p, 2)[None]]).T, axis=0)
        if not len(cells):
            return cells[:, :3]
        groups, count = np.unique(cells[:, :3], axis=0, return_counts=True)
        return groups[count >= self.needed[groups[:, 1]]]


def band_distance(item: np.ndarray, text: np.ndarray, low: int, width: int) -> int:
    """Fewest edits that turn ``item`` into a part of ``text`` along diagonals [low, low + width)."""
    far = len(item) + 1
    steps = np.arange(width)
    row = np.where((low + steps >= 0) & (low + steps <= len(text)), 0, far)
    for i in range(1, len(item) + 1):
        j = low + steps + i
        real = (j >= 1) & (j <= len(text))
        same = np.zeros(width, dtype=bool)
        same[real] = text[j[real] - 1] == item[i - 1]
        diagonal = np.where(real, row + ~same, far)
        above = np.where((j >= 0) & (j <= len(text)), np.append(row[1:], far) + 1, far)
        best = np.minimum(diagonal, above)
        row = np.minimum.accumulate(best - steps) + steps
        row = np.where((j >= 0) & (j <= len(text)), np.minimum(row, far), far)
    return int(row.min())


def _exact(item: np.ndarray, text: np.ndarray, low: int, width: int) -> bool:
    return any(
        (text[d : d + len(item)] == item).all()
        for d in range(max(low, 0), min(low + width, len(text) - len(item) + 1))
        if text[d] == item[0] and text[d + len(item) - 1] == item[-1]
    )


def find(block: Block, texts: list[str]) -> list[tuple[int, int, int]]:
    """(row, item number, edits) of every item found in every text."""
    parts = [codes(normalise(t)) for t in texts]
    edges = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    joined = np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint32)
    best: dict[tuple[int, int], int] = {}
    for width in block.index:
        for row, k, band in block.candidates(joined, width, edges):
            if best.get((row, k)) == 0:
                continue
            half = int(block.edits[k]) + 1
            low, wide = int(band) * half, 2 * half
            if _exact(block.items[k], parts[row], low, wide):
                best[row, k] = 0
                continue
            # an alignment may leave the band of its shared grams by its own edits
            slack = half - 1
            edits = band_distance(block.items[k], parts[row], low - slack, wide + 2 * slack)
            if edits <= block.edits[k]:
                best[row, k] = min(edits, best.get((row, k), edits))
    return [(int(r), int(k), e) for (r, k), e in best.items()]


def _search(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(*shared.value)
        for batch in batches:
            ids, keys = batch.column("_id"), batch.column("_key")
            column, at, rows = batch.column("text"), 0, batch.num_rows
            while at < rows:
                texts, size = [], 0
                while at + len(texts) < rows and (not texts or size < _GROUP_CHARS):
                    texts.append(column[at + len(texts)].as_py())
                    size += len(texts[-1])
                hits = find(block, texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[at + r].as_py() for r, _, _ in hits], pa.int64()),
                        pa.array([keys[at + r].as_py() for r, _, _ in hits], pa.int64()),
                        pa.array([block.ids[k] for _, k, _ in hits], pa.int64()),
                        pa.array([e for _, _, e in hits], pa.int64()),
                        pa.array([block.parts[k] for _, k, _ in hits], pa.float64()),
                    ],
                    names=["_id", "_key", "item_id", "edits", "part"],
                )
                at += len(texts)

    return run


def item_blocks(
    benchmark: DataFrame, size: int = BLOCK_CHARS, least: int = MIN_PART
) -> Iterator[tuple[list[int], list[float], list[np.ndarray]]]:
    """Ids, shares and texts of items and their halves in ascending id, at most ``size`` characters
    or one item at a time.

    Items without text, blank or null, cannot occur and are left out. Items without id are one id.
    """
    known = F.coalesce(F.col("item_id").cast("bigint"), F.lit(NO_ID)).alias("item_id")
    rows = benchmark.where("text IS NOT NULL").select(known, "text")
    block, chars = ([], [], []), 0
    for item in rows.orderBy("item_id", "text").toLocalIterator():
        text = codes(normalise(item.text))
        if not len(text):
            continue
        parts = halves(text, least)
        more = sum(len(x) for _, x in parts)
        if chars and chars + more > size:
            yield block
            block, chars = ([], [], []), 0
        for share, part in parts:
            for column, value in zip(block, (item.item_id, share, part)):
                column.append(value)
        chars += more
    if chars:
        yield block


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    q: int = Q,
    share: float = EDIT_SHARE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``_id, _key, item_id, edits, part``: every pair of a document and an item that occurs in it.

    ``part`` is 1 if the item occurs whole, 0.5 if only one of its halves does; ``edits`` is the
    smallest number of edits of any such occurrence. A null text holds nothing. Repeated items of one id
    count once, with the largest part and then the fewest edits, as do repeated rows of one
    document; items without id are one item whose id is null. Without items the result is empty.
    """
    spark = docs.sparkSession
    base = keyed(docs, id_col, text_col)
    schema = "_id long, _key long, item_id long, edits long, part double"
    found = [
        base.mapInArrow(_search(spark.sparkContext.broadcast((*block, q, share))), schema)
        for block in item_blocks(benchmark)
    ]
    if not found:
        return spark.createDataFrame([], schema)
    best = F.max(F.struct("part", (-F.col("edits")).alias("kept")))
    pairs = reduce(DataFrame.union, found).groupBy("_id", "_key", "item_id").agg(best.alias("best"))
    return pairs.select(
        "_id",
        "_key",
        F.when(F.col("item_id") != F.lit(NO_ID), F.col("item_id")).alias("item_id"),
        (-F.col("best.kept")).alias("edits"),
        F.col("best.part").alias("part"),
    )


def op8_decontamination(spark, sf_dir: str) -> DataFrame:
    """All pairs of ``documents`` and ``benchmark`` items found in them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contaminated(docs, items).select(named_id(), "item_id", "edits", "part")
