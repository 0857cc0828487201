"""Document fingerprints: MinHash signatures, likeness, and near-duplicate classes.

A signature holds, for each of ``PERMUTATIONS`` universal hash functions, the smallest value over the
text's word shingles, computed for all shingles of a piece of text at once. Near copies are found by
joining equal bands of signatures in Spark and verifying the Jaccard likeness of the shingle
sets themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.graph import components
from holdfast.llm.rows import NO_ID, keyed, named_id, packed
from holdfast.llm.text import (
    U64,
    WORD_POWERS,
    Piece,
    list_array,
    mix,
    pieces,
    prefix,
    signed,
    span_hash,
)
from holdfast.session import materialize

SHINGLE_WORDS = 5
PERMUTATIONS = 128
#: Signatures for links: a pair of likeness 0.8 shares one of 25 bands of 5 values but for one in 20,000.
BANDS, BAND_ROWS = 25, 5
SIMILARITY = 0.8
#: A pair is verified if its signatures' likeness, with a standard error of 0.036, is not this far below.
MARGIN = 0.15
SEED = 1729
#: Members in a block; where their sets are compared, with so many shingles each on average.
BLOCK, BLOCK_SHINGLES = 2048, 512
#: What a text without words has in every place of its signature.
EMPTY = np.uint16(0xFFFF)


def permutations(count: int = PERMUTATIONS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and offsets of ``count`` universal hash functions x -> (a x + b) >> 32."""
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 63, count, dtype=np.uint64) * U64(2) + U64(1)
    return a, rng.integers(0, 1 << 63, count, dtype=np.uint64)


def shingles(piece: Piece, width: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all word shingles of a piece and each row's first shingle (and the end).

    A row with fewer words than ``width`` has one shingle, its whole sequence; without words, none.
    """
    starts, ends, first = piece.words()
    sums = prefix(piece.word_hashes(starts, ends), WORD_POWERS[0])
    counts = np.diff(first)
    per_row = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    edges = np.concatenate([[0], np.cumsum(per_row)])
    of = np.repeat(np.arange(piece.rows), per_row)
    begin = first[of] + np.arange(edges[-1]) - edges[of]
    end = np.minimum(begin + width, first[of + 1])
    hashes = span_hash(sums, begin, end, WORD_POWERS[0]) + (end - begin).astype(U64)
    return mix(hashes), edges


def signatures(hashes: np.ndarray, edges: np.ndarray, functions=None) -> np.ndarray:
    """A (rows, permutations) matrix: the low 16 bits of each minimum.

    Two different minima agree in them once in 65,536 times, far below the error of an estimate.
    """
    a, b = permutations() if functions is None else functions
    out = np.full((len(edges) - 1, len(a)), EMPTY, dtype=np.uint16)
    full = np.flatnonzero(np.diff(edges) > 0)
    if len(full):
        heads = edges[full]
        for k in range(len(a)):
            values = ((hashes * a[k] + b[k]) >> U64(32)).astype(np.uint32)
            out[full, k] = np.minimum.reduceat(values, heads).astype(np.uint16)
    return out


def as_hex(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def likeness(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Share of equal places, row by row: an estimate of the Jaccard likeness."""
    return (left == right).mean(axis=1)


# --- fingerprints of texts and of their edited texts -------------------------------------


def _following(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(row, next row) of the sorted rows of a task; rows are (slot, first, id, text)."""
    last = None
    for batch in batches:
        columns = [batch.column(c) for c in ("slot", "sentinel", "_id", "text")]
        for values in zip(*columns):
            row = tuple(v.as_py() for v in values)
            if last is not None and last[0] == row[0] and not last[1]:
                yield last, row
            last = row


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprints of neighbours, in groups of about a megabyte of text."""
    functions, group, size = permutations(), [], 0

    def flush():
        texts, own, edited, after = [], [], [], []
        for at, (row, following) in enumerate(group):
            half = len(row[3]) // 2
            own.append(len(texts))
            edited.append(len(texts) + 1)
            texts += [row[3], row[3][: len(row[3]) - half] + following[3][:half]]
            # the next document is mostly the next row; else it is worked out on its own
            after.append(len(texts))
            if at + 1 == len(group) or group[at + 1][0] is not following:
                texts.append(following[3])
        column = pa.array(texts, pa.large_string())
        found = np.concatenate([signatures(*shingles(p), functions) for p in pieces(column)])
        ids = [row[2] for row, _ in group]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array([len(texts[i]) for i in own], pa.int64()),
                pa.array([hashlib.sha256(texts[i].encode()).hexdigest() for i in edited]),
                pa.array([as_hex(found[i]) for i in own]),
                pa.array([as_hex(found[i]) for i in edited]),
                pa.array(likeness(found[own], found[edited])),
                pa.array(likeness(found[own], found[after])),
            ],
            names=[
                "_id",
                "n_chars",
                "edited_sha256",
                "fingerprint",
                "edited_fingerprint",
                "near_edited",
                "near_next",
            ],
        )

    for pair in _following(batches):
        group.append(pair)
        size += len(pair[0][3])
        if size >= 1 << 20:
            yield flush()
            group, size = [], 0
    if group:
        yield flush()


def edited_fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Each text's fingerprint and that of its edited text, and how alike they are.

    The edited text has the last floor(n/2) code points replaced by the first as many, or all, of the
    next document by ascending id; the last document's next is the first. A null text is empty, a
    null id comes first and back as null, rows of one id follow by text. Other columns
    are ignored. One shuffle: ids are cut into slots at some of the ids themselves, and the
    document at a cut goes to both sides, so each slot knows the successor of its last row.
    """
    spark = docs.sparkSession
    base = keyed(docs, id_col, text_col).select("_id", "text")
    slots = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    shares = F.array(*(F.lit(i / slots) for i in range(slots)))
    # at most one cut per slot comes to the driver
    found = base.agg(F.min("_id").alias("low"), F.percentile_approx("_id", shares, 10_000)).first()
    if found.low is None:
        cuts = [0]
    else:
        cuts = sorted({found.low, *found[1]})
    # which slot an id belongs to, doubled, plus one if the id is the cut that opens the slot
    slot_of = F.pandas_udf(_slots(cuts), "int")
    code = slot_of("_id")
    slot, is_cut = F.shiftright("code", 1), F.col("code") % 2 == 1
    before = F.when(slot == 0, F.lit(len(cuts) - 1)).otherwise(slot - 1)
    placed = base.withColumn("code", code).select(
        "_id", "text", slot.alias("slot"), F.when(is_cut, before).alias("other")
    )
    copies = placed.select(
        "_id",
        "text",
        F.inline(
            F.filter(
                F.array(
                    F.struct(F.col("slot"), F.lit(False).alias("sentinel")),
                    F.struct(F.col("other").alias("slot"), F.lit(True).alias("sentinel")),
                ),
                lambda c: c["slot"].isNotNull(),
            )
        ),
    )
    rows = copies.repartitionById(len(cuts), F.col("slot").cast("int")).sortWithinPartitions(
        "slot", "sentinel", "_id", "text"
    )
    return rows.mapInArrow(
        _edited,
        "_id long, n_chars long, edited_sha256 string, fingerprint string,"
        " edited_fingerprint string, near_edited double, near_next double",
    ).select(
        named_id(id_col),
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


def _slots(cuts: list[int]):
    edges = np.array(cuts, dtype=np.int64)

    def of(ids: pd.Series) -> pd.Series:
        slot = np.searchsorted(edges, ids.to_numpy(), side="right") - 1
        return pd.Series((2 * slot + (edges[slot] == ids.to_numpy())).astype(np.int32))

    return of


# --- near-duplicate classes --------------------------------------------------------------


def _sketches(bands: int, rows: int):
    """Digest and size of each row's shingle set, its signature and its band values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        functions = permutations(bands * rows)
        salt = mix(np.arange(1, bands + 1).astype(U64))
        for batch in batches:
            for piece in pieces(batch.column("text")):
                hashes, edges = shingles(piece)
                found = signatures(hashes, edges, functions)
                values = np.zeros((piece.rows, bands), dtype=U64) + salt
                for k in range(rows):
                    values = mix(values * U64(0x9E3779B97F4A7C15) + found[:, k::rows].astype(U64))
                sets = [np.unique(hashes[i:j]) for i, j in zip(edges[:-1], edges[1:])]
                part = slice(piece.first, piece.first + piece.rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c)[part] for c in ("_id", "_key")),
                        pa.array([hashlib.sha256(x.tobytes()).digest()[:16] for x in sets]),
                        pa.array(list(map(len, sets)), pa.int32()),
                        pa.array([row.tobytes() for row in found], pa.binary()),
                        list_array(
                            signed(values.ravel()),
                            bands * np.arange(piece.rows + 1),
                            pa.int64(),
                        ),
                    ],
                    names=["_id", "_key", "set", "n", "signature", "bands"],
                )

    return run


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch.column("text")):
            hashes, edges = shingles(piece)
            sets = [np.unique(signed(hashes[i:j])) for i, j in zip(edges[:-1], edges[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("set")[piece.first : piece.first + piece.rows],
                    list_array(np.concatenate(sets), np.cumsum([0, *map(len, sets)]), pa.int64()),
                ],
                names=["set", "shingles"],
            )


def _matrix(prints: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(prints), dtype=np.uint16).reshape(len(prints), -1)


def _hopeful(floor: float):
    """The pairs whose signatures agree in a share of at least ``floor``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = likeness(*(_matrix(batch.column(c).to_pylist()) for c in ("left", "right")))
                yield batch.select(["a", "b"]).filter(pa.array(near >= floor))

    return run


def best_ties(
    low: np.ndarray, low_class: np.ndarray, high: np.ndarray, high_class: np.ndarray, floor: float
) -> tuple[np.ndarray, np.ndarray, bool]:
    """(place in low, place in high) of each low class's most alike pair with another class.

    Arguments are signatures and class numbers. The last value is False if a class has more than
    one pair that reaches ``floor``.
    """
    left, right, whole = [], [], True
    for label in np.unique(low_class):
        other = np.flatnonzero(high_class != label)
        best = (floor, None, None)
        found = 0
        for at in np.flatnonzero(low_class == label):
            if not len(other):
                break
            alike = (high[other] == low[at]).mean(axis=1)
            found += int((alike >= floor).sum())
            top = int(alike.argmax())
            if alike[top] > best[0] or best[1] is None and alike[top] >= floor:
                best = (alike[top], at, other[top])
        if best[1] is not None:
            left.append(best[1])
            right.append(best[2])
        whole &= found < 2
    return np.array(left, dtype=int), np.array(right, dtype=int), whole


def _ties(floor: float):
    """Ties inside cells; a cell that could not name all its pairs says so by a row without ``a``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            band, a, b = [], [], []
            for cell in batch.to_pylist():
                members = cell["members"]
                prints = _matrix([m["signature"] for m in members])
                label = _numbers([m["class"] for m in members])
                block = np.array([m["block"] for m in members])
                low = np.flatnonzero(block == cell["low"])
                high = np.flatnonzero(block == cell["high"])
                x, y, whole = best_ties(prints[low], label[low], prints[high], label[high], floor)
                band += [cell["band"]] * (len(x) + (not whole))
                a += [members[i]["set"] for i in low[x]] + [None] * (not whole)
                b += [members[i]["set"] for i in high[y]] + [None] * (not whole)
            yield pa.RecordBatch.from_arrays(
                [pa.array(band, pa.int64()), pa.array(a, pa.binary()), pa.array(b, pa.binary())],
                names=["band", "a", "b"],
            )

    return run


def exact_ties(
    ids: np.ndarray, edges: np.ndarray, label: np.ndarray, low: np.ndarray, high: np.ndarray, similarity: float
) -> list[tuple[int, int]]:
    """Pairs (of low, of high) that join classes: their sets, numbered shingles, reach the likeness.

    Every pair of different classes is looked at until it is joined, so the ties connect what all similar
    pairs would; there are fewer of them than classes.
    """
    label, sizes = label.copy(), np.diff(edges)
    held = np.concatenate([ids[edges[i] : edges[i + 1]] for i in high])
    starts = np.cumsum(sizes[high]) - sizes[high]
    mark = np.zeros(ids.max() + 1, dtype=bool)
    ties = []
    for at in low:
        apart = label[high] != label[at]
        if not apart.any():
            continue
        own = ids[edges[at] : edges[at + 1]]
        mark[own] = True
        shared = np.add.reduceat(mark[held], starts, dtype=np.int64)
        mark[own] = False
        alike = shared / (sizes[at] + sizes[high] - shared) >= similarity
        for to in high[apart & alike]:
            if label[to] != label[at]:
                ties.append((int(at), int(to)))
                label[label == label[to]] = label[at]
    return ties


def _exact(similarity: float):
    def run(cell: pa.Table) -> pa.Table:
        sets = cell.column("shingles").combine_chunks()
        edges = sets.offsets.to_numpy().astype(np.int64)
        ids = np.unique(sets.values.to_numpy()[edges[0] : edges[-1]], return_inverse=True)[1]
        block = cell.column("block").to_numpy()
        low, high = (
            np.flatnonzero(block == cell.column(side)[0].as_py()) for side in ("low", "high")
        )
        ties = []
        if len(low) and len(high):
            label = _numbers(cell.column("class").to_pylist())
            ties = exact_ties(ids, edges - edges[0], label, low, high, similarity)
        names = cell.column("set").to_pylist()
        return pa.table(
            {
                "a": pa.array([names[i] for i, _ in ties], pa.binary()),
                "b": pa.array([names[j] for _, j in ties], pa.binary()),
            }
        )

    return run


def _numbers(classes: list[bytes]) -> np.ndarray:
    """The same number for the same class."""
    seen: dict[bytes, int] = {}
    return np.array([seen.setdefault(c, len(seen)) for c in classes])


def _in_cells(parts: DataFrame, weight: Column, block: int) -> DataFrame:
    """``parts`` with ``low, high, block``, once for each cell of its band that a row belongs to.

    The members of a band's largest class are open towards the others only. So these, the minor
    ones, are cut into blocks that meet every block; the major ones meet blocks of minor ones. A band
    with few minor members has as many rows as members, however large its main class is. A block
    holds members of about ``block`` in ``weight``.
    """
    crowd = parts.groupBy("band", "class").agg(F.sum(weight).alias("m"))
    crowd = crowd.groupBy("band").agg(
        F.sum("m").alias("size"), F.max(F.struct("m", "class")).alias("major")
    )
    minors = F.col("size") - F.col("major.m")
    crowd = crowd.where(minors > 0).select(
        "band",
        F.col("major.class").alias("major"),
        F.ceil(minors / block).cast("int").alias("small"),
        F.ceil(F.col("major.m") / block).cast("int").alias("large"),
    )
    near = parts.join(crowd, "band").withColumn("minor", F.col("class") != F.col("major"))
    drawn = F.xxhash64("set", "band")
    near = near.withColumn(
        "block",
        F.when(F.col("minor"), F.pmod(drawn, F.col("small"))).otherwise(
            F.col("small") + F.pmod(drawn, F.col("large"))
        ).cast("int"),
    )
    last = F.when(F.col("minor"), F.col("small") + F.col("large") - 1).otherwise(F.col("small") - 1)
    met = near.withColumn("met", F.explode(F.sequence(F.lit(0), last)))
    return met.select(
        *parts.columns,
        "block",
        F.least("block", "met").alias("low"),
        F.greatest("block", "met").alias("high"),
    )


def near_copy_classes(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = BAND_ROWS,
    block: int = BLOCK,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``_id, _key, class`` of each row: what is reachable over verified links of ``similarity``.

    Capital ASCII letters count as small ones. Rows with one shingle set are one node; texts without
    words have the empty set. Members of a band that are connected need no comparison. First each
    meets the one leader of its band. Bands that still hold several classes are cut into blocks, and
    each class names its most alike pair with another class by signature; these pairs are verified
    and join classes. Where a class had more than one such pair and classes are still apart, the
    blocks' shingle sets are compared in the task, which returns the ties that join classes. So the
    result is that of all pairs of all bands, and no step makes a row per pair.
    """
    small = F.translate("text", ascii_uppercase, ascii_lowercase)
    base = keyed(docs, id_col, text_col).withColumn("text", small)
    sketch = materialize(
        base.mapInArrow(
            _sketches(bands, rows),
            "_id long, _key long, set binary, n int, signature binary, bands array<long>",
        ),
        "minhash",
    )
    nodes = sketch.groupBy("set").agg(
        F.min(F.struct("_id", "_key")).alias("rep"),
        F.any_value("n").alias("n"),
        F.any_value("signature").alias("signature"),
        F.any_value("bands").alias("bands"),
    )
    nodes = materialize(nodes.where("n > 0"), "minhash-sets")
    every = nodes.select("set", F.explode("bands").alias("band"))
    shared = every.groupBy("band").agg(F.count("*").alias("m"), F.min("set").alias("leader"))
    shared = materialize(shared.where("m > 1").select("band", "leader"), "shared-bands")
    keys = materialize(every.join(shared, "band"), "band-members")
    members = nodes.join(keys.select("set").distinct(), "set").select("set", "rep", "n", "signature")
    members = materialize(members, "candidates")
    sets = materialize(
        base.join(members.select("set", "rep.*"), ["_id", "_key"])
        .mapInArrow(_shingle_sets, "set binary, shingles array<long>")
        .dropDuplicates(["set"]),
        "shingle-sets",
    )
    floor = similarity - MARGIN
    prints = members.select("set", "n", "signature")

    def alike(pairs: DataFrame) -> DataFrame:
        """The ``pairs(a, b)`` whose shingle sets reach the likeness."""
        left = sets.select(F.col("set").alias("a"), F.col("shingles").alias("left"))
        right = sets.select(F.col("set").alias("b"), F.col("shingles").alias("right"))
        shared = F.size(F.array_intersect("left", "right"))
        jaccard = shared / (F.size("left") + F.size("right") - shared)
        joined = pairs.join(left, "a").join(right, "b")
        return joined.where(jaccard >= similarity).select("a", "b")

    def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
        """``set, class`` after the classes of linked sets have become one."""
        ends = links.join(labels.toDF("a", "from"), "a").join(labels.toDF("b", "to"), "b")
        tied = components(ends.select("from", "to")).toDF("class", "root")
        return materialize(
            labels.join(tied, "class", "left").select("set", F.coalesce("root", "class").alias("class")),
            "copy-classes",
        )

    first = keys.where("set <> leader").select(F.col("set").alias("a"), F.col("leader").alias("b"))
    # likeness is at most the ratio of the set sizes
    fits = f"n >= {similarity} * m - 0.000001 and m >= {similarity} * n - 0.000001"
    hopeful = (
        first.distinct()
        .join(prints.toDF("a", "n", "left"), "a")
        .join(prints.toDF("b", "m", "right"), "b")
        .where(fits)
        .mapInArrow(_hopeful(floor), "a binary, b binary")
    )
    labels = members.select("set", F.col("set").alias("class"))
    labels = joined(labels, alike(materialize(hopeful, "leader-pairs")))
    def still_open(bands: DataFrame) -> DataFrame:
        """``band, set, class`` of the members of bands that hold several classes."""
        parts = bands.join(labels, "set")
        mixed = parts.groupBy("band").agg(F.min("class").alias("c"), F.max("class").alias("d"))
        return parts.join(mixed.where("c <> d").select("band"), "band")

    # leaders have met all members of their bands
    pending = keys.where("set <> leader").select("band", "set")
    parts = materialize(still_open(pending).join(prints.drop("n"), "set"), "open-members")
    cells = (
        _in_cells(parts, F.lit(1), block)
        .groupBy("band", "low", "high")
        .agg(F.collect_list(F.struct("set", "class", "signature", "block")).alias("members"))
    )
    named = materialize(cells.mapInArrow(_ties(floor), "band long, a binary, b binary"), "named-pairs")
    pairs = named.where("a is not null").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    )
    labels = joined(labels, alike(pairs.distinct()))
    again = named.where("a is null").select("band").distinct()
    parts = still_open(parts.select("band", "set").join(again, "band"))
    parts = materialize(parts.join(sets, "set"), "unsettled-members")
    cells = _in_cells(parts, F.size("shingles").cast("long"), block * BLOCK_SHINGLES)
    ties = cells.groupBy("band", "low", "high").applyInArrow(_exact(similarity), "a binary, b binary")
    labels = joined(labels, ties)
    return sketch.join(labels, "set", "left").select(
        "_id", "_key", F.coalesce("class", "set").alias("class")
    )


def one_of_alike(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row of each class of ``near_copy_classes``, the one with the smallest id; all columns stay.

    Rows of one id are told apart by text, repeated rows by their other columns, the smallest first.
    """
    classes = near_copy_classes(docs, similarity, id_col=id_col, text_col=text_col)
    return first_of_each(docs, classes, id_col, text_col)


def first_of_each(docs: DataFrame, classes: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class of ``classes(_id, _key, class)``, the one with the smallest id; all columns stay."""
    keepers = classes.groupBy("class").agg(F.min(F.struct("_id", "_key")).alias("kept"))
    keepers = materialize(keepers.select("kept.*"), "keepers")
    rows = packed(docs, id_col, text_col).join(keepers, ["_id", "_key"])
    return rows.groupBy("_id", "_key").agg(F.min("row").alias("row")).select("row.*")


def op5_minhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of every whole text of ``documents`` and of its edited text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return edited_fingerprints(docs)
