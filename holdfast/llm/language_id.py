"""Language ID: multinomial naive Bayes over hashed character n-grams.

Counting is a Spark aggregate over all labelled rows. The model is a matrix of log
probabilities, one row per language and one column per hash bucket, so its size depends on the
label set only; it is broadcast, and texts are scored in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.text import U64
from holdfast.session import materialize

ORDERS = (1, 2, 3)
BUCKET_BITS = 16
SMOOTHING = 0.5
UNKNOWN = "und"
#: Largest model to broadcast; at 2**16 buckets this is 256 languages.
MODEL_BYTES = 64 << 20
#: A text is rejected if the posterior of its language is lower.
MIN_SCORE = 0.5
_GROUP_CHARS = 1 << 20
_FACTORS = tuple(U64(pow(0x9E3779B97F4A7C15, k + 1, 1 << 64)) for k in range(max(ORDERS)))

#: ASCII characters that are no letters count as a space.
_FOLD = np.arange(128, dtype=np.uint32)
_FOLD[[not chr(c).isalpha() for c in range(128)]] = 32


def buckets(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, row) of every n-gram, order by order; n-grams stay inside their text."""
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    rows = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
    plain = codes < 128
    codes = np.where(plain, _FOLD[np.where(plain, codes, 0)], codes)
    space = codes == 32
    again = np.zeros(len(codes), dtype=bool)
    again[1:] = space[1:] & space[:-1] & (rows[1:] == rows[:-1])
    codes, rows = codes[~again].astype(U64), rows[~again]
    for order in ORDERS:
        count = len(codes) - order + 1
        if count <= 0:
            continue
        mixed = np.full(count, order, dtype=U64)
        for k in range(order):
            mixed += codes[k : k + count] * _FACTORS[k]
        mixed ^= mixed >> U64(31)
        mixed *= U64(0xBF58476D1CE4E5B9)
        whole = rows[:count] == rows[order - 1 :]
        found = (mixed >> U64(64 - BUCKET_BITS)).astype(np.int64)
        yield found[whole], rows[:count][whole]


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def _groups(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[list[list]]:
    """Rows as column lists, about a megabyte of text (the last column) or one row at a time."""
    for batch in batches:
        group, size = [[] for _ in columns], 0
        for values in zip(*(batch.column(c) for c in columns)):
            for cell, value in zip(group, values):
                cell.append(value.as_py())
            size += len(group[-1][-1] or "")
            if size >= _GROUP_CHARS:
                yield group
                group, size = [[] for _ in columns], 0
        if group[0]:
            yield group


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a task has seen: non-zero n-gram counts and documents of each language."""
    totals: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for labels, texts in _groups(batches, ["label", "text"]):
        names, of = np.unique(labels, return_inverse=True)
        for name, n in zip(names, np.bincount(of)):
            docs[str(name)] = docs.get(str(name), 0) + int(n)
            totals.setdefault(str(name), np.zeros(1 << BUCKET_BITS, dtype=np.int64))
        for found, rows in buckets([t or "" for t in texts]):
            spread = np.bincount(
                of[rows] * (1 << BUCKET_BITS) + found, minlength=len(names) << BUCKET_BITS
            )
            for name, part in zip(names, spread.reshape(len(names), -1)):
                totals[str(name)] += part
    for name, total in totals.items():
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([name]),
                pa.array([docs[name]], pa.int64()),
                pa.array([seen.tolist()], pa.list_(pa.int32())),
                pa.array([total[seen].tolist()], pa.list_(pa.int64())),
            ],
            names=["label", "docs", "bucket", "n"],
        )


@dataclass
class Model:
    languages: list[str]
    prior: np.ndarray
    weights: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        """Log likelihood plus log prior, one row per text and one column per language."""
        out = np.tile(self.prior, (len(texts), 1))
        for found, rows in buckets(texts):
            for k in range(len(self.languages)):
                out[:, k] += np.bincount(rows, self.weights[k][found], len(texts))
        return out


def train(labelled: DataFrame, label_col: str = "lang", text_col: str = "text") -> Model:
    """The model of all rows with a label; rows without one are left out, a null text is empty.

    An empty table gives a model without languages.
    """
    rows = labelled.where(F.col(label_col).isNotNull()).select(
        F.col(label_col).cast("string").alias("label"), F.col(text_col).alias("text")
    )
    parts = rows.mapInArrow(
        _counts, "label string, docs long, bucket array<int>, n array<long>"
    )
    # one entry for the documents of a language beside its buckets, so one job counts both
    cells = parts.select(
        "label",
        F.explode(
            F.concat(
                F.arrays_zip("bucket", "n"),
                F.array(F.struct(F.lit(-1).alias("bucket"), F.col("docs").alias("n"))),
            )
        ).alias("cell"),
    )
    counted = cells.groupBy("label", "cell.bucket").agg(F.sum("cell.n").alias("n"))
    counted = materialize(counted, "language-counts")
    most = MODEL_BYTES >> (BUCKET_BITS + 2)
    # labels are counted before any of their rows comes to the driver
    if counted.select("label").distinct().limit(most + 1).count() > most:
        raise ValueError(f"more than {most} languages are too many for one broadcast model")
    # at most languages x buckets rows
    table = counted.toPandas()
    languages = sorted(table["label"].unique())
    counts = np.zeros((len(languages), 1 << BUCKET_BITS))
    docs = np.zeros(len(languages))
    place = table["label"].map({name: k for k, name in enumerate(languages)}).to_numpy(dtype=int)
    bucket, n = table["bucket"].to_numpy(dtype=int), table["n"].to_numpy(dtype=float)
    docs[place[bucket < 0]] = n[bucket < 0]
    counts[place[bucket >= 0], bucket[bucket >= 0]] = n[bucket >= 0]
    weights = np.log(counts + SMOOTHING)
    weights -= np.log(counts.sum(axis=1, keepdims=True) + SMOOTHING * counts.shape[1])
    prior = np.log(docs / max(docs.sum(), 1))
    return Model(languages, prior, weights.astype(np.float32))


def predict(model: Model, texts: list[str]) -> tuple[list[str], np.ndarray]:
    known = [bool(model.languages) and has_letter(t) for t in texts]
    if not any(known):
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    odds = model.scores(texts)
    share = np.exp(odds - odds.max(axis=1, keepdims=True)).sum(axis=1)
    labels = [model.languages[b] if k else UNKNOWN for b, k in zip(odds.argmax(axis=1), known)]
    return labels, np.where(known, 1 / share, 0.0)


def language_of(model: Model, spark: SparkSession):
    """A function of a text column: struct ``lang_pred, score``.

    The score is the posterior probability of the predicted language. A null text or one without a
    letter is ``und`` with score 0, as is any text if nothing was learned; equally likely
    languages go by name.
    """
    shared = spark.sparkContext.broadcast((model.languages, model.prior, model.weights))

    def run(texts: pd.Series) -> pd.DataFrame:
        fitted = Model(*shared.value)
        labels, scores, group, size = [], [np.zeros(0)], [], 0
        for at, text in enumerate(texts):
            group.append(text or "")
            size += len(group[-1])
            if size >= _GROUP_CHARS or at + 1 == len(texts):
                found, score = predict(fitted, group)
                labels += found
                scores.append(score)
                group, size = [], 0
        return pd.DataFrame({"lang_pred": labels, "score": np.concatenate(scores)})

    return F.pandas_udf(run, "lang_pred string, score double")


def fold(id_col: Column) -> Column:
    """0, 1 or 2 from the crc32 of the id as text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 3


def confident(
    docs: DataFrame, model: Model, min_score: float = MIN_SCORE, text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` whose language is known with at least ``min_score``; all columns stay."""
    found = language_of(model, docs.sparkSession)(F.col(text_col))
    rows = docs.select(F.struct("*").alias("row"), found.alias("found"))
    good = (F.col("found.lang_pred") != UNKNOWN) & (F.col("found.score") >= min_score)
    return rows.where(good).select("row.*")


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    """Languages of all ``documents``, learned from two of three folds."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = train(docs.where(fold(F.col("doc_id")) != 1))
    found = language_of(model, spark)(F.col("text"))
    return docs.select("doc_id", (fold(F.col("doc_id")) == 1).alias("held_out"), found.alias("f")).select(
        "doc_id", "held_out", "f.lang_pred", "f.score"
    )
