"""Line dedup with a log-template tree: recurring templates are kept once and dropped elsewhere.

The tree has a fixed depth. A line's path is its token count and its first ``DEPTH`` tokens; tokens
with a digit are variable fields from the start. Inside a leaf a token stays a constant if enough
lines have it at that place, else its place is generalised to a variable field. What
a line becomes by that is its template. A template is recurring if it is in ``MIN_DOCS`` documents and
most of its tokens are constants; its lines stay in the document with the smallest id
and go from all others, so a text that exists in copies is never lost as a whole.

A long line that stands word for word, digits included, in two documents is recurring by itself if its
neighbours differ: somewhere another line comes before it and another one after it. In copies
and near copies of a whole document the neighbours are the same; those are left to the
operators that remove documents.

All statistics are aggregates over all documents and do not depend on any order of arrival.
Equal lines are counted together before their tokens are looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.rows import keyed, packed
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

DEPTH = 3
MIN_DOCS = 10
MIN_CONSTANT = 0.6
#: Tokens from which an identical line counts from the second document.
LONG_LINE = 10
#: Stands for a variable field.
VARIABLE = U64(0x2A)
_KEY = ["_id", "_key"]
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_NEWLINE = 10


def _lines(piece: Piece, depth: int):
    """Of all lines with a token: row, number in the row, first token (and the end), path, tokens,
    and a hash of the line as it is."""
    starts, ends, first = piece.words()
    tokens = piece.word_hashes(starts, ends)
    sums = prefix(tokens, WORD_POWERS[0])
    digits = np.concatenate([[0], np.cumsum(_DIGIT[piece.data])])
    tokens[digits[ends] > digits[starts]] = VARIABLE
    breaks = np.concatenate([[0], np.cumsum(piece.data == _NEWLINE)])
    number, row = breaks[starts], np.repeat(np.arange(piece.rows), np.diff(first))
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (number[1:] != number[:-1]) | (row[1:] != row[:-1])
    heads = np.flatnonzero(new)
    edges = np.append(heads, len(starts))
    count = np.diff(edges)
    path = mix(count.astype(U64))
    for level in range(depth):
        deep = count > level
        path[deep] = mix(path[deep] * U64(0x9E3779B97F4A7C15) + tokens[heads[deep] + level])
    owner = row[heads]
    whole = mix(span_hash(sums, heads, edges[1:], WORD_POWERS[0]) + count.astype(U64))
    return owner, number[heads] - breaks[piece.edges[owner]], edges, path, tokens, whole


def _neighbours(owner: np.ndarray, whole: np.ndarray, rows: np.ndarray):
    """Hashes of the lines before and after each line.

    The first and last line of a row have a neighbour that is the row's own, ``rows``; an only line none.
    """
    begins = np.ones(len(owner), dtype=bool)
    begins[1:] = owner[1:] != owner[:-1]
    ends = np.ones(len(owner), dtype=bool)
    ends[:-1] = begins[1:]
    before, after = np.roll(whole, 1), np.roll(whole, -1)
    before[begins], after[ends] = rows[owner[begins]], rows[owner[ends]]
    only = begins & ends
    before[only] = after[only] = 0
    return before, after


_LONG = pa.struct(
    [("number", pa.int32()), ("line", pa.int64()), ("before", pa.int64()), ("after", pa.int64())]
)


def _paths(depth: int, long_line: int):
    """The distinct paths of each document, its number of lines, and its long lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column("text")):
                owner, number, line_edges, path, _, whole = _lines(piece, depth)
                part = slice(piece.first, piece.first + piece.rows)
                rows = [
                    batch.column(c)[part].to_numpy(zero_copy_only=False).view(U64) for c in _KEY
                ]
                before, after = _neighbours(owner, whole, mix(rows[0] * VARIABLE + rows[1]))
                long = np.flatnonzero(np.diff(line_edges) >= long_line)
                long_edges = np.searchsorted(owner[long], np.arange(piece.rows + 1))
                values = pa.StructArray.from_arrays(
                    [
                        pa.array(number[long].astype(np.int32)),
                        *(pa.array(signed(x[long])) for x in (whole, before, after)),
                    ],
                    fields=list(_LONG),
                )
                longs = pa.ListArray.from_arrays(pa.array(long_edges.astype(np.int32)), values)
                each = np.unique(np.stack([owner.astype(U64), path], axis=1), axis=0)
                edges = np.searchsorted(each[:, 0], np.arange(piece.rows + 1).astype(U64))
                breaks = np.concatenate([[0], np.cumsum(piece.data == _NEWLINE)])
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c)[part] for c in _KEY),
                        pa.array(np.diff(breaks[piece.edges]) + 1),
                        list_array(signed(each[:, 1]), edges, pa.int64()),
                        longs,
                    ],
                    names=[*_KEY, "n_lines", "paths", "longs"],
                )

    return run


_LINE = pa.struct(
    [
        ("number", pa.int32()),
        ("path", pa.int64()),
        ("line", pa.int64()),
        ("tokens", pa.list_(pa.int64())),
    ]
)


def _shared_lines(depth: int):
    """The lines of each document whose path is among ``wanted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column("wanted")
            for piece in pieces(batch.column("text")):
                owner, number, edges, path, tokens, _ = _lines(piece, depth)
                part = slice(piece.first, piece.first + piece.rows)
                asked = np.unique(wanted[part].flatten().to_numpy(zero_copy_only=False))
                rows = [[] for _ in range(piece.rows)]
                for k in np.flatnonzero(np.isin(signed(path), asked)):
                    own = tokens[edges[k] : edges[k + 1]]
                    order = np.arange(1, len(own) + 1).astype(U64)
                    whole = mix(np.bitwise_xor.reduce(mix(own + order * VARIABLE)) + path[k : k + 1])
                    rows[owner[k]].append(
                        {
                            "number": int(number[k]),
                            "path": int(signed(path[k : k + 1])[0]),
                            "line": int(signed(whole)[0]),
                            "tokens": signed(own),
                        }
                    )
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c)[part] for c in _KEY),
                        pa.array(rows, pa.list_(_LINE)),
                    ],
                    names=[*_KEY, "lines"],
                )

    return run


def template_lines(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    min_constant: float = MIN_CONSTANT,
    depth: int = DEPTH,
    long_line: int = LONG_LINE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """``_id, _key, n_lines`` of each row, and ``_id, _key, dropped`` (line numbers) where some go.

    Repeated rows count as documents of their own for the support of a template, not for a long line,
    and share their dropped lines. A null text is one empty line; a null id is smaller than any other.
    """
    base = keyed(docs, id_col, text_col)
    sketch = materialize(
        base.mapInArrow(
            _paths(depth, long_line),
            "_id long, _key long, n_lines long, paths array<long>,"
            " longs array<struct<number:int,line:long,before:long,after:long>>",
        ),
        "line-paths",
    )
    paths = sketch.select(*_KEY, F.explode("paths").alias("path"))
    leaves = materialize(
        paths.groupBy("path").count().where(F.col("count") >= min_docs).select("path"), "leaves"
    )
    wanted = paths.join(leaves, "path").groupBy(*_KEY).agg(F.collect_set("path").alias("wanted"))
    found = base.join(wanted, _KEY).mapInArrow(
        _shared_lines(depth),
        "_id long, _key long,"
        " lines array<struct<number:int,path:long,line:long,tokens:array<long>>>",
    )
    rows = materialize(found.select(*_KEY, F.inline("lines")), "shared-lines")

    distinct = materialize(
        rows.groupBy("path", "line").agg(
            F.count("*").alias("n"), F.any_value("tokens").alias("tokens")
        ),
        "distinct-lines",
    )
    cells = distinct.select(
        "path", "line", "n", F.size("tokens").alias("size"), F.posexplode("tokens").alias("at", "token")
    )
    # tokens of the path and variable fields need no count
    open_cells = cells.where((F.col("at") >= depth) & (F.col("token") != F.lit(int(VARIABLE))))
    constants = materialize(
        open_cells.groupBy("path", "at", "token")
        .agg(F.sum("n").alias("support"))
        .where(F.col("support") >= min_docs)
        .select("path", "at", "token"),
        "line-constants",
    )
    fixed = (
        open_cells.join(constants, ["path", "at", "token"])
        .groupBy("path", "line")
        .agg(F.collect_list(F.struct("at", "token")).alias("constant"))
    )
    leading = F.size(
        F.filter(F.slice("tokens", 1, depth), lambda t: t != F.lit(int(VARIABLE)))
    )
    kept = F.when(F.col("constant").isNull(), F.array().cast("array<struct<at:int,token:long>>"))
    templates = (
        distinct.join(fixed, ["path", "line"], "left")
        .withColumn("constant", F.array_sort(F.coalesce("constant", kept)))
        .where((leading + F.size("constant")) >= F.size("tokens") * F.lit(min_constant))
        .select("line", F.xxhash64("path", "constant").alias("template"))
    )
    lines = rows.join(materialize(templates, "line-templates"), "line")
    support = (
        lines.groupBy("template", *_KEY)
        .agg(F.count("*").alias("n"))
        .groupBy("template")
        .agg(F.count("*").alias("docs"), F.min(F.struct(*_KEY)).alias("keeper"))
        .where(F.col("docs") >= min_docs)
    )
    recurring = materialize(support, "recurring-templates")
    copies = lines.join(recurring.select("template", "keeper"), "template")
    # smallest and largest differ where there are two of them, and combine before the shuffle
    longs = sketch.select(*_KEY, F.inline("longs"))
    me = F.struct(*_KEY)
    ends = [
        f(x).alias(f"{name}_{end}")
        for name, x in (("doc", me), ("before", F.col("before")), ("after", F.col("after")))
        for f, end in ((F.min, "low"), (F.max, "high"))
    ]
    repeated = materialize(
        longs.groupBy("line")
        .agg(*ends)
        .where("doc_low <> doc_high and before_low <> before_high and after_low <> after_high")
        .select("line", F.col("doc_low").alias("keeper")),
        "repeated-lines",
    )
    gone = copies.select(*_KEY, "number", "keeper").union(
        longs.join(repeated, "line").select(*_KEY, "number", "keeper")
    )
    dropped = (
        gone.where(F.struct(*_KEY) != F.col("keeper"))
        .groupBy(*_KEY)
        .agg(F.collect_set("number").alias("dropped"))
    )
    return sketch.select(*_KEY, "n_lines"), dropped


def without_lines(text: str, dropped) -> str:
    gone = set(dropped)
    return "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)


def _cut(texts: pd.Series, dropped: pd.Series) -> pd.Series:
    return pd.Series(
        [t if d is None or t is None else without_lines(t, d) for t, d in zip(texts, dropped)]
    )


def drop_template_lines(docs: DataFrame, **options) -> DataFrame:
    """``row``: every row of ``docs``, recurring lines gone from its text; and ``n_dropped``.

    All columns stay inside ``row``, whatever their names. A null text stays null.
    See ``template_lines`` for options.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    _, dropped = template_lines(docs, **options)
    dropped = materialize(dropped, "dropped-lines")
    joined = packed(docs, id_col, text_col).join(dropped, _KEY, "left")
    text = F.pandas_udf(_cut, "string")(F.col(f"row.{text_col}"), F.col("dropped"))
    return joined.select(
        F.col("row").withField(text_col, text).alias("row"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def op4_line_templates(spark, sf_dir: str) -> DataFrame:
    """``documents`` without the lines of recurring templates."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    lines = F.size(F.split("row.text", "\n")).cast("long")
    return drop_template_lines(docs).select(
        "row.doc_id", F.coalesce(lines, F.lit(0)).alias("n_kept"), "n_dropped", "row.text"
    )
