"""Quality rules as a short-circuit cascade: what one rule rejects, no later rule looks at.

Every rule is a condition on counts of one text, so the verdict, all rules passed, does not
depend on their order; only the time does. Each task runs all rules on a sample, the first
``SAMPLE_ROWS`` of its rows, takes each rule's time and the rows it rejects, and orders the rules by rejected
rows per time among the rows still alive. The order thus fits the data at hand (a hot source may
fail another rule than the rest), needs no pass of its own and no driver, and a task that is
repeated elsewhere gives the same rows, whatever order it finds.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.rows import keyed, named_id
from holdfast.llm.text import (
    BYTE_POWERS,
    U64,
    WORD_POWERS,
    Piece,
    mix,
    pieces,
    prefix,
    span_hash,
    window_hash,
)

#: Rows of each task on which rules are timed; it steers their order only.
SAMPLE_ROWS = 256
WINDOW_WORDS = 8


def _bytes(characters: str) -> np.ndarray:
    found = np.zeros(256, dtype=bool)
    found[list(characters.encode())] = True
    return found


SYMBOLS = _bytes("#*$%&|<>")
BULLETS = _bytes("-*")
#: ASCII letters, and every byte of a character beyond ASCII.
LETTERS = _bytes("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") | (np.arange(256) > 127)


class Texts:
    """Counts of some texts, each worked out when a rule first asks for it."""

    def __init__(self, piece: Piece):
        self.piece = piece
        self._known: dict[str, object] = {}

    def _once(self, name: str, make: Callable):
        if name not in self._known:
            self._known[name] = make()
        return self._known[name]

    def only(self, alive: np.ndarray) -> Texts:
        """The rows that are alive; nothing of the others is kept or looked at again."""
        if alive.all():
            return self
        sizes = np.diff(self.piece.edges)
        edges = np.concatenate([[0], np.cumsum(sizes[alive])])
        part = Texts(Piece(0, self.piece.data[np.repeat(alive, sizes)], edges))
        if "words" in self._known:
            starts, ends, first = self.words
            counts = np.diff(first)
            keep = np.repeat(alive, counts)
            shift = np.repeat((self.piece.edges[:-1][alive] - edges[:-1]), counts[alive])
            part._known["words"] = (
                starts[keep] - shift,
                ends[keep] - shift,
                np.concatenate([[0], np.cumsum(counts[alive])]),
            )
            if "word_hashes" in self._known:
                part._known["word_hashes"] = self.word_hashes[keep]
        return part

    def _per_row(self, marked: np.ndarray, edges: np.ndarray) -> np.ndarray:
        return np.diff(np.searchsorted(np.flatnonzero(marked), edges))

    @property
    def words(self):
        return self._once("words", self.piece.words)

    @property
    def word_hashes(self) -> np.ndarray:
        return self._once("word_hashes", lambda: self.piece.word_hashes(*self.words[:2]))

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.words[2])

    @property
    def word_chars(self) -> np.ndarray:
        """Code points in words."""
        starts, ends, first = self.words
        heads = np.flatnonzero((self.piece.data & 0xC0) != 0x80)
        inside = np.searchsorted(heads, ends) - np.searchsorted(heads, starts)
        return np.diff(np.concatenate([[0], np.cumsum(inside)])[first])

    @property
    def n_symbols(self) -> np.ndarray:
        return self._per_row(SYMBOLS[self.piece.data], self.piece.edges)

    @property
    def lines(self):
        """Start, end, row, first and last word of each line that has a word."""

        def make():
            data, edges = self.piece.data, self.piece.edges
            breaks = np.flatnonzero(data == 10)
            starts = np.sort(np.concatenate([edges[:-1], breaks + 1]))
            ends = np.sort(np.concatenate([breaks, edges[1:]]))
            row = np.repeat(np.arange(len(edges) - 1), self._per_row(data == 10, edges) + 1)
            word_starts = self.words[0]
            head = np.searchsorted(word_starts, starts)
            tail = np.searchsorted(word_starts, ends) - 1
            full = head <= tail
            return starts[full], ends[full], row[full], head[full], tail[full]

        return self._once("lines", make)

    def _of_rows(self, rows: np.ndarray) -> np.ndarray:
        return np.bincount(rows, minlength=self.piece.rows)

    @property
    def n_lines(self) -> np.ndarray:
        return self._of_rows(self.lines[2])

    @property
    def n_dup_lines(self) -> np.ndarray:
        """Lines equal to an earlier one."""
        starts, ends, row, _, _ = self.lines
        sums = prefix(self.piece.data.astype(U64), BYTE_POWERS)
        size = (ends - starts).astype(U64)
        said = mix(span_hash(sums, starts, ends, BYTE_POWERS) + size * U64(0x9E3779B97F4A7C15))
        _, first = np.unique(mix(said + row.astype(U64)), return_index=True)
        return self._of_rows(row) - self._of_rows(row[first])

    @property
    def n_repeat_words(self) -> np.ndarray:
        """Words in windows that the text holds twice or more."""
        first = self.words[2]
        total = int(first[-1])
        hashes = window_hash(prefix(self.word_hashes, WORD_POWERS[0]), WINDOW_WORDS, WORD_POWERS[0])
        row = np.repeat(np.arange(self.piece.rows), np.diff(first))
        if not len(hashes):
            return np.zeros(self.piece.rows, dtype=np.int64)
        at = np.flatnonzero(row[: len(hashes)] == row[WINDOW_WORDS - 1 :])
        key = mix(mix(hashes[at]) + row[at].astype(U64))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        again = np.zeros(len(at), dtype=bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        change = np.zeros(total + 1, dtype=np.int64)
        change[at[again]] += 1
        change[at[again] + WINDOW_WORDS] -= 1
        covered = np.concatenate([[0], np.cumsum(np.cumsum(change[:total]) > 0)])
        return np.diff(covered[first])

    @property
    def n_letter_words(self) -> np.ndarray:
        starts, ends, first = self.words
        letters = np.flatnonzero(LETTERS[self.piece.data])
        has = np.searchsorted(letters, starts) < np.searchsorted(letters, ends)
        return np.diff(np.concatenate([[0], np.cumsum(has)])[first])

    @property
    def n_bullet_lines(self) -> np.ndarray:
        """Lines whose first word begins with a dash or an asterisk."""
        _, _, row, head, _ = self.lines
        return self._of_rows(row[BULLETS[self.piece.data[self.words[0][head]]]])

    @property
    def n_ellipsis_lines(self) -> np.ndarray:
        """Lines whose last word ends in three dots."""
        _, _, row, _, tail = self.lines
        starts, ends = self.words[0][tail], self.words[1][tail]
        dots = np.flatnonzero(self.piece.data == 46)
        run = np.searchsorted(dots, ends) - np.searchsorted(dots, np.maximum(starts, ends - 3))
        return self._of_rows(row[run == 3])

    @property
    def n_common_word(self) -> np.ndarray:
        """How often the most frequent word stands in the text."""
        first = self.words[2]
        row = np.repeat(np.arange(self.piece.rows), np.diff(first))
        _, at, times = np.unique(
            mix(self.word_hashes + row.astype(U64)), return_index=True, return_counts=True
        )
        most = np.zeros(self.piece.rows, dtype=np.int64)
        np.maximum.at(most, row[at], times)
        return most


@dataclass(frozen=True)
class Rule:
    """``rejects`` gives True for each text that fails."""

    name: str
    rejects: Callable[[Texts], np.ndarray]


#: What every text is judged by first.
BASE_RULES = (
    Rule("few_words", lambda t: t.n_words < 20),
    Rule("repeated_windows", lambda t: 100 * t.n_repeat_words > 30 * t.n_words),
)
#: All in whole numbers, so that any engine gives the same verdict.
RULES = (
    Rule("short_words", lambda t: t.word_chars < 2 * t.n_words),
    Rule("long_words", lambda t: t.word_chars > 15 * t.n_words),
    Rule("symbols", lambda t: 10 * t.n_symbols > 3 * t.n_words),
    Rule("repeated_lines", lambda t: 10 * t.n_dup_lines > 3 * t.n_lines),
    Rule("words_without_letter", lambda t: 10 * t.n_letter_words < 6 * t.n_words),
    Rule("bullets", lambda t: 10 * t.n_bullet_lines > 9 * t.n_lines),
    Rule("ellipses", lambda t: 10 * t.n_ellipsis_lines > 3 * t.n_lines),
    Rule("one_word", lambda t: 10 * t.n_common_word > 4 * t.n_words),
)
BASE_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def greedy_order(rejected: np.ndarray, cost: np.ndarray) -> list[int]:
    """Rules by rejection per cost: ``rejected`` is rows x rules on a sample, ``cost`` per rule.

    After each choice the gain of the others is counted among the rows that are left, so a
    rule whose rejects another one takes already moves back. Rules that reject nothing follow, the cheapest first.
    """
    alive = np.ones(len(rejected), dtype=bool)
    left, order = list(range(len(cost))), []
    price = np.maximum(np.asarray(cost, dtype=float), 1e-12)
    while left:
        gain = rejected[alive][:, left].sum(axis=0)
        best = left[int(np.lexsort((price[left], -gain / price[left]))[0])]
        order.append(best)
        left.remove(best)
        alive &= ~rejected[:, best]
    return order


class Cascade:
    """Runs the rules on texts; the first ``SAMPLE_ROWS`` rows it sees are the sample."""

    def __init__(self, rules: tuple[Rule, ...], sample_rows: int = SAMPLE_ROWS):
        self.rules, self.wanted = rules, sample_rows
        self.order = list(range(len(rules)))
        self.cost = np.zeros(len(rules))
        self.seen = np.zeros((0, len(rules)), dtype=bool)

    def _learn(self, texts: Texts) -> np.ndarray:
        """Passes of the sample: every rule on every row, timed."""
        found = []
        for k, rule in enumerate(self.rules):
            began = time.thread_time_ns()
            found.append(rule.rejects(texts))
            self.cost[k] += time.thread_time_ns() - began
        rejected = np.stack(found, axis=1) if found else np.zeros((texts.piece.rows, 0), dtype=bool)
        self.seen = np.concatenate([self.seen, rejected])
        self.order = greedy_order(self.seen, self.cost)
        return ~rejected.any(axis=1)

    def passes(self, texts: Texts) -> np.ndarray:
        if len(self.seen) < self.wanted:
            return self._learn(texts)
        out = np.zeros(texts.piece.rows, dtype=bool)
        kept = np.arange(texts.piece.rows)
        for k in self.order:
            if not len(kept):
                break
            alive = ~self.rules[k].rejects(texts)
            kept, texts = kept[alive], texts.only(alive)
        out[kept] = True
        return out


def _judged(base: tuple[Rule, ...], rules: tuple[Rule, ...], sample_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cascade = Cascade(rules, sample_rows)
        for batch in batches:
            for piece in pieces(batch.column("text")):
                texts = Texts(piece)
                counts = {name: getattr(texts, name) for name in BASE_COLUMNS}
                failed = np.zeros(piece.rows, dtype=bool)
                for rule in base:
                    failed |= rule.rejects(texts)
                kept = ~failed
                kept[kept] = cascade.passes(texts.only(~failed))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_id")[piece.first : piece.first + piece.rows],
                        *(pa.array(counts[name], pa.int64()) for name in BASE_COLUMNS),
                        pa.array(failed),
                        pa.array(kept),
                    ],
                    names=["_id", *BASE_COLUMNS, "base_failed", "kept"],
                )

    return run


def judged(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    base: tuple[Rule, ...] = BASE_RULES,
    sample_rows: int = SAMPLE_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: id, the base counts, ``base_failed`` and ``kept``.

    The base counts are of every whole text; ``rules`` run as a cascade on texts that pass all of
    ``base``. A null or empty text has no words and fails; null ids stay null; repeated rows give
    repeated rows; other columns are ignored; an empty table gives an empty one. One narrow pass
    without a shuffle. Texts are worked on in pieces of a megabyte, a longer text as a whole: a task's
    memory is some 60 bytes per byte of its longest text.
    """
    return (
        keyed(docs, id_col, text_col)
        .select("_id", "text")
        .mapInArrow(
            _judged(tuple(base), tuple(rules), sample_rows),
            "_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long,"
            " n_repeat_words long, base_failed boolean, kept boolean",
        )
        .select(named_id(id_col), *BASE_COLUMNS, "base_failed", "kept")
    )


def filtered(
    docs: DataFrame,
    rules: tuple[Rule, ...] = BASE_RULES + RULES,
    sample_rows: int = SAMPLE_ROWS,
    text_col: str = "text",
) -> DataFrame:
    """The rows whose text passes all rules, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cascade = Cascade(tuple(rules), sample_rows)
        at = None
        for batch in batches:
            at = names.index(text_col) if at is None else at
            kept = [cascade.passes(Texts(piece)) for piece in pieces(batch.column(at))]
            if kept:
                yield batch.filter(pa.array(np.concatenate(kept)))

    names = docs.columns
    return docs.mapInArrow(run, docs.schema)


def rule_statistics(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    sample_rows: int = SAMPLE_ROWS,
    text_col: str = "text",
) -> DataFrame:
    """What the samples say of each rule: rows looked at, rows rejected, seconds, place in the order.

    ``rank_sum`` over ``tasks`` is the mean place that tasks give the rule, 0 first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cascade = Cascade(tuple(rules), sample_rows)
        for batch in batches:
            for piece in pieces(batch.column("text")):
                if len(cascade.seen) < sample_rows:
                    cascade.passes(Texts(piece))
        if len(cascade.seen):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([rule.name for rule in rules]),
                    pa.array([len(cascade.seen)] * len(rules), pa.int64()),
                    pa.array(cascade.seen.sum(axis=0), pa.int64()),
                    pa.array(cascade.cost / 1e9, pa.float64()),
                    pa.array(np.argsort(cascade.order), pa.int64()),
                ],
                names=["rule", "rows", "rejected", "seconds", "place"],
            )

    parts = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "rule string, rows long, rejected long, seconds double, place long"
    )
    return parts.groupBy("rule").agg(
        F.sum("rows").alias("rows"),
        F.sum("rejected").alias("rejected"),
        F.sum("seconds").alias("seconds"),
        F.sum("place").alias("rank_sum"),
        F.count("*").alias("tasks"),
    )


def op11_quality_cascade(spark, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every whole text of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return judged(docs)
