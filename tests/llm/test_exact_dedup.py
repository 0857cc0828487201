"""Word windows (op1) and byte strings (op10) against brute force."""

import hashlib
import random
from collections import Counter

import pytest

from holdfast.llm.substring_dedup import op1_substring_dedup, repeated_spans
from holdfast.llm.suffix_dedup import op10_suffix_dedup, repeated_byte_spans

ROWS = "doc_id long, text string, _id string, position string, h1 int, name string"


def table(spark, docs):
    """(id, text) pairs with extra columns whose names clash with internal ones."""
    return spark.createDataFrame([(d, t, "x", "y", 1, "z") for d, t in docs], ROWS)


def awkward(seed: int, words: int = 6) -> list[tuple]:
    """Random documents that share passages, and every kind of odd row."""
    rng = random.Random(seed)
    vocabulary = [chr(97 + i) * (1 + i % 3) for i in range(words)]
    passages = [" ".join(rng.choices(vocabulary, k=12)) for _ in range(4)]
    docs = []
    for i in range(30):
        parts = [" ".join(rng.choices(vocabulary, k=rng.randrange(0, 9)))]
        parts += rng.sample(passages, rng.randrange(0, 3))
        rng.shuffle(parts)
        docs.append((i, rng.choice([" ", "\n", " \t "]).join(parts)))
    docs += [(40, None), (41, ""), (42, " \n\t "), (43, "one"), (None, passages[0])]
    docs += [(44, passages[1]), (44, passages[1]), (45, docs[3][1]), (45, "other " + passages[2])]
    docs += [(46, "aa " * 40), (47, "é ü " * 12), (48, "x y " * 9)]
    rng.shuffle(docs)
    return docs


def removed(count: int, width: int, bad) -> list[bool]:
    gone = [False] * count
    for i in range(count - width + 1):
        if bad(i):
            gone[i : i + width] = [True] * width
    return gone


def spans_of(gone: list[bool]) -> list[tuple[int, int]]:
    out = []
    for i, g in enumerate(gone):
        if g and out and out[-1][1] == i:
            out[-1] = (out[-1][0], i + 1)
        elif g:
            out.append((i, i + 1))
    return out


def brute_words(docs, width):
    words = [(d, (t or "").encode().split()) for d, t in docs]
    first: dict = {}
    order = [(-1 if d is None else d, w) for d, w in words]
    for d, w in order:
        for i in range(len(w) - width + 1):
            key = tuple(w[i : i + width])
            first[key] = min(first.get(key, d), d)
    out = []
    for (d, w), (rank, _) in zip(words, order):
        gone = removed(len(w), width, lambda i: first[tuple(w[i : i + width])] < rank)
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), tuple(spans_of(gone)), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def brute_bytes(docs, width):
    texts = [(d, (t or "").encode()) for d, t in docs]
    seen = Counter(b[i : i + width] for _, b in texts for i in range(len(b) - width + 1))
    out = []
    for d, b in texts:
        gone = removed(len(b), width, lambda i: seen[b[i : i + width]] > 1)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), tuple(spans_of(gone)), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def found(rows, size):
    return Counter(
        (r.doc_id, r[size], tuple((s.start, s.end) for s in r.spans), r.kept_sha256) for r in rows
    )


@pytest.mark.parametrize(("seed", "width"), [(1, 5), (2, 4)])
def test_word_windows_equal_brute_force(spark, seed, width):
    docs = awkward(seed)
    got = found(repeated_spans(table(spark, docs), width).collect(), "n_words")
    assert got == brute_words(docs, width)


@pytest.mark.parametrize(("seed", "width"), [(3, 10), (4, 24)])
def test_byte_strings_equal_brute_force(spark, seed, width):
    docs = awkward(seed)
    got = found(repeated_byte_spans(table(spark, docs), width).collect(), "n_bytes")
    assert got == brute_bytes(docs, width)


@pytest.mark.parametrize("longest", [1, 3, 200, 399, 400, 401])
def test_short_texts_only(spark, longest):
    """Pieces that are shorter than a window, or just as long."""
    docs = [(i, "ab"[i % 2] * (longest - i)) for i in range(min(longest, 3))] + [(9, None)]
    got = found(repeated_byte_spans(table(spark, docs)).collect(), "n_bytes")
    assert got == brute_bytes(docs, 400)
    got = found(repeated_spans(table(spark, docs)).collect(), "n_words")
    assert got == brute_words(docs, 50)


def test_empty_tables(spark):
    assert repeated_spans(table(spark, [])).count() == 0
    assert repeated_byte_spans(table(spark, [])).count() == 0


def test_a_very_long_text(spark):
    rng = random.Random(9)
    long = " ".join(str(rng.randrange(10**6)) for _ in range(120_000))
    docs = [(1, long[200:5_000]), (2, long), (3, "short")]
    rows = {r.doc_id: r for r in repeated_spans(table(spark, docs)).collect()}
    assert rows[2].n_words == 120_000 and len(rows[2].spans) == 1 and not rows[1].spans
    rows = {r.doc_id: r for r in repeated_byte_spans(table(spark, docs)).collect()}
    assert [(s.start, s.end) for s in rows[2].spans] == [(200, 5_000)]
    assert [(s.start, s.end) for s in rows[1].spans] == [(0, 4_800)]


def test_registered_queries_equal_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    for query, brute, size, width in (
        (op1_substring_dedup, brute_words, "n_words", 50),
        (op10_suffix_dedup, brute_bytes, "n_bytes", 400),
    ):
        want = Counter(
            (d, n, sum(e - s for s, e in spans), len(spans), sha)
            for d, n, spans, sha in brute(docs, width)
        )
        rows = query(spark, sf).collect()
        got = Counter((r.doc_id, r[size], r.n_removed, r.n_spans, r.kept_sha256) for r in rows)
        assert got == want
