"""Line templates (op4), language (op7), decontamination (op8) and packing (op9)."""

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.llm import decontaminate as D
from holdfast.llm import language_id as N
from holdfast.llm import line_templates as L
from holdfast.llm import packing as P

ROWS = "doc_id long, text string, lang string, path string, row string, bucket int"


def table(spark, docs):
    return spark.createDataFrame([(*d, *[None] * (3 - len(d)), "p", "r", 1) for d in docs], ROWS)


# --- line templates ----------------------------------------------------------------------


def brute_long_lines(rows, size):
    """(row, line number) of long identical lines with other neighbours elsewhere; the first row keeps its own."""
    seen = defaultdict(list)
    for row in set(rows):
        lines = [(k, " ".join(words)) for k, x in enumerate(row[1].split("\n")) if (words := spaced(x))]
        for at, (number, said) in enumerate(lines):
            if len(said.split(" ")) < size:
                continue
            before = lines[at - 1][1] if at else ("edge", row)
            after = lines[at + 1][1] if at + 1 < len(lines) else ("edge", row)
            if len(lines) == 1:
                before = after = None
            seen[said].append((row, number, before, after))
    for found in seen.values():
        if all(len({x[k] for x in found}) > 1 for k in (0, 2, 3)):
            keeper = min(row for row, *_ in found)
            yield from ((row, number) for row, number, *_ in found if row != keeper)


def spaced(line):
    return [w for w in re.split("[\x20\x09-\x0d]+", line) if w]


def brute_templates(docs, min_docs, share, depth, long_line=10):
    """Line numbers that go, for each (id, text)."""
    rows = [(-1 if d is None else d, t or "") for d, t in docs]
    leaves = defaultdict(lambda: defaultdict(int))  # path -> tokens -> rows that have them
    holders = defaultdict(set)
    lines = []
    for n, (_, t) in enumerate(rows):
        for number, line in enumerate(t.split("\n")):
            tokens = tuple(
                "*" if any(48 <= c <= 57 for c in w) else w for w in line.encode().split()
            )
            if tokens:
                path = (len(tokens), tokens[:depth])
                lines.append((n, number, path, tokens))
                holders[path].add(n)
    for _, _, path, tokens in lines:
        leaves[path][tokens] += 1
    template = {}
    for path, found in leaves.items():
        if len(holders[path]) < min_docs:
            continue
        support = Counter()
        for tokens, n in found.items():
            for at, w in enumerate(tokens):
                support[at, w] += n
        for tokens in found:
            constant = tuple(
                (at, w)
                for at, w in enumerate(tokens)
                if at >= depth and w != "*" and support[at, w] >= min_docs
            )
            fixed = sum(w != "*" for w in tokens[:depth]) + len(constant)
            if fixed >= len(tokens) * share:
                template[path, tokens] = (path, constant)
    owners = defaultdict(set)
    for n, _, path, tokens in lines:
        if (path, tokens) in template:
            owners[template[path, tokens]].add(n)
    gone = defaultdict(set)
    for n, number, path, tokens in lines:
        t = template.get((path, tokens))
        if t and len(owners[t]) >= min_docs:
            keeper = min(rows[o][0] for o in owners[t])
            if rows[n][0] != keeper:
                gone[rows[n]].add(number)
    for row, number in brute_long_lines(rows, long_line):
        gone[row].add(number)
    return gone


def logs(seed):
    rng = random.Random(seed)
    users = ["ann", "bob", "cid", "dee", "eve"]
    docs = []
    for i in range(40):
        body = [
            f"user {rng.choice(users)} logged in from 10.0.0.{rng.randrange(9)}",
            "All rights reserved.",
            " ".join(rng.choices([f"word{c}" for c in "abcdefghij"], k=9)),
            "",
            f"job {i} done in {rng.random():.3f} seconds on host {rng.choice(users)}",
        ]
        rng.shuffle(body)
        docs.append((i, "\n".join(body[: rng.randrange(1, 6)])))
    docs += [(50, None), (51, ""), (52, "\n\n"), (None, "All rights reserved.\nnone"), (53, docs[0][1])]
    docs += [(54, "All rights reserved."), (54, "All rights reserved."), (55, "one\n" * 50_000)]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize(("min_docs", "share", "depth"), [(3, 0.6, 3), (8, 0.4, 2)])
def test_templates_equal_brute_force(spark, min_docs, share, depth):
    docs = logs(min_docs)
    options = {"min_docs": min_docs, "min_constant": share, "depth": depth}
    rows = L.drop_template_lines(table(spark, docs), **options).collect()
    gone = brute_templates(docs, min_docs, share, depth)
    want = Counter()
    for d, t in docs:
        dropped = gone.get((-1 if d is None else d, t or ""), set())
        kept = None if t is None else L.without_lines(t, dropped)
        want[d, kept, len(dropped)] += 1
    assert Counter((r.row.doc_id, r.row.text, r.n_dropped) for r in rows) == want
    assert sum(n for (_, _, n), c in want.items()) > 10
    assert rows[0].row.asDict().keys() == dict.fromkeys(table(spark, []).columns).keys()


def test_long_lines_count_from_the_second_document_but_not_in_copies(spark):
    rng = random.Random(11)
    line = lambda: " ".join(rng.choices([f"w{i}" for i in range(900)], k=12))
    notice, number = "call 555 1234 or 555 1235 " * 3, line()
    docs = [(1, "\n".join([line(), notice, line()])), (2, "\n".join([line(), line(), notice, line()]))]
    whole = [line() for _ in range(6)]
    docs += [(3, "\n".join(whole)), (4, "\n".join(whole))]  # a copy
    docs += [(5, "\n".join([*whole[:2], line(), *whole[3:]]))]  # a near copy
    docs += [(6, number), (7, number), (8, "\n".join([line(), number])), (9, "x\n" + whole[1] + "\ny")]
    docs += [(None, notice), (10, "short line\n" + line()), (11, "a\nshort line")]
    options = {"min_docs": 10, "min_constant": 0.6, "depth": 3}
    rows = L.drop_template_lines(table(spark, docs), **options).collect()
    gone = brute_templates(docs, 10, 0.6, 3)
    found = {(r.row.doc_id, r.row.text, r.n_dropped) for r in rows}
    assert found == {(d, L.without_lines(t, gone[-1 if d is None else d, t]), len(gone[-1 if d is None else d, t])) for d, t in docs}
    dropped = {r.row.doc_id: r.n_dropped for r in rows}
    assert dropped[2] == dropped[9] == 1 and dropped[3] == 0
    assert dropped[4] == dropped[5] == 1  # only the line that stands elsewhere, in document 9


def test_no_documents_have_no_templates(spark):
    assert L.drop_template_lines(table(spark, [])).count() == 0


def test_line_query_equals_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    gone = brute_templates(docs, L.MIN_DOCS, L.MIN_CONSTANT, L.DEPTH)
    want = {(d, L.without_lines(t, gone.get((d, t), ()))) for d, t in docs}
    assert {(r.doc_id, r.text) for r in L.op4_line_templates(spark, sf).collect()} == want


# --- language ----------------------------------------------------------------------------

SAYS = {
    "aa": ["laka", "muka", "tala", "kuma"],
    "bb": ["striph", "thwest", "ngrolf", "schwip"],
    "cc": ["éàè", "ôçü", "àéôç", "üèà"],
}


def spoken(rng, lang, n):
    return " ".join(rng.choices(SAYS[lang], k=n))


def test_languages_are_learned_and_odd_rows_defined(spark):
    rng = random.Random(3)
    rows = [(i, spoken(rng, lang, 1 + i % 20), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 40)]
    odd = [(900, None, "aa"), (901, "", "bb"), (902, "12 34 !?", "aa"), (903, "laka", None), (None, "éàè", "cc")]
    docs = table(spark, [*rows, *odd, (904, "striph " * 100_000, None)])
    model = N.train(docs)
    assert model.languages == ["aa", "bb", "cc"]
    found = docs.select("doc_id", "lang", N.language_of(model, spark)(F.col("text")).alias("f")).collect()
    got = {r.doc_id: r.f for r in found}
    assert all(got[i].lang_pred == lang for i, _, lang in rows)
    assert all(0 < got[i].score <= 1 for i, _, _ in rows)
    for i in (900, 901, 902):
        assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
    assert (got[903].lang_pred, got[904].lang_pred, got[None].lang_pred) == ("aa", "bb", "cc")
    kept = N.confident(docs, model)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 3


def test_counts_equal_brute_force(spark):
    rng = random.Random(6)
    rows = [(i, spoken(rng, lang, 5), lang) for i, lang in enumerate(["aa", "bb"] * 30)]
    model = N.train(table(spark, rows))
    counts = np.zeros((2, 1 << N.BUCKET_BITS))
    for _, text, lang in rows:
        for found, _ in N.buckets([text]):
            np.add.at(counts[int(lang == "bb")], found, 1)
    smooth = counts + N.SMOOTHING
    want = np.log(smooth / smooth.sum(axis=1, keepdims=True))
    assert np.allclose(model.weights, want, atol=1e-5) and np.allclose(model.prior, np.log(0.5))


def test_ngrams_stay_inside_their_text():
    both = [sorted(zip(f[r == 1], r[r == 1])) for f, r in N.buckets(["abc", "xyz q"])]
    alone = [sorted(zip(f, r + 1)) for f, r in N.buckets(["xyz q"])]
    assert both == alone


def test_nothing_to_learn_from(spark):
    docs = table(spark, [(1, "laka", None)])
    model = N.train(docs)
    assert model.languages == []
    found = docs.select(N.language_of(model, spark)(F.col("text")).alias("f")).first().f
    assert (found.lang_pred, found.score) == ("und", 0.0)


def test_held_out_accuracy(spark, sf):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = N.op7_language_id(spark, sf).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and len(held) > 40
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.95


def plain_buckets(text):
    """Buckets of all n-grams of one text, one character at a time."""
    folded = []
    for c in text.lower():
        c = " " if ord(c) < 128 and not c.isalpha() else c
        if c != " " or folded[-1:] != [" "]:
            folded.append(c)
    word = (1 << 64) - 1
    for order in N.ORDERS:
        for at in range(len(folded) - order + 1):
            mixed = order
            for k in range(order):
                mixed += ord(folded[at + k]) * pow(0x9E3779B97F4A7C15, k + 1, 1 << 64)
            mixed &= word
            mixed = (mixed ^ mixed >> 31) * 0xBF58476D1CE4E5B9 & word
            yield mixed >> 64 - N.BUCKET_BITS


def test_language_query_equals_plain_bayes(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect()
    counts, docs = defaultdict(Counter), Counter()
    for r in rows:
        if zlib.crc32(str(r.doc_id).encode()) % 3 != 1 and r.lang is not None:
            docs[r.lang] += 1
            counts[r.lang].update(plain_buckets(r.text or ""))
    names, size = sorted(docs), 1 << N.BUCKET_BITS
    totals = {x: sum(counts[x].values()) + N.SMOOTHING * size for x in names}
    found = {r.doc_id: r for r in N.op7_language_id(spark, sf).collect()}
    assert len(found) == len(rows)
    for r in rows:
        grams = Counter(plain_buckets(r.text or ""))
        odds = {
            x: math.log(docs[x] / sum(docs.values()))
            + sum(n * math.log((counts[x][b] + N.SMOOTHING) / totals[x]) for b, n in grams.items())
            for x in names
        }
        got, best = found[r.doc_id], max(odds.values())
        assert got.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        if not any(c.isalpha() for c in r.text or ""):
            assert (got.lang_pred, got.score) == ("und", 0.0)
            continue
        assert best - odds[got.lang_pred] < 0.01
        want = 1 / sum(math.exp(x - odds[got.lang_pred]) for x in odds.values())
        assert abs(got.score - want) < 1e-3


def test_too_many_labels_are_refused_before_they_are_collected(spark, monkeypatch):
    monkeypatch.setattr(N, "MODEL_BYTES", 3 << (N.BUCKET_BITS + 2))
    docs = table(spark, [(i, "laka muka", f"l{i}") for i in range(4)])
    with pytest.raises(ValueError, match="more than 3 languages"):
        N.train(docs)
    assert len(N.train(docs.where("doc_id < 3")).languages) == 3


# --- decontamination ---------------------------------------------------------------------


def edit_distance_inside(item: str, text: str) -> int:
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        last, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(last[j - 1] + (a != b), last[j] + 1, row[-1] + 1))
    return min(row)


def test_edited_items_are_found_as_brute_force_says(spark):
    rng = random.Random(12)
    letters = "abcdefghij klmno"
    items = [(i, "".join(rng.choices(letters, k=rng.randrange(60, 180)))) for i in range(6)]
    items += [(50, "short one"), (51, " "), (52, None), (None, "no id here"), (0, items[0][1])]
    docs = []
    for n in range(40):
        i, item = items[rng.randrange(6)]
        own = list(item)
        for _ in range(rng.randrange(0, 9)):
            at = rng.randrange(len(own))
            kind = rng.randrange(3)
            if kind == 0:
                own[at] = rng.choice(letters)
            elif kind == 1:
                own.insert(at, rng.choice(letters))
            else:
                del own[at]
        around = ["".join(rng.choices(letters, k=rng.randrange(0, 80))) for _ in range(2)]
        if n % 5 == 0:
            own = own[: len(own) * 2 // 3]
        docs.append((n, around[0] + "".join(own).upper() + around[1]))
    docs += [(95, "there is no id here at all")]
    docs += [(90, None), (91, ""), (92, "a SHORT  \n one b"), (None, items[1][1]), (93, items[2][1]), (93, items[2][1])]
    docs += [(94, "z" * 400_000 + items[3][1])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = D.contaminated(table(spark, docs), benchmark).collect()
    got = {(None if r["_id"] == -(1 << 63) else r["_id"], r.item_id): (r.part, r.edits) for r in found}
    want = {}
    for d, t in docs[:-1]:
        for i, item in items:
            for share, part in D.halves(D.codes(D.normalise(item or ""))):
                text = part.tobytes().decode("utf-32-le")
                if not text:
                    continue
                edits = edit_distance_inside(text, D.normalise(t or ""))
                if edits <= D.budget(len(text)):
                    key = (d, i)
                    want[key] = max(want.get(key, (0, 0)), (share, -edits))
    want = {k: (share, -edits) for k, (share, edits) in want.items()}
    assert {k: v for k, v in got.items() if k[0] != 94} == want
    assert got[94, 3] == (1.0, 0)
    assert {share for share, _ in want.values()} == {0.5, 1.0}
    assert any(i is None for _, i in want)


def test_items_come_in_blocks(spark):
    items = spark.createDataFrame([(i, "x" * 30) for i in (0, 1, 2, 3, 4)], "item_id long, text string")
    blocks = list(D.item_blocks(items, size=70))
    assert [b[0] for b in blocks] == [[0, 1], [2, 3], [4]]
    assert D.contaminated(table(spark, [(1, "a")]), items.limit(0)).count() == 0
    assert D.contaminated(table(spark, []), items).count() == 0


def test_query_finds_every_planted_item(spark, sf):
    docs = [(r.doc_id, D.normalise(r.text or "")) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, D.normalise(r.text)) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    planted = {(d, i) for d, t in docs for i, x in items if x in t}
    rows = D.op8_decontamination(spark, sf).collect()
    assert planted and {(r.doc_id, r.item_id) for r in rows if (r.part, r.edits) == (1, 0)} == planted
    texts, wanted = dict(docs), dict(items)
    for r in rows:
        parts = [p.tobytes().decode("utf-32-le") for s, p in D.halves(D.codes(wanted[r.item_id])) if s == r.part]
        if r.edits:
            assert min(edit_distance_inside(p, texts[r.doc_id]) for p in parts) == r.edits
        else:
            assert any(p in texts[r.doc_id] for p in parts)


# --- packing -----------------------------------------------------------------------------


def padding(lengths, bounds):
    return sum(min(b for b in bounds if b >= n) - n for n in lengths)


@pytest.mark.parametrize("seed", range(6))
def test_bounds_are_optimal(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([rng.randrange(0, 12), rng.randrange(0, 400)]) for _ in range(40)]
    histogram = sorted(Counter(lengths).items())
    values = [v for v, _ in histogram][:14]
    lengths = [n for n in lengths if n in values]
    counts = [c for v, c in histogram if v in values]
    totals = [v * c for v, c in histogram if v in values]
    for buckets in (1, 2, 3, 4):
        bounds = P.best_bounds(values, counts, totals, buckets)
        best = min(
            padding(lengths, [*rest, values[-1]])
            for k in range(buckets)
            for rest in itertools.combinations(values[:-1], k)
        )
        assert len(bounds) <= buckets and padding(lengths, bounds) == best


def test_cells_are_bounded_and_ordered(spark):
    lengths = spark.range(0, 3_000_000, 37).withColumn("cell", P.cell_of(F.col("id")))
    low = lengths.groupBy("cell").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    rows = low.orderBy("cell").collect()
    assert len(rows) < 8_000
    assert all(a.high < b.low for a, b in zip(rows, rows[1:]))
    assert all(r.high - r.low <= max(r.low, 1) / 256 for r in rows if r.low >= P.EXACT)
    exact = spark.range(P.EXACT).select((P.cell_of(F.col("id")) == F.col("id")).alias("same"))
    assert exact.where("NOT same").count() == 0


def test_batches_respect_the_budget(spark):
    rng = random.Random(1)
    docs = [(i, "w " * rng.randrange(0, 60)) for i in range(300)]
    docs += [(400, None), (401, ""), (402, "w " * 5_000), (None, "a b"), (403, "t"), (403, "t")]
    rows = P.pack(table(spark, docs), buckets=5, token_budget=200).collect()
    sizes = Counter((d, len((t or "").split())) for d, t in docs)
    assert Counter((r.doc_id, r.n_tokens) for r in rows) == sizes
    bounds = sorted({r.bucket for r in rows})
    lengths = [r.n_tokens for r in rows]
    assert all(r.bucket == min(b for b in bounds if b >= r.n_tokens) for r in rows)
    histogram = sorted(Counter(lengths).items())
    want = P.best_bounds([v for v, _ in histogram], [c for _, c in histogram], [v * c for v, c in histogram], 5)
    assert padding(lengths, bounds) == padding(lengths, want)
    batches = defaultdict(list)
    for r in rows:
        batches[r.bucket, r.batch].append(r.slot)
    for (bucket, _), slots in batches.items():
        assert sorted(slots) == list(range(len(slots)))
        assert len(slots) == 1 or len(slots) * bucket <= 200
    for bucket in bounds:
        full = max(200 // max(bucket, 1), 1)
        own = sorted(b for k, b in batches if k == bucket)
        assert own == list(range(len(own)))
        assert all(len(batches[bucket, b]) == full for b in own[:-1])


def test_nothing_to_pack(spark):
    assert P.pack(table(spark, [])).count() == 0


def test_packing_query_covers_every_document(spark, sf):
    docs = [(r.doc_id, len((r.text or "").split())) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = P.op9_packing(spark, sf).collect()
    assert len(rows) == len(docs)
    histogram = sorted(Counter(r.n_tokens for r in rows).items())
    want = P.best_bounds([v for v, _ in histogram], [c for _, c in histogram], [v * c for v, c in histogram], P.BUCKETS)
    lengths = [r.n_tokens for r in rows]
    assert padding(lengths, {r.bucket for r in rows}) <= 1.01 * padding(lengths, want)
