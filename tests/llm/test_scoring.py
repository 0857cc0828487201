"""Quality cascade (op11), filter audit (op12) and whitening (op13)."""

import itertools
import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from holdfast.llm import filter_audit as A
from holdfast.llm import quality_cascade as Q
from holdfast.llm import whitening as W
from holdfast.llm.text import pieces

SPACES = " \t\n\x0b\x0c\r"


def split(text):
    return "".join(" " if c in SPACES else c for c in text).split(" ")


def words(text):
    return [w for w in split(text or "") if w]


# --- quality cascade ---------------------------------------------------------------------


def brute_counts(text):
    text, w = text or "", words(text)
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    repeated = {
        p for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for p in range(i, i + 8)
    }
    lines = [x for x in text.split("\n") if words(x)]
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(repeated),
        "n_lines": len(lines),
        "n_letter": sum(any(c.isascii() and c.isalpha() or ord(c) > 127 for c in x) for x in w),
        "n_bullets": sum(words(x)[0][0] in "-*" for x in lines),
        "n_ellipses": sum(words(x)[-1].endswith("...") for x in lines),
        "n_common": max(Counter(w).values(), default=0),
    }


def brute_verdict(c):
    failed = c["n_words"] < 20 or 100 * c["n_repeat_words"] > 30 * c["n_words"]
    bad = (
        c["word_chars"] < 2 * c["n_words"]
        or c["word_chars"] > 15 * c["n_words"]
        or 10 * c["n_symbols"] > 3 * c["n_words"]
        or 10 * c["n_dup_lines"] > 3 * c["n_lines"]
        or 10 * c["n_letter"] < 6 * c["n_words"]
        or 10 * c["n_bullets"] > 9 * c["n_lines"]
        or 10 * c["n_ellipses"] > 3 * c["n_lines"]
        or 10 * c["n_common"] > 4 * c["n_words"]
    )
    return failed, not (failed or bad)


def odd_texts(count=600, seed=3):
    rng = random.Random(seed)
    alphabet = ["the", "of", "añb", "x", "1234", "- ", "end...", "##", "a" * 40, "\n", "\n", "\t", "\r", "-", "日本"]
    plain = [f"w{i}" for i in range(400)]
    out = [None, "", " \n\t", "one", "a\n\na\n", "...\n", "a b c d e f g h " * 4]
    for _ in range(count):
        marks = rng.choice(["{}", "{}", "{}#", "{}...", "- {}", "{0}{0}{0}{0}{0}{0}", "{}\nsame\n"])
        fresh = [marks.format(w) if rng.random() < 0.9 else w for w in plain]
        if rng.random() < 0.1:
            fresh = [w.replace("w", "") for w in fresh]
        pool = rng.sample(alphabet, rng.randint(1, 6)) + rng.sample(fresh, rng.randint(0, 300))
        text = "".join(rng.choice(pool) + rng.choice([" ", " ", "  ", "\n"]) for _ in range(rng.randint(0, 120)))
        out += [text, text] if rng.random() < 0.1 else [text]
    return out


@pytest.mark.parametrize("sample_rows", [0, 50, 10**6])
def test_verdicts_equal_brute_force_whatever_the_sample(spark, sample_rows):
    texts = odd_texts()
    rows = [(n if n % 50 else None, t, n, "x") for n, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, kept string")
    found = Q.judged(docs.repartition(3), sample_rows=sample_rows).collect()
    want = Counter()
    for n, text, _, _ in rows:
        c = brute_counts(text)
        want[(n, *(c[k] for k in Q.BASE_COLUMNS), *brute_verdict(c))] += 1
    assert Counter(map(tuple, found)) == want
    assert {False, True} == {r.kept for r in found if not r.base_failed}


def test_cascade_skips_what_is_rejected(spark):
    looked = Counter()

    def rule(name, keeps):
        def rejects(texts):
            looked[name] += texts.piece.rows
            return np.array([not keeps(texts.piece.text(r)) for r in range(texts.piece.rows)])

        return Q.Rule(name, rejects)

    rules = (rule("seldom", lambda t: t != b"z"), rule("often", lambda t: t.startswith(b"k")))
    cascade = Q.Cascade(rules, sample_rows=0)
    cascade.order = [1, 0]
    column = pa.array(["k", "a", "", "z", "k" * 9, "b"])
    piece = next(pieces(column))
    assert cascade.passes(Q.Texts(piece)).tolist() == [True, False, False, False, True, False]
    assert looked == {"often": 6, "seldom": 2}


def test_order_is_rejection_per_cost_among_those_left():
    rejected = np.zeros((10, 4), dtype=bool)
    rejected[:6, 0] = True
    rejected[:5, 1] = True  # all of them are rejected by rule 0 already
    rejected[8:, 2] = True
    assert Q.greedy_order(rejected, np.array([1.0, 1.0, 1.0, 0.1])) == [0, 2, 3, 1]
    assert Q.greedy_order(rejected, np.array([9.0, 1.0, 1.0, 1.0])) == [1, 2, 0, 3]
    assert Q.greedy_order(np.zeros((0, 2), dtype=bool), np.array([2.0, 1.0])) == [1, 0]


def test_counts_of_a_subset_are_those_of_its_rows():
    texts = [t or "" for t in odd_texts(80, 9)]
    whole = Q.Texts(next(pieces(pa.array(texts))))
    names = [*Q.BASE_COLUMNS, "n_lines", "n_letter_words", "n_bullet_lines", "n_ellipsis_lines", "n_common_word"]
    full = {name: getattr(whole, name) for name in names}
    rng = np.random.default_rng(1)
    alive = rng.random(len(texts)) < 0.4
    part = whole.only(alive)
    for name in names:
        assert (getattr(part, name) == full[name][alive]).all(), name
    none = whole.only(np.zeros(len(texts), dtype=bool))
    assert all(len(getattr(none, name)) == 0 for name in names)


def test_quality_of_empty_tables_and_one_very_long_text(spark):
    schema = "doc_id long, text string"
    assert Q.judged(spark.createDataFrame([], schema)).collect() == []
    text = " ".join(f"word{i}" for i in range(300_000))
    row = Q.judged(spark.createDataFrame([(1, text), (2, text + " " + text)], schema)).orderBy("doc_id").collect()
    assert (row[0].n_words, row[0].n_repeat_words, row[0].kept) == (300_000, 0, True)
    assert (row[1].n_words, row[1].n_repeat_words, row[1].base_failed) == (600_000, 600_000, True)


def test_filtered_keeps_whole_rows_and_statistics_count_samples(spark):
    rows = [(n, t, n * 2) for n, t in enumerate(odd_texts(200, 5))]
    docs = spark.createDataFrame(rows, "row int, text string, kept int").repartition(3)
    kept = [r for r in rows if brute_verdict(brute_counts(r[1]))[1]]
    assert sorted(map(tuple, Q.filtered(docs).collect())) == kept
    stats = {r.rule: r for r in Q.rule_statistics(docs, Q.BASE_RULES, 10**6).collect()}
    counts = [brute_counts(t) for _, t, _ in rows]
    assert stats["few_words"].rows == len(rows) and stats["few_words"].tasks == 3
    assert stats["few_words"].rejected == sum(c["n_words"] < 20 for c in counts)
    assert stats["repeated_windows"].rejected == sum(
        100 * c["n_repeat_words"] > 30 * c["n_words"] for c in counts
    )


# --- filter audit ------------------------------------------------------------------------


def brute_audit(docs, labels):
    """(part, order, step) to the seven counts, by removing rows one filter after the other."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    low = {}
    for d, text, _ in docs:
        d, text = -1 if d is None else d, text or ""
        low[text] = min(low.get(text, d), d)
    rows = []
    for d, text, part in docs:
        text, w = text or "", words(text)
        fails = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": (-1 if d is None else d) > low[text],
        }
        rows.append((part or "", {f for f in fails if fails[f]}, d in good, d in toxic))
    out, totals = {}, Counter()
    for part in {p for p, *_ in rows}:
        for order in itertools.permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                every = [r for r in rows if r[0] == part and f in r[1]]
                left = [r for r in left if f not in r[1]]
                totals[part, f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), len(every) - len(gone), sum(r[1] == {f} for r in every),
                    sum(r[2] for r in gone), sum(r[3] for r in gone),
                ]
    return {k: (*v, totals[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audit_rows(seed):
    rng = random.Random(seed)
    base = []
    for _ in range(14):
        size = rng.choice([0, 5, 150, 199, 200, 201, 260])
        pool = [f"w{i}" for i in range(rng.choice([40, 90, 100, 130, 400]))]
        w = [rng.choice(pool) for _ in range(size)]
        text = rng.choice([" ", "\t", "\n"]).join(w)
        if rng.random() < 0.4:
            text += "AB" * rng.randint(1, 30)
        if rng.random() < 0.4:
            text += rng.choice(["#", "|", " * ", "^", "日本"])
        base.append(text)
    docs = []
    for _ in range(90):
        docs.append((rng.choice([None, *range(60)]), rng.choice([None, *base]), rng.choice([None, "", "a", "b"])))
    labels = [
        (rng.choice([None, *range(60)]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1]))
        for _ in range(70)
    ]
    return docs, labels


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_equals_removing_filter_after_filter(spark, seed):
    docs, labels = audit_rows(seed)
    table = spark.createDataFrame(
        [(*d, 1, "x") for d in docs], "doc_id long, text string, source string, mask int, n string"
    )
    marks = spark.createDataFrame([(*x, "s") for x in labels], "doc_id long, quality int, toxic int, source string")
    found = A.audit(table, marks).collect()
    assert {tuple(r)[:3]: tuple(r)[3:] for r in found} == brute_audit(docs, labels)
    assert len(found) == 600 * len({d[2] or "" for d in docs})


def test_audit_of_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert A.audit(docs, labels).collect() == []
    one = spark.createDataFrame([(None, None, None)], docs.schema)
    found = A.audit(one, labels).collect()
    assert len(found) == 600 and {r.part for r in found} == {""}
    assert {(r.removed, r.kept, r.shapley) for r in found if r.filter_order[r.step - 1] == "A"} == {(1, 0, 120)}


def test_least_squares_give_shapley_values():
    players = 5
    rng = random.Random(7)
    v = [0] + [rng.randint(-1000, 1000) for _ in range(31)]
    exact = [Fraction(0)] * players
    for s in range(32):
        for f in range(players):
            if not s >> f & 1:
                size = s.bit_count()
                weight = Fraction(math.factorial(size) * math.factorial(players - size - 1), math.factorial(players))
                exact[f] += weight * (v[s | 1 << f] - v[s])
    fitted = [sum(c * x for c, x in zip(row, v)) for row in A.shapley_coefficients()]
    assert fitted == [x * 120 for x in exact]
    assert sum(fitted) == 120 * v[31]


def test_audit_shuffles_digests_not_texts(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    plan = A.audit(docs, labels)._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in plan and "text#" not in plan


# --- whitening ---------------------------------------------------------------------------


def vectors(spark, rows, more=()):
    return spark.createDataFrame(
        [(n, v, 1, "c") for n, v in rows], "vec_id long, embedding array<double>, n int, component string"
    )


def exact_spectrum(x):
    """Covariance in rationals, its eigenvalues and vectors, and the exact deviations."""
    n, d = len(x), len(x[0])
    sums = [sum(row[k] for row in x) for k in range(d)]
    centred = [[n * row[k] - sums[k] for k in range(d)] for row in x]
    cov = [[float(Fraction(sum(r[i] * r[j] for r in centred), n**3)) for j in range(d)] for i in range(d)]
    e, q = np.linalg.eigh(np.array(cov))
    return e[::-1], q[:, ::-1], [sum(c * c for c in r) for r in centred], np.array(centred, dtype=object) / n


def check_whitening(found, ids, x, components=32, tolerance=1e-9):
    e, q, deviations, centred = exact_spectrum(x)
    k = min(components, int((e > 1e-18 * e[0]).sum()))
    assert Counter(r.component for r in found) == {c: len(x) for c in range(1, k + 1)}
    by_row = {}
    for r in found:
        by_row.setdefault(r.vec_id, {})[r.component] = r
    for vec, dev, c in zip(ids, deviations, centred.astype(float)):
        for m in range(1, k + 1):
            r = by_row[vec][m]
            assert r.deviation == dev and r.n == len(x)
            want = c @ q[:, m - 1] / math.sqrt(e[m - 1])
            assert abs(abs(r.whitened) - abs(want)) < tolerance * max(1, abs(want))
            assert math.isclose(r.explained, e[m - 1] / e.sum(), rel_tol=1e-9)
            assert r.identity_error < 1e-9
    for m in range(1, k + 1):  # one sign for all rows
        own = np.array([by_row[v][m].whitened for v in ids])
        want = centred.astype(float) @ q[:, m - 1]
        assert abs(own @ want) > (1 - 1e-9) * np.linalg.norm(own) * np.linalg.norm(want)


@pytest.mark.parametrize("d,components", [(6, 32), (9, 3)])
def test_whitening_equals_eigenvectors_of_the_exact_covariance(spark, d, components):
    rng = np.random.default_rng(d)
    data = (rng.standard_normal((60, d)) * np.geomspace(1, 30, d)) @ rng.standard_normal((d, d))
    rows = [(n, [float(c) for c in v]) for n, v in enumerate(data)]
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows]
    found = W.whitened(vectors(spark, rows).repartition(3), components).collect()
    check_whitening(found, [n for n, _ in rows], x, components)


def test_whitening_of_repeated_eigenvalues_and_missing_rank(spark):
    # +-3 along four axes: one eigenvalue four times; the fifth axis is constant, the sixth repeats the first
    rows = []
    for axis in range(4):
        for sign in (3.0, -3.0):
            v = [0.0] * 6
            v[axis] = sign
            v[4], v[5] = 7.0, v[0]
            rows.append((len(rows), v))
    found = W.whitened(vectors(spark, rows)).collect()
    assert Counter(r.component for r in found) == {1: 8, 2: 8, 3: 8, 4: 8}
    z = np.zeros((8, 4))
    for r in found:
        z[r.vec_id, r.component - 1] = r.whitened
    assert np.allclose(z.T @ z / 8, np.eye(4), atol=1e-12)
    shares = {r.component: r.explained for r in found}
    assert np.allclose([shares[c] for c in (1, 2, 3, 4)], [2 / 5, 1 / 5, 1 / 5, 1 / 5])


def test_whitening_stops_early_only_with_proof(spark):
    rng = np.random.default_rng(4)
    data = rng.standard_normal((80, 2)) @ rng.standard_normal((2, 20)) * 1000
    rows = [(n, [float(c) for c in v]) for n, v in enumerate(data)]
    passes = []

    class Counted(W.Vectors):
        def totals(self, of, size):
            passes.append(size)
            return super().totals(of, size)

    found = Counted(vectors(spark, rows))
    spectrum = W.bidiagonalise(found, wanted=2)
    assert len(spectrum.sigma) == 2 and len(passes) < 20
    x = [[math.floor(64 * c) for c in v] for _, v in rows]
    e, _, _, _ = exact_spectrum(x)
    assert np.allclose(spectrum.sigma**2 / len(rows), e[:2], rtol=1e-12)


def test_whitening_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [1.0, 2.0]), (2, [2.0, -1.0]), (2, [2.0, -1.0]), (None, [0.015, 9.0]), (5, [-0.01, 4.0])]
    bad = [(6, None), (7, [nan, 1.0]), (8, [1.0, inf]), (9, [None, 1.0]), (10, []), (11, [1.0]), (12, [1.0, 2.0, 3.0])]
    found = W.whitened(vectors(spark, good + bad)).collect()
    x = [[math.floor(64 * c) for c in v] for _, v in good]
    e, _, deviations, _ = exact_spectrum(x)
    assert Counter((r.vec_id, r.deviation) for r in found) == {
        **{(n, d): 2 for (n, _), d in zip(good, deviations)}, (2, deviations[1]): 4
    }
    assert {r.n for r in found} == {5}
    assert W.whitened(vectors(spark, bad[:5])).collect() == []
    assert W.whitened(vectors(spark, [(1, [3.0, 4.0])] * 3)).collect() == []
    empty = W.whitened(vectors(spark, []))
    assert empty.collect() == [] and empty.columns == found[0].__fields__


def test_whitening_of_enormous_entries(spark):
    rows = [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0]), (4, [3e9, 5.0])]
    found = W.whitened(vectors(spark, rows)).collect()
    assert {r.vec_id for r in found} == {1, 2, 3, 4} and all(math.isfinite(r.whitened) for r in found)
    assert all(r.deviation is None for r in found if r.vec_id in (1, 2))
    large = [(n, [c * 1e5, 1.0 * n]) for n, c in enumerate([1.0, -2.5, 40.0, 3.0])]
    x = [[math.floor(64 * c) for c in v] for _, v in large]
    check_whitening(W.whitened(vectors(spark, large)).collect(), [0, 1, 2, 3], x, tolerance=1e-6)


def test_whitening_of_the_whole_table(spark, sf):
    found = W.op13_whitening(spark, sf)
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([[math.floor(64 * float(c)) for c in r.embedding] for r in rows], dtype=np.int64)
    n = len(x)
    centred = n * x - x.sum(axis=0)
    e, q = np.linalg.eigh((centred / n).T @ (centred / n) / n)
    e, q = e[::-1][:32], q[:, ::-1][:, :32]
    z = np.zeros((n, 32))
    place = {r.vec_id: i for i, r in enumerate(rows)}
    for r in found.collect():
        z[place[r.vec_id], r.component - 1] = r.whitened
        assert r.deviation == int((centred[place[r.vec_id]] ** 2).sum())
        assert r.identity_error < 1e-10
    want = (centred / n) @ q / np.sqrt(e)
    assert np.allclose(np.abs((z * want).sum(axis=0)) / n, 1, atol=1e-9)
    assert np.allclose(np.abs(z), np.abs(want), atol=1e-7)
