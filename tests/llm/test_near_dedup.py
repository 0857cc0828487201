"""SimHash classes (op6), components, and MinHash fingerprints (op5) against brute force."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from holdfast.llm import minhash as M
from holdfast.llm import simhash as S
from holdfast.llm.graph import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ROWS = "doc_id long, text string, fp string, component string, slot int, _key int"


def table(spark, docs):
    return spark.createDataFrame([(d, t, "a", "b", 1, 2) for d, t in docs], ROWS)


def brute_print(text: str | None) -> int:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    if words and not shingles:
        shingles = [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints: dict) -> dict:
    """Smallest key reachable over links of at most two bits."""
    label = {k: k for k in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 2 and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


def test_odd_rows_and_components(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base = rng.choices(words, k=300)
    docs = [(None, "only here")]
    for i in range(40):
        own = list(base)
        for _ in range(rng.randrange(0, 3)):
            own[rng.randrange(300)] = "edit"
        docs.append((i, " ".join(own)))
    docs += [(50, None), (51, ""), (52, " \n"), (53, "One"), (54, "one"), (55, "a b"), (55, "a b")]
    docs += [(56, "É é É"), (57, "é é é"), (58, "x " * 200_000)]
    got = S.near_duplicate_classes(table(spark, docs)).collect()
    prints = {-1 if d is None else d: brute_print(t) for d, t in docs}
    label = brute_classes(prints)
    want = Counter(
        (d, f"{brute_print(t):016x}", None if label[-1 if d is None else d] < 0 else label[d])
        for d, t in docs
    )
    assert Counter(tuple(r) for r in got) == want
    assert len({v for k, v in label.items() if 0 <= k < 40}) < 40  # near copies were linked
    assert S.near_duplicate_classes(table(spark, [])).count() == 0


@pytest.mark.parametrize("size", [3, 90, 400])
def test_crowded_keys_link_like_brute_force(spark, size):
    """Fingerprints around one centre share keys of any size."""
    rng = random.Random(size)
    centre = rng.getrandbits(64)
    prints = {}
    for i in range(size):
        flips = rng.sample(range(16), rng.randrange(0, 5))
        prints[i] = centre ^ sum(1 << b for b in flips)
    signed = [(i, 0, p - (1 << 64) if p >> 63 else p) for i, p in prints.items()]
    rows = spark.createDataFrame(signed, "_id long, _key long, fp long")
    classes = {r.fp: r.component for r in S.linked_fingerprints(rows).collect()}
    want = brute_classes(prints)
    assert {i: classes[fp] for i, _, fp in signed} == want


def test_every_close_pair_shares_a_viable_key():
    rng = random.Random(2)
    allowed = set(S._viable())
    for _ in range(300):
        flips = rng.sample(range(64), rng.choice([1, 2]))
        difference = sum(1 << b for b in flips)
        hit = False
        for loose, last in S.chains():
            free = (0xFF << 8 * loose) | (0xFF << 8 * last)
            code = ((difference >> 8 * loose & 0xFF) << 8) | (difference >> 8 * last & 0xFF)
            hit |= not difference & ~free and code in allowed
        assert hit


def test_one_document_of_each_class_stays(spark):
    text = " ".join(f"t{i}" for i in range(50))
    docs = [(3, text), (1, text), (1, text), (2, "other words here"), (None, None), (9, "")]
    kept = S.one_of_each(table(spark, docs))
    assert kept.columns == table(spark, []).columns
    assert sorted((r.doc_id or -1, r.text) for r in kept.collect()) == sorted(
        [(1, text), (2, "other words here"), (-1, None)]
    )


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 80)]
    loops = [(5000, 5000)]
    edges = spark.createDataFrame([*chain, *star, *chain[:5], *loops], "a long, b long")
    found = {r.node: r.root for r in components(edges).collect()}
    assert found == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(80)}


# --- MinHash -----------------------------------------------------------------------------


def edited(docs):
    rows = sorted(docs, key=lambda r: (-1 if r[0] is None else r[0], r[1] or ""))
    for i, (d, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        yield d, text, text[: len(text) - half] + after[:half], after


def sets(text):
    words = text.encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, min(len(words), 1)))}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_edited_fingerprints(spark):
    rng = random.Random(8)
    docs = [(i * 3, " ".join(rng.choices("abcdefgh", k=rng.randrange(0, 90)))) for i in range(60)]
    docs += [(None, "first é"), (500, None), (501, ""), (502, "été " * 30_000), (503, "z"), (503, "z")]
    rng.shuffle(docs)
    got = M.edited_fingerprints(table(spark, docs)).collect()
    want = Counter(
        (d, len(t), hashlib.sha256(e.encode()).hexdigest()) for d, t, e, _ in edited(docs)
    )
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    prints = {r.doc_id: r for r in got}
    for d, t, e, after in edited(docs):
        if (d, t) != (503, "z"):
            assert abs(prints[d].near_edited - jaccard(sets(t), sets(e))) < 0.25
            assert abs(prints[d].near_next - jaccard(sets(t), sets(after))) < 0.25
    assert prints[500].fingerprint == prints[501].fingerprint != prints[503].fingerprint
    assert prints[501].near_edited == 1.0
    alone = M.edited_fingerprints(table(spark, [(7, "just one row")])).first()
    assert alone.near_next == 1.0
    assert M.edited_fingerprints(table(spark, [])).count() == 0


def test_registered_query_covers_every_document(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r.doc_id: r for r in M.op5_minhash(spark, sf).collect()}
    errors = []
    for d, t, e, after in edited(docs):
        assert got[d].edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        errors.append(abs(got[d].near_edited - jaccard(sets(t), sets(e))))
        errors.append(abs(got[d].near_next - jaccard(sets(t), sets(after))))
    assert len(got) == len(docs) and sum(errors) / len(errors) < 0.03


def test_simhash_query_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.col("text")).collect()
    prints = {r.doc_id: brute_print(r.text) for r in docs}
    label = brute_classes(prints)
    got = {tuple(r) for r in S.op6_simhash(spark, sf).collect()}
    assert got == {(d, f"{p:016x}", label[d]) for d, p in prints.items()}


def brute_alike(texts: dict) -> dict:
    """Smallest key reachable over links of a five-word Jaccard of 0.8 or more."""
    found = {d: sets((t or "").lower()) for d, t in texts.items()}
    label = {d: d for d in texts}

    def root(d):
        while label[d] != d:
            d = label[d]
        return d

    for a in found:
        for b in found:
            if a < b and jaccard(found[a], found[b]) >= 0.8 and root(a) != root(b):
                low, high = sorted((root(a), root(b)))
                label[high] = low
    return {d: root(d) for d in texts}


def edits(rng, base, most):
    own = list(base)
    for _ in range(rng.randrange(most)):
        own[rng.randrange(len(own))] = f"e{rng.random()}"
    return own


@pytest.mark.parametrize(("crowd", "block"), [(70, 2048), (40, 7)])
def test_one_of_alike_equals_brute_force_jaccard(spark, monkeypatch, crowd, block):
    """A chain whose ends are unlike, crowds of edited copies, and a crowd that shares only half.

    Small blocks meet in more cells and give the same classes."""
    monkeypatch.setattr(M, "BLOCK_SHINGLES", 100)
    rng = random.Random(crowd)
    words = [f"v{i}" for i in range(3000)]
    texts, chain, base = {}, rng.choices(words, k=100), rng.choices(words, k=200)
    for i in range(20):
        chain[i * 5] = f"c{i}"
        texts[1000 + i] = " ".join(chain)
    for i in range(crowd):
        texts[i] = " ".join(edits(rng, base, 8))
        texts[2000 + i] = " ".join(base[:120] + rng.choices(words, k=80))
        texts[4000 + i] = " ".join(edits(rng, base[100:] + base[:100], 16))  # at the threshold
    texts |= {3000: texts[5].upper(), 3001: "One", 3002: "one", 3003: "", 3004: None, 3005: " "}
    docs = list(texts.items())
    rng.shuffle(docs)
    label = brute_alike(texts)
    classes = M.near_copy_classes(table(spark, [*docs, *docs[:3]]), block=block).collect()
    assert len(classes) == len(docs) + 3
    assert len({(r["class"], label[r["_id"]]) for r in classes}) == len(set(label.values()))
    kept = M.one_of_alike(table(spark, [*docs, *docs[:3]])).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(label.values()))
    assert all(r.text == texts[r.doc_id] for r in kept)
    assert M.one_of_alike(table(spark, [])).count() == 0


def test_a_thousand_near_copies_and_a_thousand_that_share_a_passage(spark):
    rng = random.Random(6)
    words = [f"v{i}" for i in range(5000)]
    base, passage = rng.choices(words, k=150), rng.choices(words, k=110)
    texts = {i: " ".join(edits(rng, base, 6)) for i in range(1000)}
    texts |= {2000 + i: " ".join(passage + rng.choices(words, k=60)) for i in range(1000)}
    kept = {r.doc_id for r in M.one_of_alike(table(spark, list(texts.items()))).collect()}
    label = brute_alike({d: t for d, t in texts.items() if d < 1000})
    assert kept == set(label.values()) | {d for d in texts if d >= 2000}


def test_a_class_names_its_most_alike_pair():
    rng = np.random.default_rng(3)
    prints = rng.integers(0, 3, (30, 50)).astype(np.uint16)
    label = rng.integers(0, 4, 30)
    for floor in (0.3, 0.5, 0.9):
        x, y, whole = M.best_ties(prints[:10], label[:10], prints[10:], label[10:], floor)
        every = defaultdict(list)
        for i, j in itertools.product(range(10), range(10, 30)):
            alike = (prints[i] == prints[j]).mean()
            if label[i] != label[j] and alike >= floor:
                every[label[i]].append(alike)
        assert {label[i]: (prints[i] == prints[10 + j]).mean() for i, j in zip(x, y)} == {
            c: max(found) for c, found in every.items()
        }
        assert len(x) == len(every) and whole == all(len(found) < 2 for found in every.values())


@pytest.mark.parametrize("seed", range(4))
def test_exact_ties_connect_what_all_similar_pairs_connect(seed):
    rng = random.Random(seed)
    bases = [rng.sample(range(400), 30) for _ in range(3)]
    found = [sorted({rng.randrange(400) if rng.random() < 0.12 else v for v in rng.choice(bases)}) for _ in range(40)]
    edges = np.cumsum([0, *map(len, found)])
    label = np.array([rng.randrange(20) for _ in found])
    low, high = np.arange(0, 15), np.arange(10, 40)
    ties = M.exact_ties(np.concatenate(found), edges, label, low, high, 0.8)
    sets = list(map(set, found))
    similar = [(i, j) for i in low for j in high if jaccard(sets[i], sets[j]) >= 0.8]

    def joined(pairs):
        root = {c: c for c in label}
        for i, j in pairs:
            a, b = root[label[i]], root[label[j]]
            root = {c: a if r == b else r for c, r in root.items()}
        return {frozenset(c for c in root if root[c] == r) for r in root.values()}

    assert similar and set(ties) <= set(similar) and len(ties) < 20
    assert joined(ties) == joined(similar)


def test_pipeline_stage_drops_every_near_copy(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    kept = corpus_pipeline.without_near_copies(spark, docs, sf).select("doc_id").collect()
    assert {r.doc_id for r in kept} == set(brute_alike(texts).values())
