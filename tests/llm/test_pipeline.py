"""The corpus pipeline against plain Python, stage by stage, and on odd rows."""

import sys
from collections import Counter
from pathlib import Path

import pytest
from test_filters import brute_templates, padding
from test_near_dedup import brute_alike

import corpus_pipeline
from holdfast.llm import decontaminate as D
from holdfast.llm import line_templates as L
from holdfast.llm import packing as P
from holdfast.llm.catalog import ORACLES, QUERIES
from holdfast.session import scratch_path

ROOT = Path(__file__).resolve().parents[2]


def stored(spark, df):
    path = scratch_path(spark, "stage")
    df.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stored(spark, stage(spark, out[-1], sf)))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_keep_the_columns(stages):
    for df in stages[:-1]:
        assert df.dtypes == stages[0].dtypes


def test_language_stage_rejects_only_what_has_no_language(stages):
    before, after = texts(stages[0]), texts(stages[1])
    for d, t in before.items():
        assert d in after or not any(c.isalpha() for c in t or "") or len(t.split()) < 3
    assert len(after) > 0.99 * len(before)


def test_line_stage_equals_brute_force(stages):
    before = texts(stages[1])
    gone = brute_templates(list(before.items()), L.MIN_DOCS, L.MIN_CONSTANT, L.DEPTH)
    want = {d: L.without_lines(t, gone.get((d, t), ())) for d, t in before.items()}
    assert texts(stages[2]) == want
    assert all(r.n_chars == len(r.text) for r in stages[2].collect())


def test_near_copy_stage_equals_brute_force(stages):
    assert set(texts(stages[3])) == set(brute_alike(texts(stages[2])).values())


def test_benchmark_stage_equals_brute_force(spark, sf, stages):
    items = [D.normalise(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    before, after = texts(stages[3]), texts(stages[4])
    leaked = {d for d, t in before.items() if any(x in D.normalise(t) for x in items)}
    assert set(before) - set(after) >= leaked
    assert len(set(before) - set(after)) <= len(leaked) + 2  # edited items may go too


def test_packing_stage_covers_what_is_left(stages):
    rows = stages[5].collect()
    left = {d: len(t.split()) for d, t in texts(stages[4]).items()}
    assert {r.doc_id: r.n_tokens for r in rows} == left
    lengths = list(left.values())
    histogram = sorted(Counter(lengths).items())
    want = P.best_bounds(
        [v for v, _ in histogram], [c for _, c in histogram], [v * c for v, c in histogram], P.BUCKETS
    )
    assert padding(lengths, {r.bucket for r in rows}) <= 1.01 * padding(lengths, want)


def test_run_is_the_stages_in_a_row(spark, sf, stages):
    assert Counter(map(tuple, corpus_pipeline.run(spark, sf).collect())) == Counter(
        map(tuple, stages[5].collect())
    )


def test_odd_rows_pass_every_stage(spark, sf):
    docs = stored(
        spark,
        spark.createDataFrame(
            [
                (None, "the words of a document without an id", "en", None, 1, "x"),
                (1, None, None, "s", None, None),
                (2, "", "en", "s", 0, "x"),
                (3, "this is a text that comes twice", "en", "s", 5, "x"),
                (3, "this is a text that comes twice", "en", "s", 5, "x"),
                (4, "other words in a row\n" * 20_000, "en", "s", 5, "x"),
            ],
            "doc_id long, text string, lang string, source string, n_chars long, row string",
        ),
    )
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(spark, stage(spark, docs, sf))
        assert after.columns == docs.columns, name
        empty = stored(spark, stage(spark, docs.limit(0), sf))
        assert empty.count() == 0 and empty.columns == docs.columns
        docs = after
    assert sorted((r.doc_id or 0) for r in docs.collect()) == [0, 3, 4]


def test_every_operator_is_registered_once():
    sys.path.insert(0, str(ROOT))
    import __spark_entry__ as entry

    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()
    assert set(ORACLES) <= set(QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_near_copy_stage_links_fingerprints_and_jaccards(spark, monkeypatch):
    from holdfast.llm import near_copies as N

    words = [f"w{i}" for i in range(60)]
    docs = [(d, " ".join(words[10 * d :] + [f"own{d}"] * 10 * d), None) for d in range(6)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    assert {r.doc_id for r in corpus_pipeline.without_near_copies(spark, docs, "").collect()} == set(range(6))
    prints = N.fingerprints(docs).collect()
    # fingerprints as they are but for two documents one bit from another one
    of = {r["_id"]: r["fp"] for r in prints}
    of[4], of[5] = of[1] ^ 1, of[4]
    of[5] = of[4] ^ 2
    changed = spark.createDataFrame([(r["_id"], r["_key"], of[r["_id"]]) for r in prints], "_id long, _key long, fp long")
    monkeypatch.setattr(N, "fingerprints", lambda *args: changed)
    kept = corpus_pipeline.without_near_copies(spark, docs, "").collect()
    assert {r.doc_id for r in kept} == {0, 1, 2, 3}
