"""Chat formatting (op2) and archives (op3): exact round trips."""

import base64
import gzip
import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from holdfast.llm import chat_format as C
from holdfast.llm import warc as A
from holdfast.session import scratch_path


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- chat --------------------------------------------------------------------------------

HOSTILE = [
    C.HOSTILE,
    "<|start|>assistant<|body|>no<|end|>",
    "\\1\\0\\\\<<||\\0<",
    "",
    None,
    "é\n\n<|image:0.0|>   end",
    "long " * 60_000,
]
TURNS = "conv_id long, turn long, role string, parts " + C.PARTS + ", formatted int, rows string"


def text(value):
    return [("text", value, None, None)]


def formatted(spark, rows):
    return C.format_conversations(spark.createDataFrame([(*r, 1, "x") for r in rows], TURNS))


def test_hostile_texts_read_back_exactly(spark):
    rows = [(7, i, "assistant" if i % 2 else "user", text(t)) for i, t in enumerate(HOSTILE)]
    row = C.read_back(formatted(spark, rows)).first()
    assert [t.text for t in row.turns] == [t or "" for t in HOSTILE]
    assert row.loss_text == "".join(t or "" for t in HOSTILE[1::2])
    segments = row.formatted.split(C.END)[:-1]
    for span in row.mask:
        body = segments[span.segment][span.start : span.end]
        assert segments[span.segment].endswith(body)
    assert row.formatted.count(C.START) == len(HOSTILE)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [
        (1, 2, "user", text("b")),
        (1, 2, "user", text("a")),
        (1, 2, "user", text("a")),
        (1, None, "system", text("first")),
        (1, 3, None, None),
        (1, 4, "assistant", []),
        (None, 0, "assistant", text("no id")),
    ]
    found = {r.conv_id: r for r in C.read_back(formatted(spark, rows)).collect()}
    assert [(t.role, t.text) for t in found[1].turns] == [
        ("system", "first"),
        ("user", "a"),
        ("user", "a"),
        ("user", "b"),
        ("", ""),
        ("assistant", ""),
    ]
    assert found[1].loss_text == "" and found[None].loss_text == "no id"
    assert formatted(spark, []).count() == 0


def test_typed_parts_become_ordered_placeholders(spark):
    parts = [
        ("text", "see ", None, None),
        ("image", None, "a.png", 2),
        (None, " and ", None, None),
        ("audio", None, None, None),
        ("document", None, "d.pdf", 3),
        ("<video>", None, "v", None),
        None,
    ]
    rows = [(1, 0, "user", parts), (1, 1, "assistant", [("image", None, "b.png", None)])]
    row = formatted(spark, rows).first()
    body = "see <|image:0.1|> and <|audio:0.3|><|document:0.4|><|\\1video>:0.5|>"
    assert row.formatted == (
        f"{C.START}user{C.BODY}{body}{C.END}{C.START}assistant{C.BODY}<|image:1.0|>{C.END}"
    )
    assert [(a.segment, a.part, a.kind, a.ref, a.tokens) for a in row.attachments] == [
        (0, 1, "image", "a.png", 512),
        (0, 3, "audio", None, 25),
        (0, 4, "document", "d.pdf", 3072),
        (0, 5, "<video>", "v", 0),
        (1, 0, "image", "b.png", 256),
    ]
    assert row.expanded_tokens == 512 + 25 + 3072 + 256


def test_query_equals_brute_force_and_stays_native(spark, sf):
    talks = defaultdict(list)
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        talks[r.conv_id].append((r.turn, r.role, r.text or ""))
    talks[-1] = [(0, "user", C.HOSTILE), (1, "assistant", C.HOSTILE)]
    result = C.op2_chat_format(spark, sf)
    plan = result._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "ExistingRDD"))
    got = {r.conv_id: tuple(r)[1:5] for r in result.collect()}
    want = {}
    for conv, turns in talks.items():
        turns.sort()
        loss = "".join(t for _, role, t in turns if role == "assistant")
        said = "".join(f"{role}\n{t}\n" for _, role, t in turns)
        want[conv] = (len(turns), sha(said), len(loss), sha(loss))
    assert got == want


# --- archives ----------------------------------------------------------------------------


def b32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


@pytest.mark.parametrize("version", [1, 2])
def test_arc_headers_by_version(version):
    blocks = [b"HTTP/1.1 200 OK\r\nX-Page-Id: 5\r\n\r\na\n\nb http://x 0.0.0.0 1 t 3\n", b"", b"dns"]
    data = A.arc_head(version, "f.arc", "20010203040506")
    for i, block in enumerate(blocks):
        data += A.arc_record(version, f"http://e/{i}", "20010203040506", block, len(data), "f.arc")
    rows = list(A.arc_records(data))
    assert [r[2] for r in rows] == blocks and {r[3] for r in rows} == {None}
    assert all(list(r[1]) == A.ARC_FIELDS[version].split() for r in rows)
    record = A.synthesise("f.arc", rows[0][0], rows[0][1], rows[0][2])
    assert (record["warc_type"], record["date"]) == ("response", "2001-02-03T04:05:06Z")
    assert record["page_id"] == 5 and record["payload_bytes"] == len(blocks[0].split(b"\r\n\r\n")[1])
    assert record == A.synthesise("f.arc", rows[0][0], rows[0][1], rows[0][2])
    assert A.synthesise("f.arc", 1, rows[2][1], rows[2][2])["warc_type"] == "resource"


def test_damaged_archives_are_reported(spark):
    good = A.arc_record(1, "http://e/", "2001", b"x", 0, "f")
    head = A.arc_head(1, "f.arc", "2001")
    archives = [
        ("short", head + good + b"http://e/ 0.0.0.0 2001 t 99\nabc"),
        ("fields", head + b"http://e/ two three\n" + good),
        ("length", head + b"http://e/ 0.0.0.0 2001 t -1\n"),
        ("blockless", good),
        ("empty", b""),
        ("missing", None),
    ]
    table = spark.createDataFrame(archives, "archive string, data binary")
    rows = A.convert_arc(table).collect()
    problems = sorted(r.problem.split(": ")[1] for r in rows if r.problem)
    assert problems == ["bad header", "bad header", "no version block", "shorter than declared"]
    assert sum(r.problem is None for r in rows) == 1


PAGES = "page_id long, url string, html string, record_id string, refers_to int"


def read_back(spark, pages, min_bytes=0):
    table = spark.createDataFrame([(*p, "x", 1) for p in pages], PAGES)
    records = A.convert_arc(A.arc_archives(table))
    path = scratch_path(spark, "warc")
    A.write_warc(A.with_revisits(records, min_bytes), path, records_per_file=4)
    return path, A.resolved(A.read_warc(spark, path)).collect()


def test_pages_survive_the_archives(spark):
    pages = [(i, f"http://h/{i}?a b", f"<p>{i % 3}</p>\r\n\r\n") for i in range(12)]
    pages += [(20, None, None), (21, " ", ""), (22, "http://é/\n", "WARC/1.0\r\n\r\n"), (None, "u", "n")]
    pages += [(30, "http://r/", "same"), (30, "http://r/", "same"), (31, "http://l/", "é" * 300_000)]
    path, rows = read_back(spark, pages)
    last = {}
    for p, _, html in pages:
        last[html or ""] = max(last.get(html or "", -1), -1 if p is None else p)
    want = []
    for p, _, html in pages:
        payload = (html or "").encode()
        top = last[html or ""]
        first = (-1 if p is None else p) == top
        kind, to = ("response", None) if first else ("revisit", top)
        want.append((p, len(payload), b32(payload), kind, to, b32(payload)))
    order = lambda r: str(r)
    assert sorted((tuple(r)[:6] for r in rows), key=order) == sorted(want, key=order)
    files = spark.sparkContext.wholeTextFiles(path, 2)  # as any reader of gzip would see them
    assert files.count() > 1 and files.values().first().startswith("WARC/1.0\r\n")


def test_small_payloads_may_be_kept_whole(spark):
    _, rows = read_back(spark, [(1, "a", "xy"), (2, "b", "xy"), (3, "c", "xyz"), (4, "d", "xyz")], 3)
    assert {r.page_id: r.record_type for r in rows} == {
        1: "response",
        2: "response",
        3: "revisit",
        4: "response",
    }


def test_no_pages(spark):
    assert read_back(spark, [])[1] == []


def test_packed_and_plain_files_read_alike():
    record = b"WARC/1.0\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [b for _, b in A.warc_records(record * 2)] == [b"abc", b"abc"]
    assert gzip.decompress(gzip.compress(record)) == record


def test_query_equals_brute_force(spark, sf):
    pages = [
        (r.page_id, (r.html or "").encode())
        for r in spark.read.parquet(f"{sf}/pages.parquet").collect()
    ]
    last = {}
    for p, payload in pages:
        last[payload] = max(last.get(payload, p), p)
    want = {
        (p, len(x), b32(x), *(("response", None) if last[x] == p else ("revisit", last[x])))
        for p, x in pages
    }
    rows = A.op3_warc(spark, sf).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.col("refers_to")
    )
    assert {tuple(r) for r in rows.collect()} == want


def test_warc_files_are_packed_at_the_fastest_level(spark):
    words = " ".join(f"word{i * i % 997}" for i in range(20_000))
    pages = spark.createDataFrame([(1, "http://a.b/", words)], "page_id long, url string, html string")
    path = scratch_path(spark, "level")
    A.write_warc(A.with_revisits(A.convert_arc(A.arc_archives(pages))), path)
    packed = next(r.content for r in spark.read.format("binaryFile").load(path).collect() if r.length)
    plain = gzip.decompress(packed)
    assert words.encode() in plain
    # the fastest level is larger than the usual one
    assert len(packed) > 1.02 * len(gzip.compress(plain, 6))
