"""Legacy archives: ARC files parsed by version, converted to WARC, and WARC files read back.

ARC version 1 heads a record with ``URL IP date type length``, version 2 with ``URL IP date type
status checksum location offset filename length``; the version block at the start of a file says which. A
record's block is exactly its declared length. The converter gives each record what WARC wants and
ARC lacks: an identifier, a timestamp, a type and digests. Records with equal payloads
become one response and revisits of it.

WARC files are written by Spark's text writer with the record separator as line separator,
as whole-file gzip, and read through ``binaryFile``, so any storage that Spark reaches will do.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.rows import NO_ID
from holdfast.session import scratch_path

#: Field names of a record's header line by version, as the version block declares them.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename"
    " Archive-length",
}
ARCHIVE_BYTES = 4 << 20
RECORDS_PER_FILE = 1000
SEPARATOR = "\r\n\r\n"
PAGE_HEADER = "X-Page-Id"
_RECORD = (
    "record_id string, warc_type string, url string, date string, page_id long,"
    " content_type string, block binary, payload_start int, payload_bytes long,"
    " payload_sha1 string, payload_sha256 string, problem string"
)


# --- writing legacy archives -------------------------------------------------------------


def arc_head(version: int, name: str, date: str) -> bytes:
    """The version block that opens an archive."""
    body = f"{version} 0 holdfast\n{ARC_FIELDS[version]}\n".encode()
    line = {
        1: f"filedesc://{name} 0.0.0.0 {date} text/plain {len(body)}",
        2: f"filedesc://{name} 0.0.0.0 {date} text/plain 200 - - 0 {name} {len(body)}",
    }[version]
    return line.encode() + b"\n" + body + b"\n"


def arc_record(version: int, url: str, date: str, block: bytes, offset: int, name: str) -> bytes:
    line = {
        1: f"{url} 0.0.0.0 {date} text/html {len(block)}",
        2: f"{url} 0.0.0.0 {date} text/html 200 - - {offset} {name} {len(block)}",
    }[version]
    return line.encode() + b"\n" + block + b"\n"


def _address(url: str | None, page: int | None) -> str:
    """A URL without spaces, as the header line needs; a missing one is made up."""
    if not url or not url.strip():
        return f"http://missing.invalid/{'' if page is None else page}"
    return "".join(f"%{ord(c):02X}" if c.isspace() else c for c in url)


def _archives(date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, body, name, version = TaskContext.get().partitionId(), 0, b"", "", 1

        def flush():
            return pa.RecordBatch.from_pydict(
                {"archive": pa.array([name]), "data": pa.array([bytes(body)], pa.binary())}
            )

        for batch in batches:
            columns = (batch.column(c) for c in ("page_id", "url", "html"))
            for page, url, html in zip(*columns):
                page, url, payload = page.as_py(), url.as_py(), (html.as_py() or "").encode()
                if not body:
                    name, version = f"pages-{task:05d}-{number:05d}.arc", 1 + (task + number) % 2
                    body = bytearray(arc_head(version, name, date))
                known = "" if page is None else f"{PAGE_HEADER}: {page}\r\n"
                head = (
                    f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{known}"
                    f"Content-Length: {len(payload)}\r\n\r\n"
                )
                body += arc_record(
                    version, _address(url, page), date, head.encode() + payload, len(body), name
                )
                if len(body) >= ARCHIVE_BYTES:
                    yield flush()
                    body, number = b"", number + 1
        if body:
            yield flush()

    return run


def arc_archives(pages: DataFrame, date: str = "20200101000000") -> DataFrame:
    """``archive, data``: ARC files of about four megabytes, of both versions, from pages."""
    pages = pages.select("page_id", "url", "html")
    return pages.mapInArrow(_archives(date), "archive string, data binary")


# --- reading legacy archives -------------------------------------------------------------


def arc_records(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes | None, str | None]]:
    """Offset, header fields, block and problem of each record after the version block.

    A header that does not fit its version, or a length beyond the end, is reported as a
    problem and ends the archive: without a true length the next header cannot be found.
    """
    at, fields = 0, None
    while at < len(data):
        end = data.find(b"\n", at)
        line = data[at : len(data) if end < 0 else end].decode("utf-8", "replace").rstrip("\r")
        if not line:
            at += 1
            continue
        values = line.split(" ")
        names = fields or (ARC_FIELDS[1] if len(values) == 5 else ARC_FIELDS[2]).split()
        length = values[-1]
        if end < 0 or len(values) != len(names) or not (length.isascii() and length.isdigit()):
            yield at, {}, None, "bad header"
            return
        stop = end + 1 + int(length)
        if stop > len(data):
            yield at, dict(zip(names, values)), None, "shorter than declared"
            return
        block = data[end + 1 : stop]
        if fields is None:
            version = block.split(b" ", 1)[0]
            known = version.isdigit() and int(version) in ARC_FIELDS
            if not line.startswith("filedesc://") or not known:
                yield at, {}, None, "no version block"
                return
            fields = ARC_FIELDS[int(version)].split()
        else:
            yield at, dict(zip(names, values)), block, None
        at = stop


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def http_head(block: bytes) -> tuple[int, dict[str, str]]:
    """Where the payload of a block starts, and its HTTP headers in lower case."""
    if not block.startswith(b"HTTP/"):
        return 0, {}
    end = block.find(b"\r\n\r\n")
    if end < 0:
        return len(block), {}
    lines = block[:end].decode("latin-1").split("\r\n")[1:]
    return end + 4, {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def _page(headers: dict[str, str]) -> int | None:
    value = headers.get(PAGE_HEADER.lower())
    return int(value) if value else None


def synthesise(archive: str, offset: int, fields: dict[str, str], block: bytes) -> dict:
    """A WARC record's identity for an ARC record: the same on every run."""
    url, date = fields["URL"], fields["Archive-date"].ljust(14, "0")[:14]
    seed = hashlib.sha1(f"{archive}\n{offset}\n{url}\n{date}".encode()).digest()
    start, headers = http_head(block)
    kind = "response" if start else "resource"
    payload = block[start:]
    return {
        "record_id": f"<urn:uuid:{uuid.UUID(bytes=seed[:16], version=5)}>",
        "warc_type": kind,
        "url": url,
        "date": f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:]}Z",
        "page_id": _page(headers),
        "content_type": "application/http; msgtype=response" if start else fields["Content-type"],
        "block": block,
        "payload_start": start,
        "payload_bytes": len(payload),
        "payload_sha1": sha1_base32(payload),
        "payload_sha256": hashlib.sha256(payload).hexdigest(),
    }


_RECORD_FIELDS = [
    ("record_id", pa.string()),
    ("warc_type", pa.string()),
    ("url", pa.string()),
    ("date", pa.string()),
    ("page_id", pa.int64()),
    ("content_type", pa.string()),
    ("block", pa.binary()),
    ("payload_start", pa.int32()),
    ("payload_bytes", pa.int64()),
    ("payload_sha1", pa.string()),
    ("payload_sha256", pa.string()),
    ("problem", pa.string()),
]


def _convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for archive, data in zip(batch.column("archive"), batch.column("data")):
            rows = []
            for offset, fields, block, problem in arc_records(data.as_py() or b""):
                if problem:
                    rows.append({"url": fields.get("URL"), "problem": f"{offset}: {problem}"})
                else:
                    rows.append(synthesise(archive.as_py(), offset, fields, block))
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(_RECORD_FIELDS))


def convert_arc(archives: DataFrame) -> DataFrame:
    """One WARC-shaped record per ARC record of ``archives(archive, data)``.

    A damaged record gives a row with only ``problem`` (offset and reason) and ends its archive.
    A null archive is empty.
    """
    return archives.select("archive", "data").mapInArrow(_convert, _RECORD)


# --- writing and reading WARC files ------------------------------------------------------


def with_revisits(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Adds ``refers_to, refers_url, refers_date``: set where a record revisits another.

    Of records with equal payloads of at least ``min_bytes`` the one with the largest page id
    stays; a null id is smaller than any other. Repeated rows of the largest id all stay.
    """
    order = F.struct(
        F.coalesce("page_id", F.lit(NO_ID)).alias("page"),
        F.col("record_id").alias("id"),
        F.col("url").alias("to_url"),
        F.col("date").alias("to_date"),
    )
    narrow = records.where(F.col("payload_bytes") >= min_bytes).select(
        "payload_sha256", "payload_bytes", "record_id", order.alias("me")
    )
    same = ["payload_sha256", "payload_bytes"]
    groups = narrow.groupBy(*same).agg(F.max("me").alias("kept"), F.count("*").alias("n"))
    path = scratch_path(records.sparkSession, "responses")
    groups.where("n > 1").drop("n").write.parquet(path)
    kept = records.sparkSession.read.parquet(path)
    revisits = (
        narrow.join(kept, same)
        .where("me.page < kept.page")
        .select(
            "record_id",
            F.col("kept.id").alias("refers_to"),
            F.col("kept.to_url").alias("refers_url"),
            F.col("kept.to_date").alias("refers_date"),
        )
    )
    return records.join(revisits, "record_id", "left")


def _serialise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            revisit = r["refers_to"] is not None
            block = r["block"][: r["payload_start"]] if revisit else r["block"]
            lines = [
                "WARC/1.0",
                f"WARC-Type: {'revisit' if revisit else r['warc_type']}",
                f"WARC-Record-ID: {r['record_id']}",
                f"WARC-Date: {r['date']}",
                f"WARC-Target-URI: {r['url']}",
                f"WARC-Payload-Digest: sha1:{r['payload_sha1']}",
                f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
                f"Content-Type: {r['content_type']}",
                f"Content-Length: {len(block)}",
            ]
            if revisit:
                lines += [
                    "WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest",
                    f"WARC-Refers-To: {r['refers_to']}",
                    f"WARC-Refers-To-Target-URI: {r['refers_url']}",
                    f"WARC-Refers-To-Date: {r['refers_date']}",
                ]
            out.append("\r\n".join(lines).encode() + b"\r\n\r\n" + block)
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])


def write_warc(records: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Writes ``records`` (with revisits) as gzipped WARC files of bounded length."""
    (
        records.where("problem IS NULL")
        .drop("problem", "payload_bytes", "payload_sha256", "page_id")
        .mapInArrow(_serialise, "value binary")
        .select(F.col("value").cast("string").alias("value"))
        .write.option("lineSep", SEPARATOR)
        .option("compression", "gzip")
        .option("zlib.compress.level", "BEST_SPEED")  # packing is the job's largest cost
        .option("maxRecordsPerFile", records_per_file)
        .text(path)
    )


def warc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower case) and block of each record of an unpacked WARC file."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        stop = end + 4 + int(headers["content-length"])
        yield headers, data[end + 4 : stop]
        at = stop + len(SEPARATOR)


_READ_FIELDS = [
    ("record_id", pa.string()),
    ("record_type", pa.string()),
    ("url", pa.string()),
    ("page_id", pa.int64()),
    ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()),
    ("declared_digest", pa.string()),
    ("refers_to", pa.string()),
]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            rows = []
            packed = content.as_py()
            data = zlib.decompress(packed, wbits=31) if packed[:2] == b"\x1f\x8b" else packed
            for headers, block in warc_records(data):
                start, http = http_head(block)
                whole = headers["warc-type"] != "revisit"
                rows.append(
                    {
                        "record_id": headers["warc-record-id"],
                        "record_type": headers["warc-type"],
                        "url": headers["warc-target-uri"],
                        "page_id": _page(http),
                        "payload_bytes": len(block) - start if whole else None,
                        "payload_digest": sha1_base32(block[start:]) if whole else None,
                        "declared_digest": headers["warc-payload-digest"].removeprefix("sha1:"),
                        "refers_to": headers.get("warc-refers-to"),
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(_READ_FIELDS))


def read_warc(spark, path: str) -> DataFrame:
    """One row per record; digest and length are taken from the payload read, null for revisits."""
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("content")
    return files.mapInArrow(
        _read,
        "record_id string, record_type string, url string, page_id long, payload_bytes long,"
        " payload_digest string, declared_digest string, refers_to string",
    )


def resolved(read: DataFrame) -> DataFrame:
    """Revisits with length, digest and page id of the response they refer to, as read."""
    full = read.where("record_type <> 'revisit'")
    targets = full.select(
        F.col("record_id").alias("refers_to"),
        F.col("page_id").alias("_page"),
        F.col("payload_bytes").alias("_bytes"),
        F.col("payload_digest").alias("_digest"),
    )
    # only revisits are joined: the missing reference of all others would be one hot key
    revisits = read.where("record_type = 'revisit'").join(targets, "refers_to", "left")
    return full.select(
        "page_id",
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.lit(None).cast("long").alias("refers_to"),
        "declared_digest",
        "url",
    ).union(
        revisits.select(
            "page_id", "_bytes", "_digest", "record_type", "_page", "declared_digest", "url"
        )
    )


def op3_warc(spark, sf_dir: str) -> DataFrame:
    """``pages`` as legacy archives, converted to WARC files, and those read back."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    archives = scratch_path(spark, "arc")
    arc_archives(pages).write.option("compression", "zstd").parquet(archives)
    records = convert_arc(spark.read.parquet(archives))
    path = scratch_path(spark, "warc")
    write_warc(with_revisits(records), path)
    return resolved(read_warc(spark, path)).drop("declared_digest", "url")
