"""Tables that grow by whole batches: staged first, then published by one commit file.

A table is a folder with ``batches/<name>``, Parquet written by the executors, and ``commits/<version>``,
one small file for each published batch. Readers take the batches that commits name, so a batch
that failed, or is still being written, has no visible row. Versions count from one without a gap
and are never given twice: a commit file is created only where none exists, and of two
writers that saw the same table the later one is refused.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

COMMIT_SCHEMA = "version long, batch string, rows long"


class LateWriter(RuntimeError):
    """Another batch was published since this writer looked at the table."""


def _path(spark: SparkSession, path: str):
    """A path and its file system, as Spark's own writers see them."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def commits(spark: SparkSession, base: str) -> list[dict]:
    """Published batches in ascending version; a commit file still being written does not count."""
    folder, files = _path(spark, f"{base}/commits")
    if not files.exists(folder):
        return []
    found = spark.read.schema(COMMIT_SCHEMA).json(f"{base}/commits").where("batch IS NOT NULL")
    return sorted((r.asDict() for r in found.collect()), key=lambda r: r["version"])


def version(spark: SparkSession, base: str) -> int:
    """The last published version, 0 for a table without any."""
    return max((c["version"] for c in commits(spark, base)), default=0)


def stage(df: DataFrame, base: str) -> tuple[str, DataFrame]:
    """Writes a batch that nobody sees yet; its name, and the rows as they were written."""
    name = uuid.uuid4().hex
    path = f"{base}/batches/{name}"
    df.write.mode("errorifexists").parquet(path)
    return name, df.sparkSession.read.schema(df.schema).parquet(path)


def publish(spark: SparkSession, base: str, batch: str, rows: int, after: int) -> int:
    """Makes a staged batch version ``after + 1``, or raises :class:`LateWriter`.

    One exclusive creation of one file, which the shared file system decides.
    """
    number = after + 1
    target, files = _path(spark, f"{base}/commits/{number:012d}.json")
    line = json.dumps({"version": number, "batch": batch, "rows": rows}) + "\n"
    try:
        out = files.create(target, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in str(error.java_exception):
            raise
        raise LateWriter(f"version {number} of {base} was published by another writer") from error
    try:
        out.write(bytearray(line.encode()))
    finally:
        out.close()
    return number


def read_committed(
    spark: SparkSession, base: str, schema: StructType | str, upto: int | None = None
) -> DataFrame:
    """All published rows with their ``_version``, as of version ``upto`` if one is given."""
    found = [c for c in commits(spark, base) if upto is None or c["version"] <= upto]
    wanted = spark.createDataFrame([], schema).schema
    if not found:
        return spark.createDataFrame([], wanted).withColumn("_version", F.lit(None).cast("long"))
    rows = spark.read.schema(wanted).parquet(*(f"{base}/batches/{c['batch']}" for c in found))
    # one entry per commit
    of = F.create_map(*(F.lit(x) for c in found for x in (c["batch"], c["version"])))
    folder = F.regexp_extract(F.col("_metadata.file_path"), "/batches/([0-9a-f]{32})/", 1)
    return rows.withColumn("_version", of[folder].cast("long"))
