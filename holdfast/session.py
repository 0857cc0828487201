"""Session defaults for local runs, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(app: str = "holdfast", cores: str | int = "*", **conf) -> SparkSession:
    """A session for tests and benchmarks; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only where the cluster names none (a bare local session) is one created.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="holdfast-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is ever overwritten or deleted."""
    return os.path.join(shared_dir(spark), f"holdfast-{name}-{uuid.uuid4().hex[:12]}")


def materialize(df, name: str):
    """Cut lineage by writing to the shared folder and reading the table back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
