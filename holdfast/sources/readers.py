"""Batch sources. Every read has an explicit schema; charge text stays text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.operators.quality import ContractViolation, require_contract
from holdfast.sources.contract import TELCO, Contract

SPLITS = ("train", "val", "test")


def read_customers(
    spark: SparkSession,
    path: str,
    contract: Contract = TELCO,
    validate: bool = True,
    expected_rows: int | None = None,
    fmt: str | None = None,
) -> DataFrame:
    """Raw customers from CSV (with header) or Parquet, unmodified.

    ``fmt`` is "csv" or "parquet"; without it a path that ends in ``.parquet`` is Parquet.
    """
    reader = spark.read.schema(contract.schema)
    if fmt is None:
        fmt = "parquet" if path.rstrip("/").endswith(".parquet") else "csv"
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unknown format '{fmt}'")
    if fmt == "parquet":
        df = reader.parquet(path)
    else:
        # a header that does not match the contract fails the read
        df = reader.csv(path, header=True, enforceSchema=False, mode="FAILFAST")
    if validate:
        require_contract(df, contract, expected_rows)
    return df


def read_split(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One named split; the filter prunes the other partitions' files."""
    if name not in SPLITS:
        raise ContractViolation(f"unknown split '{name}', expected one of {SPLITS}")
    return read_splits(spark, base).where(F.col("split") == name)


def read_splits(spark: SparkSession, base: str, contract: Contract = TELCO) -> DataFrame:
    """All rows of a stored split, with its name."""
    schema = T.StructType([*contract.schema.fields, T.StructField("split", T.StringType())])
    return spark.read.schema(schema).parquet(f"{base}/splits")


def read_manifest(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.json(
        f"{base}/manifest",
        schema="split string, rows long, share double, churn_rate double, "
        "id_fingerprint string, fingerprint_mode string, random_seed long, stratified boolean, total_rows long",
    )


def ask(spark: SparkSession, sql: str) -> DataFrame:
    """Ad-hoc SQL over the registered layers."""
    return spark.sql(sql)
