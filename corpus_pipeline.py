"""A training corpus from ``documents``: five stages, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.decontaminate import contaminated
from holdfast.llm.language_id import confident, fold, train
from holdfast.llm.line_templates import drop_template_lines
from holdfast.llm.near_copies import one_of_near
from holdfast.llm.packing import pack
from holdfast.llm.rows import packed
from holdfast.session import scratch_path


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; learned from the labelled ones of two folds."""
    return confident(docs, train(docs.where(fold(F.col("doc_id")) != 1)))


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines of templates that an earlier document holds."""
    rows = drop_template_lines(docs).select("row")
    if "n_chars" in docs.columns:
        chars = F.length("row.text").cast(docs.schema["n_chars"].dataType)
        rows = rows.select(F.col("row").withField("n_chars", chars).alias("row"))
    return rows.select("row.*")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of SimHash fingerprints within two bits or five-word Jaccards of 0.8 or more."""
    return one_of_near(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = contaminated(docs, items).select("_id", "_key").distinct()
    return packed(docs).join(found, ["_id", "_key"], "left_anti").select("row.*")


def in_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length bucket, batch and slot of each document that is left."""
    return pack(docs)


STAGES = [
    ("language_id", known_language),
    ("line_dedup", without_boilerplate),
    ("near_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("packing", in_batches),
]

#: A Bayes model, MinHash bands and a dynamic programme have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
