"""Stateless scoring of arriving records with Structured Streaming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from holdfast.operators.explain import LinearTerm
from holdfast.operators.quality import record_errors, unknown_json_fields
from holdfast.plans.scoring import score_records
from holdfast.sources.contract import TELCO, Contract


def read_record_stream(
    spark: SparkSession, path: str, fmt: str = "parquet", contract: Contract = TELCO, **options
) -> DataFrame:
    """Files of typed records arriving in a folder."""
    return spark.readStream.schema(contract.schema).options(**options).format(fmt).load(path)


def parse_json_records(lines: DataFrame, contract: Contract = TELCO) -> DataFrame:
    """JSON text in ``value`` to typed columns plus ``errors`` naming every bad field.

    A field of the wrong type parses to NULL and is reported as bad; a field outside
    the contract is reported by name.
    """
    extra = F.coalesce(
        unknown_json_fields(F.col("value"), contract), F.array().cast("array<string>")
    )
    parsed = lines.select("value", F.from_json("value", contract.schema).alias("r"), extra.alias("x"))
    typed = parsed.select("value", "r.*", "x")
    return typed.withColumn("errors", F.concat(record_errors(contract), F.col("x"))).drop("x")


def score_stream(
    records: DataFrame,
    model: PipelineModel,
    out: str,
    checkpoint: str,
    terms: Sequence[LinearTerm] | None = None,
    contract: Contract = TELCO,
    once: bool = True,
    **options,
) -> StreamingQuery:
    """Write decisions to ``out/scored`` and bad records to ``out/quarantine``.

    Both are written from the same micro-batch, each under its batch number, so a batch
    that is replayed after a failure replaces its own output instead of doubling it.
    """
    if "errors" not in records.columns:
        records = records.withColumn("errors", record_errors(contract))

    def both(batch: DataFrame, number: int) -> None:
        batch.persist()  # read twice, once per output
        good = batch.where(F.size("errors") == 0).drop("errors")
        bad = batch.where(F.size("errors") > 0)
        scored = score_records(good, model, terms, contract.id_column, **options)
        scored.write.mode("overwrite").parquet(f"{out}/scored/batch={number}")
        bad.write.mode("overwrite").parquet(f"{out}/quarantine/batch={number}")
        batch.unpersist()

    writer = records.writeStream.foreachBatch(both).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
