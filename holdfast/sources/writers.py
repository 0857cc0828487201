"""Sinks. Tables are written by the executors; only one-row metadata starts on the driver."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from holdfast.operators.quality import ContractViolation, require_contract
from holdfast.operators.split import require_disjoint, split_manifest
from holdfast.session import materialize
from holdfast.sources import commits
from holdfast.sources.contract import TELCO, Contract


def _existing(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored table, or None where there is none; one that cannot be read is an error."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def append_checked(df: DataFrame, path: str, contract: Contract = TELCO) -> int:
    """Append rows that meet the table contract, or fail without a visible row.

    The rows are staged, checked as they were written, and published by one commit (see
    :mod:`holdfast.sources.commits`). Keys must be new to the table as well as unique in the
    batch; a writer that others overtook between check and commit is refused with
    ``LateWriter`` and may try again. ``read_committed`` reads the table.
    """
    spark = df.sparkSession
    seen = commits.version(spark, path)
    name, batch = commits.stage(df.select(*contract.names), path)
    require_contract(batch, contract)
    stored = commits.read_committed(spark, path, contract.schema, seen)
    again = batch.join(stored.select(contract.id_column), contract.id_column, "left_semi").count()
    if again:
        raise ContractViolation(f"{again} keys are already stored in {path}")
    rows = batch.count()
    commits.publish(spark, path, name, rows, seen)
    return rows


def save_splits(
    df: DataFrame, base: str, contract: Contract = TELCO, seed: int = 42, stratified: bool = True
) -> DataFrame:
    """Write the splits, one folder each, and the manifest that seals them."""
    df = materialize(df, "parts")  # checked and written from the same rows, placed once
    require_disjoint(df, contract.id_column, "split")
    df.write.mode("errorifexists").partitionBy("split").parquet(f"{base}/splits")
    stored = df.sparkSession.read.schema(df.schema).parquet(f"{base}/splits")
    manifest = split_manifest(stored, contract.id_column, contract.target, contract.positive)
    total = F.sum("rows").over(Window.partitionBy())
    manifest = manifest.withColumns(
        {
            "random_seed": F.lit(seed).cast("bigint"),
            "stratified": F.lit(stratified),
            "total_rows": total,
        }
    )
    manifest.coalesce(1).write.mode("errorifexists").json(f"{base}/manifest")
    return df.sparkSession.read.schema(manifest.schema).json(f"{base}/manifest")


# text is written as it is: a blank stays a blank
CSV_VERBATIM = {
    "header": True,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def export_csv(layers: dict[str, DataFrame], path: str, detail: str = "customers") -> dict[str, str]:
    """One CSV folder with header per layer; marts as a single file, detail in parallel."""
    written = {}
    for name, df in layers.items():
        target = f"{path}/{name}"
        single = df if name == detail else df.coalesce(1)
        single.write.mode("overwrite").options(**CSV_VERBATIM).csv(target)
        written[name] = target
    return written


def write_report(df: DataFrame, path: str) -> None:
    """Nested result rows as JSON lines."""
    df.write.mode("overwrite").json(path)


def append_history(history: DataFrame, path: str) -> None:
    history.write.mode("append").parquet(path)


def save_model(
    model: PipelineModel,
    path: str,
    spark: SparkSession,
    metadata: dict,
    means: dict[str, float] | None = None,
) -> None:
    """Fitted pipeline, one-row metadata, and the feature means explanations need."""
    model.write().overwrite().save(f"{path}/model")
    facts = {k: str(v) for k, v in metadata.items()}
    spark.createDataFrame([(facts,)], "metadata map<string,string>").write.mode(
        "overwrite"
    ).parquet(f"{path}/metadata")
    if means is not None:
        spark.createDataFrame(
            [(k, float(v)) for k, v in means.items()], "feature string, mean double"
        ).coalesce(1).write.mode("overwrite").parquet(f"{path}/background")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, dict, dict[str, float]]:
    """(model, metadata, feature means); means are empty if none were stored."""
    model = PipelineModel.load(f"{path}/model")
    facts = spark.read.parquet(f"{path}/metadata").first()["metadata"]
    stored = _existing(spark, f"{path}/background")
    means = {r["feature"]: r["mean"] for r in stored.collect()} if stored is not None else {}
    return model, facts, means


RUN_SCHEMA = (
    "run_id string, family string, tags map<string,string>, params map<string,string>, "
    "metrics map<string,double>, version int"
)


def log_run(
    spark: SparkSession,
    path: str,
    family: str,
    params: dict,
    metrics: dict,
    tags: dict | None = None,
    register: bool = False,
) -> str:
    """Append one training run; a registered run gets the next version number.

    Numbers are never given twice: a writer that another one overtook looks again.
    """
    while True:
        seen = commits.version(spark, path)
        number = None
        if register:
            last = commits.read_committed(spark, path, RUN_SCHEMA, seen).agg(F.max("version")).first()[0]
            number = (last or 0) + 1
        run_id = uuid.uuid4().hex
        row = (
            run_id,
            family,
            {k: str(v) for k, v in (tags or {}).items()},
            {k: str(v) for k, v in params.items()},
            {k: float(v) for k, v in metrics.items() if v is not None},
            number,
        )
        name, _ = commits.stage(spark.createDataFrame([row], RUN_SCHEMA).coalesce(1), path)
        try:
            commits.publish(spark, path, name, 1, seen)
        except commits.LateWriter:
            continue
        return run_id


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return commits.read_committed(spark, path, RUN_SCHEMA).drop("_version")
