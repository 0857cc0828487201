"""Adapters from the given star-schema tables to the inputs of the operators.

The customer file this engine is made for is not part of the given data, so the same
21 columns are derived from ``customer`` and ``orders`` with integer and decimal
arithmetic only (see FIXTURES.md).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.sources.contract import ADDON_COLUMNS, TELCO

# Columns the queries use; a given schema saves the footer job of schema inference.
SCHEMAS = {
    "customer": "c_custkey long, c_nationkey int, c_mktsegment string",
    "orders": "o_custkey long, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string",
    "events": "event_id long, event_type string",
    "documents": "doc_id long, lang string, n_chars long",
    "labels": "doc_id long, quality int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw customer rows: one per ``customer``, activity aggregated from ``orders``."""
    orders = table(spark, sf_dir, "orders")
    # one row per customer leaves the map side, so a customer holding most orders is no hot key
    activity = orders.groupBy("o_custkey").agg(
        F.count("*").alias("n"), F.max("o_orderdate").alias("last_order")
    )
    latest = orders.agg(F.max("o_orderdate")).scalar()
    addons = [
        f"CASE WHEN internet = 'No' THEN 'No internet service' "
        f"WHEN (k * {7 + 2 * i}) % 11 < 4 THEN 'Yes' ELSE 'No' END AS {name}"
        for i, name in enumerate(ADDON_COLUMNS)
    ]
    return (
        table(spark, sf_dir, "customer")
        .join(activity, F.col("c_custkey") == F.col("o_custkey"), "left")
        .withColumn("latest", latest)
        .selectExpr(
            "c_custkey AS k",
            "c_nationkey AS nation",
            "coalesce(n, 0) AS n",
            "last_order IS NULL OR datediff(latest, last_order) > 365 AS lapsed",
            "CAST((c_custkey * 31) % 73 AS INT) AS tenure",
            "CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'Fiber optic' "
            "WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 'DSL' ELSE 'No' END AS internet",
            "CAST(CAST(1800 + (c_custkey * 7919) % 10000 AS DECIMAL(12,0)) "
            "* CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS monthly",
        )
        .selectExpr(
            "CAST(k AS STRING) AS customerID",
            "IF(k % 2 = 0, 'Female', 'Male') AS gender",
            "CAST(IF(k % 6 = 0, 1, 0) AS SMALLINT) AS SeniorCitizen",
            "IF(nation % 2 = 0, 'Yes', 'No') AS Partner",
            "IF(nation % 3 = 0, 'Yes', 'No') AS Dependents",
            "tenure",
            "IF(k % 10 = 0, 'No', 'Yes') AS PhoneService",
            "CASE WHEN k % 10 = 0 THEN 'No phone service' WHEN k % 3 = 0 THEN 'Yes' "
            "ELSE 'No' END AS MultipleLines",
            "internet AS InternetService",
            *addons,
            "CASE WHEN n <= 8 THEN 'Month-to-month' WHEN n <= 11 THEN 'One year' "
            "ELSE 'Two year' END AS Contract",
            "IF(k % 5 < 3, 'Yes', 'No') AS PaperlessBilling",
            "CASE k % 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check' "
            "WHEN 2 THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END "
            "AS PaymentMethod",
            "monthly AS MonthlyCharges",
            "IF(tenure = 0, ' ', CAST(CAST(monthly * tenure AS DECIMAL(12,2)) AS STRING)) "
            "AS TotalCharges",
            "IF(lapsed, 'Yes', 'No') AS Churn",
        )
        .select(*TELCO.names)
    )


def scored_lineitems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest table as (label, score, slice) rows for order-free metrics."""
    number = (F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729) % 100003
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        (number.cast("double") / F.lit(100003.0)).alias("score"),
        F.col("l_linestatus").alias("linestatus"),
    )


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents: small, imbalanced, with natural slices."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id").select(
        "doc_id",
        F.col("quality").cast("int").alias("label"),
        ((F.col("n_chars") % 1009).cast("double") / F.lit(1009.0)).alias("score"),
        "lang",
    )
