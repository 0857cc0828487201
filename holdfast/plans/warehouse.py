"""Bronze, silver and gold layers in dependency order, and the jobs that read them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from holdfast.operators import marts
from holdfast.operators.silver import silver_customers
from holdfast.sources.readers import ask
from holdfast.sources.writers import export_csv

# Names of the exported marts.
MARTS = ("kpi_summary", "churn_by_segment", "retention_curve", "revenue_at_risk", "addon_paradox")


def build_layers(spark: SparkSession, raw: DataFrame) -> dict[str, DataFrame]:
    """Register every layer as a temp view; nothing runs until a view is read."""
    v = silver_customers(raw)
    layers = {
        "raw_customers": raw,
        "v_customers": v,
        "v_kpi_summary": marts.kpi_summary(v),
        "v_churn_by_segment": marts.churn_by_segment(v),
        "v_retention_curve": marts.retention_curve(v),
        "v_revenue_at_risk": marts.revenue_at_risk(v),
        "v_addon_paradox": marts.addon_paradox(v),
        "v_customer_risk": marts.risk_mart(v),
        "v_customer_detail": marts.detail_extract(v),
    }
    for name, df in layers.items():
        df.createOrReplaceTempView(name)
    return layers


def report(spark: SparkSession) -> dict[str, DataFrame]:
    """The six sections of the warehouse report, read from the registered views."""
    return {
        "kpis": ask(spark, "SELECT * FROM v_kpi_summary"),
        "segments": ask(
            spark,
            "SELECT contract_type, internet_service, customers, churn_rate, "
            "annual_revenue_at_risk, churn_index FROM v_churn_by_segment "
            "WHERE aggregation_level = 0 "
            "ORDER BY churn_rate DESC, contract_type, internet_service LIMIT 6",
        ),
        "retention": ask(spark, "SELECT * FROM v_retention_curve"),
        "revenue": ask(
            spark,
            "SELECT * FROM v_revenue_at_risk "
            "ORDER BY annual_revenue_lost DESC, contract_type, payment_method LIMIT 5",
        ),
        "paradox": ask(spark, "SELECT * FROM v_addon_paradox"),
        "deciles": marts.decile_summary(spark.table("v_customer_risk")),
    }


def export_all(spark: SparkSession, raw: DataFrame, path: str) -> dict[str, str]:
    """Detail table and marts as CSV folders for BI tools."""
    layers = build_layers(spark, raw)
    chosen = {"customers": layers["v_customer_detail"]}
    chosen |= {name: layers[f"v_{name}"] for name in MARTS}
    return export_csv(chosen, path)
