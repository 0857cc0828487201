"""Aggregated marts and the rule-based customer risk mart over the cleaned view."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from holdfast.functions.numeric import is_true, rate, rate_where, ratio
from holdfast.operators.position import PRIVATE, tile, with_position

# Points of the transparent risk rules.
RISK_POINTS = {
    "contract": {"Month-to-month": 40, "One year": 10},
    "tenure": ((6, 25), (12, 15), (24, 8)),
    "internet": {"Fiber optic": 20, "DSL": 5},
    "payment": {"Electronic check": 15},
    "internet_without_addons": 10,
    "many_addons": (4, -10),
}


def _churned() -> Column:
    return is_true(F.col("has_churned"))


def _lost(amount: Column) -> Column:
    return F.sum(F.when(_churned(), amount))


def kpi_summary(v: DataFrame) -> DataFrame:
    """Headline figures: one row from one partial + final aggregate."""
    charge, tenure = F.col("monthly_charges"), F.col("tenure_months")
    totals = v.agg(
        F.count("*").alias("total_customers"),
        F.count_if(_churned()).alias("churned_customers"),
        F.round(rate(_churned()), 4).alias("churn_rate"),
        F.sum(charge).alias("total_monthly_revenue"),
        _lost(charge).alias("monthly_revenue_lost"),
        F.round(F.avg(tenure), 1).alias("avg_tenure_months"),
        F.round(F.avg(F.when(_churned(), tenure)), 1).alias("avg_tenure_churned"),
        F.count(charge).alias("_charges"),
    )
    return totals.select(
        "total_customers",
        "churned_customers",
        "churn_rate",
        "total_monthly_revenue",
        "monthly_revenue_lost",
        F.round(
            ratio(F.col("monthly_revenue_lost"), F.col("total_monthly_revenue")), 4
        ).alias("revenue_churn_rate"),
        "avg_tenure_months",
        "avg_tenure_churned",
        F.round(ratio(F.col("total_monthly_revenue"), F.col("_charges")), 2).alias(
            "avg_monthly_charges"
        ),
    )


def churn_by_segment(
    v: DataFrame,
    dims: Sequence[str] = ("contract_type", "internet_service"),
    total_labels: Sequence[str] = ("ALL CONTRACTS", "ALL SERVICES"),
) -> DataFrame:
    """Segments with subtotals and grand total from one ROLLUP.

    The company-wide rate of the index is the grand-total row of the same rollup, read
    over the few aggregated rows: the base is scanned once, not twice. A segment whose
    value is NULL keeps NULL; only subtotal rows get the ALL labels.
    """
    level = F.grouping_id()
    rolled = v.rollup(*dims).agg(
        level.alias("aggregation_level"),
        *(F.grouping(d).alias(f"_all_{d}") for d in dims),
        F.count("*").alias("customers"),
        F.count_if(_churned()).alias("churned"),
        rate(_churned()).alias("_rate"),
        (_lost(F.col("monthly_charges")) * 12).alias("annual_revenue_at_risk"),
    )
    is_total = F.col("aggregation_level") == 2 ** len(dims) - 1
    total = {
        f"_total_{c}": F.max(F.when(is_total, F.col(c))).over(Window.partitionBy())
        for c in ("customers", "churned")
    }
    # rate over overall rate as one quotient of products, exact where the result is a tie
    index = ratio(
        F.col("churned") * F.col("_total_customers"), F.col("customers") * F.col("_total_churned")
    )
    return (
        rolled.withColumns(total)
        .select(
            *(
                F.when(F.col(f"_all_{d}") == 1, label).otherwise(F.col(d)).alias(d)
                for d, label in zip(dims, total_labels, strict=True)
            ),
            F.col("aggregation_level").cast("int").alias("aggregation_level"),
            "customers",
            "churned",
            F.round("_rate", 4).alias("churn_rate"),
            "annual_revenue_at_risk",
            F.round(index, 2).alias("churn_index"),
        )
        .orderBy("aggregation_level", F.col("churn_rate").desc_nulls_first(), *dims)
    )


def top_segments(segments: DataFrame, n: int = 6) -> DataFrame:
    """Leaf rows of the rollup with the highest churn rate."""
    return (
        segments.where(F.col("aggregation_level") == 0)
        .orderBy(F.col("churn_rate").desc(), "contract_type", "internet_service")
        .limit(n)
    )


def retention_curve(v: DataFrame) -> DataFrame:
    """Churn by tenure band; the windows run over one row per band."""
    bands = v.groupBy("tenure_band").agg(
        F.min("tenure_months").alias("band_start"),
        F.count("*").alias("customers"),
        rate(_churned()).alias("_rate"),
        F.sum("monthly_charges").alias("monthly_revenue"),
    )
    previous = F.lag("_rate").over(Window.orderBy("band_start"))
    base = F.sum("customers").over(Window.partitionBy())
    return bands.select(
        "tenure_band",
        "customers",
        F.round("_rate", 4).alias("churn_rate"),
        F.round(1 - F.col("_rate"), 4).alias("retention_rate"),
        "monthly_revenue",
        F.round(F.col("_rate") - previous, 4).alias("churn_rate_change"),
        F.round(F.col("customers") * 100.0 / base, 1).alias("pct_of_base"),
        "band_start",
    ).orderBy("band_start").drop("band_start")


def revenue_at_risk(
    v: DataFrame, dims: Sequence[str] = ("contract_type", "payment_method")
) -> DataFrame:
    """Segments ranked by yearly revenue lost, with the running share of all loss.

    Equal losses share one rank and one running share (RANGE frame). Segments without
    loss are removed before the windows.
    """
    lost = F.col("annual_revenue_lost")
    by_loss = Window.orderBy(lost.desc())
    segments = (
        v.groupBy(*dims)
        .agg(
            F.count("*").alias("customers"),
            F.count_if(_churned()).alias("churned"),
            F.round(rate(_churned()), 4).alias("churn_rate"),
            _lost(F.col("monthly_charges") * 12).alias("annual_revenue_lost"),
        )
        .where(lost > 0)
    )
    running = F.sum(lost).over(by_loss)  # default frame: RANGE up to the current row
    return segments.select(
        *dims,
        "customers",
        "churned",
        "churn_rate",
        "annual_revenue_lost",
        F.rank().over(by_loss).alias("risk_rank"),
        F.round(
            ratio(running, F.sum(lost).over(Window.partitionBy())) * 100.0, 1
        ).alias("cumulative_pct_of_loss"),
    ).orderBy(lost.desc(), *dims)


def addon_paradox(
    v: DataFrame, factor: str = "addon_service_count", confounder: str = "has_internet"
) -> DataFrame:
    """Churn per factor value overall and conditioned on a boolean confounder."""
    yes, no = is_true(F.col(confounder)), is_true(~F.col(confounder))
    return (
        v.groupBy(factor)
        .agg(
            F.count("*").alias("customers_all"),
            F.round(rate(_churned()), 4).alias("churn_rate_all"),
            F.count_if(yes).alias("customers_with_internet"),
            F.round(rate_where(_churned(), yes), 4).alias("churn_rate_with_internet"),
            F.count_if(no).alias("customers_no_internet"),
            F.round(rate_where(_churned(), no), 4).alias("churn_rate_no_internet"),
        )
        .orderBy(factor)
    )


def risk_score(points: dict = RISK_POINTS) -> Column:
    """Sum of rule points as one integer expression; few distinct values by construction."""

    def lookup(column: str, table: dict) -> Column:
        expr = F.lit(0)
        for value, gain in table.items():
            expr = F.when(F.col(column) == value, gain).otherwise(expr)
        return expr

    tenure = F.lit(0)
    for upper, gain in reversed(points["tenure"]):
        tenure = F.when(F.col("tenure_months") <= upper, gain).otherwise(tenure)
    least, change = points["many_addons"]
    addons = F.col("addon_service_count")
    return (
        lookup("contract_type", points["contract"])
        + tenure
        + lookup("internet_service", points["internet"])
        + lookup("payment_method", points["payment"])
        + F.when((addons == 0) & F.col("has_internet"), points["internet_without_addons"])
        .otherwise(0)
        + F.when(addons >= least, change).otherwise(0)
    )


def customer_risk(
    v: DataFrame, points: dict = RISK_POINTS, tiles: int = 10, seed: int = 0
) -> DataFrame:
    """Score, decile, rank and tier for every customer; other columns pass through.

    Customers with equal scores are spread over deciles by the digest of their id.
    """
    scored = v.withColumn("risk_score", risk_score(points))
    placed = with_position(
        scored, "customer_id", order=[("risk_score", "desc")], seed=seed, names=PRIVATE
    )
    decile = tile(F.col("_position"), F.col("_group_rows"), tiles)
    return (
        placed.withColumn("risk_decile", decile)
        .withColumn("risk_rank", F.col("_level_start") + 1)
        .withColumn(
            "risk_tier",
            F.when(F.col("risk_decile") == 1, "high")
            .when(F.col("risk_decile") <= 3, "medium")
            .otherwise("low"),
        )
        .drop(*PRIVATE)
    )


# Columns of the risk mart and of the detail extract, in output order.
RISK_COLUMNS = (
    "customer_id",
    "contract_type",
    "internet_service",
    "payment_method",
    "tenure_months",
    "tenure_band",
    "monthly_charges",
    "annual_revenue",
    "addon_service_count",
    "risk_score",
    "risk_decile",
    "risk_rank",
    "risk_tier",
    "has_churned",
)
DETAIL_COLUMNS = (
    "customer_id",
    "gender",
    "is_senior",
    "has_partner",
    "has_dependents",
    "tenure_months",
    "tenure_band",
    "contract_type",
    "internet_service",
    "payment_method",
    "is_automatic_payment",
    "paperless_billing",
    "phone_service",
    "multiple_lines",
    "online_security",
    "online_backup",
    "device_protection",
    "tech_support",
    "streaming_tv",
    "streaming_movies",
    "addon_service_count",
    "has_internet",
    "monthly_charges",
    "total_charges",
    "annual_revenue",
    "risk_score",
    "risk_decile",
    "risk_rank",
    "risk_tier",
)


def risk_mart(v: DataFrame) -> DataFrame:
    return customer_risk(v).select(*RISK_COLUMNS)


def detail_extract(v: DataFrame) -> DataFrame:
    """Cleaned attributes plus risk columns, one row per customer.

    Both halves come from the same rows, so the risk columns are computed in place
    instead of joining the view with itself.
    """
    lost = F.when(_churned(), F.col("annual_revenue")).otherwise(F.lit(0).cast("decimal(10,2)"))
    return customer_risk(v).select(
        *DETAIL_COLUMNS,
        F.when(_churned(), "Yes").otherwise("No").alias("churned"),
        lost.alias("annual_revenue_lost"),
    )


def decile_summary(risk: DataFrame) -> DataFrame:
    """Size, observed churn and revenue per decile."""
    return (
        risk.groupBy("risk_decile")
        .agg(
            F.count("*").alias("customers"),
            F.round(rate(_churned()), 4).alias("actual_churn_rate"),
            F.round(F.sum("annual_revenue"), 0).alias("annual_revenue"),
        )
        .orderBy("risk_decile")
    )
