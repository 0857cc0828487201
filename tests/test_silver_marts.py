"""The cleaned view and the marts: edge rows and reconciliation."""

from decimal import Decimal

import pytest
from conftest import customer, unserved
from pyspark.sql import functions as F

from holdfast.operators import marts, quality
from holdfast.operators.silver import silver_customers


@pytest.fixture(scope="module")
def v(raw):
    return silver_customers(raw).cache()


def test_awkward_texts_become_plain(table_of):
    row = silver_customers(table_of(unserved())).first()
    assert row["total_charges"] == Decimal("0.00")
    assert row["multiple_lines"] == "No"
    assert {row[c] for c in ("online_security", "tech_support", "streaming_movies")} == {"No"}
    assert row["addon_service_count"] == 0
    assert row["has_internet"] is False
    assert row["annual_revenue"] == Decimal("300.00")


def test_text_that_is_no_number_fails_the_strict_view(table_of):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        silver_customers(table_of(customer(TotalCharges="abc"))).collect()


@pytest.mark.parametrize(
    ("tenure", "band"),
    [(0, "0-6mo"), (6, "0-6mo"), (7, "7-12mo"), (12, "7-12mo"), (24, "13-24mo"), (48, "25-48mo"),
     (49, "49mo+"), (500, "49mo+"), (None, "49mo+")],
)
def test_bands_are_right_closed_and_open_ended(table_of, tenure, band):
    assert silver_customers(table_of(customer(tenure=tenure))).first()["tenure_band"] == band


def test_nulls_follow_sql_rules(table_of):
    row = silver_customers(table_of(customer(InternetService=None, PaymentMethod=None))).first()
    assert row["has_internet"] is None
    assert row["is_automatic_payment"] is None
    upper = silver_customers(table_of(customer(PaymentMethod="Card (AUTOMATIC)"))).first()
    assert upper["is_automatic_payment"] is False


def test_cleaning_keeps_the_rate_and_leaves_nothing_behind(raw, v):
    rates = quality.rate_reconciliation(raw, v).first()
    assert rates["raw_rate"] == rates["clean_rate"]
    assert quality.leftover_categories(v).first()["leftovers"] == 0
    checks = quality.sanity_checks(v).first()
    assert 0 <= checks["addon_min"] <= checks["addon_max"] <= 6
    assert checks["zero_charge"] == checks["also_zero_tenure"]
    ids = quality.uniqueness(raw, "customerID").first()
    assert ids["total"] == ids["distinct_ids"] == raw.count()


def test_kpis_of_a_closed_form_table(table_of):
    v = silver_customers(
        table_of(
            customer(customerID="1", MonthlyCharges=Decimal("30.00"), tenure=10, Churn="Yes"),
            customer(customerID="2", MonthlyCharges=Decimal("10.00"), tenure=20, Churn="No"),
            customer(customerID="3", MonthlyCharges=Decimal("20.00"), tenure=33, Churn="No"),
        )
    )
    row = marts.kpi_summary(v).first()
    assert (row["total_customers"], row["churned_customers"]) == (3, 1)
    assert row["churn_rate"] == 0.3333
    assert row["monthly_revenue_lost"] == Decimal("30.00")
    assert row["revenue_churn_rate"] == 0.5
    assert (row["avg_tenure_months"], row["avg_tenure_churned"]) == (21.0, 10.0)


def test_kpis_without_churn_and_without_rows(table_of):
    v = silver_customers(table_of(customer(Churn="No")))
    row = marts.kpi_summary(v).first()
    assert row["churned_customers"] == 0
    assert row["monthly_revenue_lost"] is None
    assert row["avg_tenure_churned"] is None
    empty = marts.kpi_summary(v.where("false")).first()
    assert empty["total_customers"] == 0
    assert empty["revenue_churn_rate"] is None


def test_rollup_totals(v):
    rows = marts.churn_by_segment(v).collect()
    total = [r for r in rows if r["aggregation_level"] == 3]
    assert len(total) == 1
    assert total[0]["customers"] == v.count()
    assert total[0]["churn_index"] == 1.0
    assert (total[0]["contract_type"], total[0]["internet_service"]) == ("ALL CONTRACTS", "ALL SERVICES")
    leaf = [r for r in rows if r["aggregation_level"] == 0]
    assert sum(r["customers"] for r in leaf) == v.count()


def test_a_null_segment_is_not_a_subtotal(table_of):
    v = silver_customers(table_of(customer(), customer(Contract=None)))
    rows = marts.churn_by_segment(v).where("aggregation_level = 0").collect()
    assert None in {r["contract_type"] for r in rows}


def test_retention_bands_are_in_order(v):
    rows = marts.retention_curve(v).collect()
    assert [r["tenure_band"] for r in rows] == ["0-6mo", "7-12mo", "13-24mo", "25-48mo", "49mo+"]
    assert rows[0]["churn_rate_change"] is None
    assert abs(sum(r["pct_of_base"] for r in rows) - 100) < 0.5


def test_equal_losses_share_rank_and_running_share(table_of):
    v = silver_customers(
        table_of(
            customer(customerID="1", Contract="One year"),
            customer(customerID="2", Contract="Two year"),
            customer(customerID="3", MonthlyCharges=Decimal("10.00")),
            customer(customerID="4", PaymentMethod="Mailed check", Churn="No"),
        )
    )
    rows = marts.revenue_at_risk(v).collect()
    assert [r["risk_rank"] for r in rows] == [1, 1, 3]
    assert rows[0]["cumulative_pct_of_loss"] == rows[1]["cumulative_pct_of_loss"]
    assert rows[-1]["cumulative_pct_of_loss"] == 100.0


def test_risk_score_points(table_of):
    worst = customer(tenure=6)
    best = customer(
        tenure=70, Contract="Two year", InternetService="DSL", PaymentMethod="Mailed check",
        OnlineSecurity="Yes", OnlineBackup="Yes", TechSupport="Yes", StreamingTV="Yes",
    )
    v = silver_customers(table_of(worst, best)).withColumn("s", marts.risk_score())
    assert [r["s"] for r in v.collect()] == [40 + 25 + 20 + 15 + 10, 5 - 10]


def test_every_customer_has_decile_rank_and_tier(v):
    risk = marts.risk_mart(v)
    n = v.count()
    assert risk.count() == n
    assert risk.where("risk_tier IS NULL OR risk_decile NOT BETWEEN 1 AND 10").count() == 0
    sizes = [r["customers"] for r in marts.decile_summary(risk).collect()]
    assert sum(sizes) == n
    assert max(sizes) - min(sizes) <= 1
    means = [r["m"] for r in risk.groupBy("risk_decile").agg(F.avg("risk_score").alias("m")).orderBy("risk_decile").collect()]
    assert means == sorted(means, reverse=True)
    detail = marts.detail_extract(v)
    assert detail.count() == n
    assert len(detail.columns) == 31


def plan_of(df) -> list[str]:
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


@pytest.fixture(scope="module")
def uncached(spark):
    from holdfast.sources.testtables import subscribers

    return silver_customers(subscribers(spark, "/root/testdata/sf0.01"))


def test_scan_reads_only_what_a_mart_needs(uncached):
    scans = [line for line in plan_of(marts.addon_paradox(uncached)) if "FileScan" in line]
    assert scans
    assert not any("c_nationkey" in line for line in scans)
    by_contract = uncached.where("contract_type = 'One year'").groupBy("contract_type").count()
    assert not any("c_mktsegment" in line for line in plan_of(by_contract) if "FileScan" in line)


def test_no_row_grain_data_meets_in_one_partition(uncached):
    """Single partitions take only aggregated rows; the base is shuffled by cell, once."""
    plan = plan_of(marts.risk_mart(uncached))
    below = dict(zip(range(len(plan)), plan[1:], strict=False))
    for i, line in enumerate(plan):
        if "Exchange SinglePartition" in line:
            assert "HashAggregate" in below[i]
    by_key = [i for i, line in enumerate(plan) if "Exchange hashpartitioning(_cell" in line]
    row_grain = [i for i in by_key if "HashAggregate" not in below[i]]
    assert len(row_grain) == 1
