"""The contract accepts what it should and names what it rejects."""

from decimal import Decimal

import pytest
from conftest import customer, unserved
from pyspark.sql import functions as F

from holdfast.operators import quality as Q
from holdfast.sources.contract import TELCO


def violations(df, **options):
    found = Q.check_table(df, **options).where("violations > 0").collect()
    return {(r["rule"], r["column"], r["severity"]): r["violations"] for r in found}


def test_a_valid_table_has_no_hard_violation(raw):
    assert not [k for k in violations(raw) if k[2] == "hard"]
    Q.require_contract(raw)


def test_blank_totals_are_soft_and_equal_zero_tenure(raw):
    found = violations(raw)
    zero = raw.where("tenure = 0").count()
    assert zero > 0
    assert found == {("blank", "TotalCharges", "soft"): zero}


@pytest.mark.parametrize(
    ("change", "rule"),
    [
        ({"Churn": "Maybe"}, ("domain", "Churn", "hard")),
        ({"SeniorCitizen": 2}, ("domain", "SeniorCitizen", "hard")),
        ({"tenure": -5}, ("minimum", "tenure", "hard")),
        ({"Contract": "Three year"}, ("domain", "Contract", "hard")),
        ({"InternetService": "Fibre"}, ("domain", "InternetService", "hard")),
        ({"gender": None}, ("not_null", "gender", "hard")),
    ],
)
def test_each_hard_rule_is_named(table_of, change, rule):
    df = table_of(customer(customerID="1"), customer(customerID="2", **change))
    assert violations(df)[rule] == 1
    with pytest.raises(Q.ContractViolation, match=rule[1]):
        Q.require_contract(df)


def test_null_in_a_checked_column_breaks_not_null_only(table_of):
    found = violations(table_of(customer(Contract=None)))
    assert ("not_null", "Contract", "hard") in found
    assert ("domain", "Contract", "hard") not in found


def test_shape_and_duplicate_keys(table_of):
    df = table_of(customer(customerID="1"), customer(customerID="1"), customer(customerID="1"))
    found = violations(df, expected_rows=7)
    assert found[("unique", "customerID", "hard")] == 2
    assert found[("row_count", "*", "hard")] == 4
    with pytest.raises(Q.ContractViolation, match="unique"):
        Q.require_contract(df)
    wider = df.withColumn("extra", F.lit(1))
    assert violations(wider)[("column_count", "*", "hard")] == 1


def test_missing_and_unknown_columns(table_of):
    df = table_of(customer())
    with pytest.raises(Q.ContractViolation, match="Churn"):
        Q.check_table(df.drop("Churn"))
    with pytest.raises(Q.ContractViolation, match="Tenure2"):
        Q.require_known_columns(df.withColumn("Tenure2", F.lit(5)))
    Q.require_known_columns(df)


def test_unexpected_values_are_listed(table_of):
    df = table_of(
        customer(customerID="1", Churn="Maybe"),
        customer(customerID="2", Churn="Maybe"),
        customer(customerID="3", Churn=None),
        customer(customerID="4"),
    )
    found = Q.unexpected_values(df, "Churn", ("Yes", "No")).collect()
    assert [(r["value"], r["rows"]) for r in found] == [("Maybe", 2)]


@pytest.mark.parametrize(
    ("change", "field"),
    [
        ({"InternetService": "Fibre"}, "InternetService"),
        ({"tenure": -5}, "tenure"),
        ({"tenure": 201}, "tenure"),
        ({"MonthlyCharges": Decimal("1000.01")}, "MonthlyCharges"),
        ({"TotalCharges": "abc"}, "TotalCharges"),
        ({"TotalCharges": "100000.5"}, "TotalCharges"),
        ({"TotalCharges": "NaN"}, "TotalCharges"),
        ({"Contract": None}, "Contract"),
    ],
)
def test_records_are_quarantined_with_the_field(table_of, change, field):
    df = table_of(customer(customerID="good"), customer(customerID="bad", **change))
    accepted, rejected = Q.split_valid(df)
    assert [r["customerID"] for r in accepted.collect()] == ["good"]
    assert [(r["customerID"], r["errors"]) for r in rejected.collect()] == [("bad", [field])]


def test_every_record_lands_in_exactly_one_output(raw):
    accepted, rejected = Q.split_valid(raw)
    assert accepted.count() + rejected.count() == raw.count()
    assert rejected.count() == raw.where("tenure = 0").count()


def test_several_errors_are_all_reported(table_of):
    bad = table_of(unserved(gender="X", tenure=300, TotalCharges="5"))
    errors = Q.with_record_errors(bad).first()["errors"]
    assert errors == ["gender", "tenure"]


def test_an_empty_batch_is_refused(table_of):
    df = table_of(customer())
    Q.require_rows(df)
    with pytest.raises(Q.ContractViolation):
        Q.require_rows(df.where("tenure > 999"))


def test_schema_follows_the_contract():
    assert len(TELCO.names) == 21
    assert TELCO.schema["TotalCharges"].dataType.simpleString() == "string"
    assert TELCO.schema["MonthlyCharges"].dataType.simpleString() == "decimal(10,2)"
