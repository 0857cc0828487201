"""Contract checks on tables and records, and reconciliation checks on the clean view."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.numeric import rate
from holdfast.operators.silver import ADDON_NAMES
from holdfast.sources.contract import TELCO, Contract, Rule


class ContractViolation(ValueError):
    """Data that must not be processed further."""


def _long(row_exprs: list[tuple[dict, Column]]) -> list[Column]:
    """(labels, value) pairs as an array of structs, to turn one wide row into many."""
    return [
        F.struct(*(F.lit(v).alias(k) for k, v in labels.items()), value.alias("violations"))
        for labels, value in row_exprs
    ]


def _unstack(wide: DataFrame, cells: list[tuple[dict, Column]]) -> DataFrame:
    """One output row per cell of a single aggregated row."""
    return wide.select(F.explode(F.array(*_long(cells))).alias("r")).select("r.*")


def missing_columns(df: DataFrame, contract: Contract = TELCO) -> list[str]:
    return [n for n in contract.names if n not in df.columns]


def unknown_columns(df: DataFrame, contract: Contract = TELCO) -> list[str]:
    return [n for n in df.columns if n not in contract.names]


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of each key, counted after a map-side combine."""
    per_key = df.groupBy(key).agg(F.count("*").alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.count("*").alias("distinct_keys"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def _domain(rule: Rule, column: Column) -> Column | None:
    return column.isin(*rule.allowed) if rule.allowed else None


def table_rules(contract: Contract = TELCO) -> list[tuple[dict, Column]]:
    """(labels, holds) pairs of the rules a stored table must meet.

    As in SQL, a CHECK whose value is NULL passes; NOT NULL is its own rule.
    """
    rules: list[tuple[dict, Column]] = []
    for rule in contract.rules:
        column = F.col(rule.name)
        if not rule.nullable:
            rules.append(({"rule": "not_null", "column": rule.name}, column.isNotNull()))
        if rule.in_table and rule.allowed:
            rules.append(({"rule": "domain", "column": rule.name}, _domain(rule, column)))
        if rule.in_table and rule.low is not None:
            rules.append(({"rule": "minimum", "column": rule.name}, column >= rule.low))
    return rules


def _counters(checks: list[tuple[dict, Column]]) -> list[Column]:
    return [F.count_if(broken).alias(f"n{i}") for i, (_, broken) in enumerate(checks)]


def _report(df: DataFrame, checks: list[tuple[dict, Column]]) -> DataFrame:
    """Violations per check: all counters in one aggregate over one scan."""
    wide = df.agg(*_counters(checks))
    return _unstack(wide, [(labels, F.col(f"n{i}")) for i, (labels, _) in enumerate(checks)])


def _broken(rules: list[tuple[dict, Column]]) -> list[tuple[dict, Column]]:
    return [(labels, ~F.coalesce(holds, F.lit(True))) for labels, holds in rules]


def constraint_report(df: DataFrame, contract: Contract = TELCO) -> DataFrame:
    """Violations of every NOT NULL and CHECK rule."""
    return _report(df, _broken(table_rules(contract)))


def _missing_checks(df: DataFrame) -> list[tuple[dict, Column]]:
    """NULLs of every column, and blank strings, which IS NULL does not see."""
    text = [c for c, t in df.dtypes if t == "string"]
    nulls = [({"rule": "null", "column": c}, F.col(c).isNull()) for c in df.columns]
    blanks = [
        ({"rule": "blank", "column": c}, F.trim(F.col(c)) == "" if c in text else F.lit(False))
        for c in df.columns
    ]
    return nulls + blanks


def null_blank_report(df: DataFrame) -> DataFrame:
    """NULLs of every column and blank strings of every text column, one row per column."""
    found = _report(df, _missing_checks(df))

    def of(rule: str) -> Column:
        return F.max(F.when(F.col("rule") == rule, F.col("violations")))

    return found.groupBy("column").agg(of("null").alias("nulls"), of("blank").alias("blanks"))


def class_balance_of(df: DataFrame, contract: Contract = TELCO) -> DataFrame:
    positive = F.col(contract.target) == contract.positive
    return df.agg(
        F.count("*").alias("rows"),
        F.round(rate(positive), 4).alias("positive_rate"),
        F.round(1 - rate(positive), 4).alias("negative_rate"),
    )


def unexpected_values(df: DataFrame, column: str, allowed: tuple) -> DataFrame:
    """Each value outside the domain with its row count; NULL is not a value."""
    value = F.col(column)
    return (
        df.where(value.isNotNull() & ~value.isin(*allowed))
        .groupBy(value.cast("string").alias("value"))
        .agg(F.count("*").alias("rows"))
    )


def check_table(
    df: DataFrame, contract: Contract = TELCO, expected_rows: int | None = None
) -> DataFrame:
    """``rule, column, severity, violations`` for the whole table contract.

    Hard rules: shape, unique key, target domain, NOT NULL and CHECK. Soft rules: NULLs
    and blank strings, which are reported but do not stop a load.
    """
    absent = missing_columns(df, contract)
    if absent:
        raise ContractViolation(f"required columns absent: {absent}")
    hard = [({**labels, "severity": "hard"}, b) for labels, b in _broken(table_rules(contract))]
    soft = [({**labels, "severity": "soft"}, b) for labels, b in _missing_checks(df)]
    keys = duplicate_keys(df, contract.id_column)
    off_by = (
        F.abs(F.col("rows") - F.lit(expected_rows))
        if expected_rows is not None
        else F.lit(0).cast("bigint")
    )
    n_columns = abs(len(df.columns) - len(contract.rules))
    shape = [
        ({"rule": "row_count", "column": "*", "severity": "hard"}, off_by),
        (
            {"rule": "column_count", "column": "*", "severity": "hard"},
            F.lit(n_columns).cast("bigint"),
        ),
        (
            {"rule": "unique", "column": contract.id_column, "severity": "hard"},
            F.col("duplicate_rows"),
        ),
    ]
    return (
        _report(df, hard + soft)
        .unionByName(_unstack(keys, shape))
        .select("rule", "column", "severity", "violations")
    )


def require_contract(
    df: DataFrame, contract: Contract = TELCO, expected_rows: int | None = None
) -> None:
    """Raise if any hard rule is broken. Collects only the broken rules, never rows."""
    broken = (
        check_table(df, contract, expected_rows)
        .where((F.col("severity") == "hard") & (F.col("violations") > 0))
        .collect()
    )
    if broken:
        named = ", ".join(f"{r['rule']}({r['column']})={r['violations']}" for r in broken)
        raise ContractViolation(f"table contract broken: {named}")


# ------------------------------------------------------------------ single records


def record_errors(contract: Contract = TELCO) -> Column:
    """Names of the fields of a record that are missing, out of domain or out of range."""

    def bad(rule: Rule) -> Column:
        value = F.col(rule.name)
        if rule.numeric_text:
            value = F.trim(value.cast("string")).try_cast("double")
            value = F.when(F.isnan(value), None).otherwise(value)
        holds = F.lit(True)
        if rule.allowed:
            holds = holds & value.isin(*rule.allowed)
        if rule.low is not None:
            holds = holds & (value >= rule.low)
        if rule.high is not None:
            holds = holds & (value <= rule.high)
        return F.when(value.isNull() | ~holds, F.lit(rule.name))

    return F.array_compact(F.array(*(bad(r) for r in contract.record_rules)))


def with_record_errors(df: DataFrame, contract: Contract = TELCO) -> DataFrame:
    absent = [r.name for r in contract.record_rules if r.name not in df.columns]
    if absent:
        raise ContractViolation(f"records lack fields: {absent}")
    return df.withColumn("errors", record_errors(contract))


def split_valid(df: DataFrame, contract: Contract = TELCO) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantine): every record lands in exactly one; no row is dropped."""
    checked = with_record_errors(df, contract)
    accepted = checked.where(F.size("errors") == 0).drop("errors")
    return accepted, checked.where(F.size("errors") > 0)


def require_known_columns(df: DataFrame, contract: Contract = TELCO) -> None:
    extra = unknown_columns(df, contract)
    if extra:
        raise ContractViolation(f"unknown fields: {extra}")


def unknown_json_fields(text: Column, contract: Contract = TELCO) -> Column:
    """Keys of a JSON record that the contract does not know."""
    known = F.array(*(F.lit(n) for n in contract.names))
    return F.array_except(F.json_object_keys(text), known)


def require_rows(df: DataFrame) -> None:
    if df.isEmpty():
        raise ContractViolation("an empty batch cannot be scored")


# ------------------------------------------------------------------ reconciliation


def rate_reconciliation(raw: DataFrame, clean: DataFrame, contract: Contract = TELCO) -> DataFrame:
    """Positive rate before and after cleaning, side by side."""
    raw_rate = raw.agg(rate(F.col(contract.target) == contract.positive).alias("raw_rate"))
    clean_rate = clean.agg(rate(F.col("has_churned")).alias("clean_rate")).scalar()
    return raw_rate.select(
        F.round("raw_rate", 6).alias("raw_rate"), F.round(clean_rate, 6).alias("clean_rate")
    )


def leftover_categories(clean: DataFrame) -> DataFrame:
    """Rows where a collapsed text survived cleaning."""
    addons = [F.col(n) for n in ADDON_NAMES.values()]
    left = reduce(or_, (c == "No internet service" for c in addons)) | (
        F.col("multiple_lines") == "No phone service"
    )
    return clean.agg(F.count_if(left).alias("leftovers"))


def uniqueness(df: DataFrame, key: str) -> DataFrame:
    """COUNT against COUNT DISTINCT, through a two-step aggregate on the key."""
    counts = duplicate_keys(df, key)
    return counts.select(F.col("rows").alias("total"), F.col("distinct_keys").alias("distinct_ids"))


def sanity_checks(clean: DataFrame) -> DataFrame:
    """Range of the add-on count, and zero charges with the tenure that explains them."""
    zero = F.col("total_charges") == 0
    return clean.agg(
        F.min("addon_service_count").alias("addon_min"),
        F.max("addon_service_count").alias("addon_max"),
        F.count_if(zero).alias("zero_charge"),
        F.count_if(zero & (F.col("tenure_months") == 0)).alias("also_zero_tenure"),
    )
