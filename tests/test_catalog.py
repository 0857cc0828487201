"""Every registered query against its SQL on the smallest tables, value by value."""

from pathlib import Path

import duckdb
import pytest

from holdfast.catalog.oracles import ORACLES
from holdfast.catalog.queries import QUERIES

SPARK_TO_SQL = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for file in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_query_equals_sql(spark, duck, sf, name):
    df = QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    found = duck.execute(ORACLES[name])
    sql_types = {d[0]: str(d[1]) for d in found.description}
    assert sorted(sql_types) == columns
    assert {c: SPARK_TO_SQL[t] for c, t in df.dtypes} == sql_types
    order = [list(sql_types).index(c) for c in columns]
    want = sorted(repr(tuple(r[i] for i in order)) for r in found.fetchall())
    rows = df.select(*(f"`{c}`" for c in columns)).collect()
    assert sorted(repr(tuple(r)) for r in rows) == want


@pytest.mark.parametrize(
    "name", ["model_scores", "coefficients", "final_evaluation", "stream_scores", "leakage_audit"]
)
def test_fitted_queries_return_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0
