"""Registered queries against their SQL, value by value."""

from pathlib import Path

import duckdb
import pytest

from holdfast.llm.catalog import ORACLES, QUERIES

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for file in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, sf, name):
    df = QUERIES[name](spark, sf)
    found = duck.execute(ORACLES[name])
    types = {d[0]: str(d[1]) for d in found.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    want = sorted(repr(row) for row in found.fetchall())
    assert sorted(repr(tuple(r)) for r in df.select(*types).collect()) == want
