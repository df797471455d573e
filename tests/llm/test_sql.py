"""Operators that SQL can express against their SQL in DuckDB."""

from __future__ import annotations

import duckdb
import pytest

from orestead.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_sql(name, spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    found = con.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    got = queries.queries()[name](spark, SF).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(found.fetchall())
