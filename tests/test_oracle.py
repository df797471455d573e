"""Every query with SQL against DuckDB, as the driver compares them."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from orestead import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def _plain(v):
    return None if v is None or v != v else round(v, 6) if isinstance(v, float) else v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(name, spark, db):
    df = registry.queries()[name](spark, SF)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    found = db.execute(registry.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == _rows(columns, found.fetchall())
    assert got
