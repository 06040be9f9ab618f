"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for p in Path(sf).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


def norm(v):
    return f"{v:.12g}" if isinstance(v, float) and not math.isnan(v) else "null" if v is None else repr(v)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, sf, db, name):
    cursor = db.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    want = sorted(tuple(map(norm, r)) for r in cursor.fetchall())
    df = entry.queries()[name](spark, sf)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(tuple(map(norm, r)) for r in df.select(*columns).collect()) == want


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
