"""Every query with SQL gives what DuckDB gives on the smallest data."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SQL = entry.oracle_sql()
CORE = [k for k in SQL if k in entry.queries()]


def _norm(v):
    return round(float(v), 6) if isinstance(v, float) or type(v).__name__ == "Decimal" else v


@pytest.fixture(scope="module")
def con(data):
    c = duckdb.connect()
    for f in sorted(os.listdir(data)):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{data}/{f}'")
    return c


@pytest.mark.parametrize("name", CORE)
def test_same(spark, data, con, name):
    df = entry.queries()[name](spark, data)
    cols = sorted(df.columns)
    got = sorted(repr(tuple(_norm(r[c]) for c in cols)) for r in df.collect())
    rel = con.sql(SQL[name])
    at = [rel.columns.index(c) for c in cols]
    want = sorted(repr(tuple(_norm(r[i]) for i in at)) for r in rel.fetchall())
    assert len(rel.columns) == len(cols)
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).columns == ["snapshot_dia", "kind", "id", "mudanca"]
