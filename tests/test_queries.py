"""Every registered query of the library proper against its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pytest

from millrace.plans import load

SF = "/root/testdata/sf0.001"
REGISTRY = load()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in REGISTRY.TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return "~"
    if isinstance(x, bool) or not isinstance(x, int | float):
        return str(x)
    return repr(round(float(x), 6) + 0.0)


def table(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(REGISTRY.QUERIES))
def test_query(spark, duck, name):
    got = REGISTRY.QUERIES[name](spark, SF)
    rows = [tuple(r) for r in got.collect()]
    if name not in REGISTRY.ORACLES:
        assert len(got.columns) > 0
        return
    want = duck.sql(REGISTRY.ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert table(rows, got.columns) == table(want.fetchall(), want.columns)
