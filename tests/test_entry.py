"""Driver contract: entry smoke, key coverage, and every query against its oracle at sf0.001."""

import datetime as dt
import decimal
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from routeflow.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["route_key", "origin_airport"]


def test_every_query_has_oracle():
    assert set(catalog.queries()) <= set(entry.oracle_sql())
    assert set(catalog.queries()) <= set(entry.queries())


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.date, dt.datetime)):
        return str(v)
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
@pytest.mark.parametrize("key", sorted(catalog.queries()))
def test_query_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SF)
    res = duck.execute(entry.oracle_sql()[key])
    d_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert _bag(df.columns, [tuple(r) for r in df.collect()]) == _bag(d_cols, res.fetchall())
