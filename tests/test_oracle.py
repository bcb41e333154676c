"""Every registered query against its DuckDB oracle at sf0.001 (rows, columns, values)."""

import datetime as dt
import math
import os
from collections import Counter

import pytest

import __spark_entry__ as E
from pumpguard.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
NAMES = sorted(set(QUERIES) & set(E.oracle_sql()))


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in ("events",):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    sev = Counter(r["severity"] for r in rows)
    assert sev == {"low": 16, "medium": 1, "high": 1}


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    sql = E.oracle_sql()[name]
    res = duck.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _bag(cols, rows) == _bag(ocols, orows)
