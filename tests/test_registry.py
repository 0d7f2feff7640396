"""Every registered query against its DuckDB oracle on the sf0.001 tables,
and the driver entry point."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tapecraft.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["events"]

pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES) and len(QUERIES) >= 50
    assert set(oracle_sql()) <= set(queries()) and set(QUERIES) <= set(queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _rows(s_cols, s_rows) == _rows(d_cols, d_rows)


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "volatility_regime" in df.columns
