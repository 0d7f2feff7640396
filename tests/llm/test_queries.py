"""The SQL of the llm queries on the sf0.001 tables, and what the registry holds."""

import os

import duckdb
import pytest

from __spark_entry__ import queries
from tapecraft.llm.queries import LLM_ORACLES, LLM_QUERIES

SF = "/root/testdata/sf0.001"


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in order) for r in records), key=repr)


def test_one_query_for_each_operator():
    assert [n.split("_")[0] for n in LLM_QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(LLM_QUERIES) | {"pipeline"} <= set(queries())


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "labels"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    df = LLM_QUERIES[name](spark, SF)
    found = duck.execute(LLM_ORACLES[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, found.fetchall())
