"""DQ report: the 17 checks pass on good data and each fails alone on a
seeded bad row (FIXTURES H16)."""

import pytest
from conftest import WINDOW_MS, make_trades
from pyspark.sql import functions as F

from tapecraft.operators.bars import minute_bars, minute_bars_stream
from tapecraft.operators.clean import clean_trades
from tapecraft.operators.quality import GOLD_CHECKS, dq_report
from tapecraft.plans import gold as G


@pytest.fixture(scope="module")
def tables(spark):
    rows = [("BTCUSDT", i, str(100 + i), "1", WINDOW_MS + i * 61_000, "false") for i in range(4)]
    rows += [("ETHUSDT", 10 + i, str(10 + i), "2", WINDOW_MS + i * 61_000, "true") for i in range(3)]
    clean = clean_trades(make_trades(spark, rows))
    stg, stg_s = G.stg_trades_minute(minute_bars(clean)), G.stg_trades_minute_stream(minute_bars_stream(clean))
    fct, fct_s = G.fct_market_window(stg), G.fct_market_window_stream(stg_s)
    meta = spark.createDataFrame([("c:btc", "BTC", 1.0, 1, 0.9, "s")],
                                 "coin_id string, symbol string, price double, timestamp long, "
                                 "confidence double, source string")
    return {"fct_market_window": fct.cache(), "fct_market_window_stream": fct_s.cache(),
            "dim_asset": G.dim_asset(fct, meta).cache(), "dim_time": G.dim_time(stg, stg_s).cache()}


def failing(report):
    return {(r.check_name, r.table_name, r.column_name): r.failing_rows
            for r in report.collect() if not r.passed}


def test_all_pass_on_good_data(tables):
    report = dq_report(tables)
    assert report.count() == 17
    assert failing(report) == {}


def _bad_row(tables, check, table, col):
    """The table plus one row that violates exactly ``check`` on ``col``."""
    df = tables[table]
    types = dict(df.dtypes)
    first = df.limit(1)
    if check == "unique":
        return df.unionByName(first)
    fresh = first
    if "market_window_id" in df.columns and col != "market_window_id":
        fresh = fresh.withColumn("market_window_id", F.lit("f" * 32))   # keep the key unique
    if check == "not_null":
        return df.unionByName(fresh.withColumn(col, F.lit(None).cast(types[col])))
    if check == "relationships":
        bad = "NOPEUSDT" if col == "asset_id" else 190001010000
        return df.unionByName(fresh.withColumn(col, F.lit(bad).cast(types[col])))
    raise AssertionError(check)


@pytest.mark.parametrize("check", GOLD_CHECKS, ids=lambda c: f"{c[0]}-{c[1]}-{c[2]}")
def test_each_check_fails_alone(spark, tables, check):
    name, table, col, _, _ = check
    seeded = dict(tables)
    seeded[table] = _bad_row(tables, name, table, col)
    bad = failing(dq_report(seeded))
    assert bad == {(name, table, col): 1}
