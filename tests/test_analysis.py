"""Analyses over the facts: correlation guard, session / tier grouping, roll-up."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tapecraft.operators import analysis as A

T0 = dt.datetime(2026, 6, 15, 5, 0)


def fact(spark, rows):
    return spark.createDataFrame(
        [(a, T0 + dt.timedelta(hours=h), rv, ofi, ret, vol, reg) for a, h, rv, ofi, ret, vol, reg in rows],
        "asset_id string, window_start timestamp_ntz, realized_vol double, ofi double, "
        "window_return double, volume double, volatility_regime string")


def test_corr_by_regime(spark):
    rows = [("BTCUSDT", i, 0.1 * i, float(i), 2.0 * i, 1.0, "normal") for i in range(5)]
    rows += [("BTCUSDT", 10 + i, 0.5, 1.0, float(i), 1.0, "calm") for i in range(3)]   # ofi constant
    df = fact(spark, rows).withColumn("realized_variance", F.col("realized_vol"))
    out = {r.volatility_regime: r for r in A.ofi_corr_by_regime(df).collect()}
    assert out["normal"].corr_ofi_return == pytest.approx(1.0)
    assert out["normal"].corr_ofi_vol == pytest.approx(1.0)
    assert out["calm"].corr_ofi_return is None          # zero variance -> NULL, never an error
    assert out["calm"].windows == 3


def test_vol_by_session_and_tier(spark):
    rows = [("BTCUSDT", 0, 1.0, 0.0, 0.1, 2.0, "normal"), ("ETHUSDT", 9, 3.0, 0.0, -0.3, 1.0, "normal"),
            ("AVAXUSDT", 9, 5.0, 0.0, 0.0, 1.0, "normal"), ("FOOUSDT", 17, 7.0, 0.0, 0.0, 1.0, "normal")]
    f = (fact(spark, rows).withColumn("realized_variance", F.col("realized_vol"))
         .withColumn("jump_component", F.col("ofi")))
    by_s = {r.trading_session: r for r in A.vol_by_session(f).collect()}
    # hours 5, 14, 14, 22 -> Asian, US, US, Off-hours
    assert by_s["Asian"].windows == 1 and by_s["US"].windows == 2 and by_s["Off-hours"].windows == 1
    assert by_s["US"].avg_realized_vol == pytest.approx(4.0)
    by_t = {r.market_cap_tier: r for r in A.vol_by_tier(f).collect()}
    assert by_t["Large Cap"].assets == 2 and by_t["Small Cap"].avg_realized_vol == 5.0
    assert by_t["Unknown"].windows == 1


def test_rollup(spark):
    rows = [("BTCUSDT", h, float(h), 0.0, 0.0, 1.0, "normal") for h in (0, 0, 1, 25)]
    out = A.vol_rollup_time(fact(spark, rows)).collect()
    total = [r for r in out if r.window_date is None and r.hour is None]
    assert len(total) == 1 and total[0].windows == 4
    days = [r for r in out if r.window_date is not None and r.hour is None]
    assert sorted(r.windows for r in days) == [1, 3]
    assert len(out) == 1 + 2 + 3            # total, 2 days, 3 (day, hour) cells
