"""Rolling baseline and regime classification (FIXTURES H8, H9) and the
blocked rolling window against a single-window brute force."""

import datetime as dt
import math
import random

import pytest

import brute
from tapecraft.operators import regime as R

T0 = dt.datetime(2026, 6, 15, 5, 32)


def fact(spark, series):
    """series: {asset: [(minute_offset, vol), ...]} -> minimal fact rows."""
    rows = []
    for asset, pts in series.items():
        for off, v in pts:
            rows.append((asset, T0 + dt.timedelta(minutes=off), float(v), float(v) ** 2, 0.0, 0.0))
    return spark.createDataFrame(
        rows, "asset_id string, window_start timestamp_ntz, realized_vol double, "
              "realized_variance double, jump_component double, bipower_variation double")


def regimes(spark, series, **kw):
    df = R.volatility_regime(R.vol_zscore(R.rolling_vol_baseline(fact(spark, series), **kw)))
    return [r.asDict() for r in df.orderBy("asset_id", "window_start").collect()]


@pytest.mark.parametrize("block_rows", [R.BLOCK_ROWS, 30, 31])
def test_h8_regimes(spark, block_rows):
    out = regimes(spark, {"BTCUSDT": list(enumerate([1, 2, 1, 2, 1, 4, 1]))}, block_rows=block_rows)
    assert [r["volatility_regime"] for r in out[:5]] == ["warmup"] * 5
    r6, r7 = out[5], out[6]
    assert r6["roll_mean_vol"] == pytest.approx(1.4, abs=1e-12)
    assert r6["roll_std_vol"] == pytest.approx(0.5477225575051661, abs=1e-12)
    assert r6["vol_zscore"] == pytest.approx(4.74692883171144, abs=1e-9)
    assert r6["volatility_regime"] == "turbulent"
    assert r7["roll_mean_vol"] == pytest.approx(1.8333333333333333, abs=1e-12)
    assert r7["roll_std_vol"] == pytest.approx(1.1690451944500122, abs=1e-12)
    assert r7["vol_zscore"] == pytest.approx(-0.7128324356402512, abs=1e-9)
    assert r7["volatility_regime"] == "calm"
    assert out[0]["roll_n"] == 0 and out[0]["roll_mean_vol"] is None


def test_h9_constant_is_normal(spark):
    out = regimes(spark, {"ETHUSDT": list(enumerate([1] * 6))})
    assert out[5]["roll_std_vol"] == 0.0
    assert out[5]["vol_zscore"] is None
    assert out[5]["volatility_regime"] == "normal"


@pytest.mark.parametrize("block_rows", [30, 47, 100])
def test_blocked_rolling_equals_brute_force(spark, block_rows):
    rnd = random.Random(block_rows)
    series = {}
    for asset in ("A", "B", "C"):
        offs = sorted(rnd.sample(range(6 * 1440), rnd.randrange(40, 400)))   # gaps, several days
        series[asset] = [(o, round(rnd.random(), 4)) for o in offs]
    got = regimes(spark, series, block_rows=block_rows)
    by = {(r["asset_id"], r["window_start"]): r for r in got}
    assert len(got) == sum(len(v) for v in series.values())
    for asset, pts in series.items():
        want = brute.rolling([v for _, v in pts])
        for (off, _), (mean, std, n) in zip(pts, want):
            r = by[(asset, T0 + dt.timedelta(minutes=off))]
            assert r["roll_n"] == n
            assert (r["roll_mean_vol"] is None) == (mean is None)
            if mean is not None:
                assert math.isclose(r["roll_mean_vol"], mean, rel_tol=1e-9, abs_tol=1e-12)
            if std is not None:
                assert math.isclose(r["roll_std_vol"], std, rel_tol=1e-9, abs_tol=1e-12)


def test_block_rows_must_cover_frame(spark):
    with pytest.raises(ValueError):
        R.rolling_vol_baseline(fact(spark, {"A": [(0, 1.0)]}), rows=30, block_rows=10)


def test_jump_flag(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.6), (1.0, 0.5), (2.0, 0.2)],
                               "realized_variance double, jump_component double")
    flags = [r.is_jump_minute for r in R.jump_minutes(df).collect()]
    assert flags == [False, True, False, False]
