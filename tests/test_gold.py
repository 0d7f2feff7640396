"""Gold models: time dimension (H10, H11), metadata and asset dimension (H12,
H13), facts and staging contracts."""

import datetime as dt

from conftest import WINDOW_MS, make_trades

from tapecraft.operators.bars import minute_bars, minute_bars_stream
from tapecraft.operators.clean import clean_trades
from tapecraft.plans import gold as G

T0 = dt.datetime(2026, 6, 15, 5, 32)


def test_h10_sessions(spark):
    hours = [0, 7, 8, 13, 14, 20, 21, 22]
    df = spark.createDataFrame([(T0.replace(hour=h, minute=0),) for h in hours], "window_start timestamp_ntz")
    out = {r.hour: r for r in G.time_attributes(df).collect()}
    assert [out[h].trading_session for h in hours] == [
        "Asian", "Asian", "European", "European", "US", "US", "US", "Off-hours"]
    assert [h for h in hours if out[h].is_us_market_hours] == [13, 14, 20]


def test_h11_keys(spark):
    stg = G.stg_trades_minute(minute_bars(clean_trades(make_trades(
        spark, [("BTCUSDT", 1, "100", "1", WINDOW_MS, "false")]))))
    (f,) = G.fct_market_window(stg).collect()
    assert f.time_id == 202606150532
    assert f.market_window_id == "a4eea78262001ac5e252231c04410ebd"
    assert f.window_return == 0.0
    (d,) = G.dim_time(stg, stg).collect()
    assert (d.day_name, d.day_of_week, d.is_weekend) == ("Monday", 2, False)
    assert (d.year, d.month, d.day, d.hour, d.minute) == (2026, 6, 15, 5, 32)


def meta(spark, rows):
    return spark.createDataFrame(
        rows, "coin_id string, symbol string, price double, timestamp long, confidence double, source string")


def test_h12_latest_metadata(spark):
    m = meta(spark, [("c:btc", "BTC", 1.0, 1, 0.9, "s"), ("c:btc", "BTC", 2.0, 2, 0.9, "s"),
                     ("c:btc", "BTC", 3.0, None, 0.9, "s"), ("c:eth", "ETH", 5.0, None, 0.1, "s")])
    out = {r.symbol: r for r in G.latest_metadata(m).collect()}
    assert (out["BTC"].price_timestamp, out["BTC"].reference_price) == (2, 2.0)
    assert out["ETH"].price_timestamp is None and out["ETH"].reference_price == 5.0


def test_h13_unknown_asset(spark):
    trades = make_trades(spark, [("FOOUSDT", 1, "1", "1", WINDOW_MS, "false"),
                                 ("BTCUSDT", 2, "2", "1", WINDOW_MS, "false"),
                                 ("XUSDTUSDT", 3, "2", "1", WINDOW_MS, "false")])
    fct = G.fct_market_window(G.stg_trades_minute(minute_bars(clean_trades(trades))))
    m = meta(spark, [("c:btc", "BTC", 42.0, 7, 0.99, "s")])
    out = {r.asset_id: r for r in G.dim_asset(fct, m).collect()}
    assert (out["FOOUSDT"].asset_name, out["FOOUSDT"].market_cap_tier) == ("Unknown", "Unknown")
    assert out["FOOUSDT"].reference_price is None
    assert (out["BTCUSDT"].asset_name, out["BTCUSDT"].market_cap_tier) == ("Bitcoin", "Large Cap")
    assert out["BTCUSDT"].reference_price == 42.0 and out["BTCUSDT"].loaded_at is not None
    assert out["XUSDTUSDT"].base_symbol == "X"          # every occurrence is stripped


def test_staging_contracts(spark):
    clean = clean_trades(make_trades(spark, [("BTCUSDT", 1, "100", "1", WINDOW_MS, "false")]))
    stg = G.stg_trades_minute(minute_bars(clean))
    assert len(stg.columns) == 17 and stg.columns[1] == "window_start"
    stg_s = G.stg_trades_minute_stream(minute_bars_stream(clean))
    assert len(stg_s.columns) == 16 and "window_end" in stg_s.columns
    (r,) = stg_s.collect()
    assert r.window_end - r.window_start == dt.timedelta(minutes=1)
    assert dict(stg.dtypes)["trade_count"] == "bigint"
