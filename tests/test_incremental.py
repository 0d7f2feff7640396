"""The incremental regime mart against full rebuilds; versioned models."""

import datetime as dt
import random

import pytest
from conftest import WINDOW_MS, make_trades
from pyspark.sql import functions as F

from tapecraft.operators import incremental as I
from tapecraft.operators import regime as R
from tapecraft.operators.bars import as_stream_shape, minute_bars
from tapecraft.operators.clean import clean_trades
from tapecraft.plans import gold as G
from tapecraft.plans.models import GOLD_MODELS, Model, build_models, read_models
from tapecraft.session import scratch_path
from tapecraft.sources.versioned import VersionedTable

FACT = ("market_window_id string, asset_id string, window_start timestamp_ntz, realized_vol double, realized_variance double, "
        "bipower_variation double, jump_component double, ofi double, signed_volume double, window_return double, volume double, "
        "trade_count long, dt string")


def fact_row(rng, asset, when):
    vol = round(rng.random(), 6)
    return (f"{asset}|{when}", asset, when, vol, vol * vol, 0.1, rng.random(), 0.0, 1.0, 0.0, 5.0, 3, None if when is None else f"{when:%Y-%m-%d}")


def rows(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed, gap_hours", [(1, 3), (2, 30)])
def test_mart_after_upserts_equals_a_full_rebuild_and_reads_few_days(spark, seed, gap_hours):
    rng = random.Random(seed)
    start = dt.datetime(2026, 1, 1)
    times = {a: sorted({start + dt.timedelta(hours=gap_hours * k, minutes=rng.randrange(60)) for k in range(400)}) for a in ("BTC", "ETH", None)}
    root = scratch_path(spark, "test-mart")
    fact, mart, counts = (VersionedTable(spark, f"{root}/{n}") for n in ("fact", "mart", "counts"))
    held_back = {(a, t) for a, ts in times.items() for t in rng.sample(ts, 6)}
    first = [fact_row(rng, a, t) for a, ts in times.items() for t in ts if (a, t) not in held_back]
    fact.replace(spark.createDataFrame(first, FACT))
    assert len(I.update_regime_mart(fact, mart, counts)) == len(fact.version().folders)
    for step in range(2):
        if step:                                           # changed and new windows of two assets, the first row included
            picked = [("BTC", times["BTC"][200]), ("BTC", times["BTC"][0]), (None, times[None][120])] + sorted(held_back, key=repr)[:2]
        else:                                              # one changed window
            picked = [("ETH", next(t for t in times["ETH"][250:] if ("ETH", t) not in held_back))]
        updates = spark.createDataFrame([fact_row(rng, a, t) for a, t in picked], FACT)
        fact.merge(updates, I.MART_KEYS)
        read = I.update_regime_mart(fact, mart, counts, updates, block_rows=64)
        assert rows(mart.read()) == rows(I.with_day(R.ofi_return_by_regime(fact.read())))
        if not step:
            assert len(read) <= 62 * gap_hours // 24 + 64 // (24 // gap_hours if gap_hours < 24 else 1) + 3
            assert len(read) < len(fact.version().folders) / 2
            assert {f.split("dt=")[1][:10] for f in fact.read(read).inputFiles()} == set(read)
    assert I.update_regime_mart(fact, mart, counts, updates.limit(0)) == []


def test_models_are_rebuilt_where_inputs_changed_and_switch_whole(spark):
    trades = [("BTCUSDT", i, str(100 + i % 7), "1", WINDOW_MS + i * 9_000, "false") for i in range(40)]
    bars = minute_bars(clean_trades(make_trades(spark, trades)))
    root = scratch_path(spark, "test-models")
    sources = {n: VersionedTable(spark, f"{root}/{n}", None) for n in ("silver", "silver_stream", "metadata")}
    meta = spark.createDataFrame([("c", "BTC", 1.0, 5, 0.9, "s")], "coin_id string, symbol string, price double, timestamp long, confidence double, source string")
    with pytest.raises(ValueError):
        build_models(spark, f"{root}/gold", sources)
    sources["silver"].replace(bars.where(F.col("minute") < F.lit("2026-06-15 05:35:00").cast("timestamp_ntz")))
    sources["silver_stream"].replace(as_stream_shape(bars))
    sources["metadata"].replace(meta)
    assert build_models(spark, f"{root}/gold", sources) == [m.name for m in GOLD_MODELS]
    assert build_models(spark, f"{root}/gold", sources) == []
    before = read_models(spark, f"{root}/gold")
    old = {name: rows(df) for name, df in before.items()}
    sources["silver"].replace(bars)
    assert build_models(spark, f"{root}/gold", sources) == [
        "stg_trades_minute", "fct_market_window", "dim_time", "dim_asset", "fct_ofi_return_by_regime"]
    assert {name: rows(df) for name, df in before.items()} == old                     # readers that began before
    after = read_models(spark, f"{root}/gold")
    assert after["fct_market_window"].count() == bars.count() > len(old["fct_market_window"])
    sources["metadata"].replace(meta.withColumn("price", F.lit(2.0)))
    assert build_models(spark, f"{root}/gold", sources) == ["dim_asset"]
    with pytest.raises(ValueError):
        build_models(spark, root, sources, (Model("x", ("nothing",), lambda df: df),))


def test_write_model_leaves_earlier_readers_their_version(spark):
    root = scratch_path(spark, "test-write-model")
    first = G.write_model(spark.range(3), root, "m")
    second = G.write_model(spark.range(5), root, "m")
    assert (first.count(), second.count(), G.model_table(spark, root, "m").read().count()) == (3, 5, 5)
