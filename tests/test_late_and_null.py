"""Late trades of open windows, NULL keys and times, and the hot-part guard."""

import time

import pytest
from pyspark.sql import functions as F

from conftest import WINDOW_MS, make_trades
from tapecraft.functions.columns import ms_to_ts
from tapecraft.operators import bars as B
from tapecraft.operators.clean import clean_trades
from tapecraft.operators.regime import ofi_return_by_regime
from tapecraft.plans import gold as G
from tapecraft.streaming.append import stream_minute_append


def run_stream(spark, tmp_path, batches, **options):
    """Each batch is one file and one micro-batch."""
    schema = make_trades(spark, []).schema
    for rows in batches:
        make_trades(spark, rows).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        time.sleep(1.1)   # the file source takes files by modification time
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    q = (stream_minute_append(clean_trades(raw), **options).writeStream.format("parquet")
         .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return {r.window_start.minute: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}


@pytest.mark.parametrize("part", [None, "1 second", "20 seconds", "1 minute"])
def test_a_trade_is_late_only_when_its_window_has_closed(spark, tmp_path, part):
    def trade(i, second):
        return ("BTCUSDT", i, "100", "1", WINDOW_MS + second * 1000, "false")

    # +70 s moves the watermark to +40 s: the window to +60 s is open, a trade at +20 s belongs to it
    got = run_stream(spark, tmp_path, [[trade(1, 5)], [trade(2, 70)], [trade(3, 20)], [trade(4, 400)]], part=part)
    assert [got[m].trade_count for m in sorted(got)] == [2, 1]


def test_a_trade_of_a_closed_window_is_dropped(spark, tmp_path):
    def trade(i, second):
        return ("BTCUSDT", i, "100", "1", WINDOW_MS + second * 1000, "false")

    # Spark drops by the watermark that the batch before began with, hence the batch between
    got = run_stream(spark, tmp_path, [[trade(1, 5)], [trade(2, 200)], [trade(3, 210)], [trade(4, 20)], [trade(5, 500)]])
    assert got[min(got)].trade_count == 1


def null_tape(spark):
    rows = [("BTCUSDT", i, str(100 + i % 7), "1", WINDOW_MS + i * 400, "false") for i in range(300)]
    rows += [("BTCUSDT", 1000 + i, "100", "2", None, "true") for i in range(4)]
    rows += [(None, 2000 + i, str(50 + i), "1", WINDOW_MS + i * 100, "true") for i in range(6)]
    return clean_trades(make_trades(spark, rows))


def test_batch_keeps_trades_without_time_or_symbol(spark):
    got = {(r.symbol, r.minute): r for r in B.minute_bars(null_tape(spark)).collect()}
    assert got["BTCUSDT", None].trade_count == 4 and got["BTCUSDT", None].open == 100
    assert sum(r.trade_count for (s, _), r in got.items() if s is None) == 6
    assert sum(r.trade_count for r in got.values()) == 310


def test_regime_mart_keeps_windows_without_asset_or_time(spark):
    fact = G.fct_market_window(G.stg_trades_minute(B.minute_bars(null_tape(spark)))).checkpoint()
    mart = ofi_return_by_regime(fact)
    assert mart.count() == fact.count()
    assert mart.filter("asset_id IS NULL").count() == 1 and mart.filter("window_start IS NULL").count() == 1


def test_a_time_out_of_range_is_null(spark):
    got = spark.createDataFrame([(9 * 10 ** 17,), (-9 * 10 ** 17,), (0,), (None,)], "ms long").select(ms_to_ts("ms").alias("t"))
    assert [r.t is None for r in got.collect()] == [True, True, False, True]


@pytest.mark.parametrize("wide", [False, True])
def test_a_hot_timestamp_is_cut_by_trade_id(spark, wide):
    step = 2 ** 53 if wide else 1
    rows = [("BTCUSDT", i * step, str(100 + i % 9), "1", WINDOW_MS + 7, "false") for i in range(400)]
    rows += [("BTCUSDT", 5, "101", "1", WINDOW_MS + 3, "true")]
    clean = clean_trades(make_trades(spark, rows))
    parted = B._with_part(clean, "1 minute", "1 minute", 50, 8)
    sizes = [r["count"] for r in parted.groupBy("part").count().collect()]
    assert sum(sizes) == 401 and max(sizes) <= 100
    plain = B.minute_bars(clean, part="1 minute").first()
    split = B.minute_bars(clean, part="1 minute", max_part_rows=50, hot_ways=8).first()
    for c in ("open", "close", "trade_count", "realized_variance", "bipower_variation", "volume"):
        assert split[c] == pytest.approx(plain[c], rel=1e-9), c
