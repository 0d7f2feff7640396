"""Message formats, partitioned landing, bronze load and coverage."""

import json

import pytest
from conftest import WINDOW_MS, make_trades
from pyspark.sql import functions as F

from tapecraft.session import scratch_path
from tapecraft.sources import landing as L
from tapecraft.sources import messages as M


def test_envelope_parse_and_drop(spark):
    msgs = [
        {"data": {"e": "trade", "E": 5, "s": "BTCUSDT", "t": 7, "p": "100.5", "q": "0.1", "T": 4, "m": True}},
        {"data": {"e": "trade", "E": 5, "s": "", "t": 8, "p": "1", "q": "1", "T": 4, "m": False}},
        {"data": {"e": "trade", "E": 5, "t": 9, "p": "1", "q": "1", "T": 4, "m": False}},
        {"result": None, "id": 1},
    ]
    raw = spark.createDataFrame([(json.dumps(m),) for m in msgs], "value string")
    out = M.parse_trade_envelope(raw).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.event_type, r.event_time, r.symbol, r.trade_id, r.price, r.quantity, r.trade_time,
            r.is_buyer_maker) == ("trade", 5, "BTCUSDT", 7, "100.5", "0.1", 4, "true")
    # the same bytes as a binary payload
    rawb = raw.select(F.encode("value", "UTF-8").alias("value"))
    assert M.parse_trade_envelope(rawb).count() == 1


def test_encode_round_trip(spark):
    trades = make_trades(spark, [("BTCUSDT", 1, "100", "2", WINDOW_MS, "false")])
    enc = M.encode_trades_json(trades).collect()[0]
    assert enc.key == "BTCUSDT"
    payload = json.loads(bytes(enc.value).decode())
    assert payload == {"event_type": "trade", "event_time": WINDOW_MS, "symbol": "BTCUSDT",
                       "trade_id": 1, "price": "100", "quantity": "2", "trade_time": WINDOW_MS,
                       "is_buyer_maker": "false"}
    env = M.trades_to_envelopes(trades)
    back = M.parse_trade_envelope(env).collect()[0]
    assert back.asDict() == trades.collect()[0].asDict()


def test_flatten_metadata(spark):
    msg = {"coins": {"coingecko:bitcoin": {"symbol": "BTC", "price": 1.5, "timestamp": 10, "confidence": 0.99},
                     "coingecko:ethereum": {"symbol": "ETH", "price": 2.5, "timestamp": 11, "confidence": 0.98}}}
    raw = spark.createDataFrame([(json.dumps(msg),)], "value string")
    out = {r.coin_id: r for r in M.flatten_metadata(raw).collect()}
    assert set(out) == {"coingecko:bitcoin", "coingecko:ethereum"}
    assert out["coingecko:ethereum"].symbol == "ETH" and out["coingecko:ethereum"].source == "defillama"


def _landed(spark):
    day2 = WINDOW_MS + 86_400_000
    trades = make_trades(spark, [
        ("btcusdt", 1, "1", "1", WINDOW_MS, "false"), ("BTCUSDT", 2, "2", "1", day2, "true"),
        ("ETHUSDT", 3, "3", "1", WINDOW_MS, "false"), ("DOGEUSDT", 4, "4", "1", day2, None)])
    path = scratch_path(spark, "test-landing")
    L.partitioned_landing(trades, path)
    return path


def test_landing_layout_and_load(spark):
    path = _landed(spark)
    back = L.read_landed(spark, path)
    assert sorted(r.dt for r in back.select("dt").distinct().collect()) == ["2026-06-15", "2026-06-16"]
    assert back.where("symbol = 'BTCUSDT'").count() == 2          # upper-cased partition names
    day = L.load_bronze_day(spark, path, "2026-06-16", ["btcusdt", "ethusdt", "bnbusdt"])
    assert sorted(r.trade_id for r in day.collect()) == [2]
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2026-06-16" in plan


def test_load_bronze_day_empty_raises(spark):
    path = _landed(spark)
    with pytest.raises(L.NoPartitionsError):
        L.load_bronze_day(spark, path, "1999-01-01")


def test_load_bronze_replace_day(spark):
    path = _landed(spark)
    target = scratch_path(spark, "test-bronze")
    L.load_bronze_day(spark, path, None, target=target)
    assert spark.read.parquet(target).count() == 4
    L.load_bronze_day(spark, path, "2026-06-16", ["BTCUSDT"], target=target, mode="replace_day")
    after = spark.read.parquet(target)
    assert after.count() == 3   # 06-15 kept (2 rows), 06-16 replaced by its BTC row only
    L.load_bronze_day(spark, path, "2026-06-16", ["BTCUSDT"], target=target, mode="truncate")
    assert spark.read.parquet(target).count() == 1


def test_symbol_coverage(spark):
    rows = [("BTCUSDT", i, "1", "1", WINDOW_MS + i, "false") for i in range(60)]
    rows += [("ethusdt", 100 + i, "1", "1", WINDOW_MS + i, "false") for i in range(59)]
    out = {r.symbol: r for r in L.symbol_coverage(make_trades(spark, rows)).collect()}
    assert len(out) == 8
    assert out["BTCUSDT"].meets_quota and out["BTCUSDT"].trades == 60
    assert not out["ETHUSDT"].meets_quota and out["ETHUSDT"].trades == 59
    assert out["AVAXUSDT"].trades == 0


def test_land_metadata_partitions(spark):
    meta = spark.createDataFrame(
        [("c:btc", "BTC", 1.0, 1781501520, 0.9, "defillama"), ("c:eth", "ETH", 2.0, 1781587920, 0.8, "defillama")],
        "coin_id string, symbol string, price double, timestamp long, confidence double, source string")
    path = scratch_path(spark, "test-meta-landing")
    L.land_metadata(meta, path)
    back = spark.read.json(path)
    assert sorted(r.dt for r in back.select(F.col("dt").cast("string")).collect()) == ["2026-06-15", "2026-06-16"]


def test_land_stream_then_read(spark):
    from tapecraft.schemas import TRADE
    src, out = scratch_path(spark, "test-land-src"), scratch_path(spark, "test-land-out")
    make_trades(spark, [("BTCUSDT", i, "1", "1", WINDOW_MS, "false") for i in range(3)]).write.mode("overwrite").json(src)
    q = L.land_stream(spark.readStream.schema(TRADE).json(src), out, scratch_path(spark, "test-land-ckpt"), every="1 second")
    q.processAllAvailable()
    q.stop()
    assert sorted(r.trade_id for r in spark.read.schema(TRADE).json(out).collect()) == [0, 1, 2]


def test_unknown_load_mode_raises_and_leaves_the_table(spark):
    path, target = scratch_path(spark, "test-mode"), scratch_path(spark, "test-mode-bronze")
    day = 86_400_000
    L.partitioned_landing(make_trades(spark, [("BTCUSDT", i, "1", "1", WINDOW_MS + i * day, "false") for i in range(2)]), path)
    L.load_bronze_day(spark, path, "2026-06-15", target=target)
    with pytest.raises(ValueError):
        L.load_bronze_day(spark, path, "2026-06-16", target=target, mode="replace-day")
    assert spark.read.parquet(target).count() == 1
    assert L.load_bronze_day(spark, path, "2026-06-16", target=target, mode="replace_day").count() == 2


def test_landing_writes_rebalance(spark):
    plan = L._by_bytes(make_trades(spark, []), ["symbol"])._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_only_asked_folders_are_read(spark):
    path = scratch_path(spark, "test-folders")
    day = 86_400_000
    L.partitioned_landing(make_trades(spark, [(s, i, "1", "1", WINDOW_MS + i * day, "false")
                                              for s in ("BTCUSDT", "ETHUSDT") for i in range(3)]), path)
    got = L.read_landed(spark, path, ["2026-06-16", "2026-06-30"], ["ETHUSDT", "XRPUSDT"])
    assert {f.split("/symbol=")[1].rsplit("/", 1)[0] for f in got.inputFiles()} == {"ETHUSDT/dt=2026-06-16"}
    assert L.read_landed(spark, path, ["2020-01-01"]).count() == 0


def test_flat_messages_round_trip(spark):
    tape = make_trades(spark, [("BTCUSDT", 1, "1.5", "2", WINDOW_MS, "false"), (None, None, None, "x", None, None)])
    back = M.decode_trades_json(M.encode_trades_json(tape))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, tape.collect()), key=str)
    junk = spark.createDataFrame([("no json",), ("{}",), (None,)], "value string")
    assert [r.symbol for r in M.decode_trades_json(junk).collect()] == [None] * 3


def test_landed_unknown_fields_ignored(spark):
    import os
    from tapecraft.session import local_path
    path = scratch_path(spark, "test-unknown-fields")
    folder = os.path.join(local_path(path), "symbol=BTCUSDT", "dt=2026-06-15")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "a.json"), "w") as fh:
        fh.write(json.dumps({"event_type": "trade", "trade_id": 1, "price": "1.5", "quantity": "2",
                             "trade_time": WINDOW_MS, "is_buyer_maker": False, "extra": {"x": 1}}) + "\n")
        fh.write(json.dumps({"trade_id": 2, "price": "2", "surprise": [1, 2]}) + "\n")
    rows = sorted(L.load_bronze_day(spark, path, "2026-06-15").collect(), key=lambda r: r.trade_id)
    assert [r.trade_id for r in rows] == [1, 2]
    assert rows[0].symbol == "BTCUSDT" and rows[0].is_buyer_maker == "false" and rows[1].trade_time is None
    assert "extra" not in L.read_landed(spark, path).columns


def test_messages_that_are_no_trade_go_to_the_dead_letters(spark):
    import json

    from tapecraft.schemas import TRADE
    from tapecraft.session import scratch_path
    from tapecraft.sources import messages as M
    good = {"event_type": "trade", "event_time": 1, "symbol": "BTCUSDT", "trade_id": 7, "price": "1.5", "quantity": "2",
            "trade_time": 5, "is_buyer_maker": "true"}
    other = dict(good, symbol="ñ")
    values = [(None, "empty"), (b"", "empty"), (b"\xff\xfe{}", "not_utf8"), (b"{", "malformed"), (b"7", "malformed"),
              (json.dumps(dict(good, trade_id="x")).encode(), "malformed"), (json.dumps(dict(good, symbol=None)).encode(), "no_symbol"),
              (json.dumps(dict(good, symbol="")).encode(), "no_symbol"), (b"{}", "no_symbol"),
              (json.dumps(dict(good, trade_time=None)).encode(), "no_time"), (json.dumps(dict(good, price="a")).encode(), "bad_price"),
              (json.dumps({k: v for k, v in good.items() if k != "quantity"}).encode(), "bad_quantity"),
              (json.dumps(good).encode(), None), (json.dumps(other, ensure_ascii=False).encode(), None)]
    raw = spark.createDataFrame([(v if v is None else bytearray(v),) for v, _ in values], "value binary")
    judged = M.judge_messages(raw).collect()
    assert sorted((bytes(r["value"]) if r["value"] is not None else None, r["reason"]) for r in judged if r["value"] is not None) == sorted(
        ((v, why) for v, why in values if v is not None), key=lambda x: x[0])
    assert [r["reason"] for r in judged if r["value"] is None] == ["empty"]
    root, told = scratch_path(spark, "test-dead"), {}
    handle = M.dead_letter_handler(f"{root}/good", f"{root}/bad", on_counts=lambda b, c: told.update({b: c}))
    for _ in range(2):                                                                      # a replay replaces the batch
        handle(raw, 3)
    trades = spark.read.schema(TRADE).parquet(f"{root}/good").collect()
    assert sorted(r["symbol"] for r in trades) == ["BTCUSDT", "ñ"] and trades[0]["trade_id"] == 7
    assert spark.read.parquet(f"{root}/bad").count() == 12
    assert told[3]["good"] == 2 and told[3]["malformed"] == 3 and told[3]["empty"] == 2
    assert M.decode_trades_json(raw).count() == len(values)                                 # broken bytes fail no job


def test_metadata_with_a_broken_time_lands_without_a_day(spark):
    from tapecraft.session import scratch_path
    from tapecraft.sources import landing as L
    path = scratch_path(spark, "test-meta-time")
    meta = spark.createDataFrame([("a", "A", 1.0, 900_000_000_000_000_000, 1.0, "s"), ("b", "B", 1.0, 86_400, 1.0, "s")],
                                 "coin_id string, symbol string, price double, timestamp long, confidence double, source string")
    L.land_metadata(meta, path)
    found = spark.read.schema("symbol string, dt string").json(path).collect()
    assert sorted((r["symbol"], r["dt"]) for r in found) == [("A", None), ("B", "1970-01-02")]
