"""Streaming: append reducer with late data, recompute horizon (H14),
idempotent upsert (H15) and the foreachBatch speed layer end to end."""

import datetime as dt
import json
import os

from conftest import WINDOW_MS, make_trades
from pyspark.sql import functions as F

from tapecraft.operators.bars import minute_bars, minute_bars_stream
from tapecraft.operators.clean import clean_trades
from tapecraft.schemas import TRADE
from tapecraft.session import local_path, scratch_path
from tapecraft.streaming import upsert as U
from tapecraft.streaming.append import stream_minute_append

T0 = dt.datetime(2026, 6, 15, 5, 32)


def write_file(folder, name, rows):
    folder = local_path(folder)
    os.makedirs(folder, exist_ok=True)
    keys = ["symbol", "trade_id", "price", "quantity", "trade_time", "is_buyer_maker"]
    with open(os.path.join(folder, name), "w") as fh:
        for r in rows:
            fh.write(json.dumps(dict(zip(keys, r), event_type="trade", event_time=r[4])) + "\n")


def t(sym, tid, price, qty, ms, maker="false"):
    return (sym, tid, str(price), str(qty), ms, maker)


def run_append(spark, root):
    raw = spark.readStream.schema(TRADE).json(f"{root}/in")
    out = stream_minute_append(clean_trades(raw, "1 minute"), "1 minute", "30 seconds")
    q = (out.writeStream.outputMode("append").format("parquet").option("path", f"{root}/out")
         .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()


def test_append_late_data_dropped(spark):
    root = scratch_path(spark, "test-append")
    write_file(f"{root}/in", "a.json", [t("BTCUSDT", 1, 100, 1, WINDOW_MS + 1_000),
                                        t("BTCUSDT", 2, 110, 1, WINDOW_MS + 2_000),
                                        t("BTCUSDT", 3, 120, 1, WINDOW_MS + 125_000)])
    run_append(spark, root)
    first = spark.read.parquet(f"{root}/out").collect()
    assert [(r.window_start, r.trade_count) for r in first] == [(T0, 2)]   # minute 2 still open
    # a late trade for minute 0 and a trade that closes minute 2
    write_file(f"{root}/in", "b.json", [t("BTCUSDT", 4, 500, 1, WINDOW_MS + 3_000),
                                        t("BTCUSDT", 5, 130, 1, WINDOW_MS + 300_000)])
    run_append(spark, root)
    rows = {r.window_start: r for r in spark.read.parquet(f"{root}/out").collect()}
    assert rows[T0].trade_count == 2 and rows[T0].high == 110.0          # late trade dropped
    assert rows[T0 + dt.timedelta(minutes=2)].trade_count == 1


def test_h14_horizon_never_cuts_a_window(spark):
    rows = [t("BTCUSDT", 1, 100, 1, WINDOW_MS + 10_000), t("BTCUSDT", 2, 120, 1, WINDOW_MS + 50_000)]
    clean = clean_trades(make_trades(spark, rows))
    full = minute_bars_stream(clean).collect()[0]
    as_of = T0 + dt.timedelta(minutes=20, seconds=30)      # cut at 05:32:30, inside the window
    touched = U.touched_minutes(clean)
    got = U.recompute_touched(clean, touched, "1 minute", as_of=as_of, horizon="20 minutes").collect()
    assert len(got) == 1 and got[0].asDict() == full.asDict()
    later = as_of + dt.timedelta(minutes=1)                  # window entirely before the cut
    assert U.recompute_touched(clean, touched, "1 minute", as_of=later).count() == 0


def test_h15_replay_is_idempotent(spark):
    rows = [t("BTCUSDT", i, 100 + i, 1, WINDOW_MS + i * 7_000) for i in range(20)]
    clean = clean_trades(make_trades(spark, rows))
    target = scratch_path(spark, "test-upsert")
    handler = U.upsert_handler(spark, lambda: make_trades(spark, rows), target, "1 minute", horizon=None)
    handler(clean, 0)
    once = sorted(tuple(r) for r in U.read_silver(spark, target).collect())
    handler(clean, 0)
    twice = sorted(tuple(r) for r in U.read_silver(spark, target).collect())
    assert once == twice and len(once) == 3


def test_upsert_updates_and_keeps_untouched(spark):
    rows = [t("BTCUSDT", i, 100 + i, 1, WINDOW_MS + i * 20_000) for i in range(9)]   # 3 minutes
    clean = clean_trades(make_trades(spark, rows))
    target = scratch_path(spark, "test-upsert2")
    U.upsert_minutes(spark, target, minute_bars_stream(clean.where(F.col("trade_id") < 4)))
    assert U.read_silver(spark, target).count() == 2
    U.upsert_minutes(spark, target, U.recompute_touched(
        clean, U.touched_minutes(clean.where(F.col("trade_id") >= 4)), "1 minute", horizon=None))
    got = {r.window_start: r.trade_count for r in U.read_silver(spark, target).collect()}
    assert got == {T0: 3, T0 + dt.timedelta(minutes=1): 3, T0 + dt.timedelta(minutes=2): 3}


def test_foreach_batch_speed_layer(spark):
    root = scratch_path(spark, "test-speed")
    a = [t("ETHUSDT", 1, 10, 1, WINDOW_MS + 1_000), t("ETHUSDT", 2, 11, 2, WINDOW_MS + 61_000)]
    b = [t("ETHUSDT", 3, 12, 1, WINDOW_MS + 2_000)]        # late trade for minute 0
    write_file(f"{root}/in", "a.json", a)
    target, ckpt = f"{root}/silver", f"{root}/ckpt"

    def read_all():
        return spark.read.schema(TRADE).json(f"{root}/in")

    def run():
        stream = spark.readStream.schema(TRADE).json(f"{root}/in")
        q = U.stream_upsert(spark, stream, read_all, target, ckpt, "1 minute", horizon=None,
                            trigger={"availableNow": True})
        q.awaitTermination()
        return str(q.id)

    first = run()
    write_file(f"{root}/in", "b.json", b)
    assert run() == first and U.silver_table(spark, target).version().batches == {first: 1}   # batches 0 and 1, once each
    got = {r.window_start: r for r in U.read_silver(spark, target).collect()}
    assert got[T0].trade_count == 2 and got[T0].close == 12.0           # recomputed in full
    assert got[T0 + dt.timedelta(minutes=1)].trade_count == 1


def test_recompute_with_hot_part_guard_is_unchanged(spark):
    rows = [t("BTCUSDT", i, 100 + (i * 7) % 11, 1 + i % 3, WINDOW_MS + 5_000 + (i % 9), "true" if i % 2 else "false")
            for i in range(120)] + [t("BTCUSDT", 500, 99, 1, WINDOW_MS + 70_000)]
    clean = clean_trades(make_trades(spark, rows))
    touched = U.touched_minutes(clean)
    plain = {r.window_start: r.asDict() for r in U.recompute_touched(clean, touched, horizon=None).collect()}
    guarded = U.recompute_touched(clean, touched, horizon=None, max_part_rows=10).collect()
    assert len(guarded) == len(plain) == 2
    for r in guarded:
        p = plain[r.window_start]
        for k, v in r.asDict().items():
            if isinstance(v, float):
                assert abs(v - p[k]) <= 1e-12 * max(1.0, abs(v)), (k, v, p[k])
            else:
                assert v == p[k], (k, v, p[k])


def test_windows_over_midnight_and_landings_by_run_date_are_complete(spark):
    from tapecraft.sources import landing as L
    hour = 3_600_000
    rows = [t("BTCUSDT", i, 100 + i, 1, WINDOW_MS + (14 + 2 * i) * hour) for i in range(3)]   # 19:32, 21:32, 23:32
    rows.append(t("BTCUSDT", 9, 50, 1, WINDOW_MS + 20 * hour))                               # 01:32 of the next day
    for event_day, day in (("dt", None), (None, "2026-07-01")):
        path = scratch_path(spark, "test-midnight")
        L.partitioned_landing(make_trades(spark, rows), path, day=day)
        clean = clean_trades(L.read_landed(spark, path), "7 hours")
        late = clean.where(F.col("trade_id") == 0)
        (row,) = U.recompute_touched(clean, U.touched_minutes(late), "7 hours", horizon=None, event_day=event_day).collect()
        want = {r.minute: r for r in minute_bars(clean, "7 hours").collect()}[row.window_start]
        assert (row.trade_count, row.close) == (want.trade_count, want.close) and row.trade_count >= 2


def test_handler_reads_only_touched_days(spark):
    from tapecraft.sources import landing as L
    day = 86_400_000
    rows = [t("BTCUSDT", i, 100 + i, 1, WINDOW_MS + i * day) for i in range(5)]
    path, target = scratch_path(spark, "test-prune"), scratch_path(spark, "test-prune-silver")
    L.partitioned_landing(make_trades(spark, rows), path)
    clean = clean_trades(make_trades(spark, rows))
    seen = []

    def read_all():
        seen.append(L.read_landed(spark, path))
        return seen[-1]

    handle = U.upsert_handler(spark, read_all, target, horizon=None, event_day="dt")
    handle(clean, 0)
    handle(clean.where(F.col("trade_id") == 2), 1)
    assert U.read_silver(spark, target).count() == 5
    landed = clean_trades(L.read_landed(spark, path))
    touched = U.touched_minutes(clean.where(F.col("trade_id") == 2))
    plan = U.recompute_touched(landed, touched, horizon=None, event_day="dt")._jdf.queryExecution().executedPlan().toString()
    assert "2026-06-17" in plan.split("PartitionFilters")[1].split("]")[0]


def test_horizon_moves_with_the_batches_and_counts_what_it_skips(spark):
    rows = [t("BTCUSDT", i, 100 + i, 1, WINDOW_MS + i * 600_000) for i in range(7)]            # every ten minutes
    clean = clean_trades(make_trades(spark, rows))
    target, skipped = scratch_path(spark, "test-horizon"), []
    handle = U.upsert_handler(spark, lambda: make_trades(spark, rows), target, horizon="20 minutes",
                              on_skipped=lambda batch, n: skipped.append((batch, n)))
    handle(clean.where(F.col("trade_id") <= 1), 0)
    handle(clean.where(F.col("trade_id") > 1), 1)                                             # last trade at +60
    got = {r.window_start for r in U.read_silver(spark, target).collect()}
    assert got == {T0 + dt.timedelta(minutes=m) for m in (0, 10, 40, 50, 60)}
    assert skipped == [(1, 2)]


def burst(rng, n, span_ms, ids=None):
    """Trades of one symbol within a span of a minute; ids ascend unless given."""
    out = []
    for i in range(n):
        out.append(t("BTCUSDT", ids[i] if ids else i, round(100 + rng.random() * 5, 3), rng.randint(1, 9),
                     WINDOW_MS + 10_000 + rng.randrange(span_ms), "true" if rng.random() < 0.5 else "false"))
    return out


def test_bounded_runs_give_the_batch_bars_and_no_row_above_the_bound(spark):
    import random
    rng = random.Random(5)
    rows = burst(rng, 300, 3) + burst(rng, 40, 50_000, [-(k * 3) for k in range(40)]) + [t("ETHUSDT", None, 5, 1, WINDOW_MS)]
    clean = clean_trades(make_trades(spark, rows))
    from tapecraft.streaming import append as A
    runs = A.run_summaries(A.with_event_time(clean, "1 minute"), "1 minute", "1 second", 4)
    assert runs.agg(F.max("n")).first()[0] <= 4 and runs.agg(F.sum("n")).first()[0] == 341
    want = {(r.symbol, r.minute): r for r in minute_bars(clean).collect()}
    for bound in (1, 4, None):
        got = stream_minute_append(clean, "1 minute", "1 minute", bipower=True, max_run_trades=bound).collect()
        assert len(got) == len(want) == 2
        for r in got:
            w = want[r.symbol, r.window_start].asDict()
            for name, value in r.asDict().items():
                if name in w:
                    assert value == w[name] or abs(value - w[name]) < 1e-9 * max(1, abs(value)), (bound, name, value, w[name])


def test_repeats_across_batches_are_dropped_within_the_watermark(spark):
    from tapecraft.streaming.append import deduplicated
    root = scratch_path(spark, "test-dedup")
    one = [t("BTCUSDT", 1, 100, 1, WINDOW_MS + 1_000), t("BTCUSDT", 2, 110, 1, WINDOW_MS + 2_000), t("ETHUSDT", 1, 7, 1, WINDOW_MS)]
    none = [t("BTCUSDT", None, 5, 1, WINDOW_MS + 3_000), t("BTCUSDT", None, 6, 1, WINDOW_MS + 3_000)]
    write_file(f"{root}/in", "a.json", one + one[:1] + none)
    write_file(f"{root}/in", "b.json", one + none[:1] + [t("BTCUSDT", 3, 120, 1, WINDOW_MS + 4_000)])
    write_file(f"{root}/in", "c.json", one[1:2] + [t("BTCUSDT", 9, 1, 1, WINDOW_MS + 900_000)])
    raw = spark.readStream.schema(TRADE).option("maxFilesPerTrigger", 1).json(f"{root}/in")
    out = stream_minute_append(deduplicated(clean_trades(raw, "1 minute"), "5 minutes"), "1 minute")
    q = (out.writeStream.outputMode("append").format("parquet").option("path", f"{root}/out")
         .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    got = {(r.symbol, r.window_start): r.trade_count for r in spark.read.parquet(f"{root}/out").collect()}
    assert got == {("BTCUSDT", T0): 5, ("ETHUSDT", T0): 1}
