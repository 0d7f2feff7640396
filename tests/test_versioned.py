"""Versioned tables: the switch, crashes, replays, conflicts; the upsert, ledger and gate on them."""

import datetime as dt

import pytest
from conftest import WINDOW_MS, make_trades
from pyspark.sql import functions as F

from tapecraft.operators.bars import minute_bars_stream
from tapecraft.operators.clean import clean_trades
from tapecraft.session import scratch_path
from tapecraft.sources import landing as L
from tapecraft.sources.versioned import VersionConflict, VersionedTable
from tapecraft.streaming import upsert as U
from tapecraft.streaming.ledger import SkippedWindows

T0 = dt.datetime(2026, 6, 15, 5, 32)
ROW = "symbol string, dt string, x double"


class Stopped(Exception):
    pass


@pytest.fixture
def table(spark):
    return VersionedTable(spark, scratch_path(spark, "test-versioned"))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def stop_before_switch(monkeypatch, times=1):
    """The next writes end after their data is written, before the version file."""
    real, left = VersionedTable._add_version, [times]

    def add(self, version):
        if left[0]:
            left[0] -= 1
            raise Stopped
        real(self, version)

    monkeypatch.setattr(VersionedTable, "_add_version", add)


def t(sym, tid, price, qty, ms, maker="false"):
    return (sym, tid, str(price), str(qty), ms, maker)


def test_a_write_that_stops_before_the_switch_changes_nothing_and_runs_again(spark, table, monkeypatch):
    first = [("a", "2026-01-01", 1.0), ("b", "2026-01-01", 2.0), ("c", "2026-01-02", 3.0)]
    table.merge(spark.createDataFrame(first, ROW), ["symbol", "dt"], ("w", 0))
    update = spark.createDataFrame([("a", "2026-01-01", 10.0), ("d", "2026-01-03", 4.0)], ROW)
    stop_before_switch(monkeypatch)
    with pytest.raises(Stopped):
        table.merge(update, ["symbol", "dt"], ("w", 1))
    assert rows(table.read()) == first                                   # the old version, whole
    table.merge(update, ["symbol", "dt"], ("w", 1))                        # replay
    after = [("a", "2026-01-01", 10.0), first[1], first[2], ("d", "2026-01-03", 4.0)]
    assert rows(table.read()) == after
    other = spark.createDataFrame([("a", "2026-01-01", 99.0)], ROW)
    assert table.merge(other, ["symbol", "dt"], ("w", 1)) is None          # the batch is applied already
    assert rows(table.read()) == after
    assert rows(table.read(version=table.version(1))) == first              # readers of the old version go on
    gone = table.vacuum(keep=1)
    assert len(gone) == 1 and rows(table.read()) == after                   # only what no version refers to


def test_two_writers_on_one_version(spark, table):
    base = table.replace(spark.createDataFrame([("a", "2026-01-01", 1.0)], ROW))
    table.merge(spark.createDataFrame([("b", "2026-01-01", 2.0)], ROW), ["symbol", "dt"])
    with pytest.raises(VersionConflict):
        table.replace(spark.createDataFrame([("z", "2026-01-01", 0.0)], ROW), base=base)
    assert [r[0] for r in rows(table.read())] == ["a", "b"]


def test_merge_reads_and_writes_only_the_partitions_of_its_updates(spark, table):
    days = [f"2026-01-{d:02d}" for d in range(1, 8)]
    table.replace(spark.createDataFrame([("a", d, float(i)) for i, d in enumerate(days)], ROW))
    before = table.version()
    after = table.merge(spark.createDataFrame([("a", days[3], -1.0)], ROW), ["symbol", "dt"])
    assert {d for d in days if after.folders[d] != before.folders[d]} == {days[3]}
    assert all("dt=2026-01-04" in f for f in table.read([days[3]]).inputFiles())


def test_null_and_odd_partitions_empty_frames_and_no_partition(spark, table):
    table.merge(spark.createDataFrame([("a", None, 1.0), ("b", "x/y=z %", 2.0)], ROW), ["symbol", "dt"])
    table.merge(spark.createDataFrame([("a", None, 3.0), (None, None, 4.0)], ROW), ["symbol", "dt"])
    table.merge(spark.createDataFrame([(None, None, 5.0)], ROW), ["symbol", "dt"])
    assert rows(table.read()) == [("a", None, 3.0), ("b", "x/y=z %", 2.0), (None, None, 5.0)]
    assert rows(table.read(["x/y=z %"])) == [("b", "x/y=z %", 2.0)] and rows(table.read([None])) == [("a", None, 3.0), (None, None, 5.0)]
    assert table.merge(spark.createDataFrame([], ROW), ["symbol", "dt"]) is None
    plain = VersionedTable(spark, scratch_path(spark, "test-plain"), None)
    assert plain.read() is None
    plain.replace(spark.range(5))
    plain.replace(plain.read().where("id > 2"))
    assert [r[0] for r in rows(plain.read())] == [3, 4]


def test_bars_of_the_null_window_are_merged_like_others(spark):
    """Target A, B (no window) and C; updates of A and C: B stays."""
    trades = [t("A", 1, 10, 1, None), t("B", 2, 20, 1, None), t("C", 3, 30, 1, WINDOW_MS)]
    target = scratch_path(spark, "test-null-window")
    U.upsert_minutes(spark, target, minute_bars_stream(clean_trades(make_trades(spark, trades))))
    later = [t("A", 1, 11, 1, None), t("C", 3, 33, 1, WINDOW_MS)]
    U.upsert_minutes(spark, target, minute_bars_stream(clean_trades(make_trades(spark, later))))
    assert {r.symbol: r.close for r in U.read_silver(spark, target).collect()} == {"A": 11.0, "B": 20.0, "C": 33.0}
    U.upsert_minutes(spark, target, minute_bars_stream(clean_trades(make_trades(spark, [t("B", 2, 22, 1, None)]))))
    assert {r.symbol: r.close for r in U.read_silver(spark, target).collect()} == {"A": 11.0, "B": 22.0, "C": 33.0}


def test_a_batch_stopped_before_the_switch_is_replayed_without_loss(spark, monkeypatch):
    trades = [t("BTCUSDT", i, 100 + i, 1, WINDOW_MS + i * 20_000) for i in range(9)]                # 3 minutes
    clean = clean_trades(make_trades(spark, trades))
    target = scratch_path(spark, "test-replay")
    handle = U.upsert_handler(spark, lambda: make_trades(spark, trades), target, horizon=None, writer="s")
    handle(clean, 0)
    stop_before_switch(monkeypatch)
    with pytest.raises(Stopped):
        handle(clean.where("trade_id = 4"), 1)
    assert U.read_silver(spark, target).count() == 3
    handle(clean.where("trade_id = 4"), 1)
    version = U.silver_table(spark, target).version().number
    handle(clean.where("trade_id = 4"), 1)                                                         # again: left out
    assert U.silver_table(spark, target).version().number == version
    assert sorted(r.trade_count for r in U.read_silver(spark, target).collect()) == [3, 3, 3]


def test_skipped_windows_are_repaired(spark, monkeypatch):
    trades = [t("BTCUSDT", i, 100 + i, 1, WINDOW_MS + i * 600_000) for i in range(7)]               # every ten minutes
    clean = clean_trades(make_trades(spark, trades))
    target, ledger = scratch_path(spark, "test-repair"), SkippedWindows(spark, scratch_path(spark, "test-ledger"))

    def read():
        return make_trades(spark, trades)

    handle = U.upsert_handler(spark, read, target, horizon="20 minutes", ledger=ledger, writer="s")
    handle(clean.where("trade_id = 6"), 0)
    handle(clean.where("trade_id IN (0, 1, 6)"), 1)
    handle(clean.where("trade_id IN (1, 2, 6)"), 2)
    assert ledger.pending() == ["1-horizon", "2-horizon"] and ledger.windows(ledger.pending()).count() == 3
    stop_before_switch(monkeypatch)
    with pytest.raises(Stopped):
        U.repair_skipped(spark, ledger, read, target)
    assert ledger.pending() == ["1-horizon", "2-horizon"]                                          # nothing is lost
    assert U.repair_skipped(spark, ledger, read, target).bars == 3
    assert ledger.pending() == [] and U.repair_skipped(spark, ledger, read, target) is None
    got = {r.window_start for r in U.read_silver(spark, target).collect()}
    assert got == {T0 + dt.timedelta(minutes=m) for m in (0, 10, 20, 60)}
    ledger.record(clean.where("trade_id = 3"), 9, "horizon")                                       # after a drain
    assert U.repair_skipped(spark, ledger, read, target).bars == 1


def test_a_faulty_batch_stops_alone_and_is_reported(spark):
    good = [t("BTCUSDT", 1, 100, 1, WINDOW_MS), t("ETHUSDT", 2, 10, 1, WINDOW_MS), t("BTCUSDT", 3, 101, 1, WINDOW_MS + 60_000)]
    landed = [*good, t("ETHUSDT", 4, "NaN", 1, WINDOW_MS + 120_000)]
    reports, target = [], scratch_path(spark, "test-gate")
    ledger = SkippedWindows(spark, scratch_path(spark, "test-gate-ledger"))
    handle = U.upsert_handler(spark, lambda: make_trades(spark, landed), target, horizon=None, ledger=ledger, on_report=reports.append)
    clean = clean_trades(make_trades(spark, landed))
    for number, ids in enumerate(([1, 2], [4, 1], [3])):
        handle(clean.where(F.col("trade_id").isin(ids)), number)
    assert [r.rejected for r in reports] == [False, True, False]
    assert (reports[1].bars, reports[1].failing["not_finite"], reports[1].failing["null_symbol"]) == (2, 1, 0)
    assert {(r.symbol, r.window_start) for r in U.read_silver(spark, target).collect()} == {
        ("BTCUSDT", T0), ("ETHUSDT", T0), ("BTCUSDT", T0 + dt.timedelta(minutes=1))}
    assert ledger.pending() == ["1-checks"]
    assert U.repair_skipped(spark, ledger, lambda: make_trades(spark, landed), target).rejected and ledger.pending()
    landed[-1] = t("ETHUSDT", 4, 12, 1, WINDOW_MS + 120_000)                                        # the source is mended
    assert not U.repair_skipped(spark, ledger, lambda: make_trades(spark, landed), target).rejected
    assert U.read_silver(spark, target).count() == 4 and ledger.pending() == []


def test_a_batch_lists_only_the_landing_folders_of_its_windows(spark):
    day = 86_400_000
    trades = [t("BTCUSDT", i, 100 + i, 1, WINDOW_MS + i * day) for i in range(5)]
    trades.append(t("BTCUSDT", 9, 50, 1, WINDOW_MS + 2 * day + 20 * 3_600_000))                      # 01:32, day 4
    path, target = scratch_path(spark, "test-days"), scratch_path(spark, "test-days-silver")
    L.partitioned_landing(make_trades(spark, trades), path)
    clean, read = clean_trades(make_trades(spark, trades), "7 hours"), []

    def read_days(days):
        frame = L.read_landed(spark, path, days)
        read.append({f.split("dt=")[1][:10] for f in frame.inputFiles()})
        return frame

    handle = U.upsert_handler(spark, None, target, "7 hours", horizon=None, read_days=read_days)
    handle(clean, 0)
    handle(clean.where("trade_id = 1"), 1)
    handle(clean.where("trade_id = 9"), 2)
    utc, width = (lambda ms: str(dt.datetime.fromtimestamp(ms / 1000, dt.timezone.utc).date())), 7 * 3_600_000

    def reached(ms):                                                                               # the days of its window
        return {utc(ms // width * width), utc(ms // width * width + width - 1)}

    assert len(read[0]) == 5 and read[1:] == [reached(trades[1][4]), reached(trades[5][4])]
    assert all(len(days) <= 2 for days in read[1:])
    silver = U.silver_table(spark, target)
    assert len({silver.version().folders[d] for d in ("2026-06-14", "2026-06-19") if d in silver.version().folders}) == 1   # untouched days
    want = {(r.window_start, r.trade_count) for r in minute_bars_stream(clean, "7 hours").collect()}
    assert {(r.window_start, r.trade_count) for r in U.read_silver(spark, target).collect()} == want
