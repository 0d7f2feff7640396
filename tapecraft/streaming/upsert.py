"""Speed layer with late data: recompute every touched window in full and
upsert it into silver, keyed on (symbol, window_start).

Per micro-batch (``foreachBatch``):
1. ``touched_minutes``: distinct (symbol, window) keys of the batch -- kept as
   a DataFrame, never collected to the driver. Windows before the horizon go to
   the ledger (``ledger.SkippedWindows``) for a later repair;
2. ``recompute_touched``: all landed trades of those windows (semi join),
   reduced to bars. With ``read_days`` only the landing folders of the days that
   the windows reach are listed and read;
3. the gate (``gate.check_bars``): metrics observed while the bars are made; a
   batch with a failing check changes nothing, its windows go to the ledger;
4. ``upsert_minutes``: a merge into a versioned table (``sources.versioned``),
   whose touched ``dt`` partitions are written anew beside the old ones and
   switched in by one file that also holds the batch's number.

A batch that stops anywhere before the switch changes nothing and can run again;
one that is replayed after the switch finds its number and is left out. Without a
number (direct calls) a replay recomputes the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapecraft.functions.columns import interval_seconds, ntz_literal, window_start
from tapecraft.operators.bars import minute_bars_stream
from tapecraft.operators.clean import clean_trades, recent_trades
from tapecraft.session import checkpoint_root
from tapecraft.sources.versioned import Version, VersionConflict, VersionedTable
from tapecraft.streaming.gate import SPEED_CHECKS, BatchReport, check_bars
from tapecraft.streaming.ledger import SkippedWindows

KEYS = ["symbol", "window_start"]


def touched_minutes(batch: DataFrame) -> DataFrame:
    """Distinct (symbol, minute) of a micro-batch; NULL/empty symbol and NULL
    minute are dropped. Partially aggregated, so a hot key collapses map-side."""
    return (batch.select("symbol", "minute")
            .where(F.col("symbol").isNotNull() & (F.col("symbol") != "") & F.col("minute").isNotNull())
            .distinct())


def touched_days(touched: DataFrame, width: str = "1 minute") -> tuple[str, str] | None:
    """First and last UTC day that the touched windows reach, as literals for
    partition filters (one aggregate); None without windows."""
    end = F.col("minute") + F.expr(f"INTERVAL {interval_seconds(width)} SECONDS") - F.expr("INTERVAL 1 MICROSECOND")
    row = touched.agg(F.date_format(F.min("minute"), "yyyy-MM-dd").alias("lo"),
                      F.date_format(F.max(end), "yyyy-MM-dd").alias("hi")).first()
    return None if row["lo"] is None else (row["lo"], row["hi"])


def touched_day_list(touched: DataFrame, width: str = "1 minute") -> list[str]:
    """The UTC days that the touched windows reach, each once (calendar days, on the driver)."""
    end = F.col("minute") + F.expr(f"INTERVAL {interval_seconds(width)} SECONDS") - F.expr("INTERVAL 1 MICROSECOND")
    days = touched.select(F.to_date("minute").alias("a"), F.to_date(end).alias("b")).distinct().select(
        F.explode(F.sequence("a", "b")).alias("d")).distinct()
    return sorted(row[0] for row in days.select(F.date_format("d", "yyyy-MM-dd")).collect())


def horizon_start(as_of: datetime, horizon: str, width: str):
    """The first window start that is recomputed: ``as_of - horizon``, aligned
    down to a whole window, so a window on the cut is never cut itself."""
    return window_start(ntz_literal(as_of) - F.expr(f"INTERVAL {interval_seconds(horizon)} SECONDS"), width)


def recompute_touched(all_trades: DataFrame, touched: DataFrame, width: str = "1 minute",
                      as_of: datetime | None = None, horizon: str | None = "20 minutes",
                      part: str | None = None, max_part_rows: int | None = None,
                      event_day: str | None = None) -> DataFrame:
    """Bars (speed-layer shape) of the touched windows, from *all* their trades.

    ``all_trades`` are clean trades (``clean_trades`` with the same width). With
    ``as_of`` and ``horizon`` only windows from ``horizon_start`` on are
    recomputed. ``event_day`` names a partition column that holds each trade's
    own UTC day (not a landing run's day): the scan is then pruned to the days
    that the touched windows reach. ``part`` / ``max_part_rows`` split hot
    windows as in ``minute_bars``.
    """
    t, keys = all_trades, touched.select("symbol", "minute")
    if as_of is not None and horizon:
        t = recent_trades(t, as_of, horizon, width)
        keys = keys.where(F.col("minute") >= horizon_start(as_of, horizon, width))
    if event_day is not None:
        days = touched_days(keys, width)
        t = t.where(F.col(event_day).between(*days) if days else F.lit(False))
    t = t.join(keys, ["symbol", "minute"], "left_semi")
    return minute_bars_stream(t, width, part, max_part_rows=max_part_rows)


def silver_table(spark: SparkSession, target: str) -> VersionedTable:
    """The versioned silver table at ``target``, partitioned by the day of the window."""
    return VersionedTable(spark, target, "dt")


def read_silver(spark: SparkSession, target: str, days: list[str | None] | None = None) -> DataFrame | None:
    """The current rows of the silver table (of some days only); None before the first upsert."""
    return silver_table(spark, target).read(days)


def upsert_minutes(spark: SparkSession, target: str, updates: DataFrame, keys=KEYS, day_of: str = "window_start",
                   batch: tuple[str, int] | None = None, materialized: bool = False, attempts: int = 3) -> Version | None:
    """Keyed update-or-insert of ``updates`` (one row per key) into the silver table at ``target``.

    Keys match null-safe: bars of the NULL window have a partition of their own and
    are updated like any other, untouched rows stay. Only the days of the updates
    are read and written. ``batch`` (a writer's name and its batch number) is
    applied at most once. A merge that meets another writer's new version starts
    over on that one, ``attempts`` times at most. ``materialized``: the updates are
    a written or checkpointed frame and are not checkpointed again.
    """
    table = silver_table(spark, target)
    rows = updates.withColumn("dt", F.date_format(F.col(day_of), "yyyy-MM-dd"))
    for left in reversed(range(attempts)):
        try:
            return table.merge(rows, keys, batch, materialized)
        except VersionConflict:
            if not left:
                raise


def _running_stream(spark: SparkSession) -> str | None:
    """The id of the streaming query whose batch is being handled: new with every new checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def upsert_handler(spark: SparkSession, read_all: Callable[[], DataFrame] | None, target: str,
                   width: str = "1 minute", as_of: datetime | Callable[[], datetime] | None = None,
                   horizon: str | None = "20 minutes", part: str | None = None,
                   max_part_rows: int | None = None, event_day: str | None = None,
                   on_skipped: Callable[[int, int], None] | None = None, writer: str | None = None,
                   read_days: Callable[[list[str]], DataFrame] | None = None, ledger: SkippedWindows | None = None,
                   checks: dict | None = SPEED_CHECKS, on_report: Callable[[BatchReport], None] | None = None):
    """``foreachBatch`` callback: touched -> recompute from all trades -> gate -> upsert.

    The landing comes from ``read_all()``, or from ``read_days(days)`` with the days
    that the touched windows reach. The horizon moves with the batches: it is
    counted from ``as_of`` (a time, or a function called per batch) or else from the
    batch's last trade. Touched windows before it are not recomputed but entered in
    the ``ledger``; ``on_skipped(batch_id, windows)`` is told how many.
    ``horizon=None`` recomputes all touched windows. ``checks`` (None: no gate) are
    conditions that no bar may meet; a batch with such bars is entered in the ledger
    instead of being upserted. Every batch's counts go to ``on_report``. ``writer``
    (the running streaming query's id by default) names the stream: its batches are
    applied once. Batches of direct calls have no number.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        name = writer or _running_stream(spark)
        number = None if name is None else (name, batch_id)
        if silver_table(spark, target).is_applied(number):
            return
        # touched keys are used several times (emptiness, days, semi join):
        # keep them for the duration of the batch instead of re-reading the batch
        touched = touched_minutes(batch).persist()
        try:
            if touched.isEmpty():
                return
            now, keys = None, touched
            if horizon:
                now = as_of() if callable(as_of) else as_of or batch.agg(F.max("ts").alias("t")).first()["t"]
                fresh = F.col("minute") >= horizon_start(now, horizon, width)
                counts = touched.agg(F.count(F.when(~fresh, 1)).alias("old"), F.count(F.when(fresh, 1)).alias("new")).first()
                if counts["old"]:
                    if ledger is not None:
                        ledger.record(touched.where(~fresh), batch_id, "horizon")
                    if on_skipped is not None:
                        on_skipped(batch_id, counts["old"])
                if not counts["new"]:
                    return
                keys = touched.where(fresh)
            landed = read_all() if read_days is None else read_days(touched_day_list(keys, width))
            bars = recompute_touched(clean_trades(landed, width), keys, width, now, horizon, part, max_part_rows, event_day)
            if checks is not None:
                checkpoint_root(spark)
                bars, report = check_bars(bars, checks, batch_id)
                if on_report is not None:
                    on_report(report)
                if report.rejected:
                    if ledger is not None:
                        ledger.record(keys, batch_id, "checks")
                    return
            upsert_minutes(spark, target, bars, batch=number, materialized=checks is not None)
        finally:
            touched.unpersist()

    return handle


def repair_skipped(spark: SparkSession, ledger: SkippedWindows, read_all: Callable[[], DataFrame] | None, target: str,
                   width: str = "1 minute", part: str | None = None, max_part_rows: int | None = None,
                   event_day: str | None = None, read_days: Callable[[list[str]], DataFrame] | None = None,
                   checks: dict | None = SPEED_CHECKS) -> BatchReport | None:
    """Drain the ledger: its windows are recomputed from all landed trades, whatever their age,
    and upserted; then the entries go. None if there are none.

    A repair that stops midway leaves the entries, and the next one does it again.
    Bars that fail the checks keep their batches in the ledger.
    """
    entries = ledger.pending()
    if not entries:
        return None
    keys = ledger.windows(entries)
    landed = read_all() if read_days is None else read_days(touched_day_list(keys, width))
    bars = recompute_touched(clean_trades(landed, width), keys, width, None, None, part, max_part_rows, event_day)
    checkpoint_root(spark)
    bars, report = check_bars(bars, checks or {}, -1)
    if report.rejected:
        return report
    upsert_minutes(spark, target, bars, materialized=True)
    ledger.drain(entries)
    return report


def stream_upsert(spark: SparkSession, trades_stream: DataFrame, read_all: Callable[[], DataFrame] | None,
                  target: str, checkpoint: str, width: str = "1 minute", trigger: dict | None = None, **options):
    """Start the speed-layer query; returns the StreamingQuery. ``options`` are those of
    ``upsert_handler``; batches are numbered under the query's id, which a restart from
    the same checkpoint keeps and a new checkpoint, whose batches begin at 0, does not."""
    clean = clean_trades(trades_stream, width)
    handler = upsert_handler(spark, read_all, target, width, **options)
    writer = (clean.writeStream.outputMode("append").foreachBatch(handler)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(**(trigger or {"processingTime": "30 seconds"}))
    return writer.start()
