"""Append-mode bars over a trade stream (event time, watermark, tumbling windows).

Window functions such as ``lag`` are not available on streams, so the
order-dependent statistics are computed from sorted arrays with higher-order
functions -- in levels like the batch reducer's, so that no state row ever holds
a whole hot window:

1. ``groupBy(symbol, window(ts, width), part)``: the trades of one part of a
   window, sorted by (ts, trade_id), reduced to a fixed-size summary.
2. ``groupBy(symbol, window)``: at most width/part part summaries per window,
   sorted and stitched across part boundaries.

With ``max_run_trades`` a level comes before them: the trades of one millisecond
and one range of that many trade ids. Such runs follow each other in the order
(ts, trade_id), so they stitch like parts do, twice over, and give the same bars.
A state row then holds at most ``max_run_trades`` trades where ids are unique, in
whatever burst; a part's row holds summaries, one a run.

All aggregations are stateful and driven by the same watermark; a window is
emitted once, when the watermark passes its end. Trades arriving after that
are dropped by Spark (late data). ``deduplicated`` drops repeats before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapecraft.functions.columns import BUY, MU, SELL, interval_ms
from tapecraft.operators.bars import default_part, finish_bars
from tapecraft.schemas import BARS_STREAM_COLUMNS


def _ln_ratio(num: Column, den: Column) -> Column:
    return F.when((num > 0) & (den > 0), F.log(num / den))


#: Fields of a summary of consecutive trades, after the key that orders it. ``first_abs`` and
#: ``last_abs`` are the absolute returns into its second and its last trade.
SUMMARY = ["n", "first_price", "last_price", "first_abs", "last_abs", "sum_r2", "sum_bp", "high", "low",
           "volume", "notional", "buy_volume", "sell_volume"]
_NUMBERS = ("sum_r2", "sum_bp", "volume", "notional", "buy_volume", "sell_volume")


def _zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def _appended(s: Column, x: dict[str, Column]) -> Column:
    """Summary ``s`` with the summary ``x`` of the trades that follow: the return across the
    boundary and the bipower terms that touch it are added."""
    def with_return(b: Column) -> Column:
        size = F.abs(b)
        made = {
            "n": s["n"] + x["n"],
            "first_price": F.when(s["n"] == 0, x["first_price"]).otherwise(s["first_price"]),
            "last_price": x["last_price"],
            "first_abs": F.when(s["n"] == 0, x["first_abs"]).when(s["n"] == 1, size).otherwise(s["first_abs"]),
            "last_abs": F.when(x["n"] >= 2, x["last_abs"]).otherwise(size),
            "sum_r2": s["sum_r2"] + _zero(x["sum_r2"]) + _zero(b * b),
            "sum_bp": s["sum_bp"] + _zero(x["sum_bp"]) + _zero(size * s["last_abs"]) + _zero(size * x["first_abs"]),
            "high": F.greatest(s["high"], x["high"]),
            "low": F.least(s["low"], x["low"]),
            **{k: s[k] + _zero(x[k]) for k in ("volume", "notional", "buy_volume", "sell_volume")},
        }
        return F.struct(*[made[k].alias(k) for k in SUMMARY])

    # the return is used often: bound once, as lambdas evaluate a repeated expression repeatedly
    crossing = F.when(s["n"] > 0, _ln_ratio(x["first_price"], s["last_price"]))
    return F.get(F.transform(F.array(crossing), with_return), F.lit(0))


def _folded(items: Column, summary_of) -> Column:
    """One pass over the items in their order: a state of fixed size, linear in their number."""
    nothing = F.lit(None).cast("double")
    start = {**{k: nothing for k in SUMMARY}, "n": F.lit(0).cast("long"), **{k: F.lit(0.0) for k in _NUMBERS}}
    folded = F.aggregate(F.array_sort(items), F.struct(*[start[k].alias(k) for k in SUMMARY]),
                         lambda s, x: _appended(s, summary_of(x)))
    return folded


def part_summary(trades: Column) -> Column:
    """Summary of an array of trade structs (ts, trade_id, price, quantity, buy), in (ts, trade_id)
    order like the batch reducer."""
    def single(x: Column) -> dict[str, Column]:
        price, quantity, nothing = x["price"], x["quantity"], F.lit(None).cast("double")
        return {
            "n": F.lit(1).cast("long"), "first_price": price, "last_price": price, "first_abs": nothing, "last_abs": nothing,
            "sum_r2": nothing, "sum_bp": nothing, "high": price, "low": price, "volume": quantity, "notional": price * quantity,
            "buy_volume": F.when(x["buy"], quantity), "sell_volume": F.when(~x["buy"], quantity),
        }

    return _folded(trades, single)


def stitch_summaries(parts: Column) -> Column:
    """Summary of an array of consecutive summaries' structs (an order key, then ``SUMMARY``)."""
    return _folded(parts, lambda x: {k: x[k] for k in SUMMARY})


def with_event_time(clean_stream: DataFrame, watermark: str) -> DataFrame:
    """Adds ``_et``, the trade's instant, under a watermark; trades without a time go, as no window holds them."""
    # watermarks need an instant (TIMESTAMP) column; windows are epoch aligned,
    # so their bounds equal the NTZ windows of the batch path in a UTC session
    return (clean_stream.where(F.col("ts").isNotNull()).withColumn("_et", F.timestamp_millis(F.col("trade_time")))
            .withWatermark("_et", watermark))


def deduplicated(clean_stream: DataFrame, watermark: str) -> DataFrame:
    """The stream under its watermark without repeats of a trade, also across micro-batches.

    A trade is known by symbol and id, one without an id by symbol, time, price,
    quantity and side. A key is remembered until the watermark has passed its first
    arrival's time by the watermark's delay, so repeats within that delay go.
    """
    timed = with_event_time(clean_stream, watermark)
    known = F.when(F.col("trade_id").isNull(), F.struct("trade_time", "price", "quantity", "side"))
    keyed = timed.withColumn("_known", F.xxhash64(F.col("trade_id").isNull(), F.coalesce(F.col("trade_id"), F.lit(0)),
                                                  known["trade_time"], known["price"], known["quantity"], known["side"]))
    return keyed.dropDuplicatesWithinWatermark(["symbol", "trade_id", "_known"]).drop("_known")


def _summarised(groups: DataFrame, columns: list, summary: Column) -> DataFrame:
    return groups.select(*columns, summary.alias("_s")).select("*", "_s.*").drop("_s")


def run_summaries(timed: DataFrame, width: str, part: str, max_run_trades: int) -> DataFrame:
    """First of three levels: ``symbol, pt, part, trade_time, run`` and the summary of the run's trades."""
    n = max_run_trades
    run = F.expr(f"trade_id div {n} - CASE WHEN trade_id % {n} < 0 THEN 1 ELSE 0 END")
    runs = timed.groupBy("symbol", F.window("_et", width).alias("pw"), _part_of(width, part).alias("part"), "trade_time",
                         run.alias("run")).agg(F.collect_list(_trade()).alias("_trades"))
    return _summarised(runs, ["symbol", F.window_time("pw").alias("pt"), "part", "trade_time", "run"],
                       part_summary(F.col("_trades")))


def _part_of(width: str, part: str) -> Column:
    return F.floor(F.pmod(F.col("trade_time"), F.lit(interval_ms(width))) / F.lit(interval_ms(part)))


def _trade() -> Column:
    # side kept in state as one nullable boolean (BUY true, SELL false), not text
    buy = F.when(F.col("side") == F.lit(BUY), F.lit(True)).when(F.col("side") == F.lit(SELL), F.lit(False))
    return F.struct("ts", "trade_id", "price", "quantity", buy.alias("buy"))


def stream_minute_append(clean_stream: DataFrame, width: str = "1 minute",
                         watermark: str = "30 seconds", part: str | None = None,
                         bipower: bool = False, empty_vwap: float | None = None,
                         max_run_trades: int | None = None) -> DataFrame:
    """Streaming bars in append mode (speed-layer shape; ``bipower=True`` adds
    bipower_variation and jump_component; ``empty_vwap`` as in ``minute_bars``).

    A stream that comes with an event time (``deduplicated``) keeps its watermark.
    ``max_run_trades`` bounds the trades of a state row (see above); None holds a
    part's trades in one row.
    """
    part = part or default_part(width)
    if interval_ms(width) % interval_ms(part):
        raise ValueError(f"part {part!r} must divide window width {width!r}")
    if max_run_trades is not None and max_run_trades < 1:
        raise ValueError("max_run_trades must be at least 1")
    timed = clean_stream if "_et" in clean_stream.columns else with_event_time(clean_stream, watermark)
    # The window itself is in every key: its state closes, and a trade is
    # late, when the watermark passes the window's end, whatever the part.
    if max_run_trades is None:
        lvl1 = timed.groupBy("symbol", F.window("_et", width).alias("pw"), _part_of(width, part).alias("part")).agg(
            F.collect_list(_trade()).alias("_trades"))
        summary = part_summary(F.col("_trades"))
    else:
        runs = run_summaries(timed, width, part, max_run_trades)
        lvl1 = runs.groupBy("symbol", F.window("pt", width).alias("pw"), "part").agg(
            F.collect_list(F.struct("trade_time", "run", *SUMMARY)).alias("_runs"))
        summary = stitch_summaries(F.col("_runs"))
    parts = _summarised(lvl1, ["symbol", F.window_time("pw").alias("pt"), "part"], summary)
    lvl2 = (
        parts.groupBy("symbol", F.window("pt", width).alias("w"))
        .agg(F.collect_list(F.struct("part", *SUMMARY)).alias("_parts"))
    )
    done = lvl2.select("symbol", "w", stitch_summaries(F.col("_parts")).alias("_s")).select("symbol", "w", "_s.*")
    vwap = F.try_divide("notional", "volume")
    out = done.select(
        "symbol",
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"),
        F.col("first_price").alias("open"), "high", "low", F.col("last_price").alias("close"),
        "volume", F.col("n").alias("trade_count"),
        (vwap if empty_vwap is None else F.coalesce(vwap, F.lit(float(empty_vwap)))).alias("vwap"),
        F.col("sum_r2").alias("realized_variance"),
        (F.lit(MU) * F.col("sum_bp")).alias("bipower_variation"),
        "buy_volume", "sell_volume",
    )
    out = finish_bars(out, bipower)
    if bipower:
        return out.select(*BARS_STREAM_COLUMNS, "bipower_variation", "jump_component")
    return out.select(*BARS_STREAM_COLUMNS)
