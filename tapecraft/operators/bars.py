"""Per-(symbol, window) bars: OHLC, VWAP, realized variance/volatility,
bipower variation, jump component and order-flow imbalance.

Order-dependent statistics (returns between consecutive trades) are computed
in two levels so that no single window -- however hot -- lands in one task:

1. *parts*: every window is cut into epoch-aligned sub-windows (``part``,
   default 1/60 of the window). Within a part, trades are ordered by
   (ts, trade_id) with a Window (one shuffle on (symbol, window, part); the
   Window operator sorts and spills, it never buffers a group in memory) and
   reduced to a fixed-size summary: first/last price, interior sums of r^2 and
   |r_i||r_{i-1}|, the first and last interior |r|, and the additive sums.
2. *stitch*: part summaries of one window (at most width/part rows, whatever
   the trade volume) are ordered by part; the return that crosses each part
   boundary and the bipower terms touching it are added back. The result is
   exactly the single-pass definition (every consecutive return inside the
   window, the first trade of a window has no return).

Order-free bars (OHLC, VWAP, OFI) are plain aggregations with map-side partial
aggregation, so they need no sort at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapecraft.functions.columns import (BUY, EPOCH_NTZ, MU, SELL, interval_ms, interval_seconds,
                                         safe_log_ratio, trade_order_key, window_start)
from tapecraft.operators.joins import join_small
from tapecraft.schemas import BARS_COLUMNS, BARS_STREAM_COLUMNS

KEYS = ["symbol", "minute"]


def default_part(width: str) -> str:
    """Sub-window used to split a window: width/60 (a one-minute window is cut
    into 1-second parts). Any divisor of the width works, down to milliseconds
    (e.g. ``'100 milliseconds'`` splits a hot minute 600 ways)."""
    ms = interval_ms(width)
    part = max(1, ms // 60)
    while ms % part:
        part -= 1
    return f"{part} milliseconds"


# Bits of ``part`` reserved for the sub-part of a split hot part (see below).
SUB_BITS = 20
# Cuts of a hot part, and then of a hot timestamp; at most MAX_WAYS (two rounds fit SUB_BITS).
HOT_WAYS = 64
MAX_WAYS = 1 << (SUB_BITS // 2 - 1)


def _with_part(clean: DataFrame, width: str, part: str | None,
               max_part_rows: int | None = None, hot_ways: int = HOT_WAYS) -> DataFrame:
    """Adds ``part``: a long that orders the parts of a window like their trades.

    It is the part's time offset inside the window, then (low ``SUB_BITS``)
    the sub-part index when ``max_part_rows`` splits hot parts.
    """
    part = part or default_part(width)
    if interval_ms(width) % interval_ms(part):
        raise ValueError(f"part {part!r} must divide window width {width!r}")
    if not 2 <= hot_ways <= MAX_WAYS:
        raise ValueError(f"hot_ways must be in [2, {MAX_WAYS}]")
    # the side travels through the shuffle as one nullable boolean (BUY true,
    # SELL false, anything else NULL: counted as neither), not as text
    side = F.col("side")
    out = (clean.withColumn("_pt", window_start("ts", part))
           .withColumn("_buy", F.when(side == F.lit(BUY), F.lit(True))
                       .when(side == F.lit(SELL), F.lit(False))))
    sub = F.lit(0).cast("long")
    if max_part_rows is not None:
        out = _split_hot_parts(out, max_part_rows, hot_ways)
        sub = F.col("_sub")
    # trades without a time (kept by the batch layer) are one part of the NULL window
    offset = F.coalesce(F.timestamp_diff("MILLISECOND", F.col("minute"), F.col("_pt")), F.lit(0))
    return out.withColumn("part", offset * F.lit(1 << SUB_BITS) + sub).drop("_pt", "_sub")


def _split_hot_parts(parted: DataFrame, max_rows: int, ways: int) -> DataFrame:
    """Cut every part holding more than ``max_rows`` trades into contiguous
    runs of its (ts, trade_id) order (``_sub``; 0 elsewhere).

    The ordered work of a part normally runs in one task; this bounds it even
    when one part holds a large share of the whole tape. Exact whatever the
    cut points: a run is contiguous in the order, and the stitch step adds the
    returns across every boundary.

    Two rounds: a hot part is cut by time, a run that is still hot because its
    trades share one timestamp is cut by trade id. Cuts are approximate
    quantiles, and trades that equal a cut are a run of their own, so a
    timestamp or id with more than a ``ways``-th of the trades stands alone.
    Trades that share a timestamp and an id (or have no id) are ties of the
    order and stay together, as do ids closer than a double can tell apart
    within their run.

    Costs aggregating passes over the trades (counts and ranges with map-side
    combine, then mergeable quantile sketches of the hot runs only); their
    results -- at most (trades / max_rows) rows -- are checkpointed to the
    shared folder.
    """
    from tapecraft.session import checkpoint_root
    checkpoint_root(parted.sparkSession)
    # one struct key: grouping and joins on it match NULL fields (a NULL symbol)
    out = (parted.withColumn("_pk", F.struct("symbol", "minute", "_pt")).withColumn("_sub", F.lit(0).cast("long"))
           .withColumn("_us", F.coalesce(F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), F.col("ts")), F.lit(0))))
    span = 2 * ways   # runs a cut list can make: between and on the cuts
    out = _cut_runs(out, "_us", None, max_rows, ways, span)
    out = _cut_runs(out, "trade_id", "_us", max_rows, ways, span)
    return out.drop("_pk", "_us")


def _cut_runs(runs: DataFrame, key: str, fixed: str | None, max_rows: int, ways: int, span: int) -> DataFrame:
    """Number the runs anew: those of more than ``max_rows`` trades (with one
    value of ``fixed``) are cut at quantiles of ``key``; NULL keys come first."""
    hot = (runs.groupBy("_pk", "_sub").agg(F.count(F.lit(1)).alias("_n"), F.min(key).alias("_lo"),
                                          *([F.min(fixed).alias("_a"), F.max(fixed).alias("_b")] if fixed else []))
           .where((F.col("_n") > F.lit(max_rows)) & (F.col("_a") == F.col("_b") if fixed else F.lit(True)))
           .select("_pk", "_sub", "_lo").checkpoint(eager=True))
    if hot.isEmpty():   # reads the checkpoint: nothing to cut, no sketch, no join
        return runs
    d = "decimal(38,0)"   # a difference of two longs may not fit one
    offset = (F.col(key).cast(d) - F.col("_lo").cast(d)).cast("double")
    # both small sides are checkpointed, so their size check reads them, not the trades
    cuts = (join_small(runs.select("_pk", "_sub", key), hot, ["_pk", "_sub"])
            .groupBy("_pk", "_sub", "_lo")
            .agg(F.array_distinct(F.percentile_approx(offset, [i / ways for i in range(1, ways)], HOT_ACCURACY))
                 .alias("_cuts"))
            .checkpoint(eager=True))
    # a cut list is ways-1 doubles: keep the broadcast side near 8 MB
    out = join_small(runs, cuts, ["_pk", "_sub"], "left", max_rows=max(1, (1 << 20) // ways))
    run = (F.size(F.filter("_cuts", lambda c: c < offset)) + F.size(F.filter("_cuts", lambda c: c <= offset))).cast("long")
    place = F.when(F.col("_cuts").isNull() | F.col(key).isNull(), F.lit(0).cast("long")).otherwise(run)
    return out.withColumn("_sub", F.col("_sub") * F.lit(span) + place).drop("_lo", "_cuts")


# Quantile sketch accuracy for hot-part cuts (only balance depends on it).
HOT_ACCURACY = 10_000


def _in_part_returns(parted: DataFrame) -> DataFrame:
    """lag-based returns inside each (symbol, window, part)."""
    w = Window.partitionBy("symbol", "minute", "part").orderBy("ts", "trade_id")
    return (
        parted
        .withColumn("rn", F.row_number().over(w))
        .withColumn("prev_price", F.lag("price").over(w))
        .withColumn("log_ret", safe_log_ratio(F.col("price"), F.col("prev_price")))
        .withColumn("abs_ret", F.abs("log_ret"))
        .withColumn("prev_abs_ret", F.lag("abs_ret").over(w))
    )


def _part_summaries(rets: DataFrame) -> DataFrame:
    q, p = F.col("quantity"), F.col("price")
    return rets.groupBy("symbol", "minute", "part").agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by("price", "rn").alias("first_price"),
        F.max_by("price", "rn").alias("last_price"),
        F.max(F.when(F.col("rn") == 2, F.col("abs_ret"))).alias("first_abs"),
        F.max_by("abs_ret", "rn").alias("last_abs"),
        F.sum(F.col("log_ret") * F.col("log_ret")).alias("sum_r2"),
        F.sum(F.col("abs_ret") * F.col("prev_abs_ret")).alias("sum_bp"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.sum(q).alias("volume"),
        F.sum(p * q).alias("notional"),
        F.sum(F.when(F.col("_buy"), q).otherwise(F.lit(0.0))).alias("buy_volume"),
        F.sum(F.when(~F.col("_buy"), q).otherwise(F.lit(0.0))).alias("sell_volume"),
    )


def _stitch(parts: DataFrame) -> DataFrame:
    """Add the boundary return of each part and the bipower terms touching it."""
    w = Window.partitionBy("symbol", "minute").orderBy("part")
    b_abs = F.abs(F.col("b"))
    return (
        parts
        .withColumn("prev_last", F.lag("last_price").over(w))
        .withColumn("b", safe_log_ratio(F.col("first_price"), F.col("prev_last")))
        # |return| into the last trade of the part, over the whole window sequence
        .withColumn("tail", F.when(F.col("n") >= 2, F.col("last_abs")).otherwise(b_abs))
        .withColumn("prev_tail", F.lag("tail").over(w))
        .withColumn("rv_part", F.coalesce(F.col("sum_r2"), F.lit(0.0))
                    + F.coalesce(F.col("b") * F.col("b"), F.lit(0.0)))
        .withColumn("bp_part", F.coalesce(F.col("sum_bp"), F.lit(0.0))
                    + F.coalesce(b_abs * F.col("prev_tail"), F.lit(0.0))
                    + F.coalesce(b_abs * F.col("first_abs"), F.lit(0.0)))
    )


def _vwap(notional, volume, empty_vwap: float | None = None):
    v = F.try_divide(notional, volume)
    return v if empty_vwap is None else F.coalesce(v, F.lit(float(empty_vwap)))


def with_flow(bars: DataFrame) -> DataFrame:
    """Adds ``signed_volume`` and ``ofi`` (0 for a window without volume)."""
    return (bars.withColumn("signed_volume", F.col("buy_volume") - F.col("sell_volume"))
            .withColumn("ofi", F.when(F.col("volume") > 0, F.col("signed_volume") / F.col("volume"))
                        .otherwise(F.lit(0.0))))


def finish_bars(bars: DataFrame, bipower: bool = True) -> DataFrame:
    """The columns derived from a bar's aggregates, for the batch and the stream reducer."""
    out = with_flow(bars.withColumn("realized_vol", F.sqrt("realized_variance")))
    if bipower:
        out = out.withColumn("jump_component",
                             F.greatest(F.col("realized_variance") - F.col("bipower_variation"), F.lit(0.0)))
    return out


def minute_bars(clean: DataFrame, width: str = "1 minute", part: str | None = None,
                empty_vwap: float | None = None, max_part_rows: int | None = None,
                hot_ways: int = HOT_WAYS) -> DataFrame:
    """Silver bars, batch semantics (17 columns, see ``schemas.BARS_COLUMNS``).

    ``clean`` must come from ``clean_trades`` with the same ``width``.
    ``empty_vwap``: VWAP of a window without volume (NULL by default; the
    message-stream reducer uses 0.0). Reachable only without ``positive_only``.
    ``max_part_rows``: split parts holding more trades than this into
    ``hot_ways`` sub-parts (see ``_split_hot_parts``); None skips the check.
    """
    parts = _part_summaries(_in_part_returns(_with_part(clean, width, part, max_part_rows, hot_ways)))
    stitched = _stitch(parts)
    bars = stitched.groupBy(*KEYS).agg(
        F.min_by("first_price", "part").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("last_price", "part").alias("close"),
        F.sum("volume").alias("volume"),
        F.sum("n").alias("trade_count"),
        _vwap(F.sum("notional"), F.sum("volume"), empty_vwap).alias("vwap"),
        F.sum("rv_part").alias("realized_variance"),
        (F.lit(MU) * F.sum("bp_part")).alias("bipower_variation"),
        F.sum("buy_volume").alias("buy_volume"),
        F.sum("sell_volume").alias("sell_volume"),
    )
    return finish_bars(bars).select(*BARS_COLUMNS)


def as_stream_shape(bars: DataFrame, width: str = "1 minute") -> DataFrame:
    """Batch bars -> speed-layer shape (``window_start``/``window_end``, no bipower/jump)."""
    secs = interval_seconds(width)
    return (
        bars.withColumnRenamed("minute", "window_start")
        .withColumn("window_end", F.col("window_start") + F.expr(f"INTERVAL {secs} SECONDS"))
        .select(*BARS_STREAM_COLUMNS)
    )


def minute_bars_stream(clean: DataFrame, width: str = "1 minute", part: str | None = None,
                       empty_vwap: float | None = None, max_part_rows: int | None = None) -> DataFrame:
    """Silver bars, speed-layer shape: no bipower/jump, adds ``window_end``."""
    return as_stream_shape(minute_bars(clean, width, part, empty_vwap, max_part_rows), width)


# --- order-free bars: single aggregation, partial (map-side) combine -----------

def _first_last(col: str):
    order = trade_order_key("ts", "trade_id")   # sorts as (ts, trade_id), hash-aggregatable
    return F.min_by(col, order), F.max_by(col, order)


def ohlc_bars(clean: DataFrame) -> DataFrame:
    first, last = _first_last("price")
    return clean.groupBy(*KEYS).agg(
        first.alias("open"), F.max("price").alias("high"),
        F.min("price").alias("low"), last.alias("close"),
    )


def vwap_bars(clean: DataFrame) -> DataFrame:
    return clean.groupBy(*KEYS).agg(
        F.sum("quantity").alias("volume"),
        F.count(F.lit(1)).alias("trade_count"),
        F.try_divide(F.sum(F.col("price") * F.col("quantity")), F.sum("quantity")).alias("vwap"),
    )


def order_flow_imbalance(clean: DataFrame) -> DataFrame:
    q = F.col("quantity")
    bars = clean.groupBy(*KEYS).agg(
        F.sum(q).alias("volume"),
        F.sum(F.when(F.col("side") == BUY, q).otherwise(F.lit(0.0))).alias("buy_volume"),
        F.sum(F.when(F.col("side") == SELL, q).otherwise(F.lit(0.0))).alias("sell_volume"),
    )
    return (with_flow(bars)
            .select(*KEYS, "buy_volume", "sell_volume", "signed_volume", "ofi"))


def realized_volatility(clean: DataFrame, width: str = "1 minute", part: str | None = None) -> DataFrame:
    return minute_bars(clean, width, part).select(*KEYS, "trade_count", "realized_variance", "realized_vol")


def bipower_jump(clean: DataFrame, width: str = "1 minute", part: str | None = None) -> DataFrame:
    return minute_bars(clean, width, part).select(
        *KEYS, "realized_variance", "bipower_variation", "jump_component")


# --- per-trade returns ----------------------------------------------------

RETURN_COLUMNS = ["symbol", "minute", "ts", "trade_id", "price", "quantity", "side", "prev_price",
                  "log_ret", "abs_ret", "prev_abs_ret", "bipower_term"]


def log_returns(clean: DataFrame, width: str = "1 minute", part: str | None = None,
                max_part_rows: int | None = None, hot_ways: int = HOT_WAYS) -> DataFrame:
    """Per-trade lagged returns inside each window (first trade: NULL).

    Same split as the bars, in one pass over the trades: lag inside parts;
    in the same ordered Window, the first two rows of each part also carry
    their part's summary (size, last price, last and second |r|) as
    whole-part window aggregates. Only those rows -- at most two per part,
    so at most 2*width/part per window -- are regrouped by window and ordered
    by (part, rn); two stacked lags give the previous part's last price and
    its trailing |r|, which patch rows 1 and 2. Rows 3+ need nothing from
    other parts and pass straight through. One scan, one trade shuffle, no join.
    ``max_part_rows`` / ``hot_ways`` split hot parts as in ``minute_bars``.
    """
    parted = _with_part(clean, width, part, max_part_rows, hot_ways)
    w = Window.partitionBy("symbol", "minute", "part").orderBy("ts", "trade_id")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rets = _in_part_returns(parted)
    rn = F.col("rn")
    head = (
        rets.withColumn("_n", F.count(F.lit(1)).over(whole))
        .withColumn("_last_price", F.last("price").over(whole))
        .withColumn("_last_abs", F.last("abs_ret").over(whole))
        .where(rn <= 2)
    )
    w2 = Window.partitionBy("symbol", "minute").orderBy("part", "rn")
    b = safe_log_ratio(F.col("price"), F.lag("_last_price").over(w2))
    head = (
        head.withColumn("_b", F.when(rn == 1, b))
        # |return| into the part's last trade; read on the part's last head row
        .withColumn("_tail", F.when(F.col("_n") >= 2, F.col("_last_abs")).otherwise(F.abs("_b")))
        .withColumn("_prev_tail", F.lag("_tail").over(w2))
        .withColumn("_prev_b_abs", F.lag(F.abs("_b")).over(w2))
        .withColumn("_prev_last", F.lag("_last_price").over(w2))
        .withColumn("prev_price", F.when(rn == 1, F.col("_prev_last")).otherwise(F.col("prev_price")))
        .withColumn("log_ret", safe_log_ratio(F.col("price"), F.col("prev_price")))
        .withColumn("abs_ret", F.abs("log_ret"))
        .withColumn("prev_abs_ret", F.when(rn == 1, F.col("_prev_tail")).otherwise(F.col("_prev_b_abs")))
    )
    tail = rets.where(rn > 2)
    cols = RETURN_COLUMNS[:-1]
    out = head.select(*cols).unionByName(tail.select(*cols))
    return out.withColumn("bipower_term", F.col("abs_ret") * F.col("prev_abs_ret"))
