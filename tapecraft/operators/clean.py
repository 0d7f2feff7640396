"""Cleaning and recency filters for raw trades."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapecraft.functions.columns import aggressor_side, interval_seconds, ms_to_ts, ntz_literal, window_start

CLEAN_COLUMNS = ["symbol", "trade_id", "trade_time", "ts", "price", "quantity", "side", "minute"]


def clean_trades(raw: DataFrame, width: str = "1 minute", positive_only: bool = True,
                 null_trade_id: str = "keep") -> DataFrame:
    """Type and filter bronze trades.

    price/quantity text -> double (malformed -> NULL, then dropped), epoch ms ->
    TIMESTAMP_NTZ ``ts``, maker flag -> aggressor ``side``, ``minute`` = start
    of the tumbling window of ``width`` holding the trade. With
    ``positive_only`` (batch and Spark-stream semantics) only trades with
    price > 0 and quantity > 0 survive; without it (message-stream semantics)
    only a missing trade time drops a row and returns guard the log instead.
    ``null_trade_id``: ``"keep"`` (NULL sorts first) or ``"zero"`` (NULL -> 0).
    """
    if null_trade_id not in ("keep", "zero"):
        raise ValueError("null_trade_id must be 'keep' or 'zero'")
    maker_type = raw.schema["is_buyer_maker"].dataType
    price = F.col("price").try_cast("double")
    qty = F.col("quantity").try_cast("double")
    passthrough = [c for c in ("dt",) if c in raw.columns]  # landing partition column
    out = raw.select(
        *passthrough,
        F.col("symbol"),
        (F.coalesce(F.col("trade_id").try_cast("long"), F.lit(0).cast("long"))
         if null_trade_id == "zero" else F.col("trade_id")).alias("trade_id"),
        F.col("trade_time"),
        ms_to_ts(F.col("trade_time")).alias("ts"),
        price.alias("price"),
        qty.alias("quantity"),
        aggressor_side(F.col("is_buyer_maker"), maker_type).alias("side"),
    )
    if positive_only:
        out = out.where((F.col("price") > 0) & (F.col("quantity") > 0))
    else:
        out = out.where(F.col("trade_time").isNotNull())
    return out.withColumn("minute", window_start(F.col("ts"), width))


def recent_trades(clean: DataFrame, as_of: datetime, horizon: str = "20 minutes",
                  width: str | None = None) -> DataFrame:
    """Trades at or after ``as_of - horizon``.

    With ``width`` the cutoff is rounded *down* to a whole window, so no window
    straddling the cutoff is ever cut into a suffix: a window is either fully
    inside the horizon or fully outside.
    """
    cutoff = ntz_literal(as_of) - F.expr(f"INTERVAL {interval_seconds(horizon)} SECONDS")
    if width is not None:
        cutoff = window_start(cutoff, width)
        return clean.where(F.col("minute") >= cutoff)
    return clean.where(F.col("ts") >= cutoff)
