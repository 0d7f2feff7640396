"""Access to the driver's parquet tables and their trade-tape adapters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapecraft.functions.columns import ts_to_ms, ts_to_seconds

# --- Fixed values of the test-data adapter --------------------------------
# events.event_type -> traded pair. Five pairs so that the USDT strip, all
# three market-cap tiers and a metadata gap (DOGE, AVAX) are exercised.
EVENT_SYMBOLS = {
    "click": "BTCUSDT",
    "view": "ETHUSDT",
    "purchase": "SOLUSDT",
    "signup": "DOGEUSDT",
    "error": "AVAXUSDT",
}
# The metadata feed covers three of the traded coins and two that are not
# traded, so that assets without metadata occur (DOGE, AVAX).
METADATA_COINS = {
    "click": ("coingecko:bitcoin", "BTC"),
    "view": ("coingecko:ethereum", "ETH"),
    "purchase": ("coingecko:solana", "SOL"),
    "signup": ("coingecko:litecoin", "LTC"),
    "error": ("coingecko:tron", "TRX"),
}
METADATA_SOURCE = "defillama"
# --------------------------------------------------------------------------


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(col: Column, mapping: dict) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == F.lit(k), F.lit(v)) if expr is None else expr.when(col == F.lit(k), F.lit(v))
    return expr


def events_as_trades(events: DataFrame) -> DataFrame:
    """Read ``events`` as a bronze trade tape (TRADE layout, maker flag as boolean).

    symbol from event_type, trade_id = event_id, price = value (as text, like
    the exchange sends it), quantity = props.k (text), trade_time = ts in epoch
    ms, is_buyer_maker = odd user_id.
    """
    trade_time = ts_to_ms(F.col("ts"))
    return events.select(
        F.lit("trade").alias("event_type"),
        trade_time.alias("event_time"),
        _case(F.col("event_type"), EVENT_SYMBOLS).alias("symbol"),
        F.col("event_id").alias("trade_id"),
        F.col("value").cast("string").alias("price"),
        F.get_json_object(F.col("props"), "$.k").alias("quantity"),
        trade_time.alias("trade_time"),
        (F.col("user_id") % 2 == 1).alias("is_buyer_maker"),
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_trades(read_table(spark, sf_dir, "events"))


def events_as_metadata(events: DataFrame) -> DataFrame:
    """Read ``events`` as a flat asset-metadata feed (METADATA layout).

    Each event is one price observation of its type's coin: price = value,
    timestamp = epoch seconds of ts, confidence = props.k / 100.
    """
    et = F.col("event_type")
    return events.select(
        _case(et, {k: v[0] for k, v in METADATA_COINS.items()}).alias("coin_id"),
        _case(et, {k: v[1] for k, v in METADATA_COINS.items()}).alias("symbol"),
        F.col("value").alias("price"),
        ts_to_seconds(F.col("ts")).alias("timestamp"),
        (F.get_json_object(F.col("props"), "$.k").cast("double") / F.lit(100.0)).alias("confidence"),
        F.lit(METADATA_SOURCE).alias("source"),
    )


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_metadata(read_table(spark, sf_dir, "events"))
