"""Declared schemas of the trade tape, metadata and silver bars."""

from pyspark.sql import types as T

# Bronze trade record as landed (JSON lines); price/quantity arrive as text.
TRADE = T.StructType([
    T.StructField("event_type", T.StringType()),
    T.StructField("event_time", T.LongType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("trade_id", T.LongType()),
    T.StructField("price", T.StringType()),
    T.StructField("quantity", T.StringType()),
    T.StructField("trade_time", T.LongType()),
    T.StructField("is_buyer_maker", T.StringType()),
])

# Raw exchange message: {"data": {e, E, s, t, p, q, T, m}}.
TRADE_ENVELOPE = T.StructType([
    T.StructField("data", T.StructType([
        T.StructField("e", T.StringType()),
        T.StructField("E", T.LongType()),
        T.StructField("s", T.StringType()),
        T.StructField("t", T.LongType()),
        T.StructField("p", T.StringType()),
        T.StructField("q", T.StringType()),
        T.StructField("T", T.LongType()),
        T.StructField("m", T.StringType()),
    ])),
])

COIN = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("confidence", T.DoubleType()),
])

# Raw metadata message: {"coins": {coin_id: {symbol, price, timestamp, confidence}}}.
METADATA_ENVELOPE = T.StructType([
    T.StructField("coins", T.MapType(T.StringType(), COIN)),
])

# Flattened bronze metadata record.
METADATA = T.StructType([
    T.StructField("coin_id", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("source", T.StringType()),
])

# Silver bar, batch layer (17 columns).
BARS_COLUMNS = [
    "symbol", "minute", "open", "high", "low", "close", "volume", "trade_count",
    "vwap", "realized_variance", "bipower_variation", "buy_volume", "sell_volume",
    "realized_vol", "jump_component", "signed_volume", "ofi",
]

# Silver bar, speed layer (16 columns).
BARS_STREAM_COLUMNS = [
    "symbol", "window_start", "window_end", "open", "high", "low", "close",
    "volume", "trade_count", "vwap", "realized_variance", "realized_vol",
    "buy_volume", "sell_volume", "signed_volume", "ofi",
]
