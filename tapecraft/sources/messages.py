"""Exchange and metadata message formats: decode, flatten, encode."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapecraft.schemas import METADATA_ENVELOPE, TRADE, TRADE_ENVELOPE
from tapecraft.sources.tables import METADATA_SOURCE

# Envelope key -> trade field.
ENVELOPE_FIELDS = [("e", "event_type"), ("E", "event_time"), ("s", "symbol"), ("t", "trade_id"),
                   ("p", "price"), ("q", "quantity"), ("T", "trade_time"), ("m", "is_buyer_maker")]


def message_text(raw: DataFrame, value_col: str) -> Column:
    """The message as text; bytes that are no UTF-8 become NULL (a broken message must not fail the job)."""
    value = F.col(value_col)
    return F.try_validate_utf8(value.cast("string")) if isinstance(raw.schema[value_col].dataType, T.BinaryType) else value


def parse_trade_envelope(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """``{"data": {e,E,s,t,p,q,T,m}}`` messages (string or UTF-8 bytes) -> TRADE
    rows; messages without a symbol (missing, NULL or empty) are dropped."""
    parsed = raw.select(F.from_json(message_text(raw, value_col), TRADE_ENVELOPE).alias("_msg"))
    # 'e'/'E' and 't'/'T' differ only by case; rename positionally with a
    # struct cast so field resolution never depends on spark.sql.caseSensitive.
    data = F.col("_msg").getField("data").cast(TRADE.simpleString())
    out = parsed.select(data.alias("_t")).select("_t.*")
    return out.where(F.col("symbol").isNotNull() & (F.col("symbol") != F.lit("")))


def trades_to_envelopes(trades: DataFrame) -> DataFrame:
    """TRADE rows -> exchange envelope JSON text in ``value`` (for tests and replay)."""
    data = F.struct(*[F.col(name).alias(k) for k, name in ENVELOPE_FIELDS])
    return trades.select(F.to_json(F.struct(data.alias("data"))).alias("value"))


def encode_trades_json(trades: DataFrame) -> DataFrame:
    """TRADE rows -> message records: ``key`` = symbol, ``value`` = JSON bytes."""
    payload = F.to_json(F.struct(*[F.col(f.name) for f in TRADE.fields]))
    return trades.select(F.col("symbol").alias("key"), F.encode(payload, "UTF-8").alias("value"))


def decode_trades_json(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Message records as ``encode_trades_json`` writes them (flat JSON, text or
    UTF-8 bytes) -> TRADE rows. A field that is absent is NULL; a message that
    is no JSON object is a row of NULLs, for the cleaning step to drop."""
    return raw.select(F.from_json(message_text(raw, value_col), TRADE).alias("_t")).select("_t.*")


#: Why a message is no trade, in the order of the checks.
REJECT_REASONS = ("empty", "not_utf8", "malformed", "no_symbol", "no_time", "bad_price", "bad_quantity")


def judge_messages(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Every message with its trade fields, ``reason`` (one of ``REJECT_REASONS``, NULL for a
    good one) and its own ``value``. ``malformed``: no JSON object, or a field of another type;
    the price and the quantity are texts of numbers."""
    text = message_text(raw, value_col)
    schema = T.StructType([*TRADE.fields, T.StructField("_corrupt", T.StringType())])
    read = raw.select(F.col(value_col).alias("value"), text.alias("_text")).withColumn(
        "_t", F.from_json("_text", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    field = lambda name: F.col(f"_t.{name}")
    empty = F.col("value").isNull() | (F.octet_length("value") == 0)
    failing = [empty, F.col("_text").isNull(), F.col("_t").isNull() | field("_corrupt").isNotNull(),
               F.coalesce(field("symbol"), F.lit("")) == "", field("trade_time").isNull(),
               field("price").try_cast("double").isNull(), field("quantity").try_cast("double").isNull()]
    reason = F.coalesce(*[F.when(f, F.lit(name)) for name, f in zip(REJECT_REASONS, failing)])
    return read.select(*[field(f.name).alias(f.name) for f in TRADE.fields], reason.alias("reason"), "value")


def dead_letter_handler(good_path: str, rejects_path: str, value_col: str = "value",
                        on_counts: Callable[[int, dict[str, int]], None] | None = None):
    """``foreachBatch`` callback with two sinks: trades under ``good_path``, the other messages
    with their reason under ``rejects_path``, each batch in a folder ``batch=<number>`` that a
    replay replaces. ``on_counts(batch, counts)`` is told the good messages (``good``) and those
    of each reason, observed while the batch is judged."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        counts = [F.count_if(F.col("reason") == name).alias(name) for name in REJECT_REASONS]
        judged = judge_messages(batch, value_col).observe(seen, F.count_if(F.col("reason").isNull()).alias("good"), *counts)
        judged = judged.persist()   # both sinks read it; a lost block is judged again
        try:
            trades = judged.where(F.col("reason").isNull()).select(*TRADE.fieldNames())
            trades.write.mode("overwrite").parquet(f"{good_path}/batch={batch_id}")
            judged.where(F.col("reason").isNotNull()).select("reason", "value").write.mode("overwrite").parquet(
                f"{rejects_path}/batch={batch_id}")
            if on_counts is not None:
                on_counts(batch_id, dict(seen.get))
        finally:
            judged.unpersist()

    return handle


def flatten_metadata(raw: DataFrame, value_col: str = "value",
                     source: str = METADATA_SOURCE) -> DataFrame:
    """``{"coins": {coin_id: {symbol, price, timestamp, confidence}}}`` -> one
    row per coin (METADATA layout)."""
    parsed = raw.select(F.from_json(F.col(value_col), METADATA_ENVELOPE).alias("_msg"))
    coins = parsed.select(F.explode(F.col("_msg.coins")).alias("coin_id", "_info"))
    return coins.select(
        "coin_id",
        F.col("_info.symbol").alias("symbol"),
        F.col("_info.price").alias("price"),
        F.col("_info.timestamp").alias("timestamp"),
        F.col("_info.confidence").alias("confidence"),
        F.lit(source).alias("source"),
    )


def metadata_to_envelopes(meta: DataFrame) -> DataFrame:
    """METADATA rows -> one ``{"coins": {...}}`` JSON message per row."""
    info = F.struct("symbol", "price", "timestamp", "confidence")
    return meta.select(F.to_json(F.struct(F.create_map(F.col("coin_id"), info).alias("coins")))
                       .alias("value"))
