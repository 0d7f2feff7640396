"""Gold layer: staging contracts, facts and dimensions of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapecraft.functions.columns import (
    asset_name, base_symbol, is_us_market_hours, is_weekend, market_cap_tier,
    surrogate_key, time_id, trading_session,
)
from tapecraft.sources.versioned import VersionedTable

_STG_RENAMES = [
    ("open", "open_price"), ("high", "high_price"), ("low", "low_price"), ("close", "close_price"),
]
_FLOAT_METRICS = ["vwap", "volume"]


def stg_trades_minute(bars: DataFrame) -> DataFrame:
    """Staging contract of the batch silver bars (17 columns)."""
    d = "double"
    return bars.select(
        "symbol",
        F.col("minute").alias("window_start"),
        *[F.col(a).cast(d).alias(b) for a, b in _STG_RENAMES],
        F.col("vwap").cast(d), F.col("volume").cast(d),
        F.col("trade_count").cast("long"),
        F.col("realized_variance").cast(d), F.col("realized_vol").cast(d),
        F.col("bipower_variation").cast(d), F.col("jump_component").cast(d),
        F.col("buy_volume").cast(d), F.col("sell_volume").cast(d),
        F.col("signed_volume").cast(d), F.col("ofi").cast(d),
    )


def stg_trades_minute_stream(bars: DataFrame) -> DataFrame:
    """Staging contract of the speed-layer silver bars (16 columns)."""
    d = "double"
    return bars.select(
        "symbol", "window_start", "window_end",
        *[F.col(a).cast(d).alias(b) for a, b in _STG_RENAMES],
        F.col("vwap").cast(d), F.col("volume").cast(d),
        F.col("trade_count").cast("long"),
        F.col("realized_variance").cast(d), F.col("realized_vol").cast(d),
        F.col("buy_volume").cast(d), F.col("sell_volume").cast(d),
        F.col("signed_volume").cast(d), F.col("ofi").cast(d),
    )


def _window_return() -> F.Column:
    o, c = F.col("open_price"), F.col("close_price")
    return F.when(o > 0, F.log(c / o)).otherwise(F.lit(0.0))


FCT_COLUMNS = [
    "market_window_id", "asset_id", "time_id", "window_start",
    "open_price", "high_price", "low_price", "close_price", "vwap", "volume", "trade_count",
    "realized_variance", "realized_vol", "bipower_variation", "jump_component",
    "buy_volume", "sell_volume", "signed_volume", "ofi", "window_return",
]
FCT_STREAM_COLUMNS = [
    "market_window_id", "asset_id", "time_id", "window_start", "window_end",
    "open_price", "high_price", "low_price", "close_price", "vwap", "volume", "trade_count",
    "realized_variance", "realized_vol", "buy_volume", "sell_volume", "signed_volume", "ofi",
    "window_return",
]


def _fact(stg: DataFrame, columns: list[str]) -> DataFrame:
    return (
        stg.withColumn("market_window_id", surrogate_key("symbol", "window_start"))
        .withColumn("asset_id", F.col("symbol"))
        .withColumn("time_id", time_id("window_start"))
        .withColumn("window_return", _window_return())
        .select(*columns)
    )


def fct_market_window(stg: DataFrame) -> DataFrame:
    return _fact(stg, FCT_COLUMNS)


def fct_market_window_stream(stg_stream: DataFrame) -> DataFrame:
    return _fact(stg_stream, FCT_STREAM_COLUMNS)


DIM_TIME_COLUMNS = [
    "time_id", "window_start", "window_date", "year", "month", "day", "hour", "minute",
    "day_name", "day_of_week", "is_weekend", "trading_session", "is_us_market_hours",
]


def time_attributes(df: DataFrame, ts: str = "window_start") -> DataFrame:
    """Calendar attributes of a window start (pure functions of the timestamp)."""
    c = F.col(ts)
    hour = F.hour(c).cast("long")
    dow = F.dayofweek(c).cast("long")
    return (
        df.withColumn("time_id", time_id(c))
        .withColumn("window_date", F.to_date(c))
        .withColumn("year", F.year(c).cast("long"))
        .withColumn("month", F.month(c).cast("long"))
        .withColumn("day", F.dayofmonth(c).cast("long"))
        .withColumn("hour", hour)
        .withColumn("minute", F.minute(c).cast("long"))
        .withColumn("day_name", F.date_format(c, "EEEE"))
        .withColumn("day_of_week", dow)
        .withColumn("is_weekend", is_weekend(dow))
        .withColumn("trading_session", trading_session(hour))
        .withColumn("is_us_market_hours", is_us_market_hours(hour))
    )


def dim_time(stg_batch: DataFrame, stg_stream: DataFrame) -> DataFrame:
    """One row per distinct window start across batch and speed layers.

    UNION DISTINCT as a partial-aggregated distinct: duplicates collapse
    map-side before the shuffle, so a hot minute never concentrates rows.
    """
    windows = (stg_batch.select("window_start")
               .unionByName(stg_stream.select("window_start"))
               .distinct())
    return time_attributes(windows).select(*DIM_TIME_COLUMNS)


def latest_metadata(meta: DataFrame) -> DataFrame:
    """Latest metadata row per symbol (timestamp desc, NULL last; ties by price,
    confidence). A max over a struct: partially aggregated, no per-symbol sort,
    so a symbol holding most of the feed is still combined map-side."""
    best = F.max(F.struct(
        F.col("timestamp"), F.col("price"), F.col("confidence"), F.col("coin_id"), F.col("source"),
    )).alias("m")
    return meta.groupBy("symbol").agg(best).select(
        "symbol",
        F.col("m.price").alias("reference_price"),
        F.col("m.confidence").alias("confidence"),
        F.col("m.timestamp").alias("price_timestamp"),
    )


DIM_ASSET_COLUMNS = [
    "asset_id", "base_symbol", "asset_name", "market_cap_tier",
    "reference_price", "price_confidence", "price_timestamp",
]


def dim_asset(fact: DataFrame, meta: DataFrame, with_loaded_at: bool = True,
              stream_fact: DataFrame | None = None) -> DataFrame:
    """Asset dimension: distinct assets of the fact, name and tier lookup,
    LEFT join to the latest metadata on the base symbol.

    ``stream_fact`` optionally adds speed-layer-only assets so the stream
    fact's foreign key always resolves.
    """
    assets = fact.select("asset_id")
    if stream_fact is not None:
        assets = assets.unionByName(stream_fact.select("asset_id"))
    assets = assets.distinct().withColumn("base_symbol", base_symbol(F.col("asset_id")))
    latest = latest_metadata(meta).withColumnRenamed("symbol", "base_symbol")
    joined = assets.join(latest, "base_symbol", "left")   # both small: the planner picks the strategy
    out = joined.select(
        "asset_id", "base_symbol",
        asset_name(F.col("base_symbol")).alias("asset_name"),
        market_cap_tier(F.col("base_symbol")).alias("market_cap_tier"),
        "reference_price",
        F.col("confidence").alias("price_confidence"),
        "price_timestamp",
    )
    if with_loaded_at:
        out = out.withColumn("loaded_at", F.current_timestamp())
    return out


def model_table(spark: SparkSession, root: str, name: str) -> VersionedTable:
    """The versioned table of a model, unpartitioned."""
    return VersionedTable(spark, f"{root.rstrip('/')}/{name}", None)


def write_model(model: DataFrame, root: str, name: str) -> DataFrame:
    """Write a model as a table and read it back. Readers see the version before
    until the new one is whole (``sources.versioned``)."""
    table = model_table(model.sparkSession, root, name)
    return table.read(version=table.replace(model))
