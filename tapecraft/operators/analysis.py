"""Analyses over the gold facts (the questions the star schema is built for).

Dimension attributes used here (trading session, market-cap tier, calendar
parts) are pure functions of the fact's own ``window_start`` / ``asset_id``,
so they are computed in place instead of joining the dimension: no shuffle
join on the fact. Every grouping has few groups and is partially aggregated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapecraft.functions.columns import base_symbol, market_cap_tier, trading_session


def _corr(x: str, y: str) -> Column:
    """Population correlation, NULL when either side has zero variance
    (``corr`` would raise DIVIDE_BY_ZERO under ANSI)."""
    den = F.stddev_pop(x) * F.stddev_pop(y)
    return F.try_divide(F.covar_pop(x, y), F.nullif(den, F.lit(0.0)))


def ofi_corr_by_regime(regime_mart: DataFrame) -> DataFrame:
    """Does order-flow imbalance relate to return and volatility, per regime?"""
    return regime_mart.groupBy("volatility_regime").agg(
        F.count(F.lit(1)).alias("windows"),
        F.avg("ofi").alias("avg_ofi"),
        F.avg("window_return").alias("avg_return"),
        F.avg("realized_vol").alias("avg_realized_vol"),
        _corr("ofi", "window_return").alias("corr_ofi_return"),
        _corr("ofi", "realized_vol").alias("corr_ofi_vol"),
    )


def vol_by_session(fact: DataFrame) -> DataFrame:
    """Does volatility cluster by trading session?"""
    session = trading_session(F.hour("window_start").cast("long"))
    return fact.groupBy(session.alias("trading_session")).agg(
        F.count(F.lit(1)).alias("windows"),
        F.avg("realized_vol").alias("avg_realized_vol"),
        F.avg(F.abs("window_return")).alias("avg_abs_return"),
        F.sum("volume").alias("volume"),
    )


def vol_by_tier(fact: DataFrame) -> DataFrame:
    """Does realized volatility differ by market-cap tier?"""
    tier = market_cap_tier(base_symbol(F.col("asset_id")))
    return fact.groupBy(tier.alias("market_cap_tier")).agg(
        F.count(F.lit(1)).alias("windows"),
        F.countDistinct("asset_id").alias("assets"),
        F.avg("realized_vol").alias("avg_realized_vol"),
        F.avg("realized_variance").alias("avg_realized_variance"),
        F.avg("jump_component").alias("avg_jump_component"),
    )


def vol_rollup_time(fact: DataFrame) -> DataFrame:
    """Roll-up / drill-down over the time dimension: (day, hour), day, total."""
    return (fact.withColumn("window_date", F.to_date("window_start"))
            .withColumn("hour", F.hour("window_start").cast("long"))
            .rollup("window_date", "hour")
            .agg(F.count(F.lit(1)).alias("windows"),
                 F.avg("realized_vol").alias("avg_realized_vol"),
                 F.sum("volume").alias("volume")))
