"""Rolling volatility baseline and regime classification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapecraft.functions.columns import window_start

# --- Fixed values that must equal the reference's -------------------------
ROLL_ROWS = 30          # trailing rows in the baseline (current row excluded)
MIN_ROWS = 5            # fewer trailing rows -> 'warmup'
CALM_Z = -0.5           # z <= -0.5 -> 'calm'
TURBULENT_Z = 1.0       # z >= 1.0 -> 'turbulent'
JUMP_RATIO = 0.5        # jump / RV > 0.5 -> jump minute
# --------------------------------------------------------------------------

BLOCK_ROWS = 1 << 16


def rolling_vol_baseline(fact: DataFrame, rows: int = ROLL_ROWS, key: str = "asset_id",
                         order: str = "window_start", value: str = "realized_vol",
                         chunk: str = "1 day", block_rows: int = BLOCK_ROWS, flag: str | None = None) -> DataFrame:
    """Trailing mean / sample stddev / count of ``value`` over the ``rows``
    rows before each row of a series (ROWS frame, rows not time).

    A series is never sorted in one task: rows get a per-series index from
    day-chunk counts (a tiny running sum) plus a row_number inside the chunk,
    are cut into blocks of ``block_rows``, and the last ``rows`` rows of each
    block are copied into the next block as a halo. The rolling Window then
    runs per (series, block); halo copies are dropped afterwards. Exact for
    any block size >= rows.

    ``flag`` names a boolean column; ``flagged`` then says whether it holds in a row
    or in one of the ``rows`` before it.

    The input is read twice (day counts of ``key``/``order`` only, then the
    rows): pass a materialized table, not a long lazy lineage.
    """
    if block_rows < rows:
        raise ValueError("block_rows must be >= rows")
    # one struct key: joins and groups on it match NULL fields (a series without a key, rows
    # without a time), and the join shares the shuffle of the window inside the chunk
    f = fact.withColumn("_pk", F.struct(F.col(key).alias("k"), window_start(order, chunk).alias("c")))
    counts = f.groupBy("_pk").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_pk.k").orderBy("_pk.c").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    in_chunk = Window.partitionBy("_pk").orderBy(order)
    indexed = f.join(offsets, "_pk").withColumn("_idx", F.col("_off") + F.row_number().over(in_chunk) - F.lit(1))
    own = (F.col("_idx") / F.lit(block_rows)).cast("long")
    halo = (F.col("_idx") % F.lit(block_rows)) >= F.lit(block_rows - rows)
    blocked = (indexed.withColumn("_own", own)
               .withColumn("_blk", F.explode(F.when(halo, F.array(own, own + 1)).otherwise(F.array(own)))))
    if flag is not None:
        near = Window.partitionBy(key, "_blk").orderBy("_idx").rowsBetween(-rows, 0)
        blocked = blocked.withColumn("flagged", F.max(F.coalesce(F.col(flag), F.lit(False))).over(near))
    w = Window.partitionBy(key, "_blk").orderBy("_idx").rowsBetween(-rows, -1)
    out = (blocked
           .withColumn("roll_mean_vol", F.avg(value).over(w))
           .withColumn("roll_std_vol", F.stddev_samp(value).over(w))
           .withColumn("roll_n", F.count(F.lit(1)).over(w))
           .where(F.col("_blk") == F.col("_own")))
    return out.drop("_pk", "_off", "_idx", "_own", "_blk")


def _z() -> Column:
    return (F.col("realized_vol") - F.col("roll_mean_vol")) / F.col("roll_std_vol")


def vol_zscore(rolled: DataFrame) -> DataFrame:
    std = F.col("roll_std_vol")
    return rolled.withColumn("vol_zscore", F.when(std.isNotNull() & (std > 0), _z()))


def volatility_regime(rolled: DataFrame, min_rows: int = MIN_ROWS, calm: float = CALM_Z,
                      turbulent: float = TURBULENT_Z) -> DataFrame:
    n, std = F.col("roll_n"), F.col("roll_std_vol")
    regime = (
        F.when(n.isNull() | (n < min_rows), F.lit("warmup"))
        .when(std.isNull() | (std == 0), F.lit("normal"))
        .when(_z() <= calm, F.lit("calm"))
        .when(_z() >= turbulent, F.lit("turbulent"))
        .otherwise(F.lit("normal"))
    )
    return rolled.withColumn("volatility_regime", regime)


def jump_minutes(fact: DataFrame, ratio: float = JUMP_RATIO) -> DataFrame:
    rv, jump = F.col("realized_variance"), F.col("jump_component")
    flag = F.coalesce((rv > 0) & (F.try_divide(jump, rv) > ratio), F.lit(False))
    return fact.withColumn("is_jump_minute", flag)


REGIME_COLUMNS = [
    "market_window_id", "asset_id", "window_start", "volatility_regime", "vol_zscore",
    "realized_vol", "realized_variance", "bipower_variation", "jump_component",
    "is_jump_minute", "ofi", "signed_volume", "window_return", "volume", "trade_count",
    "roll_mean_vol", "roll_std_vol",
]


def ofi_return_by_regime(fact: DataFrame, rows: int = ROLL_ROWS, min_rows: int = MIN_ROWS,
                         calm: float = CALM_Z, turbulent: float = TURBULENT_Z,
                         ratio: float = JUMP_RATIO, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The regime mart: rolling baseline, z-score, regime, jump flag."""
    rolled = rolling_vol_baseline(fact, rows=rows, block_rows=block_rows)
    return classified(rolled, min_rows, calm, turbulent, ratio).select(*REGIME_COLUMNS)


def classified(rolled: DataFrame, min_rows: int = MIN_ROWS, calm: float = CALM_Z, turbulent: float = TURBULENT_Z,
               ratio: float = JUMP_RATIO) -> DataFrame:
    """Rows with a rolling baseline, with z-score, regime and jump flag added."""
    return jump_minutes(volatility_regime(vol_zscore(rolled), min_rows, calm, turbulent), ratio)
