"""The regime mart kept up to date with a fact that is upserted.

A row's baseline looks at the ``rows`` rows before it in its asset's series, so a
new or changed window alters its own row and the next ``rows`` ones, however far
apart in time. Which days these rows and their own baselines lie on follows from
the number of rows per (asset, day), which is kept beside the mart: one small
table, recounted for the touched days only. The fact is then read for those days
alone, and only altered rows are merged into the mart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapecraft.operators import regime as R
from tapecraft.sources.versioned import VersionedTable

MART_KEYS = ["asset_id", "window_start"]


def with_day(df: DataFrame) -> DataFrame:
    return df.withColumn("dt", F.date_format("window_start", "yyyy-MM-dd"))


def day_counts(fact: DataFrame) -> DataFrame:
    """``asset_id, rows_of_day, dt``: partially aggregated, one row an asset and day."""
    return fact.groupBy("asset_id", "dt").agg(F.count(F.lit(1)).alias("rows_of_day")).select("asset_id", "rows_of_day", "dt")


def days_to_read(counts: DataFrame, touched: DataFrame, rows: int = R.ROLL_ROWS) -> DataFrame:
    """The (asset, day) pairs that hold the rows altered by changes on the ``touched`` pairs,
    and the ``rows`` rows before them.

    Over each asset's days in order, with running row numbers: a day is needed if it
    begins less than ``rows`` rows after a touched day at or before it ends, or ends
    less than ``rows`` rows before a touched day at or after it begins.
    """
    same = F.col("asset_id").eqNullSafe(F.col("_a")) & F.col("dt").eqNullSafe(F.col("_d"))
    marks = touched.select(F.col("asset_id").alias("_a"), F.col("dt").alias("_d")).distinct().withColumn("_touched", F.lit(True))
    series = Window.partitionBy("asset_id").orderBy(F.col("dt").asc_nulls_first())
    upto = series.rowsBetween(Window.unboundedPreceding, 0)
    onward = series.rowsBetween(0, Window.unboundedFollowing)
    placed = (counts.join(marks, same, "left").drop("_a", "_d")
              .withColumn("_end", F.sum("rows_of_day").over(upto)).withColumn("_begin", F.col("_end") - F.col("rows_of_day"))
              .withColumn("_after", F.max(F.when(F.col("_touched"), F.col("_end"))).over(upto))
              .withColumn("_before", F.min(F.when(F.col("_touched"), F.col("_begin"))).over(onward)))
    return placed.where((F.col("_begin") < F.col("_after") + rows) | (F.col("_end") > F.col("_before") - rows)).select("asset_id", "dt")


def update_regime_mart(fact: VersionedTable, mart: VersionedTable, counts: VersionedTable, changed: DataFrame | None = None,
                       rows: int = R.ROLL_ROWS, block_rows: int = R.BLOCK_ROWS) -> list[str | None]:
    """Bring the ``mart`` up to date after the windows ``changed`` (``asset_id, window_start``) were
    upserted into the ``fact``, both partitioned by the window's day ``dt``; the days of the fact
    that were read. The first call, or one without ``changed``, builds the mart as a whole.

    The fact's version is fixed at the start. Running it again after a stop is safe:
    recounting and merging give the same rows.
    """
    version = fact.version()
    if mart.version() is None or counts.version() is None or changed is None:
        whole = fact.read(version=version)
        counts.replace(day_counts(whole))
        mart.replace(with_day(R.ofi_return_by_regime(whole, rows=rows, block_rows=block_rows)))
        return sorted(version.folders, key=str)
    keys = with_day(changed.select(*MART_KEYS)).distinct().persist()   # read for days, counts and flags
    try:
        touched_days = [r[0] for r in keys.select("dt").distinct().collect()]   # calendar days
        if not touched_days:
            return []
        counts.replace(day_counts(fact.read(touched_days, version)), touched_days)
        needed = days_to_read(counts.read(), keys.select("asset_id", "dt"), rows).persist()
        days = [r[0] for r in needed.select("dt").distinct().collect()]   # calendar days
        mine = needed.select(F.col("asset_id").alias("_a"), F.col("dt").alias("_d"))
        marks = keys.select(F.col("asset_id").alias("_ka"), F.col("window_start").alias("_kw"), F.lit(True).alias("_changed"))
        read = fact.read(days, version).join(
            mine, F.col("asset_id").eqNullSafe(F.col("_a")) & F.col("dt").eqNullSafe(F.col("_d")), "left_semi")
        flagged = read.join(marks, F.col("asset_id").eqNullSafe(F.col("_ka")) & F.col("window_start").eqNullSafe(F.col("_kw")), "left")
        rolled = R.rolling_vol_baseline(flagged.drop("_ka", "_kw"), rows=rows, block_rows=block_rows, flag="_changed")
        altered = R.classified(rolled.where("flagged")).select(*R.REGIME_COLUMNS, "dt")
        mart.merge(altered, MART_KEYS)
        needed.unpersist()
        return sorted(days, key=str)
    finally:
        keys.unpersist()
