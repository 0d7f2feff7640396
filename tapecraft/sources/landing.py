"""Landing zone: JSON lines partitioned by symbol and UTC day, and the bronze load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapecraft.functions.columns import MS_RANGE, SYMBOLS, ms_to_ts
from tapecraft.schemas import TRADE


class NoPartitionsError(RuntimeError):
    """No landed partition matched the requested day and symbols."""


def utc_day(trade_time_ms: str = "trade_time"):
    return F.date_format(ms_to_ts(F.col(trade_time_ms)), "yyyy-MM-dd")


def _by_bytes(df: DataFrame, keys: list[str]) -> DataFrame:
    """Cluster rows by the output partition columns, by size: adaptive execution
    splits a hot partition over as many writers as its bytes ask for and merges
    small ones (``spark.sql.adaptive.advisoryPartitionSizeInBytes``)."""
    return df.hint("rebalance", *keys)


def partitioned_landing(trades: DataFrame, path: str, day: str | None = None,
                        mode: str = "append", max_records_per_file: int = 5_000_000) -> None:
    """Write TRADE rows as JSON lines under ``path/symbol=SYM/dt=YYYY-MM-DD/``.

    ``dt`` is the given ``day`` (a landing run's date) or, by default, each
    trade's own UTC day. Rows are clustered by the partition columns with a
    rebalance before the write, and no file holds more than
    ``max_records_per_file`` rows.
    """
    dt = F.lit(day) if day is not None else utc_day()
    out = trades.withColumn("symbol", F.upper(F.col("symbol"))).withColumn("dt", dt)
    (_by_bytes(out, ["symbol", "dt"])
        .write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
        .partitionBy("symbol", "dt").json(path))


def land_metadata(meta: DataFrame, path: str, day: str | None = None, mode: str = "append") -> None:
    """Write flattened metadata as JSON lines under ``path/dt=YYYY-MM-DD/``
    (``day`` of the landing run, or each record's own UTC day; a time outside
    the years 1 to 9999 has none)."""
    seconds = F.when(F.col("timestamp").between(MS_RANGE[0] // 1000, MS_RANGE[1] // 1000), F.col("timestamp"))
    dt = F.lit(day) if day is not None else F.date_format(ms_to_ts(seconds * 1000), "yyyy-MM-dd")
    (_by_bytes(meta.withColumn("dt", dt), ["dt"])
         .write.mode(mode).partitionBy("dt").json(path))


def land_stream(trades_stream: DataFrame, path: str, checkpoint: str, every: str = "5 seconds"):
    """Continuously land a trade stream as small JSON-lines files (one set per
    trigger) for a downstream file-stream reader. Returns the StreamingQuery."""
    return (trades_stream.writeStream.format("json").outputMode("append")
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(processingTime=every).start())


def read_landed(spark: SparkSession, path: str, days: list[str] | None = None,
                symbols: list[str] | None = None) -> DataFrame:
    """Landed trades with the declared schema; unknown fields are ignored,
    ``symbol``/``dt`` come from the directory names.

    With ``days`` or ``symbols`` only the folders of those partitions that
    exist are listed and read (none: an empty frame).
    """
    schema = T.StructType(TRADE.fields + [T.StructField("dt", T.StringType())])
    reader = spark.read.schema(schema).option("basePath", path)
    if days is None and symbols is None:
        return reader.json(path)
    found = _partition_paths(spark, path, symbols, days)
    return reader.json(found) if found else spark.createDataFrame([], schema)


def _partition_paths(spark: SparkSession, path: str, symbols: list[str] | None, days: list[str] | None) -> list[str]:
    """Folders ``symbol=/dt=`` that exist, through the file system Spark uses; files are not listed."""
    jvm = spark._jvm
    names = "*" if symbols is None else "{" + ",".join(symbols) + "}"
    dates = "*" if days is None else "{" + ",".join(days) + "}"
    glob = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/symbol={names}/dt={dates}")
    found = glob.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(glob)
    return sorted(f.getPath().toString() for f in found or [])


LOAD_MODES = ("truncate", "replace_day")


def load_bronze_day(spark: SparkSession, path: str, day: str | None = None,
                    symbols: list[str] | None = None, target: str | None = None,
                    mode: str = "truncate") -> DataFrame:
    """Load the landed partitions of ``day`` (all days if None) for ``symbols``.

    Only the folders of these symbols and the day are listed and read; absent
    ones are simply absent. Raises ``NoPartitionsError`` when nothing matches.
    With ``target`` the result is written as parquet, compacted by size (a
    rebalance by ``dt``): ``mode='truncate'`` replaces the table,
    ``'replace_day'`` overwrites only the partitions present (dynamic partition
    overwrite).
    """
    if mode not in LOAD_MODES:
        raise ValueError(f"mode must be one of {LOAD_MODES}, not {mode!r}")
    symbols = [s.upper() for s in (symbols or SYMBOLS)]
    df = read_landed(spark, path, [day] if day is not None else None, symbols).where(F.col("symbol").isin(symbols))
    if day is not None:
        df = df.where(F.col("dt") == F.lit(day))   # the folders say so already; the plan shows it
    if df.isEmpty():
        raise NoPartitionsError(f"no landed partitions for day={day} symbols={symbols}")
    if target is not None:
        w = _by_bytes(df, ["dt"]).write.partitionBy("dt")
        if mode == "replace_day":
            w = w.option("partitionOverwriteMode", "dynamic")
        w.mode("overwrite").parquet(target)
        return spark.read.parquet(target)
    return df


def bronze_scan_count(bronze: DataFrame) -> DataFrame:
    """Row count of a bronze table as a one-row DataFrame."""
    return bronze.agg(F.count(F.lit(1)).alias("bronze_rows"))


def symbol_coverage(trades: DataFrame, symbols: list[str] | None = None,
                    quota: int = 60) -> DataFrame:
    """Trades per expected symbol (absent symbols count 0) and whether each
    meets ``quota``. Counts are partially aggregated; the expected-symbol list
    is a fixed, tiny table."""
    symbols = [s.upper() for s in (symbols or SYMBOLS)]
    spark = trades.sparkSession
    expected = spark.createDataFrame([(s,) for s in symbols], "symbol string")
    sym = F.upper(F.col("symbol"))
    # at most len(symbols) rows after the filter: a proven bound for the broadcast
    counts = (trades.where(sym.isin(symbols)).groupBy(sym.alias("symbol"))
              .agg(F.count(F.lit(1)).alias("trades")))
    out = expected.join(F.broadcast(counts), "symbol", "left")
    return out.select(
        "symbol",
        F.coalesce(F.col("trades"), F.lit(0)).cast("long").alias("trades"),
        (F.coalesce(F.col("trades"), F.lit(0)) >= quota).alias("meets_quota"),
    )
