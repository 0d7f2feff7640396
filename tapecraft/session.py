"""Session builder and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every tapecraft job relies on. Times are UTC by convention; the
# operators themselves work on TIMESTAMP_NTZ so they do not depend on the zone,
# but parsing and display do.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Streaming state (open parts and windows per symbol) in RocksDB: off the
    # JVM heap, spills to local disk, and checkpoints as incremental changelogs
    # into the shared checkpoint location instead of full snapshots.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    app: str = "tapecraft",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session with tapecraft's defaults.

    ``shuffle_partitions`` should be sized so one shuffle partition stays
    around 128-256 MB at the target scale; AQE coalesces small ones.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` (the cluster's shared location). Where it is
    unset, a local run (``local[*]``) gets a private folder, registered as the
    checkpoint directory; on a cluster that is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext; the server's setting applies
        sc = None
    if sc is None:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if not current:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        return current.rstrip("/")
    current = None
    try:
        current = sc.getCheckpointDir()
    except Exception:  # pragma: no cover - older API
        current = None
    if not current:
        current = sc.getConf().get("spark.checkpoint.dir", None)
        if current:
            sc.setCheckpointDir(current)
    if not current:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="tapecraft-ckpt-")
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir() or current
    return current.rstrip("/")


def local_path(path: str) -> str:
    """OS path of a ``file:`` URI (local runs and tests only)."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark)
    path = f"{root}/tapecraft-scratch/{name}-{uuid.uuid4().hex[:12]}"
    if path.startswith("/") or path.startswith("file:"):
        os.makedirs(local_path(path), exist_ok=True)
    return path
