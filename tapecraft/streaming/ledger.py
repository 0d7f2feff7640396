"""Windows that the speed layer has left out, kept until a repair recomputes them.

The ledger is a versioned table of (symbol, minute, reason), one partition an
entry (a batch and a reason). Recording an entry again replaces it, so a
replayed batch leaves one; draining removes exactly the entries that were read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapecraft.sources.versioned import VersionConflict, VersionedTable

ATTEMPTS = 5


class SkippedWindows:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.table = spark, VersionedTable(spark, root, "entry")

    def _change(self, change: Callable[[], object]) -> None:
        """Stream and repair may both add a version: who comes second starts over on the first's."""
        for left in reversed(range(ATTEMPTS)):
            try:
                change()
                return
            except VersionConflict:
                if not left:
                    raise

    def record(self, keys: DataFrame, batch: int, reason: str) -> None:
        """Enter the windows (symbol, minute) of a batch."""
        entry = f"{batch}-{reason}"
        rows = keys.select("symbol", "minute", F.lit(reason).alias("reason"), F.lit(entry).alias("entry"))
        self._change(lambda: self.table.replace(rows, [entry]))

    def pending(self) -> list[str]:
        """The entries that no repair has drained yet."""
        version = self.table.version()
        return [] if version is None else sorted(version.folders)

    def windows(self, entries: Sequence[str]) -> DataFrame:
        """Distinct (symbol, minute) of some entries."""
        return self.table.read(entries).select("symbol", "minute").distinct()

    def drain(self, entries: Sequence[str]) -> None:
        """Remove entries that are repaired; later ones stay."""
        self._change(lambda: self.table.remove(entries))
