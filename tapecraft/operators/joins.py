"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest side, in rows, that is ever broadcast on a measured size.
BROADCAST_MAX_ROWS = 1_000_000


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Join ``big`` with a side expected to be small.

    The small side is broadcast only after its size is checked (a bounded
    ``limit(max_rows + 1).count()``); beyond the bound the join is left to
    the planner (shuffle join, AQE may still convert it at runtime).
    """
    if small.limit(max_rows + 1).count() <= max_rows:
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)
