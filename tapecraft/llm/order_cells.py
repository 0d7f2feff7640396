"""Cells of a long key's order, so that ordered work over a whole table is dealt out.

``order_cuts`` takes approximate quantiles of the key over all rows (one partially
aggregated pass over that column; as many numbers as cells come to the driver).
``order_cell`` maps a row to its cell: cells ascend with (key, tie), NULL keys
first. A key that several quantiles fall on is hot; it gets a cell of its own,
cut further by the top bits of a tie hash, and so do the NULL keys.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TIE_BITS = 6
#: Cells at most: every row is compared with the cuts.
MOST_CELLS = 1024


def tie_hash(*columns: Column) -> Column:
    """A hash of 63 bits, not negative."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 1)


def order_cuts(df: DataFrame, key: str, cells: int) -> tuple[list[int], list[int]]:
    """``(cuts, hot)``: ascending quantiles of the key, and those that stand for several."""
    cells = max(2, min(cells, MOST_CELLS))
    found = df.agg(F.percentile_approx(key, [i / cells for i in range(1, cells)], 100 * cells).alias("q")).first()["q"]
    times = Counter(found or [])
    return sorted(times), sorted(k for k, n in times.items() if n > 1)


def order_cell(key: Column, tie: Column, cuts: list[int], hot: list[int]) -> Column:
    """The cell of a row (long); ``tie`` is a ``tie_hash``."""
    def longs(values: list[int]) -> Column:
        return F.array(*[F.lit(v).cast("long") for v in values]) if values else F.array().cast("array<bigint>")

    below = F.size(F.filter(longs(cuts), lambda c: c < key))
    above = F.size(F.filter(longs(hot), lambda c: c < key))
    own = F.array_contains(longs(hot), key)
    place = F.when(key.isNull(), F.lit(0)).otherwise(1 + below + above + F.when(own, 1).otherwise(0))
    split = F.when(key.isNull() | own, F.shiftright(tie, 63 - TIE_BITS)).otherwise(F.lit(0).cast("long"))
    return place.cast("long") * F.lit(1 << TIE_BITS) + split
