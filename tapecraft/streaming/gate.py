"""Checks of a micro-batch's bars before they reach silver.

The checks are counted by ``DataFrame.observe`` while the bars are made and
written to the shared checkpoint folder, so they cost no pass of their own; the
upsert then reads the checkpoint. A batch is rejected as a whole.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def _not_finite(name: str) -> Column:
    c = F.col(name)
    return F.isnan(c) | (F.abs(c) == F.lit(float("inf")))


#: Conditions that no bar of the speed layer may meet. A price text such as 'NaN' or 'Infinity'
#: is a number to the cleaning step; it shows here.
SPEED_CHECKS: dict[str, Callable[[], Column]] = {
    "null_symbol": lambda: F.col("symbol").isNull(),
    "null_window": lambda: F.col("window_start").isNull(),
    "null_volatility": lambda: F.col("realized_vol").isNull(),
    "not_finite": lambda: (_not_finite("high") | _not_finite("low") | _not_finite("volume") | _not_finite("realized_variance")),
    "low_above_high": lambda: F.col("low") > F.col("high"),
    "no_volume": lambda: F.coalesce(F.col("volume") <= 0, F.lit(True)),
}


@dataclass(frozen=True)
class BatchReport:
    """Bars of a batch, and how many of them meet each condition."""

    batch: int
    bars: int
    failing: dict[str, int]

    @property
    def rejected(self) -> bool:
        return any(self.failing.values())


def check_bars(bars: DataFrame, checks: dict[str, Callable[[], Column]], batch: int) -> tuple[DataFrame, BatchReport]:
    """The bars, made once (checkpointed), and the report of the checks on them."""
    seen = Observation()
    counts = [F.count_if(F.coalesce(failing(), F.lit(False))).alias(name) for name, failing in checks.items()]
    made = bars.observe(seen, F.count(F.lit(1)).alias("bars"), *counts).checkpoint(eager=True)
    found = dict(seen.get)
    return made, BatchReport(batch, found.pop("bars"), found)
