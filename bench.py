"""Benchmark: headline queries over the driver tables.

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
Each query is executed in full through the ``noop`` sink (no collect); the
best of ``BENCH_REPEAT`` runs is reported. Session start-up is not timed.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tapecraft.operators import bars as B  # noqa: E402
from tapecraft.operators import regime as R  # noqa: E402
from tapecraft.operators.clean import clean_trades  # noqa: E402
from tapecraft.plans import gold as G  # noqa: E402
from tapecraft.plans.registry import QUERIES  # noqa: E402
from tapecraft.session import build_session, checkpoint_root  # noqa: E402
from tapecraft.sources import tables as S  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))


def minute_width(fn):
    """A query at the production width (one minute)."""
    def run(spark, sf_dir):
        clean = clean_trades(S.trades(spark, sf_dir), "1 minute")
        return fn(clean)
    return run


def regime_1m(spark, sf_dir):
    clean = clean_trades(S.trades(spark, sf_dir), "1 minute")
    fct = G.fct_market_window(G.stg_trades_minute(B.minute_bars(clean, "1 minute")))
    return R.ofi_return_by_regime(fct.checkpoint(eager=True))   # materialized fact, as in the gold layer


HEADLINE = {
    "minute_bars_1m": minute_width(lambda c: B.minute_bars(c, "1 minute")),
    # same, with the hot-part guard on (cost of its two extra aggregating passes)
    "minute_bars_1m_hot_guard": minute_width(lambda c: B.minute_bars(c, "1 minute", max_part_rows=1000)),
    "log_returns_1m": minute_width(lambda c: B.log_returns(c, "1 minute")),
    "ohlc_bars_1m": minute_width(B.ohlc_bars),
    "regime_1m": regime_1m,
    "minute_bars_1h": QUERIES["minute_bars"],
    "ofi_return_by_regime_1h": QUERIES["ofi_return_by_regime"],
    "dim_time": QUERIES["dim_time"],
    "dim_asset": QUERIES["dim_asset"],
    "dq_report": QUERIES["dq_report"],
    "parse_trade_envelope": QUERIES["parse_trade_envelope"],
    "partitioned_landing": QUERIES["partitioned_landing"],
    "stream_minute_append": QUERIES["stream_minute_append"],
    "stream_upsert": QUERIES["stream_upsert"],
}


def main() -> None:
    spark = build_session(app="tapecraft-bench", master=f"local[{CPUS}]",
                          shuffle_partitions=int(CPUS) * 2,
                          conf={"spark.driver.memory": "16g"})
    checkpoint_root(spark)
    # warm-up: JVM, parquet footers, codegen caches
    QUERIES["vwap_bars"](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    times = {}
    for name, q in HEADLINE.items():
        best = None
        for _ in range(REPEAT):
            t0 = time.perf_counter()
            q(spark, SF_DIR).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", SF_DIR)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else SF_DIR,
        "cpus": int(CPUS),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
