"""Execute headline queries and summarize their final (AQE) physical plans.

usage: python scripts/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tapecraft.operators import bars as B  # noqa: E402
from tapecraft.operators.clean import clean_trades  # noqa: E402
from tapecraft.plans.registry import QUERIES  # noqa: E402
from tapecraft.session import build_session  # noqa: E402
from tapecraft.sources import tables as S  # noqa: E402

OPS = ["Exchange hashpartitioning", "Exchange SinglePartition", "ReusedExchange", "BroadcastExchange",
       "FileScan", "Scan ExistingRDD", "Window [", "HashAggregate", "SortAggregate",
       "ObjectHashAggregate", "BroadcastHashJoin", "SortMergeJoin", "Expand", "Generate"]


def landing_day_read(spark, sf):
    """The partition-pruned read of one landed day (what load_bronze_day loads)."""
    from tapecraft.functions.columns import SYMBOLS
    from tapecraft.session import scratch_path
    from tapecraft.sources import landing as L
    path = scratch_path(spark, "plan-landing")
    L.partitioned_landing(S.trades(spark, sf), path)
    return L.load_bronze_day(spark, path, "2024-01-15", SYMBOLS[:3])


def minute(fn):
    return lambda spark, sf: fn(clean_trades(S.trades(spark, sf), "1 minute"))


TARGETS = {
    "minute_bars (1 minute)": minute(lambda c: B.minute_bars(c, "1 minute")),
    "log_returns (1 minute)": minute(lambda c: B.log_returns(c, "1 minute")),
    "ohlc_bars (1 minute)": minute(B.ohlc_bars),
    "minute_bars with the hot-part guard (1 minute, max_part_rows=2)":
        minute(lambda c: B.minute_bars(c, "1 minute", max_part_rows=2)),
    **{k: QUERIES[k] for k in ["ofi_return_by_regime", "dim_time", "dim_asset", "latest_metadata",
                               "dq_report", "vol_by_tier", "vol_rollup_time", "symbol_coverage",
                               "recompute_touched"]},
    "load_bronze_day (landing read of one day, 3 symbols)": landing_day_read,
}


def summarize(plan: str) -> dict:
    counts = {op.rstrip(" ["): plan.count(op) for op in OPS if plan.count(op)}
    scans = []
    for line in plan.splitlines():
        if "FileScan" in line:
            schema = re.search(r"ReadSchema: (\S+)", line)
            pushed = re.search(r"PushedFilters: (\[[^\]]*\])", line)
            parts = re.search(r"PartitionFilters: (\[[^\]]*\])", line)
            scans.append((schema.group(1) if schema else "?", pushed.group(1) if pushed else "",
                          parts.group(1) if parts else ""))
    return {"ops": counts, "scans": scans}


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", shuffle_partitions=8)
    print("# Physical plans of headline queries\n")
    print(f"Generated by `scripts/plan_report.py` on `{sf}` (final adaptive plans, after execution).\n")
    for name, q in TARGETS.items():
        df = q(spark, sf)
        df.write.format("noop").mode("overwrite").save()
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("== Initial Plan ==")[0]     # keep the final adaptive plan only
        s = summarize(plan)
        print(f"## {name}\n")
        print("| operator | count |\n| --- | --- |")
        for op, n in s["ops"].items():
            print(f"| {op} | {n} |")
        for schema, pushed, parts in sorted(set(s["scans"])):
            print(f"\n- scan `{schema}`" + (f" pushed `{pushed}`" if pushed not in ("", "[]") else "")
                  + (f" partitions `{parts}`" if parts not in ("", "[]") else ""))
        print()
    spark.stop()


if __name__ == "__main__":
    main()
