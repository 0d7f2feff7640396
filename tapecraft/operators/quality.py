"""Data-quality checks on the gold tables: unique, not_null, relationships.

Each check yields one row (check, table_name, column_name, failing_rows,
passed). failing_rows counts what the check's query returns: duplicated key
values for ``unique``, NULL rows for ``not_null``, child rows whose key has no
parent for ``relationships``. Every check aggregates before it shuffles.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The 17 checks of the star schema: (check, table, column, parent table, parent column).
GOLD_CHECKS = [
    ("unique", "fct_market_window", "market_window_id", None, None),
    ("not_null", "fct_market_window", "market_window_id", None, None),
    ("not_null", "fct_market_window", "asset_id", None, None),
    ("relationships", "fct_market_window", "asset_id", "dim_asset", "asset_id"),
    ("not_null", "fct_market_window", "time_id", None, None),
    ("relationships", "fct_market_window", "time_id", "dim_time", "time_id"),
    ("not_null", "fct_market_window", "realized_vol", None, None),
    ("unique", "fct_market_window_stream", "market_window_id", None, None),
    ("not_null", "fct_market_window_stream", "market_window_id", None, None),
    ("not_null", "fct_market_window_stream", "asset_id", None, None),
    ("relationships", "fct_market_window_stream", "asset_id", "dim_asset", "asset_id"),
    ("not_null", "fct_market_window_stream", "time_id", None, None),
    ("relationships", "fct_market_window_stream", "time_id", "dim_time", "time_id"),
    ("unique", "dim_asset", "asset_id", None, None),
    ("not_null", "dim_asset", "asset_id", None, None),
    ("unique", "dim_time", "time_id", None, None),
    ("not_null", "dim_time", "time_id", None, None),
]

DQ_COLUMNS = ["check_order", "check_name", "table_name", "column_name", "failing_rows", "passed"]


def _column_checks(df: DataFrame, col: str, checks: list, tables: dict[str, DataFrame]) -> DataFrame:
    """All checks on one (table, column) from a single pass over the table.

    ``not_null`` alone needs one plain count. Otherwise the column is grouped
    once (partial aggregation: a key holding most rows is combined map-side)
    and that grouping serves ``unique``, ``not_null`` and ``relationships``.
    Returns (check_order, failing_rows) rows.
    """
    names = {c[1] for c in checks}
    if names == {"not_null"}:
        (order, _), = [(i, c) for i, c in checks]
        return df.agg(F.lit(order).cast("long").alias("check_order"),
                      F.count(F.when(F.col(col).isNull(), F.lit(1))).cast("long").alias("failing_rows"))
    keys = df.groupBy(F.col(col).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    parts = []
    for order, (check, _table, _col, ptable, pcol) in checks:
        if check == "not_null":
            res = keys.agg(F.coalesce(F.sum(F.when(F.col("_k").isNull(), F.col("_n"))), F.lit(0))
                           .alias("failing_rows"))
        elif check == "unique":
            res = keys.agg(F.count(F.when(F.col("_k").isNotNull() & (F.col("_n") > 1), F.lit(1)))
                           .alias("failing_rows"))
        elif check == "relationships":
            parents = (tables[ptable].select(F.col(pcol).alias("_k"))
                       .where(F.col("_k").isNotNull()).distinct())
            missing = keys.where(F.col("_k").isNotNull()).join(parents, "_k", "left_anti")
            res = missing.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("failing_rows"))
        else:
            raise ValueError(f"unknown check {check!r}")
        parts.append(res.select(F.lit(order).cast("long").alias("check_order"),
                                F.col("failing_rows").cast("long").alias("failing_rows")))
    return reduce(DataFrame.unionByName, parts)


def dq_report(tables: dict[str, DataFrame], checks=GOLD_CHECKS) -> DataFrame:
    """Run ``checks`` over named tables; one row per check, in check order.

    Checks on the same (table, column) share one aggregation of that column
    (the grouped key counts are computed once and reused), so each table is
    read once per checked column, not once per check.
    """
    by_column: dict[tuple[str, str], list] = {}
    for i, c in enumerate(checks, start=1):
        by_column.setdefault((c[1], c[2]), []).append((i, c))
    results = [_column_checks(tables[t], col, cs, tables) for (t, col), cs in by_column.items()]
    failing = reduce(DataFrame.unionByName, results)
    spec = failing.sparkSession.createDataFrame(
        [(i, c[0], c[1], c[2]) for i, c in enumerate(checks, start=1)],
        "check_order long, check_name string, table_name string, column_name string")
    # the spec has one row per check: a fixed, tiny table
    out = failing.join(F.broadcast(spec), "check_order")
    return out.select("check_order", "check_name", "table_name", "column_name", "failing_rows",
                      (F.col("failing_rows") == 0).alias("passed"))
