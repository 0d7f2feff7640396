import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tapecraft.session import build_session  # noqa: E402

WINDOW_MS = 1781501520000  # 2026-06-15 05:32:00 UTC


@pytest.fixture(scope="session")
def spark():
    s = build_session(app="tapecraft-tests", master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()


def make_trades(spark, rows, maker_type="string"):
    """rows: (symbol, trade_id, price_text, qty_text, trade_time_ms, maker)."""
    schema = ("event_type string, event_time long, symbol string, trade_id long, price string, "
              f"quantity string, trade_time long, is_buyer_maker {maker_type}")
    data = [("trade", r[4], r[0], r[1], r[2], r[3], r[4], r[5]) for r in rows]
    return spark.createDataFrame(data, schema)
