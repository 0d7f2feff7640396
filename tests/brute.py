"""Plain-Python single-pass definitions used as a brute-force check on small fixtures."""

import math
from collections import defaultdict

MU = math.pi / 2


def bars(trades, width_ms):
    """trades: list of dicts symbol, trade_id, price, quantity, trade_time, buy (bool)."""
    groups = defaultdict(list)
    for t in trades:
        if t["price"] is None or t["quantity"] is None or t["price"] <= 0 or t["quantity"] <= 0:
            continue
        start = (t["trade_time"] // width_ms) * width_ms
        groups[(t["symbol"], start)].append(t)
    out = {}
    for key, ts in groups.items():
        # (trade_time, trade_id) ascending, NULL trade_id first (as Spark sorts)
        ts = sorted(ts, key=lambda t: (t["trade_time"], t["trade_id"] is not None, t["trade_id"] or 0))
        p = [t["price"] for t in ts]
        q = [t["quantity"] for t in ts]
        rets = [math.log(p[i] / p[i - 1]) for i in range(1, len(p))]
        rv = sum(r * r for r in rets)
        bv = MU * sum(abs(rets[i]) * abs(rets[i - 1]) for i in range(1, len(rets)))
        vol = sum(q)
        buy = sum(t["quantity"] for t in ts if t["buy"])
        sell = vol - buy
        out[key] = {
            "open": p[0], "high": max(p), "low": min(p), "close": p[-1],
            "volume": vol, "trade_count": len(ts),
            "vwap": sum(a * b for a, b in zip(p, q)) / vol,
            "realized_variance": rv, "realized_vol": math.sqrt(rv),
            "bipower_variation": bv, "jump_component": max(rv - bv, 0.0),
            "buy_volume": buy, "sell_volume": sell, "signed_volume": buy - sell,
            "ofi": (buy - sell) / vol if vol > 0 else 0.0,
        }
    return out


def rolling(values, rows=30):
    """Trailing mean / sample std / count over the previous ``rows`` values."""
    out = []
    for i in range(len(values)):
        win = values[max(0, i - rows):i]
        n = len(win)
        mean = sum(win) / n if n else None
        std = None
        if n >= 2:
            std = math.sqrt(sum((x - mean) ** 2 for x in win) / (n - 1))
        out.append((mean, std, n))
    return out
