"""Property: for any tape and any part width dividing the window, the split
reducer equals the single-pass brute force (and the stream reducer equals it too)."""

import datetime as dt
import math

from conftest import WINDOW_MS, make_trades
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import brute
from tapecraft.operators import bars as B
from tapecraft.operators.clean import clean_trades
from tapecraft.streaming.append import stream_minute_append

trade = st.tuples(
    st.sampled_from(["BTCUSDT", "ETHUSDT"]),
    st.integers(0, 50),                                   # trade ids repeat -> (ts, id) ties possible
    st.one_of(st.decimals(min_value=-1, max_value=200, places=2).map(str), st.just("x")),
    st.integers(0, 3).map(str),
    st.integers(0, 3 * 60_000 - 1).map(lambda o: WINDOW_MS + o // 250 * 250),   # coarse ts -> ties
    st.sampled_from(["true", "false", None]),
)


def _brute_rows(rows):
    out = []
    for s, i, p, q, t, m in rows:
        try:
            price = float(p)
        except ValueError:
            price = None
        out.append(dict(symbol=s, trade_id=i, price=price, quantity=float(q), trade_time=t, buy=(m == "false")))
    return out


def _close(a, b):
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(trade, min_size=1, max_size=60, unique_by=lambda r: (r[0], r[1], r[4])),
       part=st.sampled_from(["100 milliseconds", "1 second", "5 seconds", "30 seconds", "60 seconds"]))
def test_split_reducer_equals_brute_force(spark, rows, part):
    expect = brute.bars(_brute_rows(rows), 60_000)
    clean = clean_trades(make_trades(spark, rows))
    got = {(r.symbol, r.minute): r for r in B.minute_bars(clean, "1 minute", part).collect()}
    stream = {(r.symbol, r.window_start): r for r in
              stream_minute_append(clean, "1 minute", "30 seconds", part, bipower=True).collect()}
    assert len(got) == len(expect) == len(stream)
    for (sym, start), e in expect.items():
        k = (sym, dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=start))
        for r in (got[k], stream[k]):
            assert r.trade_count == e["trade_count"]
            for f in ("open", "close", "high", "low", "volume", "realized_variance",
                      "bipower_variation", "buy_volume", "ofi"):
                assert _close(getattr(r, f), e[f]), (f, getattr(r, f), e[f])


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(trade, min_size=1, max_size=60, unique_by=lambda r: (r[0], r[1], r[4])),
       part=st.sampled_from(["1 second", "30 seconds", "60 seconds"]),
       max_rows=st.integers(1, 6), ways=st.integers(2, 9))
def test_hot_part_split_equals_brute_force(spark, rows, part, max_rows, ways):
    expect = brute.bars(_brute_rows(rows), 60_000)
    clean = clean_trades(make_trades(spark, rows))
    got = {(r.symbol, r.minute): r for r in
           B.minute_bars(clean, "1 minute", part, max_part_rows=max_rows, hot_ways=ways).collect()}
    assert len(got) == len(expect)
    for (sym, start), e in expect.items():
        r = got[(sym, dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=start))]
        assert r.trade_count == e["trade_count"]
        for f in ("open", "close", "high", "low", "volume", "realized_variance",
                  "bipower_variation", "buy_volume", "ofi"):
            assert _close(getattr(r, f), e[f]), (f, getattr(r, f), e[f])
