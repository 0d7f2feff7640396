"""Scalar column expressions shared by the operators.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen. Timestamps are TIMESTAMP_NTZ holding UTC wall-clock time, which makes
every expression here independent of the session time zone.
"""

from __future__ import annotations

import math
import re
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- Fixed values that must equal the reference's -------------------------
# Bipower scaling constant: pi / 2.
MU = math.pi / 2
# Traded universe (8 pairs quoted in USDT).
SYMBOLS = ["BTCUSDT", "ETHUSDT", "SOLUSDT", "BNBUSDT", "XRPUSDT", "ADAUSDT", "DOGEUSDT", "AVAXUSDT"]
QUOTE = "USDT"
# Base symbol -> asset name; anything else is 'Unknown'.
ASSET_NAMES = {
    "BTC": "Bitcoin", "ETH": "Ethereum", "SOL": "Solana", "BNB": "BNB",
    "XRP": "XRP", "ADA": "Cardano", "DOGE": "Dogecoin", "AVAX": "Avalanche",
}
# Base symbol -> market-cap tier; anything else is 'Unknown'.
MARKET_CAP_TIERS = {
    "BTC": "Large Cap", "ETH": "Large Cap", "BNB": "Large Cap",
    "SOL": "Mid Cap", "XRP": "Mid Cap", "DOGE": "Mid Cap", "ADA": "Mid Cap",
    "AVAX": "Small Cap",
}
UNKNOWN = "Unknown"
# Trading sessions by UTC hour, first matching (inclusive) range wins.
SESSIONS = [(0, 7, "Asian"), (7, 13, "European"), (13, 21, "US")]
OFF_HOURS = "Off-hours"
# US equity market hours flag: UTC hour 13..20 inclusive.
US_MARKET_HOURS = (13, 20)
# Side labels.
BUY, SELL = "BUY", "SELL"
# --------------------------------------------------------------------------

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

_UNIT_MS = {
    "millisecond": 1, "milliseconds": 1, "ms": 1,
    "second": 1000, "seconds": 1000, "sec": 1000, "s": 1000,
    "minute": 60_000, "minutes": 60_000, "min": 60_000, "m": 60_000,
    "hour": 3_600_000, "hours": 3_600_000, "h": 3_600_000,
    "day": 86_400_000, "days": 86_400_000, "d": 86_400_000,
}


def interval_ms(width: str) -> int:
    """Length in milliseconds of a width such as ``'100 milliseconds'`` or ``'6 hours'``."""
    m = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]+)\s*", width)
    if not m or m.group(2).lower() not in _UNIT_MS:
        raise ValueError(f"unsupported window width: {width!r}")
    return int(m.group(1)) * _UNIT_MS[m.group(2).lower()]


def interval_seconds(width: str) -> int:
    """Length in whole seconds of a window width (must be a whole number of seconds)."""
    ms = interval_ms(width)
    if ms % 1000:
        raise ValueError(f"{width!r} is not a whole number of seconds")
    return ms // 1000


# Epoch milliseconds of 0001-01-01 00:00:00.000 and 9999-12-31 23:59:59.999.
MS_RANGE = (-62_135_596_800_000, 253_402_300_799_999)


def ntz_literal(value) -> Column:
    """A TIMESTAMP_NTZ literal for a datetime (aware values are moved to UTC)."""
    from datetime import timezone
    if getattr(value, "tzinfo", None) is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def ms_to_ts(ms: Column | str) -> Column:
    """Epoch milliseconds -> TIMESTAMP_NTZ (UTC wall clock), zone-independent.

    Outside the years 1 to 9999 the result is NULL: a broken time must not
    fail the job.
    """
    ms = F.col(ms) if isinstance(ms, str) else ms
    return F.timestamp_add("MILLISECOND", F.when(ms.between(*MS_RANGE), ms), F.expr(EPOCH_NTZ))


def ts_to_ms(ts: Column | str) -> Column:
    """TIMESTAMP_NTZ -> epoch milliseconds (floor for post-1970 values)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MILLISECOND", F.expr(EPOCH_NTZ), ts)


def ts_to_seconds(ts: Column | str) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("SECOND", F.expr(EPOCH_NTZ), ts)


_D38 = "decimal(38,0)"


def trade_order_key(ts: Column | str = "ts", trade_id: Column | str = "trade_id") -> Column:
    """One DECIMAL(38,0) that sorts exactly like ``struct(ts, trade_id)``.

    ``ts`` in microseconds times 10^20 plus ``trade_id`` shifted to
    [1, 2^64]; NULLs map below every value, as they sort first in the struct.
    Unlike a struct, a decimal is a mutable aggregation-buffer type, so
    ``min_by``/``max_by`` over it plan as a HashAggregate (no sort of the
    input) with map-side partial aggregation.
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    trade_id = F.col(trade_id) if isinstance(trade_id, str) else trade_id
    micros = F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), ts).cast(_D38)
    micros = F.coalesce(micros, F.lit(Decimal(-10 ** 17)).cast(_D38))   # before year 1
    tid = F.coalesce(trade_id.cast(_D38) + F.lit(Decimal(2 ** 63 + 1)).cast(_D38),
                     F.lit(Decimal(0)).cast(_D38))
    return micros * F.lit(Decimal(10 ** 20)).cast(_D38) + tid


def window_start(ts: Column | str, width: str) -> Column:
    """Start of the tumbling event-time window holding ``ts`` (epoch aligned).

    Plain arithmetic: unlike ``F.window`` it keeps rows whose ``ts`` is NULL
    (their start is NULL).
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    past = F.pmod(F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), ts), F.lit(interval_ms(width) * 1000))
    return F.timestamp_add("MICROSECOND", -past, ts)


def aggressor_side(maker: Column, maker_type: T.DataType) -> Column:
    """Maker flag false -> BUY; anything else, NULL included -> SELL."""
    if isinstance(maker_type, T.BooleanType):
        is_buy = maker == F.lit(False)
    else:
        is_buy = maker.cast("string") == F.lit("false")
    return F.when(is_buy, F.lit(BUY)).otherwise(F.lit(SELL))


def safe_log_ratio(num: Column, den: Column) -> Column:
    """ln(num/den) when both are positive, else NULL (never raises under ANSI)."""
    return F.when((num > 0) & (den > 0), F.log(num / den))


def base_symbol(asset: Column) -> Column:
    """Strip every occurrence of the quote currency (BTCUSDT -> BTC)."""
    return F.replace(asset, F.lit(QUOTE), F.lit(""))


def _lookup(key: Column, mapping: dict[str, str]) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = (F.when(key == F.lit(k), F.lit(v)) if expr is None
                else expr.when(key == F.lit(k), F.lit(v)))
    return expr.otherwise(F.lit(UNKNOWN))


def asset_name(base: Column) -> Column:
    return _lookup(base, ASSET_NAMES)


def market_cap_tier(base: Column) -> Column:
    return _lookup(base, MARKET_CAP_TIERS)


def time_id(ts: Column | str) -> Column:
    """Smart key YYYYMMDDHHMM as BIGINT."""
    return F.date_format(ts, "yyyyMMddHHmm").cast("long")


def surrogate_key(symbol: Column | str, ts: Column | str) -> Column:
    """md5 hex of ``symbol|yyyy-MM-dd HH:mm:ss+00`` (NULL if either is NULL)."""
    symbol = F.col(symbol) if isinstance(symbol, str) else symbol
    text = F.date_format(ts, "yyyy-MM-dd HH:mm:ss'+00'")
    return F.md5(F.concat(symbol, F.lit("|"), text))


def trading_session(hour: Column) -> Column:
    expr = None
    for lo, hi, name in SESSIONS:
        cond = hour.between(lo, hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(OFF_HOURS))


def is_us_market_hours(hour: Column) -> Column:
    lo, hi = US_MARKET_HOURS
    return F.coalesce(hour.between(lo, hi), F.lit(False))


def is_weekend(day_of_week: Column) -> Column:
    return F.coalesce(day_of_week.isin(1, 7), F.lit(False))
