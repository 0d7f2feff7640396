"""Registered queries over the driver's tables and their DuckDB oracles.

Every query reads the driver's parquet tables (the ``events`` table read as a
trade tape, see ``sources.tables``) and runs over them whole. Doubles are
rounded to ``oracle.DIGITS`` places on both sides because the split
summation order of the Spark operators differs from a single pass in the last
bits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapecraft.operators import bars as B
from tapecraft.operators import regime as R
from tapecraft.operators.clean import clean_trades
from tapecraft.operators.quality import dq_report
from tapecraft.plans import gold as G
from tapecraft.plans import oracle as O
from tapecraft.session import scratch_path
from tapecraft.sources import messages as M
from tapecraft.sources import tables as S

# Oracle checks run on sparse synthetic tapes: hour windows hold enough trades
# for RV/BV to be non-trivial (at one minute almost every window has < 3).
WIDTH = "1 hour"
WIDTH_WIDE = "6 hours"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def rounded(df: DataFrame, digits: int = O.DIGITS) -> DataFrame:
    cols = [F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return rounded(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return deco


def select_rounded(cols: list[str], doubles: set[str], src: str, tail: str = "") -> str:
    """SELECT of ``cols`` from ``src`` with doubles rounded; ``tail`` is appended (e.g. a WHERE)."""
    items = [O.r(c) if c in doubles else c for c in cols]
    return f"SELECT {', '.join(items)} FROM {src}{tail}"


# --- shared Spark building blocks ---------------------------------------------

def _clean(spark, sf_dir, width=WIDTH):
    return clean_trades(S.trades(spark, sf_dir), width)


def _bars(spark, sf_dir, width=WIDTH):
    return B.minute_bars(_clean(spark, sf_dir, width), width)


def _stg(spark, sf_dir, width=WIDTH):
    return G.stg_trades_minute(_bars(spark, sf_dir, width))


def _stg_stream(spark, sf_dir, width=WIDTH):
    return G.stg_trades_minute_stream(B.minute_bars_stream(_clean(spark, sf_dir, width), width))


def _fct(spark, sf_dir, width=WIDTH):
    return G.fct_market_window(_stg(spark, sf_dir, width))


def _fct_stream(spark, sf_dir, width=WIDTH):
    return G.fct_market_window_stream(_stg_stream(spark, sf_dir, width))


BAR_DOUBLES = {"open", "high", "low", "close", "volume", "vwap", "realized_variance",
               "bipower_variation", "buy_volume", "sell_volume", "realized_vol",
               "jump_component", "signed_volume", "ofi"}
STG_DOUBLES = {"open_price", "high_price", "low_price", "close_price", "vwap", "volume",
               "realized_variance", "realized_vol", "bipower_variation", "jump_component",
               "buy_volume", "sell_volume", "signed_volume", "ofi", "window_return"}


# --- MD1: clean trades -------------------------------------------------------------

@register("clean_trades", "WITH " + O.tape_cte() + ",\n" + O.clean_cte(WIDTH) + "\n" +
          "SELECT symbol, trade_id, trade_time, ts, price, quantity, side, minute FROM clean")
def q_clean_trades(spark, sf_dir):
    """Typed, filtered trades with aggressor side and window start."""
    return _clean(spark, sf_dir).select("symbol", "trade_id", "trade_time", "ts", "price",
                                        "quantity", "side", "minute")


# --- AG1-10, DR1-4: bars ------------------------------------------------------------

@register("ohlc_bars", O.with_ctes(WIDTH) + select_rounded(
    ["symbol", "minute", "open", "high", "low", "close"], BAR_DOUBLES, "bars"))
def q_ohlc_bars(spark, sf_dir):
    """Open/high/low/close per (symbol, hour) -- order-free single aggregation."""
    return B.ohlc_bars(_clean(spark, sf_dir))


@register("vwap_bars", O.with_ctes(WIDTH) + select_rounded(
    ["symbol", "minute", "volume", "trade_count", "vwap"], BAR_DOUBLES, "bars"))
def q_vwap_bars(spark, sf_dir):
    return B.vwap_bars(_clean(spark, sf_dir))


@register("order_flow_imbalance", O.with_ctes(WIDTH) + select_rounded(
    ["symbol", "minute", "buy_volume", "sell_volume", "signed_volume", "ofi"], BAR_DOUBLES, "bars"))
def q_ofi(spark, sf_dir):
    return B.order_flow_imbalance(_clean(spark, sf_dir))


@register("realized_volatility", O.with_ctes(WIDTH) + select_rounded(
    ["symbol", "minute", "trade_count", "realized_variance", "realized_vol"], BAR_DOUBLES, "bars"))
def q_realized_volatility(spark, sf_dir):
    return B.realized_volatility(_clean(spark, sf_dir), WIDTH)


@register("bipower_jump", O.with_ctes(WIDTH) + select_rounded(
    ["symbol", "minute", "realized_variance", "bipower_variation", "jump_component"],
    BAR_DOUBLES, "bars"))
def q_bipower_jump(spark, sf_dir):
    return B.bipower_jump(_clean(spark, sf_dir), WIDTH)


@register("minute_bars", O.with_ctes(WIDTH) + select_rounded(
    B.BARS_COLUMNS, BAR_DOUBLES, "bars"))
def q_minute_bars(spark, sf_dir):
    """Silver bars (17 columns) per (symbol, hour)."""
    return _bars(spark, sf_dir)


@register("minute_bars_wide", O.with_ctes(WIDTH_WIDE) + select_rounded(
    B.BARS_COLUMNS, BAR_DOUBLES, "bars"))
def q_minute_bars_wide(spark, sf_dir):
    """Silver bars per (symbol, 6 hours): long windows, many parts stitched."""
    return _bars(spark, sf_dir, WIDTH_WIDE)


_NULL_TAPE = """tape_all AS (SELECT * FROM tape),
tape_nulls AS (
  SELECT CASE WHEN trade_id % 31 = 5 THEN NULL ELSE symbol END AS symbol, trade_id, price, quantity,
         CASE WHEN trade_id % 50 = 7 THEN NULL ELSE trade_time END AS trade_time, is_buyer_maker
  FROM tape_all)"""
_NULL_SQL = "WITH " + ",\n".join([O.tape_cte(), _NULL_TAPE, O.clean_cte(WIDTH).replace("FROM tape", "FROM tape_nulls"),
                                 O.returns_cte(), O.bars_cte()]) + "\n"


@register("minute_bars_null_keys", _NULL_SQL + select_rounded(B.BARS_COLUMNS, BAR_DOUBLES, "bars"))
def q_minute_bars_null_keys(spark, sf_dir):
    """Silver bars of the tape with a share of its times and symbols set to NULL:
    such trades are kept, in the NULL window or under the NULL symbol."""
    tape = S.trades(spark, sf_dir)
    tape = (tape.withColumn("symbol", F.when(F.col("trade_id") % 31 != 5, F.col("symbol")))
            .withColumn("trade_time", F.when(F.col("trade_id") % 50 != 7, F.col("trade_time"))))
    return B.minute_bars(clean_trades(tape, WIDTH), WIDTH)


_MESSAGE_SQL = _NULL_SQL.replace("WHERE price > 0 AND quantity > 0", "WHERE trade_time IS NOT NULL").replace(
    "SELECT symbol, trade_id, trade_time,\n", "SELECT symbol, coalesce(trade_id, 0) AS trade_id, trade_time,\n").replace(
    "sum(price * quantity) / sum(quantity) AS vwap",
    "coalesce(sum(price * quantity) / nullif(sum(quantity), 0), 0.0) AS vwap")


@register("minute_bars_message", _MESSAGE_SQL + select_rounded(B.BARS_COLUMNS, BAR_DOUBLES, "bars"))
def q_minute_bars_message(spark, sf_dir):
    """Bars with the message reducer's rules: no positive filter, a missing id is
    0, trades without a time go, VWAP 0 without volume. The trades come from
    encoded and decoded messages."""
    tape = S.trades(spark, sf_dir)
    tape = (tape.withColumn("symbol", F.when(F.col("trade_id") % 31 != 5, F.col("symbol")))
            .withColumn("trade_time", F.when(F.col("trade_id") % 50 != 7, F.col("trade_time"))))
    read = M.decode_trades_json(M.encode_trades_json(tape))
    return B.minute_bars(clean_trades(read, WIDTH, positive_only=False, null_trade_id="zero"), WIDTH, empty_vwap=0.0)


@register("log_returns", O.with_ctes(WIDTH) + select_rounded(
    B.RETURN_COLUMNS, {"price", "prev_price", "log_ret", "abs_ret", "prev_abs_ret", "bipower_term"},
    "rets"))
def q_log_returns(spark, sf_dir):
    """Per-trade lagged log returns inside each (symbol, hour)."""
    return B.log_returns(_clean(spark, sf_dir), WIDTH)


@register("minute_bars_hot_split", O.with_ctes(WIDTH) + select_rounded(
    B.BARS_COLUMNS, BAR_DOUBLES, "bars"))
def q_minute_bars_hot_split(spark, sf_dir):
    """Silver bars with hot-part splitting forced on: each hour is one part, and
    every part of more than 2 trades is cut into 4 sub-parts at time quantiles
    (exercises the skew path on every busy window of the small tables)."""
    return B.minute_bars(_clean(spark, sf_dir), WIDTH, part=WIDTH, max_part_rows=2, hot_ways=4)


@register("log_returns_hot_split", O.with_ctes(WIDTH) + select_rounded(
    B.RETURN_COLUMNS, {"price", "prev_price", "log_ret", "abs_ret", "prev_abs_ret", "bipower_term"},
    "rets"))
def q_log_returns_hot_split(spark, sf_dir):
    """Per-trade returns with the same forced hot-part splitting."""
    return B.log_returns(_clean(spark, sf_dir), WIDTH, part=WIDTH, max_part_rows=2, hot_ways=4)


# --- MD3-MD8: staging, facts, dimensions ---------------------------------------------

STG_COLUMNS = ["symbol", "window_start", "open_price", "high_price", "low_price", "close_price",
               "vwap", "volume", "trade_count", "realized_variance", "realized_vol",
               "bipower_variation", "jump_component", "buy_volume", "sell_volume",
               "signed_volume", "ofi"]
STG_S_COLUMNS = ["symbol", "window_start", "window_end", "open_price", "high_price", "low_price",
                 "close_price", "vwap", "volume", "trade_count", "realized_variance",
                 "realized_vol", "buy_volume", "sell_volume", "signed_volume", "ofi"]
GOLD = O.with_ctes(WIDTH, *O.gold_ctes(WIDTH))


@register("minute_bars_stream", GOLD + select_rounded(
    ["symbol", "window_start", "window_end", "open_price", "high_price", "low_price",
     "close_price", "volume", "trade_count", "vwap", "realized_variance", "realized_vol",
     "buy_volume", "sell_volume", "signed_volume", "ofi"], STG_DOUBLES, "stg_s"))
def q_minute_bars_stream(spark, sf_dir):
    """Speed-layer silver shape (window_end, no bipower/jump)."""
    b = B.minute_bars_stream(_clean(spark, sf_dir), WIDTH)
    return b.select(
        "symbol", "window_start", "window_end",
        *[F.col(a).alias(a + "_price") for a in ("open", "high", "low", "close")],
        "volume", "trade_count", "vwap", "realized_variance", "realized_vol",
        "buy_volume", "sell_volume", "signed_volume", "ofi")


@register("stg_trades_minute", GOLD + select_rounded(STG_COLUMNS, STG_DOUBLES, "stg"))
def q_stg(spark, sf_dir):
    return _stg(spark, sf_dir)


@register("stg_trades_minute_stream", GOLD + select_rounded(STG_S_COLUMNS, STG_DOUBLES, "stg_s"))
def q_stg_stream(spark, sf_dir):
    return _stg_stream(spark, sf_dir)


@register("fct_market_window", GOLD + select_rounded(G.FCT_COLUMNS, STG_DOUBLES, "fct"))
def q_fct(spark, sf_dir):
    return _fct(spark, sf_dir)


@register("fct_market_window_stream", GOLD + select_rounded(G.FCT_STREAM_COLUMNS, STG_DOUBLES, "fct_s"))
def q_fct_stream(spark, sf_dir):
    return _fct_stream(spark, sf_dir)


@register("surrogate_key", GOLD + "SELECT market_window_id, asset_id, time_id, window_start FROM fct")
def q_surrogate_key(spark, sf_dir):
    """md5 surrogate key and YYYYMMDDHHMM time key of every (asset, window)."""
    return _fct(spark, sf_dir).select("market_window_id", "asset_id", "time_id", "window_start")


@register("dim_time", GOLD + ",\n" + O.dim_time_cte() + "\nSELECT * FROM dim_time")
def q_dim_time(spark, sf_dir):
    """Distinct window starts of the batch and speed-layer staging tables: the
    batch side ends a day before the tape does, the speed side has its last two days."""
    clean = _clean(spark, sf_dir)
    end = clean.agg(F.max("trade_time").alias("t")).first()["t"] or 0
    day = 86_400_000
    batch = clean.where(F.col("trade_time") < end - day)
    speed = clean.where(F.col("trade_time") >= end - 2 * day)
    return G.dim_time(G.stg_trades_minute(B.minute_bars(batch, WIDTH)),
                      G.stg_trades_minute_stream(B.minute_bars_stream(speed, WIDTH)))


@register("latest_metadata", "WITH " + O.metadata_cte() + ",\n" + O.latest_metadata_cte() +
          "\nSELECT symbol, reference_price, confidence, price_timestamp FROM latest")
def q_latest_metadata(spark, sf_dir):
    return G.latest_metadata(S.metadata(spark, sf_dir))


@register("dim_asset", GOLD + ",\n" + O.metadata_cte() + ",\n" + O.latest_metadata_cte() + ",\n" +
          O.dim_asset_cte() + "\nSELECT * FROM dim_asset")
def q_dim_asset(spark, sf_dir):
    """Asset dimension (``loaded_at`` left out: it is the load time)."""
    return G.dim_asset(_fct(spark, sf_dir), S.metadata(spark, sf_dir), with_loaded_at=False)


# --- MD9: regime mart ---------------------------------------------------------------

REGIME_SQL = GOLD + ",\n" + O.regime_cte() + "\n"
REGIME_DOUBLES = STG_DOUBLES | {"roll_mean_vol", "roll_std_vol", "vol_zscore"}


def materialized_fct(spark, sf_dir, width=WIDTH):
    """The batch fact as the mart reads it: a model written as a table before its
    dependents. The blocked rolling window reads its input twice (day counts,
    then rows); of a table that is a narrow second scan, not a recompute."""
    return G.write_model(_fct(spark, sf_dir, width), scratch_path(spark, "gold"), "fct_market_window")


def _regime_input(spark, sf_dir):
    return materialized_fct(spark, sf_dir)


@register("rolling_vol_baseline", REGIME_SQL + select_rounded(
    ["asset_id", "window_start", "realized_vol", "roll_mean_vol", "roll_std_vol", "roll_n"],
    REGIME_DOUBLES, "classified"))
def q_rolling(spark, sf_dir):
    rolled = R.rolling_vol_baseline(_regime_input(spark, sf_dir))
    return rolled.select("asset_id", "window_start", "realized_vol", "roll_mean_vol",
                         "roll_std_vol", "roll_n")


@register("rolling_vol_baseline_blocked", REGIME_SQL + select_rounded(
    ["asset_id", "window_start", "realized_vol", "roll_mean_vol", "roll_std_vol", "roll_n"],
    REGIME_DOUBLES, "classified"))
def q_rolling_blocked(spark, sf_dir):
    """Same baseline with tiny blocks (64 rows): every block boundary and halo
    path is exercised on the small tables."""
    rolled = R.rolling_vol_baseline(_regime_input(spark, sf_dir), block_rows=64)
    return rolled.select("asset_id", "window_start", "realized_vol", "roll_mean_vol",
                         "roll_std_vol", "roll_n")


@register("vol_zscore", REGIME_SQL + select_rounded(
    ["asset_id", "window_start", "vol_zscore"], REGIME_DOUBLES, "classified"))
def q_vol_zscore(spark, sf_dir):
    return R.vol_zscore(R.rolling_vol_baseline(_regime_input(spark, sf_dir))).select(
        "asset_id", "window_start", "vol_zscore")


@register("volatility_regime", REGIME_SQL + select_rounded(
    ["asset_id", "window_start", "volatility_regime"], REGIME_DOUBLES, "classified"))
def q_volatility_regime(spark, sf_dir):
    return R.volatility_regime(R.rolling_vol_baseline(_regime_input(spark, sf_dir))).select(
        "asset_id", "window_start", "volatility_regime")


@register("jump_minutes", REGIME_SQL + select_rounded(
    ["asset_id", "window_start", "realized_variance", "jump_component", "is_jump_minute"],
    REGIME_DOUBLES, "classified"))
def q_jump_minutes(spark, sf_dir):
    return R.jump_minutes(_fct(spark, sf_dir)).select(
        "asset_id", "window_start", "realized_variance", "jump_component", "is_jump_minute")


@register("ofi_return_by_regime", REGIME_SQL + select_rounded(
    R.REGIME_COLUMNS, REGIME_DOUBLES, "classified"))
def q_ofi_return_by_regime(spark, sf_dir):
    """The regime mart (17 columns)."""
    return R.ofi_return_by_regime(_regime_input(spark, sf_dir))


# --- 2.11: data quality -----------------------------------------------------------

def _dq_sql() -> str:
    """The checks of the star schema, one row each, written out."""
    tables = {"fct_market_window": "fct", "fct_market_window_stream": "fct_s", "dim_asset": "dim_asset", "dim_time": "dim_time"}
    parts = []
    for i, line in enumerate(O.DQ_CHECKS.strip().splitlines(), start=1):
        check, place, *parent = line.split()
        table, col = place.split(".")
        t = tables[table]
        if check == "unique":
            cnt = (f"(SELECT count(*) FROM (SELECT {col} FROM {t} WHERE {col} IS NOT NULL "
                   f"GROUP BY {col} HAVING count(*) > 1))")
        elif check == "not_null":
            cnt = f"(SELECT count(*) FROM {t} WHERE {col} IS NULL)"
        else:
            ptable, pcol = parent[0].split(".")
            cnt = (f"(SELECT count(*) FROM {t} c LEFT JOIN {tables[ptable]} p ON c.{col} = p.{pcol} "
                   f"WHERE c.{col} IS NOT NULL AND p.{pcol} IS NULL)")
        parts.append(f"SELECT CAST({i} AS BIGINT) AS check_order, '{check}' AS check_name, "
                     f"'{table}' AS table_name, '{col}' AS column_name, "
                     f"CAST({cnt} AS BIGINT) AS failing_rows, {cnt} = 0 AS passed")
    return (GOLD + ",\n" + O.dim_time_cte() + ",\n" + O.metadata_cte() + ",\n" +
            O.latest_metadata_cte() + ",\n" + O.dim_asset_cte() + "\n" + "\nUNION ALL\n".join(parts))


def gold_tables(spark, sf_dir, width=WIDTH, materialize=True) -> dict[str, DataFrame]:
    """The four gold tables the checks run on.

    With ``materialize`` the silver bars and the four models are written as
    tables (``write_model``), so that every check reads a table instead of
    deriving it from the tape again.
    """
    root = scratch_path(spark, "gold")
    bars = _bars(spark, sf_dir, width)
    if materialize:
        bars = G.write_model(bars, root, "silver")
    stg = G.stg_trades_minute(bars)
    stg_s = G.stg_trades_minute_stream(B.as_stream_shape(bars, width))
    fct = G.fct_market_window(stg)
    fct_s = G.fct_market_window_stream(stg_s)
    models = {
        "fct_market_window": fct,
        "fct_market_window_stream": fct_s,
        "dim_asset": G.dim_asset(fct, S.metadata(spark, sf_dir), with_loaded_at=False),
        "dim_time": G.dim_time(stg, stg_s),
    }
    return {name: G.write_model(df, root, name) for name, df in models.items()} if materialize else models


@register("dq_report", _dq_sql())
def q_dq_report(spark, sf_dir):
    """The 17 star-schema checks over the gold tables built from the tape."""
    return dq_report(gold_tables(spark, sf_dir))


# --- 2.13: analyses ------------------------------------------------------------------

from tapecraft.operators import analysis as A  # noqa: E402

_CORR = ("covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0)")


@register("ofi_corr_by_regime", REGIME_SQL + f"""SELECT volatility_regime,
       CAST(count(*) AS BIGINT) AS windows,
       round(avg(ofi), {O.DIGITS}) AS avg_ofi,
       round(avg(window_return), {O.DIGITS}) AS avg_return,
       round(avg(realized_vol), {O.DIGITS}) AS avg_realized_vol,
       round({_CORR.format(x='ofi', y='window_return')}, {O.DIGITS}) AS corr_ofi_return,
       round({_CORR.format(x='ofi', y='realized_vol')}, {O.DIGITS}) AS corr_ofi_vol
FROM classified GROUP BY volatility_regime""")
def q_ofi_corr_by_regime(spark, sf_dir):
    """OFI vs return / volatility per volatility regime."""
    return A.ofi_corr_by_regime(R.ofi_return_by_regime(_regime_input(spark, sf_dir)))


@register("vol_by_session", GOLD + f"""SELECT {O.session_case('CAST(extract(hour FROM window_start) AS BIGINT)')}
         AS trading_session,
       CAST(count(*) AS BIGINT) AS windows,
       round(avg(realized_vol), {O.DIGITS}) AS avg_realized_vol,
       round(avg(abs(window_return)), {O.DIGITS}) AS avg_abs_return,
       round(sum(volume), {O.DIGITS}) AS volume
FROM fct GROUP BY 1""")
def q_vol_by_session(spark, sf_dir):
    return A.vol_by_session(_fct(spark, sf_dir))


@register("vol_by_tier", GOLD + f"""SELECT {O.tier_case("replace(asset_id, 'USDT', '')")}
         AS market_cap_tier,
       CAST(count(*) AS BIGINT) AS windows,
       CAST(count(DISTINCT asset_id) AS BIGINT) AS assets,
       round(avg(realized_vol), {O.DIGITS}) AS avg_realized_vol,
       round(avg(realized_variance), {O.DIGITS}) AS avg_realized_variance,
       round(avg(jump_component), {O.DIGITS}) AS avg_jump_component
FROM fct GROUP BY 1""")
def q_vol_by_tier(spark, sf_dir):
    return A.vol_by_tier(_fct(spark, sf_dir))


@register("vol_rollup_time", GOLD + f"""SELECT CAST(window_start AS DATE) AS window_date,
       CAST(extract(hour FROM window_start) AS BIGINT) AS hour,
       CAST(count(*) AS BIGINT) AS windows,
       round(avg(realized_vol), {O.DIGITS}) AS avg_realized_vol,
       round(sum(volume), {O.DIGITS}) AS volume
FROM fct GROUP BY ROLLUP (CAST(window_start AS DATE), CAST(extract(hour FROM window_start) AS BIGINT))""")
def q_vol_rollup_time(spark, sf_dir):
    return A.vol_rollup_time(_fct(spark, sf_dir))


# Source, sink and streaming queries register themselves on import.
from tapecraft.plans import io_queries as _io  # noqa: E402,F401
