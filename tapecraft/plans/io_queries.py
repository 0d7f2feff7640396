"""Registered queries for sources, sinks and the streaming paths.

Writers land data under the shared checkpoint folder (``session.scratch_path``)
and the query returns what Spark reads back, so each one is a full round trip
over the whole tape.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapecraft.functions.columns import SYMBOLS, ntz_literal
from tapecraft.operators import incremental as I
from tapecraft.operators import regime as R
from tapecraft.operators.bars import as_stream_shape, minute_bars, minute_bars_stream
from tapecraft.operators.clean import clean_trades, recent_trades
from tapecraft.plans import gold as G
from tapecraft.plans import oracle as O
from tapecraft.plans.models import build_models, read_models
from tapecraft.plans.registry import _NULL_SQL, REGIME_DOUBLES, REGIME_SQL, WIDTH, register, select_rounded
from tapecraft.schemas import BARS_STREAM_COLUMNS, TRADE
from tapecraft.session import scratch_path
from tapecraft.sources import landing as L
from tapecraft.sources import messages as M
from tapecraft.sources import tables as S
from tapecraft.sources.versioned import VersionedTable
from tapecraft.streaming import upsert as U
from tapecraft.streaming.append import deduplicated, stream_minute_append
from tapecraft.streaming.ledger import SkippedWindows

TRADE_TEXT_COLS = ["event_type", "event_time", "symbol", "trade_id", "price", "quantity",
                   "trade_time", "is_buyer_maker"]

def _tape_text_sql() -> str:
    """The tape as landed text records (prices and quantities as strings)."""
    return f"""WITH tape_text AS (
  SELECT 'trade' AS event_type, epoch_us(ts) // 1000 AS event_time,
         {O._case('event_type', S.EVENT_SYMBOLS)} AS symbol, event_id AS trade_id,
         CAST(value AS VARCHAR) AS price,
         json_extract_string(props, '$.k') AS quantity,
         epoch_us(ts) // 1000 AS trade_time,
         CASE WHEN user_id % 2 = 1 THEN 'true' ELSE 'false' END AS is_buyer_maker,
         strftime(make_timestamp((epoch_us(ts) // 1000) * 1000), '%Y-%m-%d') AS dt
  FROM events)
"""


TAPE_TEXT = _tape_text_sql()


def _text_tape(spark, sf_dir):
    """The tape with the maker flag as text, as a JSON message carries it."""
    return S.trades(spark, sf_dir).withColumn("is_buyer_maker", F.col("is_buyer_maker").cast("string"))


# --- SRC1 / SNK4 / SRC2: message formats ------------------------------------------

@register("parse_trade_envelope", TAPE_TEXT + "SELECT " + ", ".join(TRADE_TEXT_COLS) + " FROM tape_text")
def q_parse_trade_envelope(spark, sf_dir):
    """Trades -> exchange envelopes -> parsed TRADE rows (symbol-less dropped)."""
    return M.parse_trade_envelope(M.trades_to_envelopes(S.trades(spark, sf_dir)))


@register("encode_trades_json", TAPE_TEXT + """
SELECT symbol AS key,
       to_json({'event_type': event_type, 'event_time': event_time, 'symbol': symbol,
                'trade_id': trade_id, 'price': price, 'quantity': quantity,
                'trade_time': trade_time, 'is_buyer_maker': is_buyer_maker = 'true'}) AS value_json,
       CAST(octet_length(encode(CAST(to_json({'event_type': event_type, 'event_time': event_time,
                'symbol': symbol, 'trade_id': trade_id, 'price': price, 'quantity': quantity,
                'trade_time': trade_time, 'is_buyer_maker': is_buyer_maker = 'true'}) AS VARCHAR)))
            AS BIGINT) AS value_bytes
FROM tape_text""")
def q_encode_trades_json(spark, sf_dir):
    """Trades -> (key = symbol, value = UTF-8 JSON bytes) message records."""
    enc = M.encode_trades_json(S.trades(spark, sf_dir))
    return enc.select("key", F.decode("value", "UTF-8").alias("value_json"),
                      F.octet_length("value").cast("long").alias("value_bytes"))


@register("decode_trades_json", TAPE_TEXT + "SELECT " + ", ".join(TRADE_TEXT_COLS) + " FROM tape_text")
def q_decode_trades_json(spark, sf_dir):
    """Trades -> flat JSON messages -> decoded TRADE rows."""
    return M.decode_trades_json(M.encode_trades_json(S.trades(spark, sf_dir)))


@register("flatten_metadata", "WITH " + O.metadata_cte() +
          "\nSELECT coin_id, symbol, price, \"timestamp\", confidence, source FROM metadata")
def q_flatten_metadata(spark, sf_dir):
    """Metadata feed -> {"coins": {...}} messages -> one row per coin."""
    return M.flatten_metadata(M.metadata_to_envelopes(S.metadata(spark, sf_dir)))


# --- SRC3 / SRC6 / SRC7 / SNK8: landing and bronze ------------------------------------

@register("partitioned_landing", TAPE_TEXT + "SELECT " + ", ".join(TRADE_TEXT_COLS) + ", dt FROM tape_text")
def q_partitioned_landing(spark, sf_dir):
    """Land the tape as JSON lines under symbol=/dt=, read it back."""
    path = scratch_path(spark, "landing")
    L.partitioned_landing(S.trades(spark, sf_dir), path)
    return L.read_landed(spark, path).select(*TRADE_TEXT_COLS, "dt")


@register("load_bronze_day", TAPE_TEXT + "SELECT " + ", ".join(TRADE_TEXT_COLS) +
          ", dt FROM tape_text WHERE dt = (SELECT max(dt) FROM tape_text)")
def q_load_bronze_day(spark, sf_dir):
    """Land the tape, then load the latest UTC day's partitions of the 8 symbols
    into a bronze parquet table (partition-pruned read)."""
    path = scratch_path(spark, "landing")
    tape = S.trades(spark, sf_dir)
    L.partitioned_landing(tape, path)
    day = tape.agg(F.max(L.utc_day()).alias("d")).first()["d"]
    target = scratch_path(spark, "bronze")
    return L.load_bronze_day(spark, path, day, SYMBOLS, target=target).select(*TRADE_TEXT_COLS, "dt")


@register("bronze_scan_count", "SELECT CAST(count(*) AS BIGINT) AS bronze_rows FROM events")
def q_bronze_scan_count(spark, sf_dir):
    return L.bronze_scan_count(S.trades(spark, sf_dir))


_EXPECTED = ", ".join(f"('{s}')" for s in O.EXPECTED_SYMBOLS)


@register("symbol_coverage", f"""WITH {O.tape_cte()},
expected(symbol) AS (VALUES {_EXPECTED}),
counts AS (SELECT upper(symbol) AS symbol, count(*) AS n FROM tape GROUP BY 1)
SELECT e.symbol, CAST(coalesce(c.n, 0) AS BIGINT) AS trades, coalesce(c.n, 0) >= 60 AS meets_quota
FROM expected e LEFT JOIN counts c ON c.symbol = e.symbol""")
def q_symbol_coverage(spark, sf_dir):
    """Trades per expected symbol against the 60-trade quota."""
    return L.symbol_coverage(S.trades(spark, sf_dir))


# --- SM*: streaming ---------------------------------------------------------------

_BARS_S_DOUBLES = {"open", "high", "low", "close", "volume", "vwap", "realized_variance",
                   "realized_vol", "buy_volume", "sell_volume", "signed_volume", "ofi"}
_BARS_S_SQL = O.with_ctes(WIDTH) + f""",
bars_s AS (
  SELECT symbol, minute AS window_start, minute + INTERVAL '{3600} seconds' AS window_end,
         open, high, low, close, volume, trade_count, vwap, realized_variance, realized_vol,
         buy_volume, sell_volume, signed_volume, ofi
  FROM bars)
"""


@register("stream_minute_append", _BARS_S_SQL + select_rounded(
    BARS_STREAM_COLUMNS, _BARS_S_DOUBLES, "bars_s",
    " WHERE window_end <= (SELECT max(ts) FROM clean) - INTERVAL 30 SECOND"))
def q_stream_minute_append(spark, sf_dir):
    """File stream of the tape -> watermarked two-level window aggregation ->
    append-mode parquet sink; returns the sink. Windows still open behind the
    30 s watermark at the end of the input are not emitted."""
    root = scratch_path(spark, "stream-append")
    _text_tape(spark, sf_dir).write.json(f"{root}/in")
    raw = spark.readStream.schema(TRADE).json(f"{root}/in")
    out = stream_minute_append(clean_trades(raw, WIDTH), WIDTH, "30 seconds")
    q = (out.writeStream.outputMode("append").format("parquet").option("path", f"{root}/out")
         .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out")


@register("touched_minutes", "WITH " + O.tape_cte() + ",\n" + O.clean_cte(WIDTH) +
          "\nSELECT DISTINCT symbol, minute FROM clean")
def q_touched_minutes(spark, sf_dir):
    """Distinct (symbol, window) keys touched by a batch (the whole tape)."""
    return U.touched_minutes(clean_trades(S.trades(spark, sf_dir), WIDTH))


def _max_ts(clean):
    return clean.agg(F.max("ts").alias("m")).first()["m"]


@register("recent_trades", "WITH " + O.tape_cte() + ",\n" + O.clean_cte(WIDTH) + """
SELECT symbol, trade_id, ts, price, quantity, side, minute FROM clean
WHERE minute >= make_timestamp(((epoch_us((SELECT max(ts) FROM clean) - INTERVAL 1 DAY)
                                 // 3600000000) * 3600000000))""")
def q_recent_trades(spark, sf_dir):
    """Trades inside a 1-day horizon before the tape's last trade, cut aligned
    down to a whole hour window."""
    clean = clean_trades(S.trades(spark, sf_dir), WIDTH)
    as_of = _max_ts(clean)
    return recent_trades(clean, as_of, "1 day", WIDTH).select(
        "symbol", "trade_id", "ts", "price", "quantity", "side", "minute")


_TOUCHED_LAST_DAY = """touched AS (
  SELECT DISTINCT symbol, minute FROM clean
  WHERE ts >= (SELECT max(ts) FROM clean) - INTERVAL 1 DAY)
"""


@register("recompute_touched", _BARS_S_SQL + ",\n" + _TOUCHED_LAST_DAY + select_rounded(
    BARS_STREAM_COLUMNS, _BARS_S_DOUBLES, "bars_s",
    " WHERE (symbol, window_start) IN (SELECT (symbol, minute) FROM touched)"))
def q_recompute_touched(spark, sf_dir):
    """Windows touched by the last day's trades, recomputed from all trades."""
    clean = clean_trades(S.trades(spark, sf_dir), WIDTH)
    as_of = _max_ts(clean)
    batch = clean.where(F.col("ts") >= ntz_literal(as_of - timedelta(days=1)))
    return U.recompute_touched(clean, U.touched_minutes(batch), WIDTH, as_of=None, horizon=None)


@register("upsert_minutes", _BARS_S_SQL + select_rounded(BARS_STREAM_COLUMNS, _BARS_S_DOUBLES, "bars_s"))
def q_upsert_minutes(spark, sf_dir):
    """Silver first built from trades before a cut that splits a window, then
    the windows touched by the later trades are recomputed and upserted: the
    split window is updated, later ones inserted."""
    clean = clean_trades(S.trades(spark, sf_dir), WIDTH)
    cut = _max_ts(clean) - timedelta(days=1, minutes=30)
    early = clean.where(F.col("ts") < ntz_literal(cut))
    late = clean.where(F.col("ts") >= ntz_literal(cut))
    target = scratch_path(spark, "silver-upsert")
    U.upsert_minutes(spark, target, minute_bars_stream(early, WIDTH))
    U.upsert_minutes(spark, target, U.recompute_touched(clean, U.touched_minutes(late), WIDTH,
                                                        horizon=None))
    return U.read_silver(spark, target).select(*BARS_STREAM_COLUMNS)


@register("stream_upsert", _BARS_S_SQL + select_rounded(BARS_STREAM_COLUMNS, _BARS_S_DOUBLES, "bars_s"))
def q_stream_upsert(spark, sf_dir):
    """Landing (symbol=/dt=) read as a file stream in several micro-batches;
    each batch recomputes its touched windows from all landed trades and
    upserts them into silver."""
    landing = scratch_path(spark, "landing")
    L.partitioned_landing(S.trades(spark, sf_dir), landing)
    schema = T.StructType(TRADE.fields + [T.StructField("dt", T.StringType())])
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 256)
              .option("basePath", landing).json(landing))
    target = scratch_path(spark, "silver-stream")
    ckpt = scratch_path(spark, "stream-upsert-checkpoint")
    q = U.stream_upsert(spark, stream, lambda: L.read_landed(spark, landing), target, ckpt,
                        WIDTH, horizon=None, trigger={"availableNow": True}, event_day="dt")
    q.awaitTermination()
    return U.read_silver(spark, target).select(*BARS_STREAM_COLUMNS)


_WIDE = "7 hours"
_WIDE_SQL = O.with_ctes(_WIDE) + """,
bars_s AS (
  SELECT symbol, minute AS window_start, minute + INTERVAL 25200 SECOND AS window_end,
         open, high, low, close, volume, trade_count, vwap, realized_variance, realized_vol,
         buy_volume, sell_volume, signed_volume, ofi
  FROM bars)
"""


@register("recompute_touched_over_midnight", _WIDE_SQL + select_rounded(BARS_STREAM_COLUMNS, _BARS_S_DOUBLES, "bars_s"))
def q_recompute_over_midnight(spark, sf_dir):
    """All seven-hour windows (many reach over midnight) recomputed from a landing
    partitioned by event day, with the day pruning on."""
    landing = scratch_path(spark, "landing")
    L.partitioned_landing(S.trades(spark, sf_dir), landing)
    clean = clean_trades(L.read_landed(spark, landing), _WIDE)
    return U.recompute_touched(clean, U.touched_minutes(clean), _WIDE, horizon=None, event_day="dt")


# Trades arrive late by up to 1,200 s, in eight batches of equal length of arrival time.
_ARRIVAL_SQL = """,
arrivals AS (
  SELECT symbol, minute, ts, trade_time + (trade_id * 7919 % 1200) * 1000 AS arrived FROM clean),
batches AS (
  SELECT symbol, minute, ts, least(7, (arrived - (SELECT min(arrived) FROM arrivals)) * 8
         // greatest((SELECT max(arrived) - min(arrived) FROM arrivals), 1)) AS b FROM arrivals)"""


def _arrival_batches(spark, sf_dir, n=8):
    """The tape with its batch number by arrival: trade time plus a delay from the trade id."""
    tape = _text_tape(spark, sf_dir).withColumn(
        "_at", F.col("trade_time") + (F.col("trade_id") * 7919 % 1200) * 1000)
    valid = (F.col("price").try_cast("double") > 0) & (F.col("quantity").try_cast("double") > 0)
    ends = tape.where(valid).agg(F.min("_at").alias("lo"), F.max("_at").alias("hi")).first()
    lo, span = ends["lo"] or 0, max((ends["hi"] or 0) - (ends["lo"] or 0), 1)
    batch = F.least(F.lit(n - 1), F.greatest(F.lit(0), F.floor((F.col("_at") - lo) * n / F.lit(span))))
    return tape.withColumn("_batch", batch)


@register("stream_append_out_of_order", _BARS_S_SQL + select_rounded(
    BARS_STREAM_COLUMNS, _BARS_S_DOUBLES, "bars_s",
    " WHERE window_end <= (SELECT max(ts) FROM clean) - INTERVAL 30 MINUTE"))
def q_stream_append_out_of_order(spark, sf_dir):
    """The append reducer over eight micro-batches of trades that arrive up to 20
    minutes late, under a watermark of 30 minutes: no trade is lost, closed
    windows equal the batch bars."""
    root = scratch_path(spark, "stream-late")
    raw = _stream_of_arrivals(spark, _arrival_batches(spark, sf_dir), root)
    return _appended(spark, stream_minute_append(clean_trades(raw, WIDTH), WIDTH, "30 minutes"), root)


def _stream_of_arrivals(spark, tape, root, files=4):
    """The tape's batches as a file stream, a micro-batch each or thereabouts."""
    tape = tape.persist()
    for b in range(8):   # one write a batch, so that file times follow the arrivals
        (tape.where(F.col("_batch") == b).drop("_at", "_batch").repartition(files)
         .write.mode("append").json(f"{root}/in"))
    tape.unpersist()
    return spark.readStream.schema(TRADE).option("maxFilesPerTrigger", files).json(f"{root}/in")


def _appended(spark, bars, root):
    """Run a stream of bars over all its input into an append-mode parquet sink; the sink."""
    q = (bars.writeStream.outputMode("append").format("parquet").option("path", f"{root}/out")
         .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out")


@register("stream_append_bounded", _BARS_S_SQL + select_rounded(
    BARS_STREAM_COLUMNS, _BARS_S_DOUBLES, "bars_s",
    " WHERE window_end <= (SELECT max(ts) FROM clean) - INTERVAL 30 MINUTE"))
def q_stream_append_bounded(spark, sf_dir):
    """The same stream with at most four trades in a state row, stitched three times."""
    root = scratch_path(spark, "stream-bounded")
    raw = _stream_of_arrivals(spark, _arrival_batches(spark, sf_dir), root)
    return _appended(spark, stream_minute_append(clean_trades(raw, WIDTH), WIDTH, "30 minutes", max_run_trades=4), root)


@register("stream_append_deduplicated", _BARS_S_SQL + select_rounded(
    BARS_STREAM_COLUMNS, _BARS_S_DOUBLES, "bars_s",
    " WHERE window_end <= (SELECT max(ts) - to_seconds((max(trade_time) - min(trade_time)) // 4000 + 3600) FROM clean)"))
def q_stream_append_deduplicated(spark, sf_dir):
    """The same stream with every fifth message twice more, once in its batch and once
    in the next one, under a watermark of a quarter of the tape and an hour: it
    remembers trades for two batches, so all repeats go and no trade is late."""
    root = scratch_path(spark, "stream-repeats")
    tape = _arrival_batches(spark, sf_dir)
    again = tape.where(F.col("trade_id") % 5 == 0)
    repeated = tape.unionByName(again).unionByName(again.withColumn("_batch", F.least(F.col("_batch") + 1, F.lit(7))))
    ends = clean_trades(tape, WIDTH).agg(F.min("trade_time").alias("lo"), F.max("trade_time").alias("hi")).first()
    delay = ((ends["hi"] or 0) - (ends["lo"] or 0)) // 4000 + 3600
    raw = _stream_of_arrivals(spark, repeated, root)
    return _appended(spark, stream_minute_append(deduplicated(clean_trades(raw, WIDTH), f"{delay} seconds"), WIDTH), root)


@register("stream_upsert_horizon", _BARS_S_SQL.rstrip() + _ARRIVAL_SQL + """,
edges AS (SELECT b, max(ts) AS last FROM batches GROUP BY b),
seen AS (
  SELECT DISTINCT t.symbol, t.minute, t.b FROM batches t JOIN edges e ON e.b = t.b
  WHERE t.minute >= make_timestamp((epoch_us(e.last - INTERVAL 6 HOUR) // 3600000000) * 3600000000))
""" + select_rounded(BARS_STREAM_COLUMNS, _BARS_S_DOUBLES, "bars_s",
                     " WHERE (symbol, window_start) IN (SELECT (symbol, minute) FROM seen)"))
def q_stream_upsert_horizon(spark, sf_dir):
    """The speed layer with a horizon of six hours that moves with the eight
    batches: of a batch only windows of its last six hours are recomputed, from
    the whole landing."""
    landing = scratch_path(spark, "landing")
    tape = _arrival_batches(spark, sf_dir).persist()
    L.partitioned_landing(S.trades(spark, sf_dir), landing)
    target = scratch_path(spark, "silver-horizon")
    handle = U.upsert_handler(spark, lambda: L.read_landed(spark, landing), target, WIDTH, horizon="6 hours",
                              event_day="dt")
    for b in range(8):
        handle(clean_trades(tape.where(F.col("_batch") == b).drop("_at", "_batch"), WIDTH), b)
    tape.unpersist()
    return U.read_silver(spark, target).select(*BARS_STREAM_COLUMNS)


@register("stream_upsert_repaired", _BARS_S_SQL + select_rounded(BARS_STREAM_COLUMNS, _BARS_S_DOUBLES, "bars_s"))
def q_stream_upsert_repaired(spark, sf_dir):
    """The speed layer as a stream with a horizon of ten minutes, which most late trades
    miss: windows before it go to the ledger, and a repair pass drains it. Only the landing
    folders of a batch's windows are read. In the end silver has all bars of the tape."""
    root = scratch_path(spark, "speed-repaired")
    L.partitioned_landing(S.trades(spark, sf_dir), f"{root}/landing")
    raw = _stream_of_arrivals(spark, _arrival_batches(spark, sf_dir), root)
    ledger = SkippedWindows(spark, f"{root}/ledger")

    def read_days(days):
        return L.read_landed(spark, f"{root}/landing", days)

    U.stream_upsert(spark, raw, None, f"{root}/silver", f"{root}/checkpoint", WIDTH, {"availableNow": True},
                    horizon="10 minutes", read_days=read_days, ledger=ledger).awaitTermination()
    U.repair_skipped(spark, ledger, None, f"{root}/silver", WIDTH, read_days=read_days)
    return U.read_silver(spark, f"{root}/silver").select(*BARS_STREAM_COLUMNS)


_FAULTY = "trade_id % 211 = 3"


@register("speed_layer_checks", _BARS_S_SQL.rstrip() + _ARRIVAL_SQL + f""",
faulty AS (SELECT DISTINCT symbol, minute FROM clean WHERE {_FAULTY})
SELECT CAST(b AS BIGINT) AS batch, count(*) AS bars, count(f.symbol) AS not_finite, count(f.symbol) > 0 AS rejected
FROM (SELECT DISTINCT b, symbol, minute FROM batches) t LEFT JOIN faulty f ON f.symbol = t.symbol AND f.minute = t.minute
GROUP BY b""")
def q_speed_layer_checks(spark, sf_dir):
    """The gate's reports over eight batches of a tape in which some prices are the text
    'NaN': batches that touch such a window are rejected, the others upserted."""
    valid = (F.col("price").try_cast("double") > 0) & (F.col("quantity").try_cast("double") > 0)
    tape = _arrival_batches(spark, sf_dir)
    tape = tape.withColumn("price", F.when(F.expr(_FAULTY) & valid, F.lit("NaN")).otherwise(F.col("price"))).persist()
    root, reports = scratch_path(spark, "speed-checks"), []
    L.partitioned_landing(tape.drop("_at", "_batch"), f"{root}/landing")
    handle = U.upsert_handler(spark, None, f"{root}/silver", WIDTH, horizon=None, on_report=reports.append,
                              read_days=lambda days: L.read_landed(spark, f"{root}/landing", days),
                              ledger=SkippedWindows(spark, f"{root}/ledger"))
    for b in range(8):
        handle(clean_trades(tape.where(F.col("_batch") == b).drop("_at", "_batch"), WIDTH), b)
    tape.unpersist()
    return spark.createDataFrame([(r.batch, r.bars, r.failing["not_finite"], r.rejected) for r in reports],
                                 "batch long, bars long, not_finite long, rejected boolean")


@register("upsert_null_windows", _NULL_SQL.rstrip() + """,
bars_s AS (
  SELECT symbol, minute AS window_start, minute + INTERVAL 3600 SECOND AS window_end,
         open, high, low, close, volume, trade_count, vwap, realized_variance, realized_vol,
         buy_volume, sell_volume, signed_volume, ofi
  FROM bars)
""" + select_rounded(BARS_STREAM_COLUMNS, _BARS_S_DOUBLES, "bars_s"))
def q_upsert_null_windows(spark, sf_dir):
    """Bars with NULL symbols and NULL windows, merged in three steps: all from half the
    trades, then the full ones of some symbols, then those of the rest. No row is lost."""
    tape = S.trades(spark, sf_dir)
    tape = (tape.withColumn("symbol", F.when(F.col("trade_id") % 31 != 5, F.col("symbol")))
            .withColumn("trade_time", F.when(F.col("trade_id") % 50 != 7, F.col("trade_time"))))
    clean, target = clean_trades(tape, WIDTH), scratch_path(spark, "silver-null")
    some = F.coalesce(F.col("symbol") != "ETHUSDT", F.lit(True))
    for trades in (clean.where("trade_id % 2 = 0"), clean.where(some), clean.where(~some)):
        U.upsert_minutes(spark, target, minute_bars_stream(trades, WIDTH))
    return U.read_silver(spark, target).select(*BARS_STREAM_COLUMNS)


# --- SRC10: messages with dead letters ----------------------------------------------------

# Every message of the tape by its id: some are broken, each in one way.
_MESSAGES_SQL = TAPE_TEXT.rstrip() + """,
texts AS (
  SELECT *, trade_id % 13 AS fault, to_json({'event_type': event_type, 'event_time': event_time,
           'symbol': CASE WHEN trade_id % 13 = 4 THEN '' ELSE symbol END, 'trade_id': trade_id,
           'price': CASE WHEN trade_id % 13 = 6 THEN 'abc' ELSE price END,
           'quantity': CASE WHEN trade_id % 13 = 7 THEN '' ELSE quantity END,
           'trade_time': trade_time, 'is_buyer_maker': is_buyer_maker = 'true'})::VARCHAR AS whole,
         to_json({'event_type': event_type, 'event_time': event_time, 'symbol': symbol, 'trade_id': trade_id,
           'price': price, 'quantity': quantity, 'is_buyer_maker': is_buyer_maker = 'true'})::VARCHAR AS timeless
  FROM tape_text)
"""


def _messages(spark, sf_dir):
    """The tape as UTF-8 JSON messages, seven in thirteen ids broken, each class in its way."""
    fault = F.col("trade_id") % 13
    tape = (S.trades(spark, sf_dir).withColumn("_fault", fault)
            .withColumn("symbol", F.when(fault == 4, F.lit("")).otherwise(F.col("symbol")))
            .withColumn("trade_time", F.when(fault != 5, F.col("trade_time")))
            .withColumn("price", F.when(fault == 6, F.lit("abc")).otherwise(F.col("price")))
            .withColumn("quantity", F.when(fault == 7, F.lit("")).otherwise(F.col("quantity"))))
    text = F.to_json(F.struct(*TRADE.fieldNames()))
    value = (F.when(fault == 1, F.lit("").cast("binary")).when(fault == 2, F.concat(F.unhex(F.lit("FF")), text.cast("binary")))
             .when(fault == 3, F.left(text, F.lit(20)).cast("binary")).otherwise(text.cast("binary")))
    return tape.select(value.alias("value"))


def _run_messages(spark, sf_dir):
    root = scratch_path(spark, "messages")
    _messages(spark, sf_dir).repartition(6).write.parquet(f"{root}/in")
    raw = spark.readStream.schema("value binary").option("maxFilesPerTrigger", 2).parquet(f"{root}/in")
    q = (raw.writeStream.foreachBatch(M.dead_letter_handler(f"{root}/trades", f"{root}/rejects"))
         .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return root


@register("message_stream_trades", _MESSAGES_SQL + "SELECT " + ", ".join(TRADE_TEXT_COLS) +
          " FROM texts WHERE fault NOT BETWEEN 1 AND 7")
def q_message_stream_trades(spark, sf_dir):
    """A stream of binary messages, judged batch by batch: the trades sink."""
    return spark.read.schema(TRADE).parquet(_run_messages(spark, sf_dir) + "/trades").select(*TRADE_TEXT_COLS)


@register("message_stream_rejects", _MESSAGES_SQL + """
SELECT ['empty', 'not_utf8', 'malformed', 'no_symbol', 'no_time', 'bad_price', 'bad_quantity'][fault] AS reason,
       CASE fault WHEN 1 THEN '' WHEN 2 THEN 'FF' || hex(encode(whole)) WHEN 3 THEN hex(encode(left(whole, 20)))
                  WHEN 5 THEN hex(encode(timeless)) ELSE hex(encode(whole)) END AS bytes
FROM texts WHERE fault BETWEEN 1 AND 7""")
def q_message_stream_rejects(spark, sf_dir):
    """The dead letters of the same stream: each rejected message with its reason."""
    rejects = spark.read.schema("reason string, value binary").parquet(_run_messages(spark, sf_dir) + "/rejects")
    return rejects.select("reason", F.hex("value").alias("bytes"))


# --- MD4-MD9: models kept up to date ------------------------------------------------------

def _split_bars(spark, sf_dir):
    """Clean trades, bars of the trades before a cut that splits a window, and (lazily) all bars
    of the windows that later trades touch."""
    clean = clean_trades(S.trades(spark, sf_dir), WIDTH)
    cut = ntz_literal(_max_ts(clean) - timedelta(days=1, minutes=30))
    late = U.touched_minutes(clean.where(F.col("ts") >= cut))
    return (clean, minute_bars(clean.where(F.col("ts") < cut), WIDTH),
            minute_bars(clean.join(late, ["symbol", "minute"], "left_semi"), WIDTH))


@register("regime_mart_incremental", REGIME_SQL + select_rounded(R.REGIME_COLUMNS, REGIME_DOUBLES, "classified"))
def q_regime_mart_incremental(spark, sf_dir):
    """The mart of the early fact, brought up to date after the later windows are upserted
    into it: equal to a rebuild, read from the affected days."""
    root = scratch_path(spark, "mart")
    fact, mart, counts = (VersionedTable(spark, f"{root}/{n}") for n in ("fact", "mart", "counts"))
    _, early, late = _split_bars(spark, sf_dir)
    fact.replace(I.with_day(G.fct_market_window(G.stg_trades_minute(early))))
    I.update_regime_mart(fact, mart, counts)
    upserts = I.with_day(G.fct_market_window(G.stg_trades_minute(late))).persist()
    fact.merge(upserts, I.MART_KEYS)
    I.update_regime_mart(fact, mart, counts, upserts)
    upserts.unpersist()
    return mart.read().select(*R.REGIME_COLUMNS)


@register("gold_models", REGIME_SQL + select_rounded(R.REGIME_COLUMNS, REGIME_DOUBLES, "classified"))
def q_gold_models(spark, sf_dir):
    """The star schema as versioned models: built from early silver, then rebuilt where the
    complete batch silver changes them; returns the regime mart, the last of the chain."""
    root = scratch_path(spark, "models")
    clean, early, _ = _split_bars(spark, sf_dir)
    sources = {n: VersionedTable(spark, f"{root}/{n}", None) for n in ("silver", "silver_stream", "metadata")}
    sources["silver"].replace(early)
    sources["silver_stream"].replace(as_stream_shape(early, WIDTH))
    sources["metadata"].replace(S.metadata(spark, sf_dir))
    build_models(spark, f"{root}/gold", sources)
    sources["silver"].replace(minute_bars(clean, WIDTH))
    build_models(spark, f"{root}/gold", sources)
    return read_models(spark, f"{root}/gold", ["fct_ofi_return_by_regime"])["fct_ofi_return_by_regime"]
