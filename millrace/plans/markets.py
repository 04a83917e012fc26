"""Indicators, signals and quality gates over event series; a user stands for a symbol."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import money, to_zone
from millrace.operators import aggregates as agg
from millrace.operators import quality, series
from millrace.plans.registry import query, rounded, table
from millrace.session import scratch
from millrace.sources.payloads import parse_trades
from millrace.streaming import ingest, stateful, ticks

ORDER = ["timestamp", "event_id"]


def tick_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("symbol"), F.col("ts").alias("timestamp"), "event_id",
        money("value").alias("price"),
        F.get_json_object("props", "$.k").cast("long").alias("volume"), "event_type")


def sparse_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors carry no price and signups no volume."""
    return tick_rows(spark, sf_dir).withColumns({
        "price": F.when(F.col("event_type") != "error", F.col("price")),
        "volume": F.when(F.col("event_type") != "signup", F.col("volume"))})


TICKS = r"""(SELECT user_id AS symbol, ts AS timestamp, event_id, value AS price,
    regexp_extract(props, '(\d+)', 1)::BIGINT AS volume, event_type FROM events)"""
SPARSE = f"""(SELECT symbol, timestamp, event_id,
    CASE WHEN event_type <> 'error' THEN price END AS price,
    CASE WHEN event_type <> 'signup' THEN volume END AS volume, event_type FROM {TICKS} t)"""


@query("stock_indicators", f"""
    WITH RECURSIVE s AS (
        SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY timestamp, event_id) AS rn,
               price / lag(price) OVER (PARTITION BY symbol ORDER BY timestamp, event_id) - 1
                 AS daily_return
        FROM {TICKS} t),
    e AS (
        SELECT symbol, rn, price AS y FROM s WHERE rn = 1
        UNION ALL
        SELECT s.symbol, s.rn, e.y * (19::DOUBLE / 21) + s.price * (2::DOUBLE / 21)
        FROM e JOIN s ON s.symbol = e.symbol AND s.rn = e.rn + 1)
    SELECT s.symbol, timestamp, event_id, price AS close,
           CASE WHEN count(price) OVER w = 20 THEN avg(price) OVER w END
             ::DECIMAL(30,6)::DOUBLE AS sma_20,
           y::DECIMAL(30,6)::DOUBLE AS ema_20, daily_return,
           (CASE WHEN count(daily_return) OVER w = 20 THEN stddev_samp(daily_return) OVER w END)
             ::DECIMAL(30,6)::DOUBLE AS volatility
    FROM s JOIN e ON s.symbol = e.symbol AND s.rn = e.rn
    WINDOW w AS (PARTITION BY s.symbol ORDER BY s.rn ROWS 19 PRECEDING)
""")
def stock_indicators(spark, sf_dir):
    closes = tick_rows(spark, sf_dir).select("symbol", "timestamp", "event_id",
                                             F.col("price").alias("close"))
    return rounded(series.stock_indicators(closes, order=ORDER), "sma_20", "ema_20", "volatility")


TICK_SQL = f"""
    WITH s AS (
        SELECT *, price / lag(price) OVER p - 1 AS price_momentum,
               sum(price::DECIMAL(18,2) * volume) OVER r AS pv, sum(volume) OVER r AS v,
               CASE WHEN count(volume) OVER f = 5 THEN avg(volume) OVER f END AS volume_ma
        FROM {TICKS} t
        WINDOW p AS (PARTITION BY symbol ORDER BY timestamp, event_id),
               r AS (PARTITION BY symbol ORDER BY timestamp, event_id
                     ROWS UNBOUNDED PRECEDING),
               f AS (PARTITION BY symbol ORDER BY timestamp, event_id ROWS 4 PRECEDING))
    SELECT symbol, timestamp, event_id, price, volume, price_momentum, volume_ma,
           CASE WHEN count(price_momentum) OVER t = 10
                THEN stddev_samp(price_momentum) OVER t END AS volatility,
           volume / nullif(volume_ma, 0) AS volume_trend,
           pv::DOUBLE / nullif(v, 0)::DOUBLE AS vwap
    FROM s WINDOW t AS (PARTITION BY symbol ORDER BY timestamp, event_id ROWS 9 PRECEDING)
"""


def _indicators(spark, sf_dir):
    return series.tick_indicators(tick_rows(spark, sf_dir).drop("event_type"), order=ORDER)


@query("tick_indicators", f"""
    SELECT * REPLACE (volatility::DECIMAL(30,6)::DOUBLE AS volatility) FROM ({TICK_SQL}) i
""")
def tick_indicators(spark, sf_dir):
    return rounded(_indicators(spark, sf_dir), "volatility")


@query("market_signals", f"""
    WITH i AS ({TICK_SQL}),
    l AS (SELECT symbol, avg(volatility) + stddev_samp(volatility) AS bound FROM i GROUP BY 1),
    n AS (SELECT * FROM i
          QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY timestamp DESC, event_id DESC)
                  = 1)
    SELECT symbol, timestamp, 'VOLUME_SPIKE' AS type, 'HIGH' AS strength, volume_trend AS value
    FROM n WHERE volume_trend > 2
    UNION ALL
    SELECT n.symbol, timestamp, 'HIGH_VOLATILITY', 'MEDIUM', volatility::DECIMAL(30,6)::DOUBLE
    FROM n JOIN l ON n.symbol = l.symbol WHERE volatility > bound
    UNION ALL
    SELECT symbol, timestamp,
           CASE WHEN price_momentum > 0 THEN 'MOMENTUM_BULLISH' ELSE 'MOMENTUM_BEARISH' END,
           'HIGH', price_momentum
    FROM n WHERE abs(price_momentum) > 0.02
""")
def market_signals(spark, sf_dir):
    found = series.market_signals(_indicators(spark, sf_dir), order=ORDER)
    flat = found.select("symbol", "timestamp", F.inline("signals"))
    steady = F.col("value").cast("decimal(30,6)").cast("double")
    return flat.withColumn(
        "value", F.when(F.col("type") == "HIGH_VOLATILITY", steady).otherwise(F.col("value")))


@query("fill_directional", f"""
    SELECT symbol, timestamp, event_id, event_type,
           coalesce(last_value(price IGNORE NULLS) OVER b, first_value(price IGNORE NULLS) OVER a)
             AS price,
           coalesce(last_value(volume IGNORE NULLS) OVER b,
                    first_value(volume IGNORE NULLS) OVER a) AS volume
    FROM {SPARSE} s
    WINDOW b AS (PARTITION BY symbol ORDER BY timestamp, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           a AS (PARTITION BY symbol ORDER BY timestamp, event_id
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
""")
def fill_directional(spark, sf_dir):
    return series.ffill_bfill(sparse_rows(spark, sf_dir), ["price", "volume"], keys=["symbol"],
                              order=ORDER)


METRICS = f"""(SELECT symbol, count(*) AS rows,
    (count(*) - count(price) + count(*) - count(volume))::BIGINT AS missing_values,
    count(*) FILTER (WHERE volume > 0) AS trading_days FROM {SPARSE} s GROUP BY 1)"""
SCORES = f"""(SELECT m.*, 1 - missing_values::DOUBLE / (rows * 6) AS quality_score,
    1 - missing_values::DOUBLE / (rows * 6) >= 0.93::DOUBLE AS passed FROM {METRICS} m)"""
_COLS = ["symbol", "timestamp", "event_id", "event_type", "price", "volume"]


@query("row_metrics", f"SELECT * FROM {METRICS} m")
def row_metrics(spark, sf_dir):
    return quality.row_metrics(sparse_rows(spark, sf_dir), "symbol", _COLS)


@query("completeness_gate", f"""
    SELECT s.* FROM {SPARSE} s JOIN {SCORES} g ON s.symbol = g.symbol WHERE passed
""")
def completeness_gate(spark, sf_dir):
    good, _ = quality.quality_gate(sparse_rows(spark, sf_dir), "symbol", _COLS, 0.93)
    return good


@query("completeness_flagged", f"SELECT * FROM {SCORES} g WHERE NOT passed")
def completeness_flagged(spark, sf_dir):
    _, flagged = quality.quality_gate(sparse_rows(spark, sf_dir), "symbol", _COLS, 0.93)
    return flagged


@query("latest_price", f"""
    SELECT symbol, arg_max(price, (timestamp, event_id)) AS price FROM {TICKS} t GROUP BY 1
""")
def latest_price(spark, sf_dir):
    return agg.latest_value(tick_rows(spark, sf_dir), "symbol", ORDER, "price")


@query("localize_timezone", """
    SELECT event_id, ts - INTERVAL 5 HOUR AS local_time FROM events
""")
def localize_timezone(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", to_zone("ts").alias("local_time"))


@query("sort_by_time", "SELECT event_id, ts FROM events")
def sort_by_time(spark, sf_dir):
    return series.sort_events(table(spark, sf_dir, "events").select("event_id", "ts"),
                              ["ts", "event_id"])


# -- messages and streams ---------------------------------------------------------------------

def trade_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases as trade messages; every other event is a message of another kind."""
    rows = tick_rows(spark, sf_dir)
    kind = F.when(F.col("event_type") == "purchase", "trade").otherwise(F.col("event_type"))
    return rows.select("event_id", F.to_json(F.struct(
        kind.alias("e"), F.concat(F.lit("SYM"), "symbol").alias("s"),
        F.col("price").cast("string").alias("p"), F.col("volume").cast("string").alias("q"),
        F.unix_millis(F.col("timestamp").cast("timestamp")).alias("T"),
    )).alias("value"))


@query("trade_message_parse", f"""
    SELECT 'sym' || symbol AS symbol, price, volume::DOUBLE AS volume,
           date_trunc('millisecond', timestamp) AS timestamp, event_id
    FROM {TICKS} t WHERE event_type = 'purchase'
""")
def trade_message_parse(spark, sf_dir):
    return parse_trades(trade_messages(spark, sf_dir)).withColumn(
        "timestamp", F.col("timestamp").cast("timestamp_ntz"))


def _tick_stream(spark: SparkSession, sf_dir: str, order: str | None = None,
                 untimed: int = 0) -> DataFrame:
    """The events as a stream of several files; a watermark needs a timestamp with time zone. One
    event in `untimed` has no time."""
    rows = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp").alias("timestamp"),
        "event_id", F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("volume"))
    if untimed:
        rows = rows.withColumn("timestamp", F.when(F.col("event_id") % untimed != 0, F.col("timestamp")))
    return ingest.land_in_batches(rows, scratch(spark, "ticks"), order=order)


@query("stream_tick_windows", f"""
    SELECT event_type AS symbol, time_bucket(INTERVAL 1 HOUR, timestamp) AS window_start,
           time_bucket(INTERVAL 1 HOUR, timestamp) + INTERVAL 1 HOUR AS window_end,
           count(*) AS points, min(price) AS low, max(price) AS high,
           sum(volume)::DOUBLE AS volume, count(*) >= 5 AS sufficient
    FROM {TICKS} t GROUP BY 1, 2, 3
""")
def stream_tick_windows(spark, sf_dir):
    """Hourly windows over batches of mixed times."""
    path = scratch(spark, "windows")
    ingest.run_available(ticks.window_table(_tick_stream(spark, sf_dir), path,
                                            scratch(spark, "checkpoint"), 3600))
    return ticks.read_windows(spark, path, 5).withColumns({
        c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


def _vwap_sql(time: str) -> str:
    return f"""
    SELECT event_type AS symbol, event_id, price, volume::DOUBLE AS volume,
           ((sum(price::DECIMAL(18,2) * volume) OVER w)::DOUBLE
             / nullif((sum(volume) OVER w)::DOUBLE, 0))::DECIMAL(30,6)::DOUBLE AS vwap
    FROM {TICKS} t WINDOW w AS (
        PARTITION BY event_type ORDER BY {time} NULLS FIRST, event_id ROWS UNBOUNDED PRECEDING)
"""


def _run_vwap(spark: SparkSession, sf_dir: str, untimed: int = 0) -> DataFrame:
    path = scratch(spark, "vwap")
    ingest.run_available(ticks.stream_vwap(_tick_stream(spark, sf_dir, "timestamp", untimed), path,
                                           scratch(spark, "checkpoint"), order=ORDER))
    return rounded(spark.read.parquet(f"{path}/rows").drop("batch_id", "timestamp"), "vwap")


@query("stream_vwap", _vwap_sql("timestamp"))
def stream_vwap(spark, sf_dir):
    return _run_vwap(spark, sf_dir)


@query("stream_vwap_untimed", _vwap_sql("CASE WHEN event_id % 13 <> 0 THEN timestamp END"))
def stream_vwap_untimed(spark, sf_dir):
    """Ticks without a time count, before all others."""
    return _run_vwap(spark, sf_dir, 13)


# Ticks as they may arrive: by stretches of eight days, every tenth one in the last go, and every
# thirteenth without a time.
GOES, DELAY = 4, 24
ARRIVALS = f"""(SELECT event_type AS symbol, price, volume,
    CASE WHEN event_id % 13 <> 0 THEN timestamp END AS timestamp,
    CASE WHEN event_id % 10 = 0 THEN {GOES - 1}
         ELSE coalesce(least((day(timestamp) - 1) // 8, {GOES - 1}), 0) END AS go FROM {TICKS} t)"""


def _arrive(spark: SparkSession, sf_dir: str, writer) -> None:
    rows = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"),
        F.when(F.col("event_id") % 13 != 0, F.col("ts").cast("timestamp")).alias("timestamp"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("volume"),
        F.when(F.col("event_id") % 10 == 0, GOES - 1).otherwise(F.least(
            F.floor((F.day("ts") - 1) / 8), F.lit(GOES - 1))).cast("int").alias("go"))
    ingest.run_goes(rows, F.col("go"), GOES, scratch(spark, "ticks"), writer)


@query("stream_vwap_state", f"""
    SELECT symbol, b.go, count(*) AS points, sum(volume)::DOUBLE AS volume,
           (sum(price::DECIMAL(18,2) * volume)::DOUBLE / nullif(sum(volume), 0)::DOUBLE)
             ::DECIMAL(30,6)::DOUBLE AS vwap
    FROM {ARRIVALS} t JOIN (SELECT unnest(range({GOES})) AS go) b ON t.go <= b.go
    GROUP BY 1, 2
""")
def stream_vwap_state(spark, sf_dir):
    """VWAP per symbol after every batch, from value state."""
    path, mark = scratch(spark, "totals"), scratch(spark, "checkpoint")
    _arrive(spark, sf_dir, lambda rows: stateful.vwap_totals(rows, path, mark))
    found = [stateful.read_vwap(spark, path, go).withColumn("go", F.lit(go).cast("long"))
             for go in range(GOES)]
    return rounded(reduce(DataFrame.unionByName, found), "vwap")


#: The watermark a go meets is the latest time of the goes before it, less the delay.
ARRIVED = f"""(
    SELECT t.*, time_bucket(INTERVAL 1 HOUR, timestamp) + INTERVAL 1 HOUR AS window_end,
           (SELECT max(epoch_ms(p.timestamp)) - {DELAY} * 3600000 FROM {ARRIVALS} p
            WHERE p.go < t.go) AS mark,
           (SELECT max(epoch_ms(p.timestamp)) - {DELAY} * 3600000 FROM {ARRIVALS} p) AS last_mark
    FROM {ARRIVALS} t)"""
_WINDOW = """symbol, window_end - INTERVAL 1 HOUR AS window_start, window_end, count(*) AS points,
    min(price) AS low, max(price) AS high, sum(volume)::DOUBLE AS volume,
    count(*) >= 5 AS sufficient"""


def _timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, mark = scratch(spark, "windows"), scratch(spark, "checkpoint")
    _arrive(spark, sf_dir, lambda rows: stateful.timed_windows(
        rows, path, mark, 3600, delay=f"{DELAY} hours"))
    return stateful.read_timed_windows(spark, path, 3600).withColumns({
        c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query("stream_windows_closed", f"""
    SELECT {_WINDOW} FROM {ARRIVED} t
    WHERE epoch_ms(window_end) < last_mark
      AND (mark IS NULL OR epoch_ms(window_end) >= mark) GROUP BY symbol, window_end
""")
def stream_windows_closed(spark, sf_dir):
    """Hourly windows given out by timers, without the ticks that came too late."""
    return _timed(spark, sf_dir).where("kind = 'closed'").drop("kind")


@query("stream_ticks_aside", f"""
    SELECT CASE WHEN timestamp IS NULL THEN 'untimed' ELSE 'late' END AS kind, {_WINDOW}
    FROM {ARRIVED} t WHERE timestamp IS NULL OR epoch_ms(window_end) < mark
    GROUP BY kind, symbol, window_end
""")
def stream_ticks_aside(spark, sf_dir):
    """What came after its window was closed, per window, and what has no time."""
    return _timed(spark, sf_dir).where("kind <> 'closed'")
