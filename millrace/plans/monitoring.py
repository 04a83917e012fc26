"""Profiles, drift and metric alerts over the event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import flatten_struct, numerics_to_double
from millrace.operators import alerts, quality, series
from millrace.operators.alerts import Rule
from millrace.plans.markets import ORDER, SPARSE, sparse_rows, tick_rows
from millrace.plans.registry import query, rounded, table
from millrace.session import scratch
from millrace.streaming import alerting, ingest

SPLIT = "2024-01-16"
HOUR = 3600


# -- profile ----------------------------------------------------------------------------------

@query("missing_values", f"""
    WITH c AS (SELECT count(*) AS n, count(*) - count(price) AS p, count(*) - count(volume) AS v
               FROM {SPARSE} s),
    r AS (SELECT 'price' AS "column", p AS missing, n AS cells FROM c
          UNION ALL SELECT 'volume', v, n FROM c UNION ALL SELECT 'event_id', 0, n FROM c
          UNION ALL SELECT '*', p + v, n * 3 FROM c)
    SELECT "column", missing, cells, missing::DOUBLE / cells AS missing_ratio FROM r
""")
def missing_values(spark, sf_dir):
    return quality.missing_report(sparse_rows(spark, sf_dir), ["price", "volume", "event_id"])


@query("missing_values_nan", f"""
    SELECT 'reading' AS "column", count(*) FILTER (WHERE event_id % 3 = 0 OR value IS NULL) AS missing,
           count(*) AS cells,
           (count(*) FILTER (WHERE event_id % 3 = 0 OR value IS NULL))::DOUBLE / count(*)
             AS missing_ratio FROM events
    UNION ALL SELECT '*', count(*) FILTER (WHERE event_id % 3 = 0 OR value IS NULL), count(*),
           (count(*) FILTER (WHERE event_id % 3 = 0 OR value IS NULL))::DOUBLE / count(*) FROM events
""")
def missing_values_nan(spark, sf_dir):
    """Every third reading is NaN, which counts as missing."""
    reading = F.when(F.col("event_id") % 3 == 0, F.lit(float("nan"))).otherwise(
        F.col("value").cast("double"))
    return quality.missing_report(
        table(spark, sf_dir, "events").select(reading.alias("reading")), ["reading"])


@query("column_profile", f"""
    WITH f AS (
        SELECT symbol, price AS raw_p, volume AS raw_v,
               coalesce(last_value(price IGNORE NULLS) OVER b,
                        first_value(price IGNORE NULLS) OVER a) AS p,
               coalesce(last_value(volume IGNORE NULLS) OVER b,
                        first_value(volume IGNORE NULLS) OVER a) AS v
        FROM {SPARSE} s
        WINDOW b AS (PARTITION BY symbol ORDER BY timestamp, event_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
               a AS (PARTITION BY symbol ORDER BY timestamp, event_id
                     ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT symbol, 'price' AS "column", sum(p::DECIMAL(18,2))::DOUBLE / count(p) AS mean,
           stddev_samp(p)::DECIMAL(30,6)::DOUBLE AS std,
           (count(*) - count(raw_p))::DOUBLE / count(*) AS missing_ratio FROM f GROUP BY 1
    UNION ALL
    SELECT symbol, 'volume', sum(v)::DOUBLE / count(v), stddev_samp(v)::DECIMAL(30,6)::DOUBLE,
           (count(*) - count(raw_v))::DOUBLE / count(*) FROM f GROUP BY 1
""")
def column_profile(spark, sf_dir):
    found = quality.profile(sparse_rows(spark, sf_dir), ["price", "volume"], keys=["symbol"],
                            order=ORDER)
    return rounded(found, "std")


@query("reference_slice", """
    SELECT event_id, user_id, ts, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) <= 3
""")
def reference_slice(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    return series.first_n(rows, ["user_id"], ["ts", "event_id"], 3)


@query("flatten_columns", """
    SELECT event_id::DOUBLE AS event_id, user_id::DOUBLE AS who_user_id, event_type AS what_type,
           value AS what_value FROM events
""")
def flatten_columns(spark, sf_dir):
    nested = table(spark, sf_dir, "events").select(
        "event_id", F.struct("user_id").alias("who"),
        F.struct(F.col("event_type").alias("type"), "value").alias("what"))
    return numerics_to_double(flatten_struct(nested))


# -- drift ------------------------------------------------------------------------------------

def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = tick_rows(spark, sf_dir).select(
        "symbol", "timestamp", "price", "volume", (F.hour("timestamp") * F.col("volume")).alias("load"))
    early = F.col("timestamp") < F.lit(SPLIT).cast("timestamp_ntz")
    late_load = rows.where(~early).withColumn("load", F.col("load") + 200)
    return rows.where(early), late_load


def _drift_sql(test: str, by: str = "") -> str:
    """`by` is a column of events that the drift is told apart by."""
    keep, key = (f"{by} AS symbol, ", "symbol, ") if by else ("", "")
    same = "g.symbol = t.symbol AND g.c = t.c" if by else "g.c = t.c"
    g_key = "g.symbol, " if by else ""
    score, drifted = ("pv", "pv < 0.05") if test == "ks" else ("ws", "ws >= 0.1")
    return rf"""
    WITH k AS (SELECT {keep}ts, value, regexp_extract(props, '(\d+)', 1)::BIGINT AS k FROM events),
    l AS (SELECT {key}'price' AS c, value AS v, ts < DATE '{SPLIT}' AS r FROM k
          UNION ALL SELECT {key}'volume', k::DOUBLE, ts < DATE '{SPLIT}' FROM k
          UNION ALL SELECT {key}'load', (hour(ts) * k + CASE WHEN ts < DATE '{SPLIT}' THEN 0
                                         ELSE 200 END)::DOUBLE, ts < DATE '{SPLIT}' FROM k),
    t AS (SELECT {key}c, count(*) FILTER (WHERE r) AS nr, count(*) FILTER (WHERE NOT r) AS nc,
                 stddev_pop(v) FILTER (WHERE r) AS sd FROM l GROUP BY ALL
          HAVING nr >= 2 AND nc >= 2),
    g AS (SELECT {key}c, v, count(*) FILTER (WHERE r) AS a, count(*) FILTER (WHERE NOT r) AS b
          FROM l GROUP BY ALL),
    w AS (SELECT {g_key}g.c, v, nr, nc, sd,
                 abs(sum(a) OVER o / nr::DOUBLE - sum(b) OVER o / nc::DOUBLE) AS d
          FROM g JOIN t ON {same}
          WINDOW o AS (PARTITION BY {g_key}g.c ORDER BY v ROWS UNBOUNDED PRECEDING)),
    x AS (SELECT *, lag(d) OVER (PARTITION BY {key}c ORDER BY v)
                    * (v - lag(v) OVER (PARTITION BY {key}c ORDER BY v)) AS area FROM w),
    m AS (SELECT {key}c, any_value(nr) AS nr, any_value(nc) AS nc, max(d) AS ks,
                 coalesce(sum(area), 0) / greatest(any_value(sd), 0.001::DOUBLE) AS ws
          FROM x GROUP BY {key}c),
    n AS (SELECT *, sqrt(nr * nc / (nr + nc)::DOUBLE) AS root FROM m),
    q AS (SELECT *, (root + 0.12::DOUBLE + 0.11::DOUBLE / root) * ks AS lam FROM n),
    p AS (SELECT *, CASE WHEN lam < 0.04::DOUBLE THEN 1 ELSE least(1, greatest(0,
              (SELECT sum((CASE WHEN i % 2 = 1 THEN 2::DOUBLE ELSE -2::DOUBLE END)
                          * exp(-2::DOUBLE * i * i * lam * lam)) FROM range(1, 101) terms(i)))) END
              AS pv FROM q)
    SELECT {key}c AS "column", nr AS n_ref, nc AS n_cur, ks AS ks_statistic,
           pv::DECIMAL(30,6)::DOUBLE AS p_value, ws::DECIMAL(30,6)::DOUBLE AS wasserstein,
           '{test}' AS test, {drifted} AS drifted,
           (CASE WHEN {drifted} THEN {score} END)::DECIMAL(30,6)::DOUBLE AS drift_score
    FROM p
    """


def _drift(spark, sf_dir, test, by=None):
    reference, current = _halves(spark, sf_dir)
    found = quality.column_drift(reference, current, ["price", "volume", "load"], by=by,
                                 test=test)
    return rounded(found, "p_value", "wasserstein", "drift_score")


@query("column_drift", _drift_sql("wasserstein"))
def column_drift(spark, sf_dir):
    return _drift(spark, sf_dir, "wasserstein")


@query("column_drift_ks", _drift_sql("ks"))
def column_drift_ks(spark, sf_dir):
    return _drift(spark, sf_dir, "ks")


@query("column_drift_by_symbol", _drift_sql("ks", "user_id"))
def column_drift_by_symbol(spark, sf_dir):
    return _drift(spark, sf_dir, "ks", ["symbol"])


@query("dataset_drift_by_symbol", f"""
    SELECT symbol, count(*) AS "columns", count(*) FILTER (WHERE drifted) AS drifted_columns,
           (count(*) FILTER (WHERE drifted))::DOUBLE / count(*) AS drift_share,
           (count(*) FILTER (WHERE drifted))::DOUBLE / count(*) >= 0.5 AS dataset_drift
    FROM ({_drift_sql("ks", "user_id")}) d GROUP BY 1
""")
def dataset_drift_by_symbol(spark, sf_dir):
    return quality.dataset_drift(column_drift_by_symbol(spark, sf_dir), by=["symbol"])


@query("dataset_drift", f"""
    SELECT count(*) AS "columns", count(*) FILTER (WHERE drifted) AS drifted_columns,
           (count(*) FILTER (WHERE drifted))::DOUBLE / count(*) AS drift_share,
           (count(*) FILTER (WHERE drifted))::DOUBLE / count(*) >= 0.5 AS dataset_drift
    FROM ({_drift_sql("wasserstein")}) d
""")
def dataset_drift(spark, sf_dir):
    return quality.dataset_drift(column_drift(spark, sf_dir))


# -- metric samples ---------------------------------------------------------------------------

# Event types stand for the monitored metrics.
METRICS = {"error": "stock_data_fetch_errors_total", "click": "data_drift_detected_total",
           "view": "stock_data_processing_seconds", "purchase": "stock_current_price",
           "signup": "missing_values_ratio"}
BOUNDS = [5.0, 10.0, 25.0, 50.0, 75.0]
# The events are minutes apart, so ranges and holds are hours instead of minutes.
RULES = [
    Rule("HighErrorRate", "stock_data_fetch_errors_total", "rate", 6 * HOUR, 0.02, "critical",
         2 * HOUR),
    Rule("HighErrorRate", "stock_data_fetch_errors_total", "rate", 6 * HOUR, 0.01, "warning",
         2 * HOUR),
    Rule("DataDriftDetected", "data_drift_detected_total", "rate", 9 * HOUR, 0.0, "warning",
         2 * HOUR),
    Rule("SlowProcessing", "stock_data_processing_seconds", "p95", 6 * HOUR, 70.0, "warning",
         2 * HOUR),
    Rule("StockPriceChange", "stock_current_price", "delta", 6 * HOUR, 20.0, "warning", 2 * HOUR),
]


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sample per event: k is the counter, duration or price of the event's metric."""
    metric = F.lit(None).cast("string")
    for kind, name in METRICS.items():
        metric = F.when(F.col("event_type") == kind, F.lit(name)).otherwise(metric)
    return alerts.to_samples(tick_rows(spark, sf_dir), metric, ["event_type"], "volume",
                             "timestamp")


_NAMES = " ".join(f"WHEN '{kind}' THEN '{metric}'" for kind, metric in METRICS.items())
SAMPLES = rf"""(SELECT CASE event_type {_NAMES} END AS metric, 'event_type=' || event_type AS series,
    ts, regexp_extract(props, '(\d+)', 1)::DOUBLE AS value,
    ((epoch_us(ts) + 3599999999) // 3600000000 * 3600)::BIGINT AS evaluated_at FROM events)"""


STEPS = f"""(SELECT metric, series, evaluated_at, count(*) AS n, sum(x) AS x,
    arg_min(x, ts) AS first_x, arg_min(value, ts) AS f, arg_max(value, ts) AS l
    FROM (SELECT *, CASE WHEN p IS NULL THEN 0 WHEN value < p THEN value ELSE value - p END AS x
          FROM (SELECT *, lag(value) OVER (PARTITION BY metric, series ORDER BY ts) AS p
                FROM {SAMPLES} s))
    GROUP BY 1, 2, 3)"""


def _grid_sql(steps: str, hours: int) -> str:
    """Every step of a series from its first sample until the range no longer holds its last."""
    return f"""(SELECT g.metric, g.series, g.evaluated_at, s.* EXCLUDE (metric, series, evaluated_at)
    FROM (SELECT metric, series, unnest(range(min(evaluated_at),
              max(evaluated_at) + {hours * HOUR}, {HOUR})) AS evaluated_at
          FROM {steps} b GROUP BY 1, 2) g
    LEFT JOIN {steps} s ON s.metric = g.metric AND s.series = g.series
                       AND s.evaluated_at = g.evaluated_at)"""


def _over(hours: int) -> str:
    return f"""WINDOW w AS (PARTITION BY metric, series ORDER BY evaluated_at
        RANGE BETWEEN {(hours - 1) * HOUR} PRECEDING AND CURRENT ROW)"""


def _rate_sql(hours: int) -> str:
    return f"""(SELECT metric, series, evaluated_at, rate FROM (
    SELECT metric, series, evaluated_at, sum(n) OVER w AS n, (sum(x) OVER w
               - first_value(first_x IGNORE NULLS) OVER w) / {hours * HOUR}::DOUBLE AS rate
    FROM {_grid_sql(STEPS, hours)} i {_over(hours)}) WHERE n >= 2)"""


DELTA_SQL = f"""(SELECT metric, series, evaluated_at, delta FROM (
    SELECT metric, series, evaluated_at, sum(n) OVER w AS n,
           last_value(l IGNORE NULLS) OVER w - first_value(f IGNORE NULLS) OVER w AS delta
    FROM {_grid_sql(STEPS, 6)} s {_over(6)}) WHERE n >= 2)"""
_COUNTS = ", ".join(f"count(*) FILTER (WHERE value <= {b}) AS c{i}"
                    for i, b in enumerate([*BOUNDS, 1e300]))
_SUMS = ", ".join(f"sum(c{i}) OVER w AS s{i}" for i in range(len(BOUNDS) + 1))


def _quantile_case(q: float) -> str:
    total = f"s{len(BOUNDS)}"
    cases, below, lower = [], "0", 0.0
    for i, bound in enumerate(BOUNDS):
        cases.append(f"WHEN s{i} >= {total} * {q}::DOUBLE THEN {lower}::DOUBLE + ({bound} - {lower})"
                     f"::DOUBLE * (({total} * {q}::DOUBLE - {below}) / (s{i} - {below})::DOUBLE)")
        below, lower = f"s{i}", bound
    return f"CASE WHEN coalesce({total}, 0) = 0 THEN NULL {' '.join(cases)} ELSE {BOUNDS[-1]}::DOUBLE END"


QUANTILE_SQL = f"""(
    WITH b AS (SELECT metric, series, evaluated_at, {_COUNTS} FROM {SAMPLES} s GROUP BY 1, 2, 3),
    r AS (SELECT metric, series, evaluated_at, {_SUMS} FROM {_grid_sql("b", 6)} g {_over(6)})
    SELECT metric, series, evaluated_at, {_quantile_case(0.95)} AS quantile FROM r)"""


@query("emit_metrics", f"SELECT metric, series, ts, value FROM {SAMPLES} s")
def emit_metrics(spark, sf_dir):
    return samples(spark, sf_dir).drop("labels")


@query("counter_rate", f"SELECT * FROM {_rate_sql(6)} r")
def counter_rate(spark, sf_dir):
    return alerts.counter_rate(samples(spark, sf_dir), 6 * HOUR, HOUR)


@query("gauge_delta", f"SELECT * FROM {DELTA_SQL} d")
def gauge_delta(spark, sf_dir):
    return alerts.gauge_delta(samples(spark, sf_dir), 6 * HOUR, HOUR)


@query("duration_histogram", rf"""
    WITH s AS (SELECT series, value FROM {SAMPLES} s)
    SELECT series, le, count(*) FILTER (WHERE value <= le)::DOUBLE AS value
    FROM s, (VALUES (5::DOUBLE), (10), (25), (50), (75), ('infinity'::DOUBLE)) b(le)
    GROUP BY 1, 2
""")
def duration_histogram(spark, sf_dir):
    return alerts.duration_histogram(samples(spark, sf_dir), "value", BOUNDS, keys=["series"])


@query("histogram_quantile", f"SELECT * FROM {QUANTILE_SQL} q")
def histogram_quantile(spark, sf_dir):
    return alerts.window_quantile(samples(spark, sf_dir), 0.95, BOUNDS, 6 * HOUR, HOUR)


def _held(source: str, condition: str, hold: int) -> str:
    return f"""(
    WITH c AS (SELECT *, coalesce({condition}, FALSE) AS is_on FROM {source} s),
    m AS (SELECT *, CASE WHEN is_on AND (lag(evaluated_at) OVER w IS NULL
                                      OR evaluated_at - lag(evaluated_at) OVER w > {HOUR}
                                      OR NOT lag(is_on) OVER w) THEN evaluated_at END AS start FROM c
          WINDOW w AS (PARTITION BY metric, series ORDER BY evaluated_at)),
    h AS (SELECT *, CASE WHEN is_on THEN evaluated_at - last_value(start IGNORE NULLS) OVER (
              PARTITION BY metric, series ORDER BY evaluated_at
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS active_seconds FROM m)
    SELECT * EXCLUDE (is_on, start), coalesce(active_seconds >= {hold}, FALSE) AS firing FROM h)"""


@query("alert_for", f"SELECT * FROM {_held(_rate_sql(6), 'rate > 0.01', 2 * HOUR)} a")
def alert_for(spark, sf_dir):
    rates = alerts.counter_rate(samples(spark, sf_dir), 6 * HOUR, HOUR)
    return alerts.alert_for(rates, F.col("rate") > 0.01, 2 * HOUR, gap=HOUR)


def _rule_sql(rule: Rule) -> str:
    if rule.measure == "rate":
        source, reading = _rate_sql(rule.seconds // HOUR), "rate"
    elif rule.measure == "delta":
        source, reading = DELTA_SQL, "abs(delta)"
    else:
        source, reading = QUANTILE_SQL, "quantile"
    held = _held(source, f"{reading} > {rule.limit}::DOUBLE", rule.hold)
    return f"""SELECT '{rule.name}' AS alertname, '{rule.severity}' AS severity, metric, series,
        evaluated_at, {reading} AS reading, firing FROM {held} x WHERE metric = '{rule.metric}'"""


ALERTS = "(" + " UNION ALL ".join(_rule_sql(r) for r in RULES) + ")"


def _alerts(spark, sf_dir):
    return alerts.evaluate_alerts(samples(spark, sf_dir), RULES, bounds=BOUNDS, step=HOUR)


@query("alert_rules", f"SELECT * FROM {ALERTS} a")
def alert_rules(spark, sf_dir):
    return _alerts(spark, sf_dir)


@query("stream_alerts", f"SELECT * FROM {ALERTS} a")
def stream_alerts(spark, sf_dir):
    """The rules over the samples in four batches, states carried from one to the next."""
    path, rows = scratch(spark, "alerts"), samples(spark, sf_dir)
    stream = ingest.land_in_batches(rows, scratch(spark, "samples"), order="ts")
    ingest.run_available(alerting.stream_alerts(
        stream, path, scratch(spark, "checkpoint"), RULES, bounds=BOUNDS, step=HOUR))
    alerting.close_alerts(spark, path, RULES, bounds=BOUNDS, step=HOUR)
    return alerting.read_alerts(spark, path).drop("since", "state")


@query("alert_group", f"""
    WITH f AS (SELECT DISTINCT alertname, metric, series, evaluated_at FROM {ALERTS} a WHERE firing),
    t AS (SELECT alertname, evaluated_at, CASE WHEN lag(evaluated_at) OVER o IS NULL
                 OR evaluated_at - lag(evaluated_at) OVER o > {HOUR} THEN evaluated_at END AS start
          FROM (SELECT DISTINCT alertname, evaluated_at FROM f)
          WINDOW o AS (PARTITION BY alertname ORDER BY evaluated_at)),
    r AS (SELECT alertname, evaluated_at, last_value(start IGNORE NULLS) OVER (
              PARTITION BY alertname ORDER BY evaluated_at) AS started FROM t)
    SELECT alertname, started, min(evaluated_at) AS sent_at,
           count(DISTINCT metric || series) AS firing_series
    FROM r JOIN f USING (alertname, evaluated_at)
    GROUP BY alertname, started, (evaluated_at - started) // {4 * HOUR}
""")
def alert_group(spark, sf_dir):
    return alerts.group_alerts(_alerts(spark, sf_dir), 4 * HOUR, step=HOUR)


@query("alert_inhibit", f"""
    WITH f AS (SELECT * FROM {ALERTS} a WHERE firing)
    SELECT * FROM f WHERE severity <> 'warning' OR NOT EXISTS (
        SELECT 1 FROM f c WHERE c.severity = 'critical' AND c.alertname = f.alertname
                           AND c.evaluated_at = f.evaluated_at)
""")
def alert_inhibit(spark, sf_dir):
    return alerts.inhibit(_alerts(spark, sf_dir))


@query("threshold_panel", f"""
    SELECT metric, sum(value) / count(*) AS mean_value, max(value) AS max_value,
           sum(value) AS sum_value,
           CASE metric WHEN 'missing_values_ratio' THEN max(value) > 0.1
                WHEN 'stock_data_processing_seconds' THEN max(value) > 5 END AS above_limit
    FROM {SAMPLES} s GROUP BY 1
""")
def threshold_panel(spark, sf_dir):
    limits = {"missing_values_ratio": 0.1, "stock_data_processing_seconds": 5}
    return alerts.threshold_panel(samples(spark, sf_dir), limits)


@query("series_legend", f"""
    SELECT series, sum(value) / count(*) AS mean_value, max(value) AS max_value,
           min(value) AS min_value FROM {SAMPLES} s GROUP BY 1
""")
def series_legend(spark, sf_dir):
    return alerts.series_legend(samples(spark, sf_dir), ["series"])
