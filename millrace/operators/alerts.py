"""Alerting over metric samples (metric, labels, ts, value).

Rules are evaluated on a grid of `step` seconds, at every step while a range still holds a sample of
the series. Samples are summed up per series and step before any window, so a window holds one row
per step of a series, however dense or sparse the samples.
A series is (metric, series), where `series` is the label text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from millrace.operators.ordered import over_series
from millrace.session import materialize

STEP = 15
_SERIES = ["metric", "series"]


def to_samples(df: DataFrame, metric: str | Column, labels: list[str], value: str,
               ts: str) -> DataFrame:
    """Rows as labelled samples of one metric, or of the metric a column names."""
    pairs = [x for c in labels for x in (F.lit(c), F.col(c).cast("string"))]
    tags = F.create_map(*pairs) if pairs else F.expr("map()").cast("map<string,string>")
    text = F.concat_ws(",", *[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in labels])
    name = F.lit(metric) if isinstance(metric, str) else metric
    return df.select(
        name.alias("metric"), tags.alias("labels"), text.alias("series"),
        F.col(ts).alias("ts"), F.col(value).cast("double").alias("value"),
    )


def _step_end(ts: str, step: int) -> Column:
    """Epoch second of the first evaluation at or after the sample."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    return (F.ceil(micros / F.lit(step * 1_000_000)) * step).cast("long")


def _range(keys: list[str], seconds: int, step: int) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy("evaluated_at").rangeBetween(-(seconds - step), 0)


def step_sums(samples: DataFrame, step: int = STEP, *, order=("ts",), keys: list[str] = _SERIES,
              bounds: list[float] | None = None, **limits: int) -> DataFrame:
    """One row per series and step with samples: `n`, the increase of a counter and that of the
    step's first sample, first and last value, and cumulative bucket counts for `bounds`.

    A falling counter was reset, so its whole value is the increase.
    """
    def increase(d: DataFrame, w: WindowSpec) -> DataFrame:
        before = F.lag("value").over(w)
        grown = F.when(F.col("value") < before, F.col("value")).otherwise(F.col("value") - before)
        return d.withColumn("_inc", F.coalesce(grown, F.lit(0.0)))

    place = F.struct(*order)
    deltas = over_series(samples, keys, list(order), lambda s: s.rolling(1, increase), **limits)
    counts = [] if bounds is None else [F.array(*[
        F.count_if(F.col("value") <= edge).cast("double") for edge in [*bounds, float("inf")]
    ]).alias("buckets")]
    return deltas.groupBy(*keys, _step_end("ts", step).alias("evaluated_at")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_inc").alias("increase"),
        F.min_by("_inc", place).alias("first_increase"), F.min_by("value", place).alias("first"),
        F.max_by("value", place).alias("last"), *counts)


def on_grid(steps: DataFrame, seconds: int, step: int = STEP, *,
            keys: list[str] = _SERIES) -> DataFrame:
    """Every step of a series from its first sample until a range of `seconds` no longer holds its
    last; steps without samples have nulls."""
    spans = steps.groupBy(*keys).agg(F.min("evaluated_at").alias("_from"),
                                     (F.max("evaluated_at") + seconds - step).alias("_to"))
    grid = spans.select(*keys, F.explode(F.sequence("_from", "_to", F.lit(step).cast("long")))
                        .alias("evaluated_at"))
    return grid.join(steps, [*keys, "evaluated_at"], "left")


def _rate(steps: DataFrame, seconds: int, step: int, keys: list[str]) -> DataFrame:
    over = _range(keys, seconds, step)
    # The first sample of the range has its predecessor outside, which a range does not see.
    grown = F.sum("increase").over(over) - F.first("first_increase", True).over(over)
    return on_grid(steps, seconds, step, keys=keys).select(
        *keys, "evaluated_at", F.sum("n").over(over).alias("_n"), (grown / seconds).alias("rate")
    ).where("_n >= 2").drop("_n")


def _delta(steps: DataFrame, seconds: int, step: int, keys: list[str]) -> DataFrame:
    over = _range(keys, seconds, step)
    change = F.last("last", True).over(over) - F.first("first", True).over(over)
    return on_grid(steps, seconds, step, keys=keys).select(
        *keys, "evaluated_at", F.sum("n").over(over).alias("_n"), change.alias("delta")
    ).where("_n >= 2").drop("_n")


def _quantile(steps: DataFrame, q: float, bounds: list[float], seconds: int, step: int,
              keys: list[str]) -> DataFrame:
    over, edges = _range(keys, seconds, step), [*bounds, float("inf")]
    seen = on_grid(steps, seconds, step, keys=keys).select(*keys, "evaluated_at", *[
        F.sum(F.get("buckets", F.lit(i))).over(over).alias(f"_b{i}") for i in range(len(edges))])
    entries = [F.struct(F.lit(edge).alias("le"), F.col(f"_b{i}").alias("value"))
               for i, edge in enumerate(edges)]
    return histogram_quantile(seen.select(*keys, "evaluated_at", F.inline(F.array(*entries))), q,
                              keys=[*keys, "evaluated_at"])


def counter_rate(samples: DataFrame, seconds: int, step: int = STEP, *, order=("ts",),
                 keys: list[str] = _SERIES, **limits: int) -> DataFrame:
    """Per-second increase over the range up to each evaluation, where it holds two samples at
    least. The increase is not extrapolated to the borders of the range."""
    return _rate(step_sums(samples, step, order=order, keys=keys, **limits), seconds, step, keys)


def gauge_delta(samples: DataFrame, seconds: int, step: int = STEP, *, order=("ts",),
                keys: list[str] = _SERIES, **limits: int) -> DataFrame:
    """Last minus first value in the range up to each evaluation, where it holds two samples."""
    return _delta(step_sums(samples, step, order=order, keys=keys, **limits), seconds, step, keys)


def duration_histogram(df: DataFrame, value: str, bounds: list[float], *,
                       keys: list[str]) -> DataFrame:
    """Cumulative `le` buckets per key; the last bucket is unbounded."""
    edges = [*bounds, float("inf")]
    counts = df.groupBy(*keys).agg(*[
        F.count_if(F.col(value) <= edge).cast("double").alias(f"_b{i}")
        for i, edge in enumerate(edges)
    ])
    entries = [F.struct(F.lit(edge).alias("le"), F.col(f"_b{i}").alias("value"))
               for i, edge in enumerate(edges)]
    return counts.select(*keys, F.inline(F.array(*entries)))


def histogram_quantile(buckets: DataFrame, q: float, *, keys: list[str]) -> DataFrame:
    """Quantile by linear interpolation in the first bucket that reaches the rank. A rank in the
    unbounded bucket gives the last finite bound, an empty histogram null."""
    w = Window.partitionBy(*keys).orderBy("le")
    total = F.max("value").over(Window.partitionBy(*keys))
    walked = buckets.select(
        *keys, "le", "value", total.alias("_total"),
        F.coalesce(F.lag("value").over(w), F.lit(0.0)).alias("_below"),
        F.coalesce(F.lag("le").over(w), F.lit(0.0)).alias("_from"),
    )
    rank = F.col("_total") * q
    inside = F.col("_from") + (F.col("le") - F.col("_from")) * F.try_divide(
        rank - F.col("_below"), F.col("value") - F.col("_below"))
    estimate = F.when(F.col("le") == float("inf"), F.col("_from")).otherwise(inside)
    hit = F.when((F.col("value") >= rank) & (F.col("_total") > 0), F.struct("le", estimate))
    return walked.groupBy(*keys).agg(F.min(hit).alias("_hit")).select(
        *keys, F.col("_hit.col2").alias("quantile"))


def alert_for(evaluations: DataFrame, condition: Column, hold: int, *,
              keys: list[str] = _SERIES, gap: int = STEP) -> DataFrame:
    """Evaluations whose condition has been true without a break for `hold` seconds.

    An evaluation more than `gap` seconds after the one before it starts anew.
    """
    w = Window.partitionBy(*keys).orderBy("evaluated_at")
    active = evaluations.withColumn("_on", F.coalesce(condition, F.lit(False)))
    late = F.col("evaluated_at") - F.lag("evaluated_at").over(w) > gap
    broken = F.coalesce(late, F.lit(True)) | ~F.lag("_on", 1, False).over(w)
    runs = active.withColumn("_start", F.when(F.col("_on") & broken, F.col("evaluated_at")))
    since = F.last("_start", True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    held = F.when(F.col("_on"), F.col("evaluated_at") - since)
    return runs.withColumn("active_seconds", held).withColumn(
        "firing", F.coalesce(held >= hold, F.lit(False))).drop("_on", "_start")


@dataclass(frozen=True)
class Rule:
    """Alert `name` fires when `measure` of `metric` over `seconds` exceeds `limit` for `hold`."""

    name: str
    metric: str
    measure: str  # rate, delta or p95
    seconds: int
    limit: float
    severity: str
    hold: int = 300


# The monitored rules, their limits and severities.
RULES = [
    Rule("HighErrorRate", "stock_data_fetch_errors_total", "rate", 300, 0.1, "critical"),
    Rule("DataDriftDetected", "data_drift_detected_total", "rate", 900, 0.0, "warning"),
    Rule("SlowProcessing", "stock_data_processing_seconds", "p95", 300, 5.0, "warning"),
    Rule("StockPriceChange", "stock_current_price", "delta", 300, 5.0, "warning"),
]


def window_quantile(samples: DataFrame, q: float, bounds: list[float], seconds: int,
                    step: int = STEP, *, order=("ts",), keys: list[str] = _SERIES,
                    **limits: int) -> DataFrame:
    """Histogram quantile of the values seen in the range up to each evaluation."""
    steps = step_sums(samples, step, order=order, keys=keys, bounds=bounds, **limits)
    return _quantile(steps, q, bounds, seconds, step, keys)


def rule_readings(steps: DataFrame, rule: Rule, bounds: list[float], step: int = STEP) -> DataFrame:
    """(metric, series, evaluated_at, reading) of one rule from sums per series and step."""
    own = steps.where(F.col("metric") == rule.metric)
    if rule.measure == "rate":
        return _rate(own, rule.seconds, step, _SERIES).withColumnRenamed("rate", "reading")
    if rule.measure == "delta":
        read = _delta(own, rule.seconds, step, _SERIES)
        return read.withColumn("reading", F.abs("delta")).drop("delta")
    return _quantile(own, 0.95, bounds, rule.seconds, step, _SERIES).withColumnRenamed(
        "quantile", "reading")


def evaluate_alerts(samples: DataFrame, rules: list[Rule] = RULES, *, bounds: list[float],
                    order=("ts",), step: int = STEP, **limits: int) -> DataFrame:
    """All rules over one sample table: (alertname, severity, metric, series, evaluated_at,
    reading, firing).

    The samples are read once, into sums per series and step; every rule works on those.
    """
    wanted = samples.where(F.col("metric").isin(sorted({r.metric for r in rules})))
    steps = materialize(step_sums(wanted, step, order=order, bounds=bounds, **limits), "steps")
    results = []
    for rule in rules:
        read = rule_readings(steps, rule, bounds, step)
        fired = alert_for(read, F.col("reading") > rule.limit, rule.hold, gap=step)
        results.append(fired.select(
            F.lit(rule.name).alias("alertname"), F.lit(rule.severity).alias("severity"),
            *_SERIES, "evaluated_at", "reading", "firing"))
    return reduce(DataFrame.unionByName, results)


def group_alerts(alerts: DataFrame, repeat: int = 3600, *, step: int = STEP) -> DataFrame:
    """Notifications per alert name: one when any of its series begins to fire, and while that goes
    on one more per full `repeat` interval since. `firing_series` counts those that fire until the
    next one."""
    line = Window.partitionBy("alertname").orderBy("evaluated_at")
    firing = alerts.where("firing").select("alertname", "metric", "series", "evaluated_at")
    times = firing.select("alertname", "evaluated_at").distinct()
    before = F.lag("evaluated_at").over(line)
    begins = before.isNull() | (F.col("evaluated_at") - before > step)
    runs = times.withColumn("_start", F.when(begins, F.col("evaluated_at"))).withColumn(
        "started", F.last("_start", True).over(
            line.rowsBetween(Window.unboundedPreceding, 0))).drop("_start")
    turn = F.floor((F.col("evaluated_at") - F.col("started")) / repeat)
    return firing.join(runs, ["alertname", "evaluated_at"]).groupBy(
        "alertname", "started", turn.alias("_turn")).agg(
        F.min("evaluated_at").alias("sent_at"),
        F.count_distinct("metric", "series").alias("firing_series")).drop("_turn")


def inhibit(alerts: DataFrame) -> DataFrame:
    """Drop a warning while a critical alert of the same name fires."""
    firing = alerts.where("firing")
    critical = firing.where(F.col("severity") == "critical").select(
        "alertname", "evaluated_at").distinct()
    calm = firing.where(F.col("severity") == "warning").join(
        critical, ["alertname", "evaluated_at"], "left_anti")
    return calm.unionByName(firing.where(F.col("severity") != "warning"))


def threshold_panel(readings: DataFrame, limits: dict[str, float]) -> DataFrame:
    """Mean, largest and summed reading per metric and whether the largest passes its limit."""
    limit = F.lit(None).cast("double")
    for metric, bound in limits.items():
        limit = F.when(F.col("metric") == metric, F.lit(float(bound))).otherwise(limit)
    return (
        readings.groupBy("metric").agg(
            F.avg("value").alias("mean_value"), F.max("value").alias("max_value"),
            F.sum("value").alias("sum_value"))
        .withColumn("above_limit", F.col("max_value") > limit)
    )


def series_legend(samples: DataFrame, by: list[str]) -> DataFrame:
    """Mean, largest and smallest value per series."""
    return samples.groupBy(*by).agg(
        F.avg("value").alias("mean_value"), F.max("value").alias("max_value"),
        F.min("value").alias("min_value"))
