"""Alert rules over a stream of samples: inactive, pending and firing, carried from batch to batch.

A batch is summed up per series and step before anything else, so what is carried is one row per step
of a series within the longest range of a rule, and one row per rule and series. A step is evaluated
when a later one has begun, so batches may part a step.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace.operators.alerts import RULES, STEP, Rule, rule_readings, step_sums

_SERIES = ["metric", "series"]
#: A rule is known by its name and severity: one alert may have a limit for each.
_RUN = ["alertname", "severity", *_SERIES]


def _step_of(ts: str, step: int) -> Column:
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    return (F.ceil(micros / F.lit(step * 1_000_000)) * step).cast("long")


def _continued(new: DataFrame, before: DataFrame, buckets: int) -> DataFrame:
    """Step sums of a batch, its first step of a series counted on from the value before it, and
    merged with the part of that step that came earlier."""
    newest = before.groupBy(*_SERIES).agg(F.max_by("last", "evaluated_at").alias("_last"))
    head = F.min("evaluated_at").over(Window.partitionBy(*_SERIES))
    grown = F.when(F.col("first") < F.col("_last"), F.col("first")).otherwise(
        F.col("first") - F.col("_last"))
    added = F.when(F.col("evaluated_at") == F.col("_head"), F.coalesce(grown, F.lit(0.0)))
    joined = new.withColumn("_head", head).join(newest, _SERIES, "left")
    counted = joined.withColumns({
        "increase": F.col("increase") + F.coalesce(added, F.lit(0.0)),
        "first_increase": F.coalesce(added, F.col("first_increase"))}).select(*new.columns)
    both = before.withColumn("_age", F.lit(0)).unionByName(counted.withColumn("_age", F.lit(1)))
    return both.groupBy(*_SERIES, "evaluated_at").agg(
        F.sum("n").alias("n"), F.sum("increase").alias("increase"),
        F.min_by("first_increase", "_age").alias("first_increase"),
        F.min_by("first", "_age").alias("first"), F.max_by("last", "_age").alias("last"),
        F.array(*[F.sum(F.get("buckets", F.lit(i))) for i in range(buckets)]).alias("buckets"))


def _carried_steps(steps: DataFrame, mark: int, longest: int) -> DataFrame:
    """Steps that a later evaluation may see, and the newest step of every series."""
    newest = F.max("evaluated_at").over(Window.partitionBy(*_SERIES))
    return steps.withColumn("_newest", newest).where(
        (F.col("evaluated_at") > mark - longest) | (F.col("evaluated_at") == F.col("_newest"))
    ).drop("_newest")


def _advance(read: DataFrame, rule: Rule, runs: DataFrame | None, step: int) -> DataFrame:
    """Readings with `since`, when their condition began to hold without a break, and `state`."""
    rows = read.select(F.lit(rule.name).alias("alertname"), F.lit(rule.severity).alias("severity"),
                       *_SERIES, "evaluated_at", "reading",
                       F.coalesce(F.col("reading") > rule.limit, F.lit(False)).alias("_on"),
                       F.lit(None).cast("long").alias("_since"), F.lit(True).alias("_new"))
    if runs is not None:
        rows = rows.unionByName(runs.where(
            (F.col("alertname") == rule.name) & (F.col("severity") == rule.severity)).select(
            *_RUN, "evaluated_at",
            F.lit(None).cast("double").alias("reading"), F.col("since").isNotNull().alias("_on"),
            F.col("since").alias("_since"), F.lit(False).alias("_new")))
    line = Window.partitionBy(*_RUN).orderBy("evaluated_at")
    before = F.lag("evaluated_at").over(line)
    broken = before.isNull() | (F.col("evaluated_at") - before > step) | ~F.lag("_on").over(line)
    begins = F.when(~F.col("_new"), F.col("_since")).when(F.col("_on") & broken,
                                                          F.col("evaluated_at"))
    since = F.last("_begin", True).over(line.rowsBetween(Window.unboundedPreceding, 0))
    held = rows.withColumn("_begin", begins).withColumn("since", F.when(F.col("_on"), since))
    firing = F.coalesce(F.col("evaluated_at") - F.col("since") >= rule.hold, F.lit(False))
    state = F.when(firing, "firing").when(F.col("_on"), "pending").otherwise("inactive")
    return held.withColumns({"state": state, "firing": firing}).drop("_on", "_since", "_begin")


def _evaluate(spark: SparkSession, path: str, batch_id: int, steps: DataFrame,
              earlier: DataFrame | None, last_mark: int | None, mark: int | None,
              rules: list[Rule], bounds: list[float], step: int) -> None:
    """Evaluate the steps after `last_mark` up to `mark` (all, if None); write alerts and runs."""
    if len({(rule.name, rule.severity) for rule in rules}) < len(rules):
        raise ValueError("two rules have the same name and severity")
    runs, found = None, []
    if batch_id > 0:
        runs = spark.read.parquet(f"{path}/runs/batch_id={batch_id - 1}")
    for rule in rules:
        read = rule_readings(steps, rule, bounds, step)
        if mark is not None:
            read = read.where(F.col("evaluated_at") <= mark)
        if last_mark is not None:
            # A silent series was evaluated until its range ran empty; the steps between that and
            # its next sample follow when the sample is there.
            done = earlier.groupBy(*_SERIES).agg(F.least(
                F.lit(last_mark), F.max("evaluated_at") + rule.seconds - step).alias("_done"))
            read = read.join(done, _SERIES, "left").where(
                F.col("_done").isNull() | (F.col("evaluated_at") > F.col("_done"))).drop("_done")
        found.append(_advance(read, rule, runs, step))
    rows = reduce(DataFrame.unionByName, found)
    target = f"{path}/advanced/batch_id={batch_id}"
    rows.write.mode("overwrite").partitionBy("_new").parquet(target)
    schema = rows.drop("_new").schema.add("_new", "boolean")
    written = spark.read.schema(schema).parquet(target)
    written.groupBy(*_RUN).agg(
        F.max("evaluated_at").alias("evaluated_at"),
        F.max_by("since", "evaluated_at").alias("since"),
    ).write.mode("overwrite").parquet(f"{path}/runs/batch_id={batch_id}")


def alert_batch(batch: DataFrame, batch_id: int, path: str, rules: list[Rule] = RULES, *,
                bounds: list[float], order=("ts",), step: int = STEP, **limits: int) -> None:
    """Evaluate the rules for the steps that a micro-batch of samples completes.

    Batches follow one another in time. A sample of a step that was evaluated before changes nothing
    any more; such samples are counted per series in `late`. Samples without a time are left out.
    A replay gives the same directories again.
    """
    spark = batch.sparkSession
    longest = max(rule.seconds for rule in rules)
    wanted = batch.where(F.col("ts").isNotNull()
                         & F.col("metric").isin(sorted({r.metric for r in rules})))
    earlier = before = last_mark = None
    if batch_id > 0:
        earlier = spark.read.parquet(f"{path}/steps/batch_id={batch_id - 1}")
        last_mark = _mark(earlier, step)
        if last_mark is not None:
            before = _carried_steps(earlier, last_mark, longest)
            late = _step_of("ts", step) <= last_mark
            wanted.where(late).groupBy(*_SERIES).agg(F.count(F.lit(1)).alias("samples")).write.mode(
                "overwrite").parquet(f"{path}/late/batch_id={batch_id}")
            wanted = wanted.where(~late)
    sums = step_sums(wanted, step, order=order, bounds=bounds, **limits)
    if before is not None:
        sums = _continued(sums, before, len(bounds) + 1)
    target = f"{path}/steps/batch_id={batch_id}"
    sums.write.mode("overwrite").parquet(target)
    steps = spark.read.schema(sums.schema).parquet(target)
    _evaluate(spark, path, batch_id, steps, earlier, last_mark, _mark(steps, step), rules, bounds,
              step)


def _mark(steps: DataFrame, step: int) -> int | None:
    """The last step that no later sample falls into: the one before the newest."""
    newest = steps.agg(F.max("evaluated_at")).first()[0]
    return None if newest is None else newest - step


def stream_alerts(samples: DataFrame, path: str, checkpoint: str, rules: list[Rule] = RULES, *,
                  bounds: list[float], **options) -> DataStreamWriter:
    """Writer of the rules' evaluations, batch by batch."""
    return samples.writeStream.foreachBatch(
        lambda batch, batch_id: alert_batch(batch, batch_id, path, rules, bounds=bounds, **options)
    ).option("checkpointLocation", checkpoint)


def close_alerts(spark: SparkSession, path: str, rules: list[Rule] = RULES, *,
                 bounds: list[float], step: int = STEP) -> None:
    """Evaluate what is left after the last batch: the samples have ended."""
    every = spark.read.parquet(f"{path}/steps")
    last = every.agg(F.max("batch_id")).first()[0]
    if last is not None:
        steps = spark.read.parquet(f"{path}/steps/batch_id={last}")
        _evaluate(spark, path, last + 1, steps, steps, _mark(steps, step), None, rules, bounds, step)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """All evaluations so far: alertname, severity, metric, series, evaluated_at, reading, since,
    state (inactive, pending, firing) and firing."""
    return spark.read.parquet(f"{path}/advanced").where(
        F.col("_new").cast("boolean")).drop("_new", "batch_id")
