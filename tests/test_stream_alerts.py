"""Alert rules over batches against the rules over all samples at once."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators import alerts
from millrace.operators.alerts import Rule
from millrace.streaming import alerting

START = datetime(2024, 1, 1)
BOUNDS = [1.0, 5.0]
RULES = [Rule("Rising", "errors", "rate", 60, 0.05, "critical", 30),
         Rule("Rising", "errors", "rate", 60, 0.2, "warning", 30),
         Rule("Slow", "seconds", "p95", 45, 2.0, "warning", 15)]
SAMPLE = "metric string, series string, ts timestamp, value double"


def samples():
    rows, count = [], 0.0
    for i in range(60):  # a counter that is reset, every four seconds
        count = 0.0 if i == 33 else count + (1.0 if 10 < i < 50 else 0.0)
        rows.append(("errors", "a", START + timedelta(seconds=4 * i + 1), count))
    # silent for longer than the range, between batches and within one
    for at, value in ((2, 0.5), (9, 4.0), (12, 4.5), (31, 4.0), (170, 3.0), (175, 9.0), (233, 9.0)):
        rows.append(("seconds", "b", START + timedelta(seconds=at), value))
    rows.append(("seconds", "new", START + timedelta(seconds=200), 3.0))
    rows += [("other", "x", START, 1.0), ("errors", "a", None, 99.0)]
    return rows


def evaluations(df):
    return {(r["alertname"], r["severity"], r["series"], r["evaluated_at"]): (
        r["reading"] if r["reading"] is None else pytest.approx(r["reading"]), r["firing"])
        for r in df.collect()}


def test_batches_equal_one_pass_with_a_replay_and_late_samples(spark, tmp_path):
    df = spark.createDataFrame(samples(), SAMPLE).cache()
    whole = alerts.evaluate_alerts(df.where("ts is not null"), RULES, bounds=BOUNDS)
    path = str(tmp_path / "alerts")
    # cuts within a step of 15 seconds and within the silence
    cuts = [START + timedelta(seconds=s) for s in (-1, 68, 120, 9999)]
    late = spark.createDataFrame([("errors", "a", START + timedelta(seconds=3), 1e6)], SAMPLE)
    for batch, (low, high) in enumerate(zip(cuts, cuts[1:])):
        part = df.where(((F.col("ts") > low) & (F.col("ts") <= high))
                        | (F.col("ts").isNull() & F.lit(batch == 1)))
        for _ in range(1 + (batch == 1)):
            alerting.alert_batch(part if batch != 2 else part.unionByName(late), batch, path, RULES,
                                 bounds=BOUNDS)
    alerting.close_alerts(spark, path, RULES, bounds=BOUNDS)
    rows = alerting.read_alerts(spark, path).cache()
    found, expected = evaluations(rows), evaluations(whole)
    assert rows.count() == len(found) and found == expected
    assert [tuple(r)[:3] for r in spark.read.parquet(f"{path}/late").where("samples > 0").collect()
            ] == [("errors", "a", 1)]
    states = [(r["state"], r["firing"]) for r in rows.where("severity = 'critical'").orderBy(
        "evaluated_at").collect()]
    assert {s for s, _ in states} == {"inactive", "pending", "firing"}
    assert all((s == "firing") == f for s, f in states)
    first = states.index(("pending", False))
    assert [s for s, _ in states[first:first + 3]] == ["pending", "pending", "firing"]


def test_an_empty_batch_and_an_empty_stream(spark, tmp_path):
    none = spark.createDataFrame([], SAMPLE)
    path = str(tmp_path / "alerts")
    one = spark.createDataFrame([("seconds", "b", START + timedelta(seconds=1), 4.0)], SAMPLE)
    for batch, part in enumerate((none, one, none)):
        alerting.alert_batch(part, batch, path, RULES[2:], bounds=BOUNDS)
    alerting.close_alerts(spark, path, RULES[2:], bounds=BOUNDS)
    rows = alerting.read_alerts(spark, path).orderBy("evaluated_at").collect()
    assert [(r["reading"], r["state"]) for r in rows] == [
        (pytest.approx(4.8), "pending"), (pytest.approx(4.8), "firing"),
        (pytest.approx(4.8), "firing")]


def test_two_rules_of_one_name_and_severity_are_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="same name and severity"):
        alerting.alert_batch(spark.createDataFrame(samples(), SAMPLE), 0, str(tmp_path),
                             [RULES[0], RULES[0]], bounds=BOUNDS)
