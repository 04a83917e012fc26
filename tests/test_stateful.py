"""State of Spark over several batches: totals, windows closed by timers, replays."""

import os
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.streaming import ingest, stateful

START = datetime(2024, 1, 1)
TICK = "go int, symbol string, timestamp timestamp, price double, volume double"


def uncommit(mark):
    """As if the last batch had failed after writing."""
    last = max(int(n) for n in os.listdir(f"{mark}/commits") if n.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        os.remove(f"{mark}/commits/{name}")


def test_totals_over_batches_a_replay_and_a_hot_symbol(spark, tmp_path):
    rows = [(i % 3, "hot" if i % 5 else None if i % 10 else "cold",
             None if i % 7 == 0 else START + timedelta(seconds=i),
             None if i % 11 == 0 else 1.0 + i % 17, None if i % 13 == 0 else float(i % 4))
            for i in range(3000)]
    rows.append((0, "still", START, 2.0, 0.0))
    df = spark.createDataFrame(rows, TICK).repartition(6)
    raw, out, mark = (str(tmp_path / n) for n in ("raw", "out", "mark"))
    seen = []

    def writer(ticks):
        return stateful.vwap_totals(ticks, out, mark, parts=2)

    ingest.run_goes(df, F.col("go"), 3, raw, writer)

    def totals(last):
        sums = defaultdict(lambda: [0, 0.0, 0.0])
        for go, symbol, _, price, volume in rows:
            if go <= last:
                sums[symbol][0] += 1
                sums[symbol][1] += volume or 0.0
                sums[symbol][2] += (price or 0.0) * (volume or 0.0)
        return {s: (n, v, pytest.approx(t / v) if v else None) for s, (n, v, t) in sums.items()}

    def found(last=None):
        return {r["symbol"]: (r["points"], r["volume"], r["vwap"])
                for r in stateful.read_vwap(spark, out, last).collect()}

    for last in range(3):
        assert found(last) == totals(last)
    uncommit(mark)
    query = ingest.run_available(writer(ingest.file_stream(spark, raw, df.schema)))
    seen = [o.numRowsTotal for o in query.lastProgress.stateOperators]
    assert found() == totals(2)
    assert seen and max(seen) <= 4 * 2  # symbols times sub-keys, whatever the ticks


def test_windows_close_once_and_late_ticks_go_aside(spark, tmp_path):
    def at(**span):
        return START + timedelta(**span)

    rows = [(0, "a", at(seconds=10), 1.0, 1.0), (0, "a", at(seconds=59), 3.0, 1.0),
            (0, None, at(seconds=5), 7.0, None), (0, "a", None, 9.0, 1.0),
            (1, "a", at(minutes=30), 2.0, 1.0), (1, "a", at(seconds=20), 2.0, 5.0),
            # behind the watermark of 20 minutes: too late for the first window, not for minute 25
            (2, "a", at(seconds=30), 8.0, 1.0), (2, "a", at(seconds=40), 6.0, 1.0),
            (2, "a", at(minutes=25), 4.0, 1.0), (2, "b", None, None, None),
            (3, "b", at(hours=2), 5.0, 1.0), (3, None, at(seconds=5), 1.0, 2.0)]
    df = spark.createDataFrame(rows, TICK)
    raw, out, mark = (str(tmp_path / n) for n in ("raw", "out", "mark"))

    def writer(ticks):
        return stateful.timed_windows(ticks, out, mark, 60, delay="10 minutes")

    ingest.run_goes(df, F.col("go"), 4, raw, writer)

    def found():
        return {(r["kind"], r["symbol"], r["window_start"]): (r["points"], r["low"], r["high"],
                                                              r["volume"], r["sufficient"])
                for r in stateful.read_timed_windows(spark, out, 60, 3).collect()}

    expected = {
        ("closed", "a", at()): (3, 1.0, 3.0, 7.0, True),
        ("closed", None, at()): (1, 7.0, 7.0, None, False),
        ("closed", "a", at(minutes=30)): (1, 2.0, 2.0, 1.0, False),
        ("closed", "a", at(minutes=25)): (1, 4.0, 4.0, 1.0, False),
        ("late", "a", at()): (2, 6.0, 8.0, 2.0, False),
        ("late", None, at()): (1, 1.0, 1.0, 2.0, False),
        ("untimed", "a", None): (1, 9.0, 9.0, 1.0, False),
        ("untimed", "b", None): (1, None, None, None, False)}
    assert found() == expected  # the window of two o'clock is still open
    uncommit(mark)
    query = ingest.run_available(writer(ingest.file_stream(spark, raw, df.schema)))
    assert found() == expected
    # one window and its timer, in two column families, are all that is kept
    assert query.lastProgress.stateOperators[0].numRowsTotal <= 3


def test_an_empty_go_leaves_the_state_as_it_is(spark, tmp_path):
    df = spark.createDataFrame([(0, "a", START, 2.0, 1.0), (2, "a", None, 4.0, 1.0)], TICK)
    raw, out, mark = (str(tmp_path / n) for n in ("raw", "out", "mark"))
    ingest.run_goes(df, F.col("go"), 3, raw, lambda t: stateful.vwap_totals(t, out, mark))
    assert [tuple(r) for r in stateful.read_vwap(spark, out).collect()] == [("a", 2, 2.0, 3.0)]
