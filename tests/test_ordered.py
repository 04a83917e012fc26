"""Blocked evaluation of hot keys against pandas and against the plain windows."""

from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from millrace.operators import features, quality, series
from millrace.operators.alerts import counter_rate
from millrace.operators.ordered import Series, number_rows, over_series
from millrace.plans import features as feature_plans
from millrace.plans import markets, monitoring

HOT = {"block_rows": 32}


@pytest.fixture(scope="module")
def skewed(spark):
    """One key owns most rows; values have gaps, among them runs longer than a block."""
    rng = np.random.default_rng(7)
    n = 600
    key = np.where(rng.random(n) < 0.7, "hot", rng.choice(list("abc"), n))
    value = rng.normal(100, 20, n).round(2)
    value[rng.random(n) < 0.2] = np.nan
    value[200:290] = np.nan
    value[:5] = np.nan
    pdf = pd.DataFrame({"k": key, "t": rng.permutation(n), "x": value})
    rows = [(k, int(t), None if np.isnan(x) else float(x)) for k, t, x in pdf.itertuples(False)]
    return spark.createDataFrame(rows, "k string, t long, x double"), pdf.sort_values("t")


def by_row(df, col):
    return {r["t"]: r[col] for r in df.select("t", col).collect()}


def same(found, expected):
    assert found.keys() == expected.keys()
    for t, value in expected.items():
        if pd.isna(value):
            assert found[t] is None or pd.isna(found[t]), t
        else:
            assert found[t] == pytest.approx(value, rel=1e-9), t


def expect(pdf, compute):
    out = {}
    for _, group in pdf.groupby("k"):
        out |= dict(zip(group["t"], compute(group["x"])))
    return out


def both(df):
    return [Series.of(df, ["k"], ["t"]), Series.of(df, ["k"], ["t"], HOT["block_rows"])]


def test_only_large_keys_are_cut(skewed):
    df, pdf = skewed
    sizes = pdf.groupby("k").size()
    cut = Series.of(df, ["k"], ["t"], 64).df.groupBy("k", "_block").count().collect()
    assert {r["k"] for r in cut if r["_block"] is None} == set(sizes[sizes <= 64].index)
    hot = sorted((r["_block"], r["count"]) for r in cut if r["k"] == "hot")
    full, rest = divmod(int(sizes["hot"]), 64)
    assert hot == [(i, 64) for i in range(full)] + [(full, rest)]


def test_sampled_cuts_are_near_the_size_asked_for(spark):
    df = spark.range(200_000).selectExpr("id as t", "id % 3 = 0 as k", "xxhash64(id) as noise")
    sizes = Series.of(df, ["k"], ["noise"], 10_000).df.groupBy("k", "_block").count().toPandas()
    full = sizes[sizes["_block"] < sizes.groupby("k")["_block"].transform("max")]
    assert 4_000 < full["count"].min() and full["count"].max() < 18_000
    assert sizes["count"].sum() == 200_000


def test_no_job_before_the_action(spark, skewed):
    tracker, group = spark.sparkContext.statusTracker(), "no-job-before-the-action"
    df = skewed[0]
    spark.sparkContext.setJobGroup(group, "planning")
    try:
        over_series(df, ["k"], ["t"], lambda s: s.last_known(f=F.col("x")).running(n=F.lit(1))
                    .rolling(2, lambda d, w: d.withColumn("p", F.lag("x").over(w)))
                    .ewm("x", 20, "y"), block_rows=32)
        assert list(tracker.getJobIdsForGroup(group)) == []
    finally:
        spark.sparkContext.setJobGroup("", "")


def test_without_cuts_the_plan_that_runs_is_a_plain_window(skewed):
    rows = over_series(skewed[0], ["k"], ["t"], lambda s: s.running(n=F.lit(1)).rolling(
        1, lambda d, w: d.withColumn("p", F.lag("x").over(w))))
    rows.collect()
    final = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" not in final and "Union" not in final
    assert final.count("ShuffleQueryStage") == 1


def test_null_keys_and_copies(spark):
    """A null key is cut like any other; rows that are equal in the order stay in one block."""
    df = spark.createDataFrame([(None, 1)] * 90 + [("a", 1)] * 10 + [("b", i) for i in range(40)],
                               "k string, t int")
    rows = over_series(df, ["k"], ["t"], lambda s: s.running(n=F.lit(1)), block_rows=16)
    found = sorted((r["k"] or "", r["n"]) for r in rows.collect())
    assert found == [("", i) for i in range(1, 91)] + [("a", i) for i in range(1, 11)] + [
        ("b", i) for i in range(1, 41)]
    mixed = spark.createDataFrame([(None, i if i % 3 else None) for i in range(90)],
                                  "k string, t int")
    parts = number_rows(mixed, ["k"], ["t"], block_rows=16).agg(
        F.max("_row"), F.count_distinct("_row"), F.max(F.when(F.col("t").isNull(), F.col("_row")))
    ).first()
    assert tuple(parts) == (90, 90, 30)


def test_number_rows(skewed):
    df, pdf = skewed
    found = by_row(number_rows(df, ["k"], ["t"], "n"), "n")
    same(found, expect(pdf, lambda x: range(1, len(x) + 1)))
    total = by_row(number_rows(df, [], ["t"], "n", block_rows=50), "n")
    assert sorted(total.values()) == list(range(1, 601))
    assert all(n == t + 1 for t, n in total.items())


def test_blocks_are_bounded(skewed):
    hot = both(skewed[0])[1]
    sizes = hot.df.groupBy("k", "_block").count().agg(F.max("count")).first()[0]
    assert sizes <= HOT["block_rows"]


@pytest.mark.parametrize("hot", [0, 1])
def test_fills(skewed, hot):
    df, pdf = skewed
    rows = both(df)[hot].last_known(f=F.col("x")).next_known(b=F.col("x")).rows()
    same(by_row(rows, "f"), expect(pdf, lambda x: x.ffill()))
    same(by_row(rows, "b"), expect(pdf, lambda x: x.bfill()))


@pytest.mark.parametrize("hot", [0, 1])
def test_running(skewed, hot):
    df, pdf = skewed
    rows = both(df)[hot].running(s=F.coalesce("x", F.lit(0.0))).rows()
    same(by_row(rows, "s"), expect(pdf, lambda x: x.fillna(0).cumsum()))


@pytest.mark.parametrize("hot", [0, 1])
def test_rolling(skewed, hot):
    df, pdf = skewed
    rows = both(df)[hot].rolling(20, lambda d, w: d.withColumns({
        "m": series.rolling_mean("x", w, 5), "s": series.rolling_std("x", w, 20)})).rows()
    same(by_row(rows, "m"), expect(pdf, lambda x: x.rolling(5).mean()))
    same(by_row(rows, "s"), expect(pdf, lambda x: x.rolling(20).std()))
    assert rows.count() == len(pdf)


def test_ewm_over_long_runs_of_nulls_stays_in_blocks(spark):
    """5,000 nulls between values and a span of a million rows."""
    n, block = 20_000, 500
    pdf = pd.DataFrame({"t": range(n)})
    pdf["x"] = np.where(pdf["t"] % 5000 == 7, pdf["t"] * 0.5, np.nan)
    pdf["z"] = np.sin(pdf["t"])
    df = spark.range(n).selectExpr(
        "'k' as k", "id as t", "if(id % 5000 = 7, id * 0.5, null) as x", "sin(id) as z")
    series_ = Series.of(df, ["k"], ["t"], block)
    assert series_.df.groupBy("_block").count().agg(F.max("count")).first()[0] < 2 * block
    for col, span in (("x", 20), ("x", 10**6), ("z", 10**6), ("z", 5)):
        rows = series_.ewm(col, span, "y").rows()
        same(by_row(rows, "y"), dict(zip(pdf["t"], pdf[col].ewm(span=span, adjust=False).mean())))


@pytest.mark.parametrize("span", [3, 20, 400])
@pytest.mark.parametrize("hot", [0, 1])
def test_ewm(skewed, hot, span):
    df, pdf = skewed
    rows = both(df)[hot].ewm("x", span, "y").rows()
    same(by_row(rows, "y"), expect(pdf, lambda x: x.ewm(span=span, adjust=False).mean()))


def test_halo_needs_room(skewed):
    with pytest.raises(ValueError):
        both(skewed[0])[1].rolling(33, lambda d, w: d)


def equal(a, b, *approx):
    steady = [F.round(c, 6).alias(c) if c in approx else F.col(c) for c in a.columns]
    a, b = a.select(steady), b.select(*a.columns).select(steady)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_stock_indicators_match_pandas(spark):
    rows = markets.tick_rows(spark, SMALL).select(
        "symbol", "timestamp", "event_id", F.col("price").cast("double").alias("close"))
    for limits in ({}, HOT):
        found = series.stock_indicators(rows, order=markets.ORDER, **limits).toPandas()
        found = found.sort_values(["symbol", "timestamp", "event_id"])
        close = found.groupby("symbol")["close"]
        back = close.pct_change()
        assert np.allclose(found["daily_return"], back, equal_nan=True)
        assert np.allclose(found["sma_20"], close.transform(lambda x: x.rolling(20).mean()),
                           equal_nan=True)
        assert np.allclose(found["ema_20"],
                           close.transform(lambda x: x.ewm(span=20, adjust=False).mean()))
        assert np.allclose(found["volatility"], back.groupby(found["symbol"]).transform(
            lambda x: x.rolling(20).std()), equal_nan=True)


def test_tick_indicators_hot(spark):
    rows = markets.tick_rows(spark, SMALL)
    equal(series.tick_indicators(rows, order=markets.ORDER),
          series.tick_indicators(rows, order=markets.ORDER, **HOT), "volatility")


def test_order_gaps_hot(spark):
    rows = markets.tick_rows(spark, SMALL)
    args = {"customer": "symbol", "date": "timestamp", "unique": "event_id"}
    equal(series.order_gaps(rows, **args), series.order_gaps(rows, **args, **HOT))


def test_profile_hot(spark):
    rows = markets.sparse_rows(spark, SMALL)
    args = {"keys": ["symbol"], "order": markets.ORDER}
    equal(quality.profile(rows, ["price", "volume"], **args),
          quality.profile(rows, ["price", "volume"], **args, **HOT), "std")


def test_pit_join_hot(spark):
    args = (feature_plans.buyers(spark, SMALL), feature_plans.view_rows(spark, SMALL),
            ["customer_id"], ["view_value"], timedelta(days=1))
    equal(features.pit_join(*args), features.pit_join(*args, **HOT))


def test_drift_hot(spark):
    halves = monitoring._halves(spark, SMALL)
    equal(quality.column_drift(*halves, ["price", "load"], test="ks"),
          quality.column_drift(*halves, ["price", "load"], test="ks", **HOT), "wasserstein", "p_value")


def test_counter_rate_hot(spark):
    rows = monitoring.samples(spark, SMALL)
    equal(counter_rate(rows, 6 * 3600, 3600), counter_rate(rows, 6 * 3600, 3600, **HOT))


def test_results_do_not_depend_on_partitions(spark):
    rows = markets.tick_rows(spark, SMALL)
    equal(series.tick_indicators(rows.repartition(1), order=markets.ORDER),
          series.tick_indicators(rows.repartition(13), order=markets.ORDER), "volatility")
