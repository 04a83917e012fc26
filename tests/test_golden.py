"""Small inputs with answers worked out by hand."""

import random
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.functions import columns as col
from millrace.functions.udfs import inventory_score_udf
from millrace.operators import aggregates as agg
from millrace.operators import alerts, features, joins, learning, quality, series, warehouse
from millrace.operators.features import FeatureView


@pytest.fixture(scope="module")
def staff(spark):
    rows = [(1, "Engineering", 85000), (2, "Engineering", 92000), (3, "Engineering", 78000),
            (4, "Engineering", 86000), (5, "Marketing", 72000), (6, "Marketing", 79000),
            (7, "Finance", 88000), (8, "Finance", 87000), (9, "HR", 71000), (10, "HR", 71000)]
    return spark.createDataFrame(rows, "employee_id int, department string, salary int")


@pytest.fixture(scope="module")
def units(spark):
    rows = [("Engineering", "SF", 1500000), ("Marketing", "NY", 800000),
            ("Finance", "CH", 1200000), ("HR", "BO", 500000), ("Sales", "LA", 900000)]
    return spark.createDataFrame(rows, "department_name string, location string, budget int")


def test_department_summary(staff, units):
    rows = agg.budget_metrics(joins.department_summary(units, agg.department_cost(staff)))
    found = {r["department_name"]: r for r in rows.collect()}
    expected = {"Engineering": (4, 341000, "85250.00", "1159000.00", "22.73"),
                "Marketing": (2, 151000, "75500.00", "649000.00", "18.88"),
                "Finance": (2, 175000, "87500.00", "1025000.00", "14.58"),
                "HR": (2, 142000, "71000.00", "358000.00", "28.40")}
    for name, (n, total, mean, rest, share) in expected.items():
        row = found[name]
        assert (row["employee_count"], row["total_salary_cost"]) == (n, total)
        assert row["avg_salary"] == Decimal(mean)
        assert row["budget_remaining"] == Decimal(rest)
        assert row["budget_utilization_percent"] == Decimal(share)
    assert found["Sales"]["employee_count"] is None
    assert found["Sales"]["budget_remaining"] is None


def test_inventory_score(spark):
    now = "2024-01-10 00:00:00"
    rows = [(20, 10000, now), (5000, 10000, now), (5000, 10000, "2024-01-09 12:00:00"),
            (10, 0, now), (50, 100, "2020-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "q int, c int, u string").withColumn(
        "u", F.col("u").cast("timestamp"))
    native = [r[0] for r in df.select(col.inventory_score("q", "c", "u", now)).collect()]
    udf = inventory_score_udf(now)
    pandas = [r[0] for r in df.select(udf(F.col("q").cast("double"), F.col("c").cast("double"),
                                          "u")).collect()]
    assert native == pytest.approx([0.4, 100.0, 99.0, None, 0.0])
    assert pandas == pytest.approx([0.4, 100.0, 99.0, None, 0.0])


def test_title_case(spark):
    texts = ["o'neil scattered-clouds 3rd", "", "ÉCLAIR été", None, "a1b"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    found = [r[0] for r in df.select(col.title_case("s")).collect()]
    assert found == [t.title() if t is not None else None for t in texts]


def test_cut_and_flags(spark):
    df = spark.createDataFrame([(t,) for t in (-3.0, 0.0, 0.1, 15.0, 25.0, 25.1, None)], "t double")
    found = [r[0] for r in df.select(col.cut("t", [0, 15, 25], ["Cold", "Mild", "Warm", "Hot"]))
             .collect()]
    assert found == ["Cold", "Cold", "Mild", "Mild", "Warm", "Hot", None]
    df = spark.createDataFrame([(101, 860), (101, 900), (50, 869), (100, 870), (None, None)],
                               "humidity int, pressure int")
    found = [r[0] for r in df.select(col.quality_flag()).collect()]
    assert found == ["Check pressure", "Check humidity", "Check pressure", "Good", "Good"]


def test_line_total_and_time(spark):
    df = spark.createDataFrame([("0.07", "3", "2024-01-02 03:04:05"), ("x", "1", "no")],
                               "price string, quantity string, at string")
    rows = df.select(col.line_total().alias("t"), col.parse_ts("at").alias("a")).collect()
    assert rows[0]["t"] == Decimal("0.21") and rows[0]["a"] == datetime(2024, 1, 2, 3, 4, 5)
    assert rows[1]["t"] is None and rows[1]["a"] is None


def test_zone_in_summer_and_winter(spark):
    df = spark.sql("select timestamp_ntz'2024-01-10 12:00:00' t union all "
                   "select timestamp_ntz'2024-07-10 12:00:00'")
    assert sorted(r[0].hour for r in df.select(col.to_zone("t")).collect()) == [7, 8]


@pytest.mark.parametrize("month,end", [(6, "2023-07-01"), (12, "2024-01-01")])
def test_month_filter(spark, month, end):
    df = spark.sql("select explode(sequence(date'2022-11-01', date'2024-02-28')) d")
    found = [r[0] for r in df.where(col.month_filter("d", 2023, month)).collect()]
    same = [r[0] for r in df.where(col.month_filter("d", 2023, month, "function")).collect()]
    assert found == same
    assert max(found) == date.fromisoformat(end) - timedelta(days=1) and min(found).day == 1


def test_order_patterns_ties(spark):
    rows = [(1, "2024-01-01 09:00:00", 10.0), (1, "2024-01-03 09:30:00", 20.0),
            (1, "2024-01-05 07:00:00", 30.0), (1, "2024-01-07 07:00:00", 40.0),
            (2, "2024-01-01 05:00:00", 5.0),
            (3, "2024-01-01 05:00:00", 5.0), (3, "2024-01-01 05:00:00", 5.0)]
    df = spark.createDataFrame(rows, "customer_id long, d string, total_amount double").select(
        "customer_id", F.col("d").cast("timestamp").alias("order_date"), "total_amount")
    found = {r["customer_id"]: r for r in
             agg.customer_order_patterns(agg.order_hours(df)).collect()}
    assert found[1]["peak_order_hour"] == 7
    assert found[1]["avg_days_between_orders"] == pytest.approx((6 - 2 / 24) / 3)
    assert found[2]["avg_days_between_orders"] is None
    assert found[3]["avg_days_between_orders"] is None


def test_fan_out_inflates_demand(spark):
    """Two hours of analytics per customer double the faithful sums, not the corrected ones."""
    inventory = spark.createDataFrame([(1, "p", "c", "w", 50.0, 7)],
                                      "product_id long, product_name string, city string, "
                                      "warehouse_code string, inventory_score double, quantity long")
    items = spark.createDataFrame([(10, 1, 3)], "order_id long, product_id long, quantity long")
    orders = spark.createDataFrame([(10, 5, date(2024, 1, 1)), (11, 5, date(2024, 1, 2))],
                                   "order_id long, customer_id long, order_date date")
    people = spark.createDataFrame([(5, "n")], "customer_id long, customer_name string")
    figures = spark.createDataFrame(
        [(5, 1, 8.0, 8.0, 0.0, 9), (5, 1, 4.0, 4.0, 0.0, 10)],
        "customer_id long, total_orders long, total_spent double, avg_order_value double, "
        "avg_days_between_orders double, peak_order_hour int")
    faithful = joins.business_insights(inventory, items, orders, people, figures,
                                       as_of="2024-01-05").first()
    assert (faithful["total_ordered"], faithful["number_of_orders"]) == (6, 1)
    assert faithful["customer_avg_order_value"] == 6.0
    patterns = spark.createDataFrame([(5, 6.0)], "customer_id long, avg_order_value double")
    once = joins.business_insights_by_customer(inventory, items, orders, patterns,
                                               as_of="2024-01-05").first()
    assert (once["total_ordered"], once["number_of_orders"]) == (3, 1)


def test_references(spark):
    child = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (9, "d"), (9, "e"), (None, "f")],
                                  "k long, v string")
    parent = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "p long")
    lost = joins.orphans(child, parent, "k", "p")
    assert sorted(r["v"] for r in lost.collect()) == ["d", "e"]
    report = quality.check_refs({"c": child, "p": parent, "e": child.limit(0)},
                                [("c", "k", "p", "p"), ("e", "k", "p", "p")]).collect()
    assert [tuple(r) for r in report] == [("c.k > p.p", 5, 2), ("e.k > p.p", 0, 0)]


def test_segments_match_ntile(spark):
    df = spark.createDataFrame([(i, i % 7, float(i * 37 % 101)) for i in range(1, 103)],
                               "customer_id long, total_orders long, total_spent double")
    df.createOrReplaceTempView("patterns_view")
    expected = spark.sql("""
        select customer_id, ntile(4) over (order by total_orders, customer_id) a,
               ntile(4) over (order by total_spent, customer_id) b from patterns_view""")
    found = agg.customer_segments(df).select("customer_id", F.col("frequency_segment").alias("a"),
                                             F.col("spend_segment").alias("b"))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    few = df.limit(3)
    assert agg.customer_segments(few).agg(F.max("spend_segment")).first()[0] == 3


def test_pit_rules(spark):
    view = FeatureView("v", ("k",), ("x",), timedelta(days=90))
    at = datetime(2024, 6, 1)
    rows = [
        (1, at, at, 1.0), (1, at, at + timedelta(hours=1), 2.0),          # same time: later created
        (2, at - timedelta(days=90), at, 3.0),                            # exactly at the limit
        (3, at - timedelta(days=91), at, 4.0),                            # expired
        (4, at + timedelta(seconds=1), at, 5.0),                          # in the future
        (5, at - timedelta(days=95), at, 6.0),
    ]
    source = spark.createDataFrame(rows, "k long, event_timestamp timestamp, created timestamp, "
                                         "x double")
    entities = spark.createDataFrame([(k, at) for k in (1, 2, 3, 4, 5, 6)],
                                     "k long, event_timestamp timestamp")
    found = features.get_historical_features(entities, ["v:x"], {"v": (view, source)})
    assert {r["k"]: r["x"] for r in found.collect()} == {
        1: 2.0, 2: 3.0, 3: None, 4: None, 5: None, 6: None}
    store = features.materialize_latest(view, source, None, at)
    latest = features.get_latest_features(entities.select("k"), ["v:x"], {"v": (view, store)}, at)
    assert {r["k"]: r["x"] for r in latest.collect()} == {
        1: 2.0, 2: 3.0, 3: None, 4: None, 5: None, 6: None}


def test_histogram_quantile(spark):
    rows = [(1.0, 0.0), (5.0, 10.0), (10.0, 20.0), (float("inf"), 20.0)]
    df = spark.createDataFrame([("a", *r) for r in rows] + [("b", *r) for r in
                               [(1.0, 0.0), (5.0, 1.0), (10.0, 1.0), (float("inf"), 20.0)]]
                               + [("c", le, 0.0) for le, _ in rows],
                               "k string, le double, value double")
    found = {r["k"]: r["quantile"] for r in
             alerts.histogram_quantile(df, 0.95, keys=["k"]).collect()}
    assert found == {"a": pytest.approx(9.5), "b": 10.0, "c": None}


def test_counter_reset_and_hold(spark):
    at = datetime(2024, 1, 1)
    values = [0, 30, 60, 5, 35, 65]
    rows = [("m", "s", at + timedelta(seconds=15 * i), float(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "metric string, series string, ts timestamp, value double")
    rate = alerts.counter_rate(df, 45)
    found = [r["rate"] * 45 for r in rate.orderBy("evaluated_at").collect()]
    # a range sees the increases between its own samples, and goes on after the last one
    assert found == pytest.approx([30, 60, 35, 35, 60, 30])
    held = alerts.alert_for(rate, F.col("rate") > 0.7, 45).orderBy("evaluated_at").collect()
    assert [r["active_seconds"] for r in held] == [None, 0, 15, 30, 45, None]
    assert [r["firing"] for r in held] == [False, False, False, False, True, False]


def sampled(spark, every, count, rise, metric="stock_current_price"):
    at = datetime(2024, 1, 1)
    rows = [(metric, "s", at + timedelta(seconds=every * i), float(rise * i)) for i in range(count)]
    return spark.createDataFrame(rows, "metric string, series string, ts timestamp, value double")


def test_alert_on_samples_sparser_than_the_step(spark):
    found = alerts.evaluate_alerts(sampled(spark, 60, 31, 10), alerts.RULES, bounds=[5.0])
    firing = [r["evaluated_at"] for r in found.where("firing").orderBy("evaluated_at").collect()]
    start = int(datetime(2024, 1, 1, tzinfo=timezone.utc).timestamp())
    # above the limit from the second sample, then five minutes without a break
    assert firing[0] - start == 60 + 300
    assert all(b - a == 15 for a, b in zip(firing, firing[1:]))
    # the range holds two samples until four minutes after the last one
    assert firing[-1] - start == 30 * 60 + 3 * 60 + 45


def test_notifications_repeat_after_a_full_interval(spark):
    times = [*range(3540, 7200, 60), *range(20000, 20600, 60)]
    df = spark.createDataFrame([("a", "m", "s", t, True) for t in times],
                               "alertname string, metric string, series string, "
                               "evaluated_at long, firing boolean")
    found = alerts.group_alerts(df, 3600, step=60).orderBy("sent_at").collect()
    assert [r["sent_at"] for r in found] == [3540, 7140, 20000]


def test_critical_silences_warning_between_samples(spark):
    rules = [alerts.Rule("X", "m", "delta", 300, 5.0, s, 60) for s in ("critical", "warning")]
    found = alerts.evaluate_alerts(sampled(spark, 60, 20, 10, "m"), rules, bounds=[5.0])
    left = alerts.inhibit(found).groupBy("severity").count().collect()
    assert [r["severity"] for r in left] == ["critical"] and left[0]["count"] > 50


def test_alert_gap_starts_anew(spark):
    df = spark.createDataFrame([("m", "s", t, 1.0) for t in (0, 15, 30, 90, 105)],
                               "metric string, series string, evaluated_at long, rate double")
    held = alerts.alert_for(df, F.col("rate") > 0, 15).orderBy("evaluated_at").collect()
    assert [r["active_seconds"] for r in held] == [0, 15, 30, 0, 15]


def test_drift_skips_short_columns_and_flags(spark):
    ref = spark.createDataFrame([(float(i), None if i else 1.0) for i in range(100)],
                                "a double, b double")
    cur = spark.createDataFrame([(float(i + 60), 1.0) for i in range(100)], "a double, b double")
    found = {r["column"]: r for r in quality.column_drift(ref, cur, ["a", "b"], test="ks").collect()}
    assert set(found) == {"a"}
    assert found["a"]["ks_statistic"] == pytest.approx(0.6)
    assert found["a"]["drifted"] and found["a"]["drift_score"] < 1e-9
    assert found["a"]["wasserstein"] * 28.866070047722118 == pytest.approx(60)
    calm = quality.column_drift(ref, ref, ["a"], test="ks").first()
    assert calm["p_value"] == 1.0 and not calm["drifted"] and calm["drift_score"] is None


def test_missing_report_of_nothing(spark):
    empty = spark.createDataFrame([], "a int, b string")
    assert {r["column"]: r["missing_ratio"] for r in quality.missing_report(empty).collect()} == {
        "a": None, "b": None, "*": None}


def test_market_signals_of_short_series(spark):
    rows = [("a", datetime(2024, 1, 1), 1, 10.0, 5.0), ("a", datetime(2024, 1, 2), 2, 11.0, 5.0),
            ("b", datetime(2024, 1, 1), 3, 10.0, 0.0)]
    df = spark.createDataFrame(rows, "symbol string, timestamp timestamp, id long, price double, "
                                     "volume double")
    order = ["timestamp", "id"]
    ticks = series.tick_indicators(df, order=order)
    assert {r["id"]: r["vwap"] for r in ticks.collect()} == {
        1: 10.0, 2: 10.5, 3: None}
    found = {r["symbol"]: r["signals"] for r in series.market_signals(ticks, order=order).collect()}
    assert [s["type"] for s in found["a"]] == ["MOMENTUM_BULLISH"] and found["b"] == []


def test_market_signals_after_a_price_of_zero(spark):
    """A rise from zero is a signal, and the volatility limit leaves out what is not finite."""
    calm = [10.0 + i % 2 for i in range(20)]
    prices = {"rise": calm + [0.0, 5.0], "zeros": calm + [0.0, 0.0],
              "later": calm[:5] + [0.0] + calm + [10.0, 40.0]}
    rows = [(k, datetime(2024, 1, 1 + i), i, p, 5.0) for k, ps in prices.items()
            for i, p in enumerate(ps)]
    df = spark.createDataFrame(rows, "symbol string, timestamp timestamp, id long, price double, "
                                     "volume double")
    order = ["timestamp", "id"]
    ticks = series.tick_indicators(df, order=order).cache()
    for symbol, values in prices.items():
        change = pd.Series(values).pct_change()
        found = ticks.where(F.col("symbol") == symbol).orderBy("id").collect()
        for name, want in (("price_momentum", change), ("volatility", change.rolling(10).std())):
            got = pd.Series([r[name] for r in found], dtype=float)
            assert got.isna().equals(want.isna())
            assert got.dropna().tolist() == pytest.approx(want.dropna().tolist(), abs=1e-9)
    found = {r["symbol"]: [(s["type"], s["value"]) for s in r["signals"]]
             for r in series.market_signals(ticks, order=order).collect()}
    assert found["rise"] == [("MOMENTUM_BULLISH", float("inf"))] and found["zeros"] == []
    assert [t for t, _ in found["later"]] == ["HIGH_VOLATILITY", "MOMENTUM_BULLISH"]


def test_first_n_beyond_the_map_side_limit(spark):
    df = spark.range(3000).select((F.col("id") % 2).alias("k"), "id")
    found = series.first_n(df, ["k"], ["id"], 1200)
    assert found.groupBy("k").agg(F.count("id"), F.max("id")).orderBy("k").collect() == [
        (0, 1200, 2398), (1, 1200, 2399)]


def test_category_tree_deeper_than_two(spark):
    rows = [("a", None, "A"), ("b", "a", "B"), ("c", "b", "C"), ("z", None, "Z")]
    df = spark.createDataFrame(rows, "category_id string, parent_category_id string, "
                                     "category_name string")
    found = {r["category_id"]: (r["root_name"], r["depth"], r["path"])
             for r in warehouse.category_paths(df).collect()}
    assert found["c"] == ("A", 2, "A > B > C") and found["z"] == ("Z", 0, "Z")


def test_deep_trees_rings_and_lost_parents(spark):
    rows = [(f"n{i}", f"n{i - 1}" if i else None, str(i)) for i in range(70)]
    rows += [("r1", "r2", "R"), ("r2", "r1", "R"), ("below", "r1", "B"), ("lost", "nowhere", "L"),
             ("under", "lost", "U")]
    df = spark.createDataFrame(rows, "category_id string, parent_category_id string, "
                                     "category_name string")
    found = {r["category_id"]: r for r in warehouse.category_paths(df).collect()}
    assert set(found) == {f"n{i}" for i in range(70)}
    assert found["n69"]["depth"] == 69 and found["n69"]["root_name"] == "0"
    assert found["n69"]["path"] == " > ".join(map(str, range(70)))


def test_nan_is_missing(spark):
    nan = float("nan")
    df = spark.createDataFrame([("k", i, v, 1.0) for i, v in enumerate([nan, 1.0, nan, None, 4.0])],
                               "k string, t int, v double, volume double")
    report = {r["column"]: r["missing"] for r in quality.missing_report(df, ["v", "t"]).collect()}
    assert report == {"v": 3, "t": 0, "*": 3}
    assert quality.row_metrics(df, "k", ["v"]).first()["missing_values"] == 3
    filled = series.ffill_bfill(df, ["v"], keys=["k"], order=["t"]).orderBy("t").collect()
    assert [r["v"] for r in filled] == [1.0, 1.0, 1.0, 1.0, 4.0]
    drift = quality.column_drift(df, df, ["v"], test="wasserstein").first()
    assert drift["n_ref"] == 2 and drift["wasserstein"] == 0.0


def test_null_keys_match_nothing(spark):
    at = datetime(2024, 1, 1)
    entities = spark.createDataFrame([(None, at, 1), ("a", at, 2)],
                                     "k string, event_timestamp timestamp, n int")
    rows = spark.createDataFrame([(None, at, at, 9.0), ("a", at, at, 5.0), ("a", at, at, 6.0)],
                                 "k string, event_timestamp timestamp, created timestamp, f double")
    found = {r["n"]: r["f"] for r in
             features.pit_join(entities, rows, ["k"], ["f"], timedelta(days=1)).collect()}
    assert found == {1: None, 2: 6.0}


def test_fact_sales_shares_order_costs(spark):
    orders = spark.createDataFrame([(1, 20240101, 7, 3, "O", 10.0, 4.0)],
                                   "order_id long, order_date_id int, customer_id long, "
                                   "location_id long, status_id string, shipping_cost double, "
                                   "tax_amount double")
    items = spark.createDataFrame([(1, 1, 9, 1, 30.0, 0.0, 30.0), (2, 1, 8, 1, 10.0, 0.0, 10.0)],
                                  "order_item_id long, order_id long, product_id long, "
                                  "quantity long, unit_price double, discount_amount double, "
                                  "total_price double")
    states = spark.createDataFrame([("O", "open")], "status_id string, status_name string")
    found = {r["order_item_id"]: r for r in
             warehouse.build_fact_sales(orders, items, states).collect()}
    assert [found[i]["shipping_cost"] for i in (1, 2)] == [7.5, 2.5]
    assert [found[i]["tax_amount"] for i in (1, 2)] == [3.0, 1.0]


def test_fingerprint_ignores_order_only(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "")], "i int, s string")
    base = learning.fingerprint(df).first()
    assert learning.fingerprint(df.orderBy(F.desc("i")).repartition(3)).first() == base
    swapped = spark.createDataFrame([(1, "a"), (2, ""), (3, None)], "i int, s string")
    assert learning.fingerprint(swapped).first() != base
    assert learning.fingerprint(df.union(df.limit(1))).first() != base
    assert learning.fingerprint(df.withColumnRenamed("i", "j")).first() != base
    assert learning.fingerprint(df.select(F.col("i").cast("long"), "s")).first() != base
    split = spark.createDataFrame([("a\u0001=b", "c")], "x string, y string")
    other = spark.createDataFrame([("a", "b\u0001=c")], "x string, y string")
    assert learning.fingerprint(split).first() != learning.fingerprint(other).first()


def test_split_is_stable(spark):
    df = spark.range(2000)
    train, test = learning.train_test_split(df, ["id"])
    again, _ = learning.train_test_split(df.repartition(7), ["id"])
    assert train.count() + test.count() == 2000 and 300 < test.count() < 500
    assert train.exceptAll(again).isEmpty()


def test_insights_equal_the_view_they_stand_for(spark):
    """Two products of one name, orders that hold both, customers with several or no figures."""
    chance = random.Random(2)
    stock = spark.createDataFrame(
        [(p, "tea" if p < 3 else f"p{p}", 5, 10, c, None if c == "B" else c, 0.5)
         for p in range(6) for c in "ABB"],
        "product_id long, product_name string, quantity int, capacity int, city string, "
        "warehouse_code string, inventory_score double")
    orders = spark.createDataFrame(
        [(i, chance.randint(0, 5), date(2024, 1, 1) + timedelta(days=i % 40)) for i in range(60)],
        "order_id long, customer_id long, order_date date")
    items = spark.createDataFrame(
        [(chance.randint(0, 59), chance.randint(0, 6), chance.randint(1, 9)) for _ in range(300)],
        "order_id long, product_id long, quantity int")
    customers = spark.createDataFrame([(c, f"c{c}") for c in range(5)],
                                      "customer_id long, customer_name string")
    figures = spark.createDataFrame(
        [(c, 3, 1.0, None if h == 1 else c + h / 3, 2.0, h) for c in (0, 1, 2, 5) for h in range(c + 1)],
        "customer_id long, total_orders int, total_spent double, avg_order_value double, "
        "avg_days_between_orders double, peak_order_hour int")
    args = (stock, items, orders, customers, figures)
    found = joins.business_insights(*args, as_of="2024-02-09")
    keys = ["product_name", "city", "warehouse_code", "inventory_score"]
    rows = joins.business_analytics(*args, as_of="2024-02-09").groupBy(*keys, "quantity").agg(
        F.sum("ordered_quantity").alias("total"), F.count_distinct("order_id").alias("orders"),
        F.avg(F.col("avg_order_value").cast("decimal(18,6)")).alias("mean"))
    want = {tuple(r)[:5]: tuple(r)[5:] for r in rows.collect()}
    got = {tuple(r)[:4] + (r["current_stock"],): r for r in found.collect()}
    assert got.keys() == want.keys() and len(got) == 8
    for key, (total, orders_, mean) in want.items():
        assert (got[key]["total_ordered"], got[key]["number_of_orders"]) == (total, orders_)
        assert got[key]["customer_avg_order_value"] == pytest.approx(float(mean), rel=1e-6)


def test_changed_keys_and_ranges(spark):
    """Copies count, a null key is a key, and only leaves that differ are told."""
    old = [(i, "a") for i in range(1000)] + [(None, "n"), (7, "a")]
    new = [(i, "b" if i == 500 else "a") for i in range(1000) if i != 20] + [(None, "m"), (4000, "a")]
    old, new = (spark.createDataFrame(r, "k long, v string").repartition(n) for r, n in ((old, 2), (new, 5)))
    found = learning.changed_keys(old, new, "k", width=16).collect()
    assert {(r["k"], r["change"]) for r in found} == {
        (500, "changed"), (20, "removed"), (4000, "added"), (7, "changed"), (None, "changed")}
    trees = [learning.digest_tree(d, "k", width=16, fanout=8, levels=3) for d in (old, new)]
    told = {(r["level"], r["node"]) for r in learning.changed_ranges(*trees).collect()}
    leaves = {0, 1, 31, 250}
    assert told == {(level, n // 8 ** level) for n in leaves for level in range(3)} | {
        (level, None) for level in range(3)}
    assert learning.changed_keys(old, old.repartition(7), "k").isEmpty()
    empty = old.where("false")
    assert learning.changed_keys(empty, empty, "k").isEmpty()
    assert learning.changed_keys(empty, new, "k").where("change <> 'added'").isEmpty()


def test_forest_learns_what_the_columns_tell(spark):
    from conftest import SMALL
    from millrace.plans import QUERIES

    got = {(r["label"], r["metric"]): r["value"] for r in
           QUERIES["forest_accuracy"](spark, SMALL).collect()}
    for side in ("train", "test"):
        assert got["price class", f"{side}_accuracy"] > got["price class", "train_majority"] + 0.2
    assert got["return flag", "fitted_accuracy"] > 0.9
    assert got["price class", "reloaded_agrees"] >= 0.99 and got["return flag", "reloaded_agrees"] >= 0.99


def test_forest_predicts_cells_as_it_predicts_rows(spark):
    """Counts by cells equal counts over row-wise predictions, at split points too."""
    rng = random.Random(3)
    rows = [(float(rng.randint(0, 40)), rng.random(), rng.choice("ab")) for _ in range(400)]
    df = spark.createDataFrame(rows, "x double, y double, l string").withColumn(
        "m", F.when(F.col("x") + 10 * F.col("y") > 25, "big").otherwise("small"))
    models = {f"said_{c}": learning.train_forest(df, ["x", "y"], c, trees=7) for c in "lm"}
    points = learning.split_points(list(models.values()), 2)
    assert all(0 < len(p) <= 31 for p in points)
    borders = spark.createDataFrame([(a + d, b, "a", "big") for a in points[0] for b in points[1]
                                     for d in (0.0, 1e-9, -1e-9)], df.schema)
    rows = df.unionByName(borders).unionByName(spark.createDataFrame(
        [(float("inf"), float("-inf"), None, "small"), (-0.0, 0.0, "new", "small")], df.schema))
    want = rows
    for name, model in models.items():
        labels = F.array(*[F.lit(v) for v in model.stages[0].labels])
        want = model.transform(want).select(
            *want.columns, F.get(labels, F.col("prediction").cast("int")).alias(name))
    want = want.groupBy("l", "m", *models).agg(F.count(F.lit(1)).alias("rows"))
    found = learning.predicted_rows(models, rows, ["x", "y"], ["l", "m"])
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))


def test_train_forest_evaluates_and_compares_the_reloaded_model(spark):
    from conftest import SMALL
    from millrace.plans import QUERIES

    found = QUERIES["train_forest"](spark, SMALL).collect()
    assert {(r["label"], r["side"]) for r in found} == {
        (label, side) for label in ("return flag", "price class") for side in ("train", "test")}
    assert all(r["rows"] == r["predicted_rows"] == r["agreeing_rows"] for r in found)
    assert {(r["label"], r["beats_majority"]) for r in found} == {
        ("return flag", None), ("price class", True)}


def test_rollups_come_from_their_smallest_parent(spark):
    base = spark.createDataFrame(
        [(a, b, c, Decimal("1.25"), 2, 1) for a in "xy" for b in (1, 2, None) for c in (True, False)] * 3,
        "a string, b int, c boolean, total_amount decimal(18,2), total_quantity long, line_count long")
    wanted = {"ab": ["a", "b"], "a": ["a"], "c": ["c"], "all": []}
    made = warehouse.rollup_lattice(base, wanted)
    for name, keys in wanted.items():
        direct = base.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in (
            "total_amount", "total_quantity", "line_count")])
        assert sorted(map(str, made[name].collect())) == sorted(map(str, direct.collect()))
        assert made[name].schema["total_amount"].dataType == base.schema["total_amount"].dataType
    assert made["ab"].where("b is null").count() == 2
