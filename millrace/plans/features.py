"""Feature retrieval, dataset identity and the classifier."""

from __future__ import annotations

from collections import Counter
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import is_weekend, money
from millrace.operators import features as ft
from millrace.operators import forest, learning, series
from millrace.plans.registry import query, table
from millrace.session import materialize, scratch
from millrace.streaming.ingest import land_in_batches, run_available
from millrace.streaming.store import read_current, upsert_latest

CLICKS = ft.FeatureView("clicks", ("customer_id",), ("click_value", "click_id"),
                        timedelta(days=90))
VIEWS = ft.FeatureView("views", ("customer_id",), ("view_value",), timedelta(days=1))
SERVICE = ft.FeatureService("recommendation", ("clicks:click_value", "clicks:click_id",
                                               "views:view_value"))


def _events(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return table(spark, sf_dir, "events").where(F.col("event_type") == kind).select(
        F.col("user_id").alias("customer_id"), F.col("ts").alias("event_timestamp"),
        F.col("ts").alias("created"), "event_id", "value")


def click_rows(spark, sf_dir):
    return _events(spark, sf_dir, "click").withColumnsRenamed(
        {"value": "click_value", "event_id": "click_id"})


def view_rows(spark, sf_dir):
    return _events(spark, sf_dir, "view").withColumnRenamed("value", "view_value")


def buyers(spark, sf_dir):
    return _events(spark, sf_dir, "purchase").select("customer_id", "event_timestamp", "event_id")


def _asof(kind: str, days: int) -> str:
    return f"""ASOF LEFT JOIN (SELECT user_id, ts, event_id, value FROM events
        WHERE event_type = '{kind}') {kind} ON {kind}.user_id = e.user_id AND {kind}.ts <= e.ts"""


def _fresh(kind: str, days: int, col: str) -> str:
    return f"CASE WHEN {kind}.ts >= e.ts - INTERVAL {days} DAY THEN {kind}.{col} END"


@query("pit_join", f"""
    SELECT e.user_id AS customer_id, e.ts AS event_timestamp, e.event_id,
           {_fresh('view', 1, 'value')} AS view_value
    FROM events e {_asof('view', 1)} WHERE e.event_type = 'purchase'
""")
def pit_join(spark, sf_dir):
    return ft.pit_join(buyers(spark, sf_dir), view_rows(spark, sf_dir), ["customer_id"],
                       ["view_value"], timedelta(days=1))


@query("pit_join_null_keys", f"""
    SELECT CASE WHEN e.event_id % 5 > 0 THEN e.user_id END AS customer_id, e.ts AS event_timestamp,
           e.event_id, CASE WHEN e.event_id % 5 > 0 THEN {_fresh('view', 1, 'value')} END AS view_value
    FROM events e {_asof('view', 1)} WHERE e.event_type = 'purchase'
""")
def pit_join_null_keys(spark, sf_dir):
    """Entities of unknown key, next to feature rows of unknown key."""
    known = F.when(F.col("event_id") % 5 > 0, F.col("customer_id"))
    views = view_rows(spark, sf_dir)
    lost = views.where(F.col("event_id") % 7 == 0).withColumn(
        "customer_id", F.lit(None).cast("long"))
    return ft.pit_join(buyers(spark, sf_dir).withColumn("customer_id", known),
                       views.unionByName(lost), ["customer_id"], ["view_value"], timedelta(days=1))


@query("historical_features", f"""
    SELECT e.user_id AS customer_id, e.ts AS event_timestamp, e.event_id,
           {_fresh('click', 90, 'value')} AS click_value,
           {_fresh('click', 90, 'event_id')} AS click_id,
           {_fresh('view', 1, 'value')} AS view_value
    FROM events e {_asof('click', 90)} {_asof('view', 1)} WHERE e.event_type = 'purchase'
""")
def historical_features(spark, sf_dir):
    views = {"clicks": (CLICKS, click_rows(spark, sf_dir)),
             "views": (VIEWS, view_rows(spark, sf_dir))}
    return ft.get_historical_features(buyers(spark, sf_dir), SERVICE, views)


_MIDDLE, _END = "2024-01-15 00:00:00", "2024-01-25 00:00:00"
LATEST_CLICKS = f"""(SELECT user_id AS customer_id, ts AS event_timestamp, ts AS created,
    value AS click_value, event_id AS click_id FROM events
    WHERE event_type = 'click' AND ts <= TIMESTAMP '{_END}'
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1)"""


def _time(text: str):
    return F.lit(text).cast("timestamp_ntz")


@query("materialize", f"SELECT * FROM {LATEST_CLICKS} c")
def materialize_views(spark, sf_dir):
    """A store filled up to the middle of the month, then folded forward to its end."""
    source = click_rows(spark, sf_dir)
    store = materialize(ft.materialize_latest(CLICKS, source, None, _time(_MIDDLE)), "store")
    return ft.materialize_latest(CLICKS, source, _time(_MIDDLE), _time(_END), store)


@query("stream_materialize", f"SELECT * FROM {LATEST_CLICKS} c")
def stream_materialize(spark, sf_dir):
    """The same store kept by a stream of feature rows."""
    path, keys, order = scratch(spark, "store"), ["customer_id"], ["event_timestamp", "created"]
    rows = table(spark, sf_dir, "events").where(
        (F.col("event_type") == "click") & (F.col("ts") <= _time(_END))).select(
        F.col("user_id").alias("customer_id"), F.col("ts").alias("event_timestamp"),
        F.col("ts").alias("created"), F.col("value").alias("click_value"),
        F.col("event_id").alias("click_id"))
    run_available(upsert_latest(land_in_batches(rows, scratch(spark, "feature_rows")), path, keys,
                                order, scratch(spark, "checkpoint")))
    return read_current(spark, path, keys, order, by_arrival=False)


@query("latest_features", f"""
    SELECT c_custkey AS customer_id, click_value, click_id
    FROM customer LEFT JOIN {LATEST_CLICKS} c ON c_custkey = customer_id
""")
def latest_features(spark, sf_dir):
    keys = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"))
    stores = {"clicks": (CLICKS, materialize_views(spark, sf_dir))}
    return ft.get_latest_features(keys, ["clicks:click_value", "clicks:click_id"], stores, _END)


@query("latest_per_key", """
    SELECT event_id, ts, user_id, event_type, value, props FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def latest_per_key(spark, sf_dir):
    return series.latest_per_key(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"])


@query("is_weekend_feature", """
    SELECT event_id, CAST(isodow(ts) >= 6 AS INT) AS is_weekend FROM events
""")
def is_weekend_feature(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", is_weekend("ts").alias("is_weekend"))


# -- data and model versions ------------------------------------------------------------------

@query("dataset_fingerprint", """
    SELECT count(*) AS rows,
           md5('o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:decimal(18,2),'
               || 'o_orderpriority:string') AS schema_digest,
           sum(('0x' || substr(md5(length(a) || ':' || a || length(b) || ':' || b
               || length(c) || ':' || c || length(d) || ':' || d || length(e) || ':' || e),
               1, 15))::BIGINT)::VARCHAR AS digest
    FROM (SELECT o_orderkey::VARCHAR AS a, o_custkey::VARCHAR AS b, o_orderstatus AS c,
                 o_totalprice::DECIMAL(18,2)::VARCHAR AS d, o_orderpriority AS e FROM orders)
""")
def dataset_fingerprint(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("o_totalprice", money("o_totalprice"))
    return learning.fingerprint(orders, ["o_orderkey", "o_custkey", "o_orderstatus",
                                         "o_totalprice", "o_orderpriority"])


CUT = "1999-06-16"  # orders before that day are the older version of the table


def _metrics_sql(rows: str) -> str:
    return f"""(
    SELECT 'orders' AS metric, count(*)::DOUBLE AS value FROM {rows}
    UNION ALL SELECT 'status_' || o_orderstatus, count(*)::DOUBLE FROM {rows} GROUP BY 1)"""


@query("metrics_diff", f"""
    WITH older AS (SELECT * FROM orders WHERE o_orderdate < DATE '{CUT}')
    SELECT coalesce(a.metric, b.metric) AS metric, a.value AS old, b.value AS new,
           b.value - a.value AS change
    FROM {_metrics_sql('older')} a FULL JOIN {_metrics_sql('orders')} b ON a.metric = b.metric
""")
def metrics_diff(spark, sf_dir):
    """The orders up to a day against all orders."""
    def metrics(orders: DataFrame) -> DataFrame:
        states = orders.groupBy(F.concat(F.lit("status_"), "o_orderstatus").alias("metric")).agg(
            F.count(F.lit(1)).cast("double").alias("value"))
        return orders.agg(F.lit("orders").alias("metric"),
                          F.count(F.lit(1)).cast("double").alias("value")).unionByName(states)

    orders = table(spark, sf_dir, "orders")
    return learning.metrics_diff(metrics(orders.where(F.col("o_orderdate") < _time(CUT))),
                                 metrics(orders))


def order_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two versions of the orders that together cover the table: the older one lacks the orders that
    came later, the newer one lacks some that were taken back and has others corrected."""
    orders = table(spark, sf_dir, "orders").withColumn("o_totalprice", money("o_totalprice"))
    key, state = F.col("o_orderkey"), F.col("o_orderstatus")
    return (orders.where(F.col("o_orderdate") < _time(CUT)),
            orders.where(key % 1013 != 0).withColumn(
                "o_orderstatus", F.when(key % 997 == 5, F.lit("X")).otherwise(state)))


@query("changed_keys", f"""
    SELECT o_orderkey, CASE WHEN o_orderdate >= DATE '{CUT}' THEN 'added'
                            WHEN o_orderkey % 1013 = 0 THEN 'removed' ELSE 'changed' END AS change
    FROM orders WHERE CASE WHEN o_orderdate >= DATE '{CUT}' THEN o_orderkey % 1013 <> 0
                           ELSE o_orderkey % 1013 = 0 OR o_orderkey % 997 = 5 END
""")
def changed_keys(spark, sf_dir):
    return learning.changed_keys(*order_versions(spark, sf_dir), "o_orderkey", width=64)


@query("changed_ranges", f"""
    WITH c AS (SELECT DISTINCT o_orderkey // 64 AS leaf FROM orders
               WHERE CASE WHEN o_orderdate >= DATE '{CUT}' THEN o_orderkey % 1013 <> 0
                          ELSE o_orderkey % 1013 = 0 OR o_orderkey % 997 = 5 END)
    SELECT DISTINCT level::INT AS level, leaf // (16 ** level)::BIGINT AS node
    FROM c, (VALUES (0), (1), (2)) v(level)
""")
def changed_ranges(spark, sf_dir):
    """The ranges of keys that differ, from stored trees of both versions."""
    trees = [materialize(learning.digest_tree(v, "o_orderkey", width=64, levels=3), "tree")
             for v in order_versions(spark, sf_dir)]
    return learning.changed_ranges(*trees)


@query("train_test_split", """
    SELECT CASE WHEN ('0x' || substr(md5('42|' || l_orderkey || '|' || l_linenumber || '|'
                       || l_partkey), 1, 8))::BIGINT % 1000000 < 200000
                THEN 'test' ELSE 'train' END AS side, l_returnflag AS target, count(*) AS rows
    FROM lineitem GROUP BY 1, 2
""")
def train_test_split(spark, sf_dir):
    """Rows per side and label."""
    lines = _lines(spark, sf_dir)
    train, test = learning.train_test_split(lines, _KEYS)
    sides = train.withColumn("side", F.lit("train")).unionByName(
        test.withColumn("side", F.lit("test")))
    return sides.groupBy("side", "target").agg(F.count(F.lit(1)).alias("rows"))


_KEYS = ["l_orderkey", "l_linenumber", "l_partkey"]
_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "line_age"]


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric columns of the lines; the return flag is the label."""
    return table(spark, sf_dir, "lineitem").select(
        *_KEYS, "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        F.datediff(F.lit("2001-12-31").cast("date"), F.to_date("l_shipdate")).cast("double")
        .alias("line_age"), F.col("l_returnflag").alias("target"))


_SPLIT_SQL = """(
    SELECT ('0x' || substr(md5('42|' || l_orderkey || '|' || l_linenumber || '|' || l_partkey),
                           1, 8))::BIGINT % 1000000 < 200000 AS test,
           l_returnflag AS target,
           CASE WHEN l_extendedprice * (1 - l_discount) < 20000 THEN 'small'
                WHEN l_extendedprice * (1 - l_discount) < 60000 THEN 'medium'
                ELSE 'large' END AS size FROM lineitem)"""


_LABELS = {"return flag": "target", "price class": "size"}


def _fitted(spark: SparkSession, sf_dir: str) -> tuple:
    """Rows with their side, the rows of the training side, all of which were fitted, and per label the
    model and its reloaded copy."""
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    lines = _lines(spark, sf_dir).withColumn("size", F.when(net < 20000, "small").when(
        net < 60000, "medium").otherwise("large"))
    train, test = learning.train_test_split(lines, _KEYS)
    fitted = materialize(train, "fitted")
    points, models = forest.candidate_points(fitted, _FEATURES), {}
    for name, label in _LABELS.items():
        model = learning.train_forest(fitted, _FEATURES, label, points=points)
        path = scratch(spark, "model")
        learning.save_model(model, path)
        models[name] = model, learning.PipelineModel.load(path)
    sides = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return sides, fitted, models


def _copies(models: dict) -> dict:
    return {f"{copy}_{label}": model for name, label in _LABELS.items()
            for copy, model in zip(("stored", "loaded"), models[name])}


@query("train_forest", f"""
    WITH s AS (SELECT CASE WHEN test THEN 'test' ELSE 'train' END AS side, target, size
               FROM {_SPLIT_SQL} s),
    l AS (SELECT 'return flag' AS label, side, target FROM s
          UNION ALL SELECT 'price class', side, size FROM s)
    SELECT label, side, target, count(*) AS rows, count(*)::DOUBLE AS predicted_rows,
           count(*) AS agreeing_rows,
           CASE WHEN label = 'price class' THEN true END AS beats_majority
    FROM l GROUP BY 1, 2, 3
""")
def train_forest(spark, sf_dir):
    """Two classifiers learnt, stored, reloaded, predicted and evaluated on both sides, for the return
    flag, which the columns do not tell, and for a class of net price, which they do. Rows per label,
    side and class, how many of them got a label predicted, on how many stored and reloaded model
    agree, and for the class of price whether the side's accuracy is above the share of its most
    frequent class. The accuracies are in `forest_accuracy`."""
    sides, _, models = _fitted(spark, sf_dir)
    found = materialize(learning.predicted_rows(
        _copies(models), sides, _FEATURES, ["side", *_LABELS.values()]), "predicted")
    rows, frames = F.col("rows"), []
    for name, label in _LABELS.items():
        stored, loaded = F.col(f"stored_{label}"), F.col(f"loaded_{label}")
        classes = found.groupBy("side", F.col(label).alias("target")).agg(
            F.sum("rows").alias("rows"),
            F.sum(F.when(loaded.isNotNull(), rows).otherwise(0)).cast("double").alias("predicted_rows"),
            F.sum(F.when(stored == loaded, rows).otherwise(0)).alias("agreeing_rows"),
            F.sum(F.when(loaded == F.col(label), rows).otherwise(0)).alias("_right"))
        of_side = classes.groupBy("side").agg(
            (F.sum("_right") > F.max("rows")).alias("beats_majority"))
        told = F.col("beats_majority") if name == "price class" else F.lit(None).cast("boolean")
        frames.append(classes.join(of_side, "side").select(
            F.lit(name).alias("label"), "side", "target", "rows", "predicted_rows", "agreeing_rows",
            told.alias("beats_majority")))
    return frames[0].unionByName(frames[1])


@query("forest_accuracy")
def forest_accuracy(spark, sf_dir):
    """Accuracies of the reloaded model on both sides and on the rows it was fitted on, the share of
    the most frequent label, and the share of fitted rows on which stored and reloaded model agree;
    for the return flag, which the columns do not tell, and for a class of net price, which they do.
    The rows that are fitted are those of the training side, so their accuracy is found twice."""
    sides, fitted, models = _fitted(spark, sf_dir)
    found = learning.predicted_rows(_copies(models), sides, _FEATURES,
                                    ["side", *_LABELS.values()]).collect()
    frames = []
    for name, label in _LABELS.items():
        right, all_rows, classes, agree = Counter(), Counter(), Counter(), 0
        for r in found:
            all_rows[r["side"]] += r["rows"]
            right[r["side"]] += r["rows"] * (r[label] is not None and r[f"loaded_{label}"] == r[label])
            if r["side"] == "train":
                classes[r[label]] += r["rows"]
                agree += r["rows"] * (r[f"stored_{label}"] == r[f"loaded_{label}"])
        rows = [(f"{side}_accuracy", right[side] / all_rows[side] if all_rows[side] else None)
                for side in ("train", "test")]
        rows += [("fitted_accuracy", learning.accuracy(models[name][1], fitted)),
                 ("train_majority", max(classes.values()) / sum(classes.values())),
                 ("reloaded_agrees", agree / all_rows["train"])]
        frames.append(spark.createDataFrame(rows, "metric string, value double").withColumn(
            "label", F.lit(name)))
    return frames[0].unionByName(frames[1])
