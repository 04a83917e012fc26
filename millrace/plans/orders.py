"""Order messages: parsing, routing, the keyed table and its upkeep."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import line_total as total_of
from millrace.functions.columns import money, parse_ts, route
from millrace.operators.aggregates import partition_counts as count_partitions
from millrace.operators.series import first_n
from millrace.plans.registry import query, table
from millrace.plans.sales import HIGH, STATS_SQL
from millrace.session import scratch
from millrace.streaming import ingest, store
from millrace.streaming import orders as stream

_FORMAT = "yyyy-MM-dd HH:mm:ss"
BATCHES = 4
MESSAGE_ROWS = 100_000  # messages in a landed file, about; a compressed file is one task's


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as orders of one product. Several lines share an id, so some orders arrive again; one
    kind of line has an unreadable quantity."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_name")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_returnflag", "l_linestatus", "l_shipdate")
    broken = (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_id"),
        F.concat(F.lit("Buyer "), "l_suppkey").alias("customer_name"),
        F.concat_ws("_", "p_type", "p_name").alias("product"), F.col("p_type").alias("category"),
        F.when(broken, "n/a").otherwise(F.col("l_quantity").cast("int").cast("string"))
        .alias("quantity"),
        money("l_extendedprice").alias("price"),
        F.date_format("l_shipdate", _FORMAT).alias("timestamp"))


MESSAGES = """(SELECT l_orderkey || '-' || l_linenumber AS order_id,
    'Buyer ' || l_suppkey AS customer_name, p_type || '_' || p_name AS product,
    p_type AS category, l_quantity::INT AS quantity, l_extendedprice AS price,
    date_trunc('second', l_shipdate) AS timestamp, l_returnflag = 'N' AND l_linestatus = 'F' AS bad,
    (('0x' || substr(md5(p_type || '_' || p_name), 1, 8))::BIGINT % 3)::INT AS partition
    FROM lineitem JOIN part ON l_partkey = p_partkey)"""
STORED = f"""(SELECT order_id, partition, customer_name, product, category, quantity, price,
    timestamp, (price::DECIMAL(10,2) * quantity)::DOUBLE AS total_amount FROM {MESSAGES} m
    WHERE NOT bad
    QUALIFY row_number() OVER (PARTITION BY partition, order_id ORDER BY timestamp DESC,
            price::DECIMAL(10,2) * quantity DESC, product DESC, customer_name DESC) = 1)"""


def _landed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders as landed JSON lines, read as a stream."""
    path = scratch(spark, "orders_topic")
    # Dealt out at random, so every batch mixes times and copies meet across batches. A line is one
    # message; counting lines reads no column and joins nothing.
    messages = stream.to_messages(order_rows(spark, sf_dir), "product").select("value")
    files = max(1, -(-table(spark, sf_dir, "lineitem").count() // (BATCHES * MESSAGE_ROWS)))
    messages.repartition(BATCHES * files).write.option("compression", "gzip").text(path)
    return stream.order_stream(spark, {"format": "text", "path": path}, files)


def _run_upsert(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    path, dead = scratch(spark, "order_table"), scratch(spark, "dead_letters")
    ingest.run_available(stream.upsert_stream(_landed_messages(spark, sf_dir), path, dead,
                                              scratch(spark, "checkpoint")))
    return path, dead


def order_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = _run_upsert(spark, sf_dir)
    current = store.read_current(spark, path, stream.KEYS, stream.ORDER_BY, by_arrival=False)
    return current.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query("stream_upsert", f"SELECT * FROM {STORED} s")
def stream_upsert(spark, sf_dir):
    return order_table(spark, sf_dir)


@query("dead_letter", f"""
    SELECT order_id, product FROM {MESSAGES} m WHERE bad
""")
def dead_letter(spark, sf_dir):
    _, dead = _run_upsert(spark, sf_dir)
    return spark.read.parquet(dead).select(
        F.get_json_object("value", "$.order_id").alias("order_id"),
        F.get_json_object("value", "$.product").alias("product"))


@query("partition_counts", f"""
    SELECT partition, count(*) AS order_count FROM {STORED} s GROUP BY 1
""")
def partition_counts(spark, sf_dir):
    return count_partitions(order_table(spark, sf_dir))


@query("limit_per_partition", f"""
    SELECT * FROM {STORED} s
    QUALIFY row_number() OVER (PARTITION BY partition ORDER BY order_id) <= 10
""")
def limit_per_partition(spark, sf_dir):
    return first_n(order_table(spark, sf_dir), ["partition"], ["order_id"], 10)


@query("limit_one_partition", f"""
    SELECT * FROM {STORED} s WHERE partition = 1 ORDER BY order_id LIMIT 10
""")
def limit_one_partition(spark, sf_dir):
    return stream.sample_partition(order_table(spark, sf_dir), 1, 10)


@query("stream_order_enrich", f"""
    SELECT order_id, partition, customer_name, product, category, quantity, price, timestamp,
           (price::DECIMAL(10,2) * quantity)::DOUBLE AS total_amount
    FROM {MESSAGES} m WHERE NOT bad
""")
def stream_order_enrich(spark, sf_dir):
    path = scratch(spark, "enriched")
    good, _ = stream.split_bad(_landed_messages(spark, sf_dir))
    ingest.run_available(stream.enrich_orders(good).writeStream.format("parquet").option(
        "path", path).option("checkpointLocation", scratch(spark, "checkpoint")))
    return spark.read.parquet(path).withColumn(
        "timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query("stream_dedup", f"SELECT DISTINCT order_id FROM {MESSAGES} m WHERE NOT bad")
def stream_dedup(spark, sf_dir):
    path = scratch(spark, "unique_orders")
    good, _ = stream.split_bad(_landed_messages(spark, sf_dir))
    unique = stream.dedup(stream.enrich_orders(good).select("order_id"), "order_id", "1 hour")
    ingest.run_available(unique.writeStream.format("parquet").option(
        "path", path).option("checkpointLocation", scratch(spark, "checkpoint")))
    return spark.read.parquet(path)


@query("stream_publish", f"SELECT order_id, product, price FROM {MESSAGES} m")
def stream_publish(spark, sf_dir):
    """A stream published as messages and read back by the schema of an order."""
    rows, topic = scratch(spark, "order_rows"), scratch(spark, "published")
    source = order_rows(spark, sf_dir)
    source.write.parquet(rows)
    ingest.run_available(stream.publish(
        ingest.file_stream(spark, rows, source.schema), "product",
        {"format": "text", "path": topic}, scratch(spark, "checkpoint")))
    parsed = spark.read.text(topic).select(F.from_json("value", stream.ORDER).alias("o"))
    return parsed.select("o.order_id", "o.product",
                         F.col("o.price").cast("decimal(18,2)").alias("price"))


@query("stream_daily_stats", STATS_SQL)
def stream_daily_stats(spark, sf_dir):
    path = scratch(spark, "daily_stats")
    rows = ingest.land_in_batches(table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("sale_date"), money("o_totalprice").alias("amount")),
        scratch(spark, "order_files"), BATCHES)
    ingest.run_available(stream.stream_daily_stats(rows, path, scratch(spark, "checkpoint"),
                                                   high=HIGH))
    return store.read_current(spark, path, ["sale_date"], ["transaction_count"])


@query("line_total", f"""
    SELECT order_id, product, price,
           CASE WHEN NOT bad THEN (price::DECIMAL(10,2) * quantity)::DOUBLE END AS total_amount
    FROM {MESSAGES} m
""")
def line_total(spark, sf_dir):
    return order_rows(spark, sf_dir).select("order_id", "product", "price",
                                            total_of().alias("total_amount"))


@query("parse_event_time", f"SELECT order_id, timestamp AS event_time FROM {MESSAGES} m")
def parse_event_time(spark, sf_dir):
    return order_rows(spark, sf_dir).select(
        "order_id", parse_ts("timestamp").cast("timestamp_ntz").alias("event_time"))


@query("partition_route", f"SELECT order_id, product, partition FROM {MESSAGES} m")
def partition_route(spark, sf_dir):
    return order_rows(spark, sf_dir).select("order_id", "product",
                                            route("product", 3).alias("partition"))
