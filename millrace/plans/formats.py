"""File formats, bulk loads, snapshots and reconciliation."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import with_audit
from millrace.plans.registry import query, table
from millrace.session import scratch
from millrace.sources import files, jdbc

ORDERS = "SELECT * FROM orders"


def _chain(spark: SparkSession, source: DataFrame, formats: list[str]) -> DataFrame:
    """The frame written in the first format and converted along the others."""
    schema = source.schema
    path = scratch(spark, formats[0])
    files.WRITERS[formats[0]](source, path)
    for before, after in zip(formats, formats[1:]):
        target = scratch(spark, after)
        files.convert_format(spark, path, before, target, after, schema)
        path = target
    return files.READERS[formats[-1]](spark, path, schema)


@query("csv_to_parquet", ORDERS)
def csv_to_parquet(spark, sf_dir):
    return _chain(spark, table(spark, sf_dir, "orders"), ["csv", "parquet"])


@query("json_to_csv", ORDERS)
def json_to_csv(spark, sf_dir):
    return _chain(spark, table(spark, sf_dir, "orders"), ["json", "csv"])


@query("json_to_parquet_to_orc", ORDERS)
def json_to_parquet_to_orc(spark, sf_dir):
    return _chain(spark, table(spark, sf_dir, "orders"), ["json", "parquet", "orc"])


@query("json_columnar_scan", """
    SELECT c_name AS name, c_nationkey AS nation, c_mktsegment AS segment FROM customer
""")
def json_columnar_scan(spark, sf_dir):
    """Customers as objects of parallel arrays, a thousand customers per object."""
    path = scratch(spark, "columnar")
    rows = table(spark, sf_dir, "customer").groupBy(
        F.floor(F.col("c_custkey") / 1000).alias("_chunk")
    ).agg(F.collect_list(F.struct("c_name", "c_nationkey", "c_mktsegment")).alias("_r"))
    rows.select(F.col("_r.c_name").alias("name"), F.col("_r.c_nationkey").alias("nation"),
                F.col("_r.c_mktsegment").alias("segment")).write.json(path)
    return files.read_columnar_json(
        spark, path, {"name": "string", "nation": "int", "segment": "string"}, multi_line=False)


_LOAD = T.StructType([T.StructField("event_id", T.LongType()),
                      T.StructField("event_type", T.StringType()),
                      T.StructField("value", T.DoubleType())])


def _loaded(spark, sf_dir):
    """Event lines as CSV; errors carry text where a number belongs."""
    path = scratch(spark, "stage")
    value = F.when(F.col("event_type") == "error", "unknown").otherwise(
        F.col("value").cast("string"))
    table(spark, sf_dir, "events").select("event_id", "event_type", value.alias("value")).write\
        .option("header", True).csv(path)
    return files.bulk_load(spark, path, _LOAD)


@query("bulk_load_csv", "SELECT event_id, event_type, value FROM events WHERE event_type <> 'error'")
def bulk_load_csv(spark, sf_dir):
    return _loaded(spark, sf_dir)[0]


@query("bulk_load_rejects", """
    SELECT event_id || ',error,unknown' AS line FROM events WHERE event_type = 'error'
""")
def bulk_load_rejects(spark, sf_dir):
    return _loaded(spark, sf_dir)[1].select("line")


@query("dated_snapshot", """
    SELECT o_orderkey, o_totalprice, DATE '2024-01-31' AS etl_date FROM orders
""")
def dated_snapshot(spark, sf_dir):
    """A snapshot under two roots; the copy of the second root is read."""
    rows = with_audit(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"),
                      datetime.date(2024, 1, 31), "etl_date")
    roots = [scratch(spark, "primary"), scratch(spark, "secondary")]
    return spark.read.parquet(files.write_snapshot(rows, roots, "orders", "2024-01-31")[1])


@query("row_count_reconcile", """
    SELECT t AS "table", n AS source_rows, n AS sink_rows, 0::BIGINT AS missing
    FROM (SELECT 'orders' AS t, count(*) AS n FROM orders
          UNION ALL SELECT 'customer', count(*) FROM customer
          UNION ALL SELECT 'lineitem', count(*) FROM lineitem)
""")
def row_count_reconcile(spark, sf_dir):
    source = {n: table(spark, sf_dir, n) for n in ("orders", "customer", "lineitem")}
    sink = {}
    for name, df in source.items():
        path = scratch(spark, name)
        files.write_parquet(df, path)
        sink[name] = files.read_parquet(spark, path)
    return files.reconcile(source, sink)


@query("register_tables", """
    SELECT o_orderstatus, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey
    GROUP BY 1
""")
def register_tables(spark, sf_dir):
    jdbc.load_tables(spark, lambda name: table(spark, sf_dir, name), ["orders", "customer"])
    return spark.sql("""
        SELECT o_orderstatus, count(*) AS orders
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY o_orderstatus
    """)
