"""Stock and customer analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import money, with_audit
from millrace.functions.udfs import order_patterns_grouped as grouped_patterns
from millrace.functions.udfs import register_udfs
from millrace.operators import aggregates as agg
from millrace.operators import joins
from millrace.operators import series
from millrace.plans.registry import query, table
from millrace.session import scratch
from millrace.sources.files import write_snapshot

AS_OF = "2001-07-15"


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"),
        money("p_retailprice").alias("price"))


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = table(spark, sf_dir, "region")
    return table(spark, sf_dir, "nation").join(
        regions, F.col("n_regionkey") == F.col("r_regionkey")
    ).select(
        F.col("n_nationkey").alias("location_id"), F.col("n_name").alias("warehouse_code"),
        F.col("r_name").alias("city"), (F.col("n_nationkey") * 10 + 100).alias("capacity"))


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock of a product at a location: what the suppliers of that place shipped."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"
    ).join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).groupBy(
        F.col("l_partkey").alias("product_id"), F.col("s_nationkey").alias("location_id")
    ).agg(F.sum(F.col("l_quantity").cast("long")).alias("quantity"),
          F.max("l_shipdate").alias("last_updated"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"), money("o_totalprice").alias("total_amount"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("long").alias("quantity"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"))


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase events as orders; unlike the order table they have a time of day."""
    return table(spark, sf_dir, "events").where("event_type = 'purchase'").select(
        F.col("event_id").alias("order_id"), F.col("user_id").alias("customer_id"),
        F.col("ts").alias("order_date"), money("value").alias("total_amount"))


INVENTORY = """(SELECT l_partkey AS product_id, s_nationkey AS location_id,
    sum(l_quantity)::BIGINT AS quantity, max(l_shipdate) AS last_updated
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)"""
DETAILED = f"""(SELECT i.product_id, p_name AS product_name, p_retailprice AS price, quantity,
    n_nationkey * 10 + 100 AS capacity, n_name AS warehouse_code, r_name AS city, last_updated
    FROM {INVENTORY} i JOIN part ON p_partkey = i.product_id
         JOIN nation ON n_nationkey = i.location_id JOIN region ON n_regionkey = r_regionkey)"""
SCORE = f"""greatest(0::DOUBLE, least(100::DOUBLE,
    (1 - abs(quantity::DOUBLE / capacity - 0.5::DOUBLE) * 2) * 100
    - (epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(last_updated)) / 1e6 / 86400 * 2))"""


@query("detailed_inventory", f"SELECT * FROM {DETAILED} d")
def detailed_inventory(spark, sf_dir):
    return joins.detailed_inventory(products(spark, sf_dir), inventory(spark, sf_dir),
                                    locations(spark, sf_dir))


SCORE_SQL = f"SELECT d.*, {SCORE} AS inventory_score FROM {DETAILED} d"


@query("inventory_score", SCORE_SQL)
def inventory_score(spark, sf_dir):
    return joins.inventory_analytics(detailed_inventory(spark, sf_dir), AS_OF)


@query("inventory_score_udf", SCORE_SQL)
def inventory_score_udf(spark, sf_dir):
    """The registered pandas UDF, called from SQL."""
    register_udfs(spark, AS_OF)
    return spark.sql(
        """
        SELECT *, calculate_inventory_score(CAST(quantity AS DOUBLE), CAST(capacity AS DOUBLE),
                                            CAST(last_updated AS TIMESTAMP)) AS inventory_score
        FROM {detailed}
        """, detailed=detailed_inventory(spark, sf_dir))


def _analytics_sql(source: str) -> str:
    return f"""
    SELECT customer_id, hour(order_date)::INT AS peak_order_hour, count(*) AS total_orders,
           sum(total_amount::DECIMAL(18,2))::DOUBLE AS total_spent,
           sum(total_amount::DECIMAL(18,2))::DOUBLE / count(*) AS avg_order_value,
           (epoch_us(max(order_date)) // 1000000 - epoch_us(min(order_date)) // 1000000)
             / (86400::DOUBLE * greatest(count(*) - 1, 1)) AS avg_days_between_orders
    FROM {source} o GROUP BY 1, 2
    """


ORDERS = """(SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
    o_totalprice AS total_amount FROM orders)"""
PURCHASES = """(SELECT event_id AS order_id, user_id AS customer_id, ts AS order_date,
    value AS total_amount FROM events WHERE event_type = 'purchase')"""


@query("customer_order_analytics", _analytics_sql(ORDERS))
def customer_order_analytics(spark, sf_dir):
    return agg.customer_order_analytics(orders(spark, sf_dir))


@query("customer_order_analytics_by_hour", _analytics_sql(PURCHASES))
def customer_order_analytics_by_hour(spark, sf_dir):
    return agg.customer_order_analytics(purchases(spark, sf_dir))


PATTERNS = f"""(
    WITH h AS (SELECT customer_id, hour(order_date)::INT AS hr, count(*) AS n
               FROM {PURCHASES} p GROUP BY 1, 2),
    peak AS (SELECT customer_id, hr FROM h
             QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, hr) = 1)
    SELECT p.customer_id, count(*) AS total_orders,
           sum(total_amount::DECIMAL(18,2))::DOUBLE AS total_spent,
           sum(total_amount::DECIMAL(18,2))::DOUBLE / count(*) AS avg_order_value,
           CASE WHEN count(*) > 1 AND max(order_date) > min(order_date)
                THEN (epoch_us(max(order_date)) - epoch_us(min(order_date))) / 1e6 / 86400
                     / (count(*) - 1) END AS avg_days_between_orders,
           any_value(peak.hr) AS peak_order_hour
    FROM {PURCHASES} p JOIN peak ON p.customer_id = peak.customer_id GROUP BY 1)"""


@query("customer_order_patterns", f"SELECT * FROM {PATTERNS} x")
def customer_order_patterns(spark, sf_dir):
    return agg.customer_order_patterns(agg.order_hours(purchases(spark, sf_dir)))


@query("order_patterns_grouped", f"SELECT * FROM {PATTERNS} x")
def order_patterns_grouped(spark, sf_dir):
    return grouped_patterns(agg.order_hours(purchases(spark, sf_dir)))


@query("order_gaps", f"""
    SELECT order_id, customer_id, order_date, total_amount,
           (epoch_us(order_date) - epoch_us(lag(order_date) OVER (
               PARTITION BY customer_id ORDER BY order_date, order_id))) / 1e6 / 86400
             AS days_since_previous
    FROM {ORDERS} o
""")
def order_gaps(spark, sf_dir):
    return series.order_gaps(orders(spark, sf_dir))


@query("customer_segments", f"""
    SELECT *, frequency_segment = 4 AND spend_segment = 4 AS is_vip FROM (
        SELECT x.*, ntile(4) OVER (ORDER BY total_orders, customer_id)::INT AS frequency_segment,
               ntile(4) OVER (ORDER BY total_spent, customer_id)::INT AS spend_segment
        FROM {PATTERNS} x) y
""")
def customer_segments(spark, sf_dir):
    return agg.customer_segments(customer_order_patterns(spark, sf_dir))


BUSINESS = f"""(
    SELECT i.*, c_name AS customer_name, coa.total_orders, coa.total_spent, coa.avg_order_value,
           coa.avg_days_between_orders, coa.peak_order_hour, o_orderkey AS order_id,
           o_orderdate AS order_date, l_quantity::BIGINT AS ordered_quantity,
           o_custkey AS customer_id
    FROM ({SCORE_SQL}) i
    LEFT JOIN lineitem ON i.product_id = l_partkey
    LEFT JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN ({_analytics_sql(ORDERS)}) coa ON c_custkey = coa.customer_id
    WHERE o_orderdate >= DATE '{AS_OF}' - 30)"""


@query("business_analytics", f"SELECT * FROM {BUSINESS} b")
def business_analytics(spark, sf_dir):
    return joins.business_analytics(
        inventory_score(spark, sf_dir), items(spark, sf_dir), orders(spark, sf_dir),
        customers(spark, sf_dir), customer_order_analytics(spark, sf_dir), as_of=AS_OF)


INSIGHTS_SQL = f"""
    SELECT product_name, city, warehouse_code, inventory_score, quantity AS current_stock,
           sum(ordered_quantity)::BIGINT AS total_ordered,
           count(DISTINCT order_id) AS number_of_orders,
           sum(avg_order_value::DECIMAL(18,6))::DOUBLE / count(avg_order_value)
             AS customer_avg_order_value
    FROM {BUSINESS} b GROUP BY ALL
"""


@query("business_insights", INSIGHTS_SQL)
def business_insights(spark, sf_dir):
    return joins.business_insights(
        inventory_score(spark, sf_dir), items(spark, sf_dir), orders(spark, sf_dir),
        customers(spark, sf_dir), customer_order_analytics(spark, sf_dir), as_of=AS_OF)


def run_insights(spark: SparkSession, tables: dict[str, DataFrame], roots: list[str],
                 run_date: str) -> DataFrame:
    """The batch job: snapshot every table under all roots, work out the insights from the
    snapshots, and store these the same way. Returns the stored insights."""
    stored = {}
    for name, df in tables.items():
        paths = write_snapshot(with_audit(df), [f"{r}/data" for r in roots], name, run_date)
        stored[name] = spark.read.parquet(paths[0]).drop("etl_timestamp")
    detailed = joins.detailed_inventory(stored["products"], stored["product_inventory"],
                                        stored["inventory_locations"])
    insights = joins.business_insights(
        joins.inventory_analytics(detailed, run_date), stored["order_items"], stored["orders"],
        stored["customers"], agg.customer_order_analytics(stored["orders"]), as_of=run_date)
    paths = write_snapshot(insights, roots, "business_insights", run_date)
    return spark.read.parquet(paths[-1])


@query("insights_job", INSIGHTS_SQL)
def insights_job(spark, sf_dir):
    tables = {
        "customers": customers(spark, sf_dir), "orders": orders(spark, sf_dir),
        "products": products(spark, sf_dir), "order_items": items(spark, sf_dir),
        "inventory_locations": locations(spark, sf_dir),
        "product_inventory": inventory(spark, sf_dir),
    }
    return run_insights(spark, tables, [scratch(spark, "lake"), scratch(spark, "local")], AS_OF)


@query("business_insights_by_customer", f"""
    WITH p AS (SELECT customer_id, (sum(total_amount::DECIMAL(18,2))::DOUBLE / count(*))
                      ::DECIMAL(18,6) AS v FROM {ORDERS} o GROUP BY 1),
    d AS (SELECT l_partkey AS product_id, sum(l_quantity)::BIGINT AS total_ordered,
                 count(DISTINCT o_orderkey) AS number_of_orders,
                 sum(v)::DOUBLE / count(v) AS customer_avg_order_value
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey
               LEFT JOIN p ON p.customer_id = o_custkey
          WHERE o_orderdate >= DATE '{AS_OF}' - 30 GROUP BY 1)
    SELECT i.product_id, product_name, city, warehouse_code, inventory_score,
           quantity AS current_stock, total_ordered, number_of_orders, customer_avg_order_value
    FROM ({SCORE_SQL}) i JOIN d ON i.product_id = d.product_id
""")
def business_insights_by_customer(spark, sf_dir):
    patterns = agg.customer_order_patterns(agg.order_hours(orders(spark, sf_dir)))
    return joins.business_insights_by_customer(
        inventory_score(spark, sf_dir), items(spark, sf_dir), orders(spark, sf_dir), patterns,
        as_of=AS_OF)


@query("warehouse_utilisation", f"""
    SELECT n_nationkey AS location_id, n_name AS warehouse_code,
           n_nationkey * 10 + 100 AS capacity, coalesce(used, 0)::BIGINT AS used,
           coalesce(used, 0)::DOUBLE / (n_nationkey * 10 + 100) AS utilisation
    FROM nation LEFT JOIN (SELECT location_id, sum(quantity) AS used FROM {INVENTORY} i GROUP BY 1)
         u ON location_id = n_nationkey
""")
def warehouse_utilisation(spark, sf_dir):
    return agg.utilisation(inventory(spark, sf_dir), locations(spark, sf_dir))


@query("stock_status", f"""
    SELECT d.*, CASE WHEN quantity::DOUBLE / capacity < 0.2::DOUBLE THEN 'needs_restock'
                     WHEN quantity::DOUBLE / capacity > 0.8::DOUBLE THEN 'overstocked'
                     ELSE 'ok' END AS stock_status
    FROM {DETAILED} d
""")
def stock_status(spark, sf_dir):
    return agg.stock_status(detailed_inventory(spark, sf_dir), 0.2, 0.8)


@query("inventory_turnover", f"""
    WITH s AS (SELECT l_partkey AS product_id, CAST(date_trunc('month', o_orderdate) AS DATE)
                      AS period, sum(l_quantity)::BIGINT AS sold
               FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
    m AS (SELECT product_id, sum(quantity)::DOUBLE / count(*) AS mean_stock
          FROM {INVENTORY} i GROUP BY 1)
    SELECT s.product_id, period, sold, mean_stock, sold::DOUBLE / mean_stock AS turnover
    FROM s LEFT JOIN m ON s.product_id = m.product_id
""")
def inventory_turnover(spark, sf_dir):
    sold = items(spark, sf_dir).join(
        orders(spark, sf_dir).select("order_id", "order_date"), "order_id")
    return agg.turnover(sold, inventory(spark, sf_dir))
