"""Sales by day, region and product; layouts and the maintained daily table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import (
    apply_filters,
    cast_columns,
    fill_defaults,
    money,
    month_filter,
    recent,
)
from millrace.operators import aggregates as agg
from millrace.operators import layout
from millrace.operators.learning import fingerprint
from millrace.plans.registry import query, table
from millrace.session import materialize, scratch
from millrace.sources.files import reconcile

HIGH = 200_000


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("transaction_id"), F.to_date("o_orderdate").alias("sale_date"),
        money("o_totalprice").alias("amount"), F.col("o_custkey").alias("customer_id"))


def regional_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line revenue with date, region and category, for a month filter on the order date."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", money("l_extendedprice").alias("revenue"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    places = table(spark, sf_dir, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(places, F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(F.col("o_orderdate").alias("transaction_date"), F.col("r_name").alias("region"),
                F.col("p_type").alias("product_category"), "revenue")
    )


def sales_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line sales as the dashboard sees them."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("long").alias("quantity"),
        money("l_extendedprice").alias("amount"))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"))
    return lines.join(orders, "order_id")


STATS_SQL = f"""
    SELECT CAST(o_orderdate AS DATE) AS sale_date,
           sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS daily_revenue,
           count(*) AS transaction_count,
           sum(o_totalprice::DECIMAL(18,2))::DOUBLE / count(*) AS avg_transaction_value,
           count(*) FILTER (WHERE o_totalprice > {HIGH}) AS high_value_transactions,
           min(o_totalprice) AS min_transaction, max(o_totalprice) AS max_transaction
    FROM orders GROUP BY 1
"""


@query("daily_sales_stats", STATS_SQL)
def daily_sales_stats(spark, sf_dir):
    return agg.daily_sales_stats(transactions(spark, sf_dir), high=HIGH)


@query("daily_stats_summary", f"""
    WITH s AS ({STATS_SQL})
    SELECT min(daily_revenue) AS min_revenue, max(daily_revenue) AS max_revenue,
           sum(daily_revenue::DECIMAL(28,2))::DOUBLE / count(*) AS avg_revenue,
           min(transaction_count) AS min_transactions, max(transaction_count) AS max_transactions,
           sum(transaction_count)::DOUBLE / count(*) AS avg_transactions,
           min(high_value_transactions) AS min_high_value,
           max(high_value_transactions) AS max_high_value,
           sum(high_value_transactions)::DOUBLE / count(*) AS avg_high_value
    FROM s
""")
def daily_stats_summary(spark, sf_dir):
    return agg.daily_stats_summary(daily_sales_stats(spark, sf_dir))


@query("daily_revenue_variance", f"""
    WITH s AS ({STATS_SQL}),
    m AS (SELECT sum(daily_revenue::DECIMAL(28,2))::DOUBLE / count(*) AS r,
                 sum(transaction_count)::DOUBLE / count(*) AS c FROM s)
    SELECT s.*, (daily_revenue - r) / r * 100 AS revenue_variance_pct,
           high_value_transactions::DOUBLE / transaction_count * 100 AS high_value_tx_pct,
           (max_transaction::DECIMAL(18,2) - min_transaction::DECIMAL(18,2))::DOUBLE
             / avg_transaction_value AS price_range_ratio
    FROM s, m
    WHERE daily_revenue > r * 0.5::DOUBLE AND transaction_count > c * 0.5::DOUBLE
      AND high_value_transactions >= 1
    ORDER BY daily_revenue DESC, sale_date LIMIT 100
""")
def daily_revenue_variance(spark, sf_dir):
    return agg.daily_revenue_variance(daily_sales_stats(spark, sf_dir))


RANGE_SQL = """
    SELECT CAST(o_orderdate AS DATE) AS order_date,
           sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total_amount
    FROM orders WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1998-01-01'
    GROUP BY 1
"""


def _order_days(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("order_date"), money("o_totalprice").alias("order_amount"),
        F.col("o_custkey").alias("customer_id"))


@query("daily_revenue_in_range", RANGE_SQL)
def daily_revenue_in_range(spark, sf_dir):
    return agg.daily_revenue(_order_days(spark, sf_dir), "1997-01-01", "1997-12-31")


@query("daily_revenue_clustered", RANGE_SQL)
def daily_revenue_clustered(spark, sf_dir):
    path = scratch(spark, "sales_clustered")
    layout.write_clustered(_order_days(spark, sf_dir), ["order_date"], path)
    return agg.daily_revenue(spark.read.parquet(path), "1997-01-01", "1997-12-31")


MONTH_SQL = """
    SELECT r_name AS region, p_type AS product_category,
           sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS total_revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
         JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
         JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey
    WHERE o_orderdate >= DATE '1997-12-01' AND o_orderdate < DATE '1998-01-01'
    GROUP BY 1, 2
"""


@query("region_category_revenue", MONTH_SQL)
def region_category_revenue(spark, sf_dir):
    sales = regional_sales(spark, sf_dir).where(month_filter("transaction_date", 1997, 12))
    return agg.region_category_revenue(sales)


@query("region_category_revenue_function_filter", MONTH_SQL)
def region_category_revenue_function_filter(spark, sf_dir):
    month = month_filter("transaction_date", 1997, 12, "function")
    return agg.region_category_revenue(regional_sales(spark, sf_dir).where(month))


@query("region_category_revenue_partitioned", MONTH_SQL)
def region_category_revenue_partitioned(spark, sf_dir):
    path = scratch(spark, "sales_partitioned")
    dated = regional_sales(spark, sf_dir).withColumns({
        "year": F.year("transaction_date"), "month": F.month("transaction_date")})
    layout.write_partitioned(dated, ["year", "month"], path)
    stored = spark.read.parquet(path).where(month_filter("", 1997, 12, "partition"))
    return agg.region_category_revenue(stored)


@query("daily_sales_refreshed", STATS_SQL)
def daily_sales_refreshed(spark, sf_dir):
    """The daily table made from the older orders, then refreshed for the days that came later."""
    path, base = scratch(spark, "daily_sales"), transactions(spark, sf_dir)
    late = F.col("sale_date") >= F.lit("1999-06-16").cast("date")
    layout.create_daily_sales(base.where(~late), path, high=HIGH)
    layout.refresh_daily_sales(base, path, added=base.where(late), high=HIGH)
    return layout.read_daily_sales(spark, path)


@query("daily_sales_emptied", f"""
    SELECT * FROM ({STATS_SQL}) s WHERE date_trunc('month', sale_date) <> DATE '1997-03-01'
""")
def daily_sales_emptied(spark, sf_dir):
    """The daily table after all orders of a month were taken back and the month was refreshed."""
    path, base = scratch(spark, "daily_sales"), transactions(spark, sf_dir)
    gone = (F.col("sale_date") >= F.lit("1997-03-01").cast("date")) & (
        F.col("sale_date") < F.lit("1997-04-01").cast("date"))
    layout.create_daily_sales(base, path, high=HIGH)
    layout.refresh_daily_sales(base.where(~gone), path, removed=base.where(gone), high=HIGH)
    return layout.read_daily_sales(spark, path)


@query("daily_sales_corrected", STATS_SQL.replace(
    "FROM orders", "FROM (SELECT * REPLACE (CASE WHEN o_orderkey % 11 = 3 THEN (o_totalprice::DECIMAL(18,2) + 1000)::DOUBLE "
    "ELSE o_totalprice END AS o_totalprice) FROM orders WHERE o_orderkey % 7 <> 5)"))
def daily_sales_corrected(spark, sf_dir):
    """Orders all over the calendar taken back, and others with another price: old rows go, new ones
    come, and extremes are looked up again only where they were taken."""
    path, base = scratch(spark, "daily_sales"), transactions(spark, sf_dir)
    key = F.col("transaction_id")
    kept, wrong = base.where(key % 7 != 5), key % 11 == 3
    dearer = kept.where(wrong).withColumn(
        "amount", (F.col("amount") + 1000).cast(base.schema["amount"].dataType))
    layout.create_daily_sales(base, path, high=HIGH)
    layout.refresh_daily_sales(
        kept.where(~wrong).unionByName(dearer), path, added=dearer,
        removed=base.where(key % 7 == 5).unionByName(kept.where(wrong)), high=HIGH)
    return layout.read_daily_sales(spark, path)


@query("layout_compare", """
    SELECT l AS layout, CASE WHEN l = 'interleaved, customers' THEN
             (SELECT count(*) FROM orders WHERE o_custkey BETWEEN 1 AND 20)
           ELSE (SELECT count(*) FROM orders WHERE o_orderdate >= DATE '1997-12-01'
                 AND o_orderdate < DATE '1998-01-01') END AS rows, TRUE AS same, TRUE AS scans_less
    FROM (VALUES ('clustered'), ('partitioned'), ('interleaved'), ('interleaved, customers')) v(l)
""")
def layout_compare(spark, sf_dir):
    """One month, or a few customers, read from plain, clustered, partitioned and interleaved copies:
    equal rows, and whether the scan handed on fewer rows than that of the plain copy."""
    root, parts = scratch(spark, "layouts"), 16
    dated = transactions(spark, sf_dir).withColumns({
        "year": F.year("sale_date"), "month": F.month("sale_date")})
    dated.repartition(parts).write.parquet(f"{root}/plain")
    layout.write_clustered(dated, ["sale_date"], f"{root}/clustered", parts)
    layout.write_partitioned(dated, ["year", "month"], f"{root}/partitioned")
    layout.write_interleaved(dated, ["sale_date", "customer_id"], f"{root}/interleaved", parts)
    first, after = (F.lit(d).cast("date") for d in ("1997-12-01", "1998-01-01"))
    days = (F.col("sale_date") >= first) & (F.col("sale_date") < after)
    few = F.col("customer_id").between(1, 20)
    filters = {"clustered": (days, days), "interleaved": (days, days),
               "interleaved, customers": (few, few),
               "partitioned": (days, days & F.expr("year = 1997 and month = 12"))}
    rows = []
    for name, (plain, own) in filters.items():
        report = layout.compare(
            spark.read.parquet(f"{root}/plain").where(plain).select(*dated.columns),
            spark.read.parquet(f"{root}/{name.split(',')[0]}").where(own).select(*dated.columns))
        rows.append((name, report["optimised"]["rows"], report["same"],
                     report["optimised"]["scanned"] < report["plain"]["scanned"]))
    return spark.createDataFrame(rows, "layout string, rows long, same boolean, scans_less boolean")


@query("fan_out_load", """
    SELECT t AS "table", (SELECT count(*) FROM orders) AS source_rows,
           (SELECT count(*) FROM orders) AS sink_rows, 0::BIGINT AS missing, TRUE AS same
    FROM (VALUES ('sales_clustered'), ('sales_non_clustered'), ('sales_partitioned'),
                 ('sales_non_partitioned'), ('sales_transactions')) v(t)
""")
def fan_out_load(spark, sf_dir):
    """One source, computed once, in five layouts; counts and contents are compared."""
    root = scratch(spark, "fan_out")
    source = transactions(spark, sf_dir).withColumns({
        "year": F.year("sale_date"), "month": F.month("sale_date")})
    plain = ["transaction_id", "sale_date", "amount", "customer_id"]
    targets = {
        "sales_clustered": (plain, {"cluster": ["sale_date"]}),
        "sales_non_clustered": (plain, {}),
        "sales_partitioned": ([*plain, "year", "month"], {"partition": ["year", "month"]}),
        "sales_non_partitioned": (plain[:3], {}),
        "sales_transactions": (plain, {}),
    }
    source = materialize(source, "source")
    layout.fan_out(source, targets, root)
    stored = {t: spark.read.parquet(f"{root}/{t}") for t in targets}
    digests = [fingerprint(source, cols).select(F.lit(t).alias("table"), F.col("digest").alias("_a"))
               .join(fingerprint(stored[t].select(*cols)).select(
                   F.lit(t).alias("table"), F.col("digest").alias("_b")), "table")
               for t, (cols, _) in targets.items()]
    same = reduce(DataFrame.unionByName, digests).select(
        "table", (F.col("_a") == F.col("_b")).alias("same"))
    return reconcile({t: source for t in targets}, stored).join(same, "table")


# -- dashboard --------------------------------------------------------------------------------

@query("sales_by_day", """
    SELECT CAST(o_orderdate AS DATE) AS period,
           sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS total_amount
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1
""")
def sales_by_day(spark, sf_dir):
    return agg.sales_by_day(sales_data(spark, sf_dir))


@query("top_products", """
    SELECT l_partkey AS product_id, sum(l_quantity)::BIGINT AS total_quantity
    FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10
""")
def top_products(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("product_id"), F.col("l_quantity").cast("long").alias("quantity"))
    return agg.top_products(lines)


@query("customer_distribution", """
    SELECT o_custkey AS customer_id, count(*) AS order_count FROM orders GROUP BY 1
""")
def customer_distribution(spark, sf_dir):
    return agg.customer_distribution(transactions(spark, sf_dir))


@query("sales_summary", """
    WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, sum(o_totalprice::DECIMAL(18,2)) AS a
               FROM orders GROUP BY 1)
    SELECT day, a::DOUBLE AS day_amount, (sum(a) OVER (ORDER BY day))::DOUBLE AS running_amount,
           (sum(a) OVER ())::DOUBLE AS total_amount
    FROM d
""")
def sales_summary(spark, sf_dir):
    return agg.sales_summary(transactions(spark, sf_dir), date="sale_date")


@query("dashboard_filter", """
    SELECT l_orderkey AS order_id, l_partkey AS product_id, l_quantity::BIGINT AS quantity,
           l_extendedprice AS amount, o_custkey AS customer_id, o_orderdate AS order_date
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE o_orderdate BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'
      AND l_partkey IN (1, 2, 3, 5, 8, 13, 21, 34, 55, 89)
      AND l_extendedprice BETWEEN 10000 AND 80000
""")
def dashboard_filter(spark, sf_dir):
    days = tuple(F.lit(d).cast("timestamp_ntz") for d in ("1996-01-01", "1998-12-31"))
    return apply_filters(sales_data(spark, sf_dir), date_range=days,
                         products=[1, 2, 3, 5, 8, 13, 21, 34, 55, 89],
                         amount_range=(10_000, 80_000))


@query("result_cap", """
    SELECT o_orderkey AS transaction_id, CAST(o_orderdate AS DATE) AS sale_date,
           o_totalprice AS amount, o_custkey AS customer_id
    FROM orders ORDER BY o_orderkey LIMIT 5000
""")
def result_cap(spark, sf_dir):
    """Dashboard results are capped at 5000 rows."""
    return transactions(spark, sf_dir).orderBy("transaction_id").limit(5000)


@query("fill_constant", """
    SELECT event_id, coalesce(CASE WHEN event_type <> 'error' THEN value END, 0) AS amount,
           coalesce(CASE WHEN event_type <> 'signup' THEN user_id END, 0) AS quantity
    FROM events
""")
def fill_constant(spark, sf_dir):
    sparse = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("amount"),
        F.when(F.col("event_type") != "signup", F.col("user_id")).alias("quantity"))
    return fill_defaults(sparse, {"amount": 0, "quantity": 0})


@query("explicit_cast", """
    SELECT event_id, (ts::VARCHAR)[:19] AS seen_at, try_cast(event_type AS DOUBLE) AS as_number,
           user_id::DOUBLE AS user_id
    FROM events
""")
def explicit_cast(spark, sf_dir):
    """Text that is no number becomes null."""
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("seen_at"),
        F.col("event_type").alias("as_number"), "user_id")
    return cast_columns(rows, {"as_number": "double", "user_id": "double"}, strict=False)


@query("recent_days_filter", """
    SELECT o_orderkey AS transaction_id, CAST(o_orderdate AS DATE) AS sale_date,
           o_totalprice AS amount, o_custkey AS customer_id
    FROM orders WHERE o_orderdate >= DATE '2001-07-15' - 30
""")
def recent_days_filter(spark, sf_dir):
    return transactions(spark, sf_dir).where(recent("sale_date", 30, "2001-07-15"))
