"""Star and snowflake models over the order tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import money
from millrace.operators import layout, quality
from millrace.operators import warehouse as wh
from millrace.operators.joins import orphans as find_orphans
from millrace.plans.registry import query, table
from millrace.session import scratch


def model(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The normalised tables."""
    part, nation = table(spark, sf_dir, "part"), table(spark, sf_dir, "nation")
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    customer = table(spark, sf_dir, "customer")
    root = part.select(F.col("p_type").alias("category_id"),
                       F.lit(None).cast("string").alias("parent_category_id"),
                       F.col("p_type").alias("category_name")).distinct()
    leaf = F.concat_ws("/", "p_type", "p_brand")
    leaves = part.select(leaf.alias("category_id"), F.col("p_type").alias("parent_category_id"),
                         F.col("p_brand").alias("category_name")).distinct()
    maker = F.concat(F.lit("M"), F.substring("p_brand", 7, 1))
    homes = customer.select(F.col("c_custkey").alias("customer_id"),
                            F.col("c_nationkey").alias("location_id"))
    price = money("l_extendedprice")
    return {
        "products": part.select(
            F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
            leaf.alias("category_id"), F.col("p_brand").alias("brand_id"),
            money("p_retailprice").alias("unit_price"),
            money(F.col("p_retailprice") - 100).alias("unit_cost")),
        "categories": root.unionByName(leaves),
        "brands": part.select(F.col("p_brand").alias("brand_id"),
                              F.col("p_brand").alias("brand_name"),
                              maker.alias("manufacturer_id")).distinct(),
        "manufacturers": part.select(
            maker.alias("manufacturer_id"),
            F.concat(F.lit("Manufacturer "), maker).alias("manufacturer_name")).distinct(),
        "customers": customer.select(
            F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("segment_id")),
        "segments": customer.select(
            F.col("c_mktsegment").alias("segment_id"),
            F.lower("c_mktsegment").alias("segment_name")).distinct(),
        "locations": nation.select(F.col("n_nationkey").alias("location_id"),
                                   F.col("n_nationkey").alias("country_id")),
        "countries": nation.select(F.col("n_nationkey").alias("country_id"),
                                   F.col("n_name").alias("country_name"),
                                   F.col("n_regionkey").alias("region_id")),
        "regions": table(spark, sf_dir, "region").select(
            F.col("r_regionkey").alias("region_id"), F.col("r_name").alias("region_name")),
        "warehouses": table(spark, sf_dir, "supplier").select(
            F.col("s_suppkey").alias("warehouse_id"), F.col("s_nationkey").alias("location_id")),
        "statuses": orders.select(
            F.col("o_orderstatus").alias("status_id"),
            F.concat(F.lit("status "), "o_orderstatus").alias("status_name")).distinct(),
        "orders": orders.select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
            wh.date_key("o_orderdate").alias("order_date_id"),
            F.col("o_orderstatus").alias("status_id"),
            money("o_totalprice").alias("tax_amount"), money("o_totalprice").alias(
                "shipping_cost")).join(homes, "customer_id", "left"),
        "items": lines.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_item_id"),
            F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("long").alias("quantity"), price.alias("unit_price"),
            (price * money("l_discount")).cast("decimal(18,4)").alias("discount_amount"),
            price.alias("total_price")),
        "inventory": lines.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("inventory_id"),
            F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("warehouse_id"),
            F.col("l_suppkey").alias("supplier_id"),
            F.col("l_quantity").cast("long").alias("quantity_on_hand"),
            F.lit(10).alias("reorder_point"),
            wh.date_key("l_shipdate").alias("last_stock_update_date_id")),
    }


def _dims(m: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "product": wh.build_dim_product(m["products"], m["categories"], m["brands"],
                                        m["manufacturers"]),
        "customer": wh.build_dim_customer(m["customers"], m["segments"]),
        "location": wh.build_dim_location(m["locations"], m["countries"], m["regions"],
                                          m["warehouses"]),
    }


def _dates(spark, sf_dir):
    bounds = table(spark, sf_dir, "orders").agg(F.min("o_orderdate").alias("low"),
                                                F.max("o_orderdate").alias("high"))
    holidays = table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("full_date")).where(
        "month(full_date) = 12 and dayofmonth(full_date) = 25")
    return wh.build_dim_date(bounds, holidays)


DATES = """(SELECT (year(d) * 10000 + month(d) * 100 + day(d))::INT AS date_id, d AS full_date,
    isodow(d)::INT AS day_of_week, dayname(d) AS day_name, day(d)::INT AS day_of_month,
    dayofyear(d)::INT AS day_of_year, weekofyear(d)::INT AS week_of_year,
    month(d)::INT AS month_number, monthname(d) AS month_name, quarter(d)::INT AS quarter,
    year(d)::INT AS year, isodow(d) >= 6 AS is_weekend,
    CASE WHEN month(d) IN (12, 1, 2) THEN 'Winter' WHEN month(d) IN (3, 4, 5) THEN 'Spring'
         WHEN month(d) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS season,
    d IN (SELECT CAST(o_orderdate AS DATE) FROM orders
          WHERE month(o_orderdate) = 12 AND day(o_orderdate) = 25) AS is_holiday
    FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate),
                                        INTERVAL 1 DAY))::DATE AS d FROM orders))"""
PRODUCTS = """(SELECT p_partkey AS product_id, p_name AS product_name, p_retailprice AS unit_price,
    (p_retailprice - 100)::DECIMAL(18,2)::DOUBLE AS unit_cost, p_brand AS category_name,
    p_type AS department_name, p_brand AS brand_name,
    'Manufacturer M' || substr(p_brand, 7, 1) AS manufacturer_name FROM part)"""
CUSTOMERS = """(SELECT c_custkey AS customer_id, c_name AS customer_name,
    lower(c_mktsegment) AS segment_name FROM customer)"""
LOCATIONS = """(SELECT n_nationkey AS location_id, n_name AS country_name, r_name AS region_name,
    n_nationkey IN (SELECT s_nationkey FROM supplier) AS is_warehouse
    FROM nation JOIN region ON n_regionkey = r_regionkey)"""
FACT = """(SELECT l_orderkey * 10 + l_linenumber AS order_item_id,
    (year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate))::INT AS order_date_id,
    o_custkey AS customer_id, l_partkey AS product_id, c_nationkey AS location_id,
    l_quantity::BIGINT AS quantity, l_extendedprice AS unit_price,
    (l_extendedprice::DECIMAL(18,2) * l_discount::DECIMAL(18,2))::DOUBLE AS discount_amount,
    l_extendedprice AS total_amount, o_totalprice * share AS shipping_cost,
    o_totalprice * share AS tax_amount, 'status ' || o_orderstatus AS order_status
    FROM (SELECT *, l_extendedprice / (sum(l_extendedprice::DECIMAL(18,2))
                 OVER (PARTITION BY l_orderkey))::DOUBLE AS share FROM lineitem)
         JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""
STOCK = """(SELECT l_orderkey * 10 + l_linenumber AS inventory_id, l_partkey AS product_id,
    l_suppkey AS supplier_id,
    (year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate))::INT AS date_id,
    s_nationkey AS location_id, l_quantity::BIGINT AS quantity_on_hand,
    NULL::INT AS quantity_received, NULL::INT AS quantity_shipped, 10 AS reorder_point,
    (p_retailprice - 100)::DECIMAL(18,2)::DOUBLE AS unit_cost,
    (l_quantity::BIGINT * (p_retailprice - 100)::DECIMAL(18,2))::DOUBLE AS total_value
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey)"""


@query("dim_date", f"SELECT * FROM {DATES} d")
def dim_date(spark, sf_dir):
    return _dates(spark, sf_dir)


@query("dim_supplier", """
    SELECT s_suppkey AS supplier_id, s_name AS supplier_name, s_acctbal AS account_balance,
           n_name AS country_name
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
def dim_supplier(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("supplier_name"),
        F.col("s_acctbal").alias("account_balance"), F.col("s_nationkey").alias("nation_id"))
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("nation_id"), F.col("n_name").alias("country_name"))
    return wh.build_dim_supplier(suppliers, nations)


@query("category_closure_deep", """
    SELECT p_partkey AS category_id, p_name AS category_name,
           CASE WHEN p_partkey % 50 = 0 THEN p_name ELSE (SELECT q.p_name FROM part q
                WHERE q.p_partkey = p.p_partkey // 50 * 50) END AS root_name,
           (p_partkey % 50)::INT AS depth
    FROM part p WHERE p_partkey // 50 * 50 IN (SELECT p_partkey FROM part)
""")
def category_closure_deep(spark, sf_dir):
    """Chains of fifty categories; one without its first link is left out."""
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("category_id"), F.col("p_name").alias("category_name"),
        F.when(F.col("p_partkey") % 50 > 0, F.col("p_partkey") - 1).alias("parent_category_id"))
    return wh.category_paths(parts).drop("path")


@query("category_closure", """
    SELECT DISTINCT p_type AS category_id, p_type AS category_name, p_type AS root_name, 0 AS depth,
           p_type AS path FROM part
    UNION ALL
    SELECT DISTINCT p_type || '/' || p_brand, p_brand, p_type, 1, p_type || ' > ' || p_brand
    FROM part
""")
def category_closure(spark, sf_dir):
    return wh.category_paths(model(spark, sf_dir)["categories"])


@query("dim_product", f"SELECT * FROM {PRODUCTS} p")
def dim_product(spark, sf_dir):
    return _dims(model(spark, sf_dir))["product"]


@query("dim_customer", f"SELECT * FROM {CUSTOMERS} c")
def dim_customer(spark, sf_dir):
    return _dims(model(spark, sf_dir))["customer"]


@query("dim_location", f"SELECT * FROM {LOCATIONS} l")
def dim_location(spark, sf_dir):
    return _dims(model(spark, sf_dir))["location"]


def _fact(m):
    return wh.build_fact_sales(m["orders"], m["items"], m["statuses"])


@query("fact_sales", f"SELECT * FROM {FACT} f")
def fact_sales(spark, sf_dir):
    return _fact(model(spark, sf_dir))


@query("fact_inventory", f"SELECT * FROM {STOCK} s")
def fact_inventory(spark, sf_dir):
    m = model(spark, sf_dir)
    return wh.build_fact_inventory(m["inventory"], m["warehouses"], m["products"])


@query("reorder_report", f"SELECT * FROM {STOCK} s WHERE quantity_on_hand < reorder_point")
def reorder_report(spark, sf_dir):
    return wh.reorder_report(fact_inventory(spark, sf_dir))


def _rollup_sql(keys: str) -> str:
    return f"""
    SELECT {keys}, sum(total_amount::DECIMAL(18,2))::DOUBLE AS total_amount,
           sum(quantity)::BIGINT AS total_quantity, count(*) AS line_count
    FROM {FACT} f JOIN {PRODUCTS} p ON f.product_id = p.product_id
         JOIN {CUSTOMERS} c ON f.customer_id = c.customer_id
         JOIN {LOCATIONS} l ON f.location_id = l.location_id
         JOIN {DATES} d ON f.order_date_id = d.date_id
    GROUP BY ALL
    """


ROLLUPS = {
    "sales_by_product_level": ["department_name", "category_name"],
    "sales_by_segment": ["segment_name", "year"],
    "sales_by_geography": ["region_name", "country_name"],
    "sales_by_period": ["year", "quarter", "season"],
}


def _star(spark, sf_dir, keys):
    m = model(spark, sf_dir)
    dims = _dims(m)
    joined = {"product_id": dims["product"], "customer_id": dims["customer"],
              "location_id": dims["location"], "order_date_id": _dates(spark, sf_dir)}
    used = [(dim, key, "date_id" if key == "order_date_id" else key)
            for key, dim in joined.items() if set(keys) & set(dim.columns)]
    return wh.sales_by(wh.sales_lines(m["orders"], m["items"]), used, keys)


for _name, _keys in ROLLUPS.items():
    query(_name, _rollup_sql(", ".join(_keys)))(
        lambda spark, sf_dir, keys=_keys: _star(spark, sf_dir, keys))


LATTICE = {**ROLLUPS, "sales_by_department": ["department_name"], "sales_by_year": ["year"],
           "sales_by_region_year": ["region_name", "year"], "sales_total": []}


@query("sales_rollups", " UNION ALL BY NAME ".join(
    f"SELECT '{name}' AS rollup, * FROM ({_rollup_sql(', '.join(keys)) if keys else _rollup_sql('1 AS one')}) t"
    for name, keys in LATTICE.items()).replace("'sales_total' AS rollup, *",
                                               "'sales_total' AS rollup, * EXCLUDE (one)"))
def sales_rollups(spark, sf_dir):
    """All rollups from one scan of the lines; columns that a rollup does not have are null."""
    keys = list(dict.fromkeys(k for ks in LATTICE.values() for k in ks))
    made = wh.rollup_lattice(_star(spark, sf_dir, keys), LATTICE)
    named = [df.withColumn("rollup", F.lit(name)) for name, df in made.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


@query("sales_by_geography_snowflake", _rollup_sql("region_name, country_name"))
def sales_by_geography_snowflake(spark, sf_dir):
    """The same rollup from the normalised tables."""
    m = model(spark, sf_dir)
    lines = m["items"].join(m["orders"], "order_id")
    by_place = lines.groupBy("location_id").agg(
        F.sum("total_price").alias("_amount"), F.sum("quantity").alias("_quantity"),
        F.count(F.lit(1)).alias("_lines"))
    places = m["locations"].join(m["countries"], "country_id").join(m["regions"], "region_id")
    return by_place.join(places, "location_id").groupBy("region_name", "country_name").agg(
        F.sum("_amount").alias("total_amount"), F.sum("_quantity").alias("total_quantity"),
        F.sum("_lines").alias("line_count"))


# -- keys and layout --------------------------------------------------------------------------

@query("pk_unique", """
    SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem
    GROUP BY 1, 2 HAVING count(*) > 1
""")
def pk_unique(spark, sf_dir):
    return quality.duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


REFS = [("lineitem", "l_orderkey", "orders", "o_orderkey"),
        ("lineitem", "l_partkey", "part", "p_partkey"),
        ("orders", "o_custkey", "customer", "c_custkey"),
        ("orders", "o_orderkey", "lineitem", "l_orderkey"),
        ("customer", "c_custkey", "events", "user_id"),
        ("nation", "n_regionkey", "region", "r_regionkey"),
        ("labels", "doc_id", "documents", "doc_id")]


@query("fk_valid", " UNION ALL ".join(f"""
    SELECT '{c}.{k} > {p}.{q}' AS ref, (SELECT count({k}) FROM {c}) AS rows,
           (SELECT count(*) FROM {c} WHERE {k} IS NOT NULL
            AND {k} NOT IN (SELECT {q} FROM {p})) AS orphans
""" for c, k, p, q in REFS))
def fk_valid(spark, sf_dir):
    names = {n for child, _, parent, _ in REFS for n in (child, parent)}
    return quality.check_refs({n: table(spark, sf_dir, n) for n in names}, REFS)


@query("fk_anti_join", """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
""")
def fk_anti_join(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return find_orphans(orders, table(spark, sf_dir, "lineitem"), "o_orderkey", "l_orderkey")


@query("bucketed_join", """
    SELECT o_orderpriority, count(*) AS lines,
           sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS amount
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1
""")
def bucketed_join(spark, sf_dir):
    """Both sides bucketed by the order key, so the join has no exchange."""
    names = {}
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        names[name] = f"{name}_{uuid.uuid4().hex}"
        layout.write_bucketed(table(spark, sf_dir, name), names[name], key, 8,
                              scratch(spark, name))
    lines = spark.table(names["lineitem"]).select("l_orderkey", money("l_extendedprice").alias("p"))
    orders = spark.table(names["orders"]).select("o_orderkey", "o_orderpriority")
    return lines.hint("merge").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(
        "o_orderpriority").agg(F.count(F.lit(1)).alias("lines"), F.sum("p").alias("amount"))
