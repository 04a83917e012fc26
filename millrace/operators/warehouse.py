"""Star and snowflake models: dimensions, facts, rollups and closure of the category tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import materialize

# The seasons of the northern hemisphere by month.
SEASONS = {"Winter": (12, 1, 2), "Spring": (3, 4, 5), "Summer": (6, 7, 8), "Autumn": (9, 10, 11)}


def date_key(date: str | Column) -> Column:
    """yyyymmdd as int."""
    date = F.col(date) if isinstance(date, str) else date
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)


def build_dim_date(bounds: DataFrame, holidays: DataFrame | None = None, *, low: str = "low",
                   high: str = "high") -> DataFrame:
    """One row per day between the bounds, a one-row frame; `holidays` has a column full_date."""
    days = bounds.select(F.explode(F.sequence(
        F.col(low).cast("date"), F.col(high).cast("date"))).alias("full_date"))
    day = F.col("full_date")
    season = F.lit(None).cast("string")
    for name, months in SEASONS.items():
        season = F.when(F.month(day).isin(*months), name).otherwise(season)
    dated = days.select(
        date_key(day).alias("date_id"), "full_date",
        (F.weekday(day) + 1).alias("day_of_week"), F.date_format(day, "EEEE").alias("day_name"),
        F.dayofmonth(day).alias("day_of_month"), F.dayofyear(day).alias("day_of_year"),
        F.weekofyear(day).alias("week_of_year"), F.month(day).alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"), F.quarter(day).alias("quarter"),
        F.year(day).alias("year"), (F.weekday(day) >= 5).alias("is_weekend"),
        season.alias("season"),
    )
    if holidays is None:
        return dated.withColumn("is_holiday", F.lit(False))
    marked = holidays.select("full_date", F.lit(True).alias("_holiday")).distinct()
    return dated.join(marked, "full_date", "left").withColumn(
        "is_holiday", F.coalesce("_holiday", F.lit(False))).drop("_holiday")


def category_paths(categories: DataFrame) -> DataFrame:
    """Root, depth and path of every category of a parent hierarchy, however deep.

    Every round each category takes over the path of the one its own path hangs from, so the paths
    double and the number of rounds is the logarithm of the depth. Categories that no root reaches
    (below a missing parent, in a ring or below one) are left out.
    """
    tree = materialize(categories.select(
        "category_id", "category_name", F.col("category_name").alias("root_name"),
        F.lit(0).alias("depth"), F.col("category_name").alias("path"),
        F.col("parent_category_id").alias("_up")), "tree")
    for _ in range(tree.count().bit_length() + 1):
        if tree.where("_up is not null").isEmpty():
            break
        above = tree.select(
            F.col("category_id").alias("_up"), F.col("root_name").alias("_root"),
            F.col("depth").alias("_depth"), F.col("path").alias("_path"),
            F.col("_up").alias("_next"))
        lifted = tree.join(above, "_up").select(
            "category_id", "category_name", F.col("_root").alias("root_name"),
            (F.col("depth") + F.col("_depth") + 1).alias("depth"),
            F.concat("_path", F.lit(" > "), "path").alias("path"), F.col("_next").alias("_up"))
        tree = materialize(tree.where("_up is null").unionByName(lifted), "tree")
    return tree.where("_up is null").drop("_up")


def build_dim_product(products: DataFrame, categories: DataFrame, brands: DataFrame,
                      manufacturers: DataFrame) -> DataFrame:
    """Products with category, department (the root category), brand and manufacturer."""
    tree = category_paths(categories).select(
        "category_id", "category_name", F.col("root_name").alias("department_name"))
    makers = brands.join(manufacturers, "manufacturer_id", "left").select(
        "brand_id", "brand_name", "manufacturer_name")
    return products.join(tree, "category_id", "left").join(makers, "brand_id", "left").drop(
        "category_id", "brand_id")


def build_dim_supplier(suppliers: DataFrame, nations: DataFrame, *, key: str = "nation_id") -> DataFrame:
    """Suppliers with the name of their nation."""
    return suppliers.join(nations, key, "left").drop(key)


def build_dim_customer(customers: DataFrame, segments: DataFrame) -> DataFrame:
    return customers.join(segments, "segment_id", "left").drop("segment_id")


def build_dim_location(locations: DataFrame, countries: DataFrame, regions: DataFrame,
                       warehouses: DataFrame) -> DataFrame:
    """Locations with country and region; a warehouse is a location that dim_warehouse names."""
    places = countries.join(regions, "region_id", "left").select(
        "country_id", "country_name", "region_name")
    stores = warehouses.select("location_id").distinct().withColumn("is_warehouse", F.lit(True))
    return (
        locations.join(places, "country_id", "left").join(stores, "location_id", "left")
        .withColumn("is_warehouse", F.coalesce("is_warehouse", F.lit(False))).drop("country_id")
    )


def build_fact_sales(orders: DataFrame, items: DataFrame, statuses: DataFrame) -> DataFrame:
    """One row per item. Shipping and tax of an order are shared by line amount, so their sums over
    lines are those of the orders.

    Line amounts are summed per order by a grouped aggregate instead of a window, so an order with
    very many lines is combined on the map side; the join of lines and heads is one that Spark
    splits where a key is skewed.
    """
    amounts = items.groupBy("order_id").agg(F.sum("total_price").alias("_order_amount"))
    heads = (
        orders.join(statuses, "status_id", "left").join(amounts, "order_id")
        .select("order_id", "order_date_id", "customer_id", "location_id", "status_name",
                "shipping_cost", "tax_amount", "_order_amount")
    )
    share = F.try_divide(F.col("total_price").cast("double"),
                         F.col("_order_amount").cast("double"))
    return items.join(heads, "order_id").select(
        "order_item_id", "order_date_id", "customer_id", "product_id", "location_id", "quantity",
        "unit_price", "discount_amount", F.col("total_price").alias("total_amount"),
        (F.col("shipping_cost").cast("double") * share).alias("shipping_cost"),
        (F.col("tax_amount").cast("double") * share).alias("tax_amount"),
        F.col("status_name").alias("order_status"),
    )


def sales_lines(orders: DataFrame, items: DataFrame) -> DataFrame:
    """The columns of the sales fact that need no sharing of order costs."""
    heads = orders.select("order_id", "order_date_id", "customer_id", "location_id")
    return items.join(heads, "order_id").select(
        "order_date_id", "customer_id", "product_id", "location_id", "quantity",
        F.col("total_price").alias("total_amount"))


def build_fact_inventory(inventory: DataFrame, warehouses: DataFrame,
                         products: DataFrame) -> DataFrame:
    """Stock at a location and day. Received and shipped have no source and stay null."""
    return (
        inventory.join(warehouses.select("warehouse_id", "location_id"), "warehouse_id", "left")
        .join(products.select("product_id", "unit_cost"), "product_id", "left")
        .select(
            "inventory_id", "product_id", "supplier_id",
            F.col("last_stock_update_date_id").alias("date_id"), "location_id",
            "quantity_on_hand", F.lit(None).cast("int").alias("quantity_received"),
            F.lit(None).cast("int").alias("quantity_shipped"), "reorder_point", "unit_cost",
            (F.col("quantity_on_hand") * F.col("unit_cost")).alias("total_value"),
        )
    )


def reorder_report(fact_inventory: DataFrame) -> DataFrame:
    return fact_inventory.where(F.col("quantity_on_hand") < F.col("reorder_point"))


def sales_by(fact: DataFrame, dims: list[tuple[DataFrame, str, str]], keys: list[str],
             amount: str = "total_amount") -> DataFrame:
    """Sales by attributes of dimensions, each given as (frame, fact key, dimension key).

    The fact is summed by its dimension keys first, so the joins see one row per combination.
    """
    fact_keys = list(dict.fromkeys(key for _, key, _ in dims))
    grouped = fact.groupBy(*fact_keys).agg(
        F.sum(amount).alias("_amount"), F.sum("quantity").alias("_quantity"),
        F.count(F.lit(1)).alias("_lines"))
    for dim, fact_key, dim_key in dims:
        wanted = [k for k in keys if k in dim.columns]
        named = dim.select(F.col(dim_key).alias(f"_{dim_key}"), *wanted)
        grouped = grouped.join(named, F.col(fact_key) == F.col(f"_{dim_key}"), "left")
    return grouped.groupBy(*keys).agg(
        F.sum("_amount").alias("total_amount"), F.sum("_quantity").alias("total_quantity"),
        F.sum("_lines").alias("line_count"))


def rollup_lattice(base: DataFrame, wanted: dict[str, list[str]],
                   measures: tuple[str, ...] = ("total_amount", "total_quantity", "line_count")
                   ) -> dict[str, DataFrame]:
    """Rollups by lists of keys, all from one frame of sums by all their keys.

    `base` is written once, so whatever it is made of is scanned once; its rows are bounded by the
    values of the keys. Every rollup is summed from the smallest one that has all its keys, which is
    written too, and only from `base` where there is none.
    """
    def summed(parent: DataFrame, keys: list[str]) -> DataFrame:
        return parent.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])

    kinds = {m: base.schema[m].dataType for m in measures}
    base, made = materialize(base, "lattice"), {}
    for name in sorted(wanted, key=lambda n: -len(wanted[n])):
        keys = wanted[name]
        parents = [n for n in made if set(keys) < set(wanted[n])]
        parent = made[min(parents, key=lambda n: len(wanted[n]))] if parents else base
        made[name] = materialize(summed(parent, keys).withColumns(
            {m: F.col(m).cast(kind) for m, kind in kinds.items()}), "rollup")
    return made
