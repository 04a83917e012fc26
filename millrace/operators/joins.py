"""Joins of stock, staff and order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import inventory_score, mean_of, recent
from millrace.session import materialize


def with_global(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row aggregate to every row, as a scalar subquery."""
    figures = one_row.select(F.struct(*one_row.columns)).scalar()
    return df.withColumn("_global", figures).select("*", "_global.*").drop("_global")


def detailed_inventory(products: DataFrame, inventory: DataFrame,
                       locations: DataFrame) -> DataFrame:
    return (
        inventory.join(products, "product_id").join(locations, "location_id")
        .select("product_id", F.col("name").alias("product_name"), "price", "quantity", "capacity",
                "warehouse_code", "city", "last_updated")
    )


def inventory_analytics(detailed: DataFrame, as_of) -> DataFrame:
    score = inventory_score("quantity", "capacity", "last_updated", as_of)
    return detailed.withColumn("inventory_score", score)


def department_summary(departments: DataFrame, cost: DataFrame) -> DataFrame:
    """Departments with the pre-aggregated cost; one without staff keeps nulls."""
    return departments.join(
        cost, departments["department_name"] == cost["department"], "left"
    ).select("department_name", "location", "budget", "employee_count", "avg_salary",
             "total_salary_cost")


def employee_summary(employees: DataFrame, departments: DataFrame, cols: list[str]) -> DataFrame:
    joined = employees.join(
        departments.select("department_name", "location"),
        F.col("department") == F.col("department_name"),
    )
    return joined.select(*cols)


def labelled(raw: DataFrame, label: str, column: str = "partition_0") -> DataFrame:
    """Rows of one label of a table that holds several kinds of record."""
    return raw.where(F.col(column) == label)


def employee_department_details(raw: DataFrame, k: int | None = 5) -> DataFrame:
    """The table joined with itself on its labels, best paid first."""
    staff = labelled(raw, "employees").select("employee_id", "name", "department", "salary")
    units = labelled(raw, "departments").select("department_name", "location")
    joined = staff.join(units, F.col("department") == F.col("department_name")).select(
        "employee_id", "name", "department", "department_name", "location", "salary"
    )
    return top_k(joined, "salary", k, "employee_id") if k else joined


def department_salary_stats(raw: DataFrame) -> DataFrame:
    """Salary figures per department. Staff is aggregated before the join, so a department with
    most of the staff meets the join as one row."""
    salary = F.col("salary")
    cost = labelled(raw, "employees").groupBy("department").agg(
        F.count(F.lit(1)).alias("employee_count"),
        F.try_divide(F.sum(salary).cast("double"), F.count(salary)).alias("avg_salary"),
        F.min(salary).alias("min_salary"), F.max(salary).alias("max_salary"),
        F.sum(salary).alias("total_salary_cost"),
    )
    units = labelled(raw, "departments").select("department_name", "location", "budget")
    return (
        cost.join(units, F.col("department") == F.col("department_name"))
        .drop("department_name")
        .withColumn("budget_remaining", F.col("budget") - F.col("total_salary_cost"))
        .orderBy(F.desc("total_salary_cost"), "department")
    )


def top_k(df: DataFrame, col: str, k: int, unique: str) -> DataFrame:
    """The k largest; `unique` settles ties, so the result is defined."""
    return df.orderBy(F.desc(col), unique).limit(k)


def business_analytics(inventory: DataFrame, items: DataFrame, orders: DataFrame,
                       customers: DataFrame, analytics: DataFrame, *, as_of,
                       days: int = 30) -> DataFrame:
    """Stock with the orders of the last days and their customers' figures.

    Stock and items are outer-joined in the view this stands for, but its filter on the order date
    drops the unmatched rows, so they are inner joins here. Recent orders are joined first: they
    cut the items before these meet the stock.
    """
    newest = orders.where(recent("order_date", days, as_of)).select(
        "order_id", "customer_id", "order_date")
    sold = items.select("order_id", "product_id", F.col("quantity").alias("ordered_quantity"))
    people = customers.select("customer_id", "customer_name").withColumn("_known", F.lit(True))
    figures = analytics.select(
        F.col("customer_id").alias("_customer"), "total_orders", "total_spent", "avg_order_value",
        "avg_days_between_orders", "peak_order_hour")
    return (
        sold.join(newest, "order_id")
        .join(people, "customer_id", "left")
        .join(figures, (F.col("customer_id") == F.col("_customer")) & F.col("_known"), "left")
        .join(inventory, "product_id")
        .drop("_customer", "_known")
    )


_INSIGHT_KEYS = ["product_name", "city", "warehouse_code", "inventory_score", "quantity"]


def business_insights(inventory: DataFrame, items: DataFrame, orders: DataFrame,
                      customers: DataFrame, analytics: DataFrame, *, as_of,
                      days: int = 30) -> DataFrame:
    """Demand per stock position, as over the rows of `business_analytics`.

    A customer with several rows of analytics repeats each of their items, so the sums count it
    several times; `business_insights_by_customer` counts each item once.

    Nothing is fanned out for that: analytics are summed per customer, items per product and order
    (which splits a hot product) and then per product, and stock meets one row per product. Orders
    are counted per product; where products of one name share the figures of a position, the orders
    that hold several of them, found by grouping each order's products by name, are taken off.
    """
    value = F.col("avg_order_value").cast("decimal(18,6)")
    newest = orders.where(recent("order_date", days, as_of)).select("order_id", "customer_id")
    figures = analytics.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("_copies"), F.sum(value).alias("_value"),
        F.count(value).alias("_values")).join(customers.select("customer_id"), "customer_id", "semi")
    sold = items.select("order_id", "product_id", F.col("quantity").alias("_quantity")).join(
        newest, "order_id").join(figures, "customer_id", "left")
    pairs = materialize(sold.groupBy("product_id", "order_id").agg(
        F.sum(F.col("_quantity") * F.coalesce("_copies", F.lit(1))).alias("_quantity"),
        F.sum("_value").alias("_value"), F.sum("_values").alias("_values")), "demand")
    sums = ("_quantity", "_value", "_values")
    demand = pairs.groupBy("product_id").agg(*[F.sum(c).alias(c) for c in sums],
                                             F.count(F.lit(1)).alias("_orders"))
    # Both are used twice, and written columns are pruned where an exchange is not.
    stock = materialize(inventory.join(demand, "product_id").groupBy(
        "product_id", *_INSIGHT_KEYS, *sums, "_orders").agg(
        F.count(F.lit(1)).alias("_positions")), "stock")
    names = stock.select("product_id", "product_name").distinct()
    several = pairs.select("product_id", "order_id").join(names, "product_id").groupBy(
        "order_id", "product_name").agg(F.collect_set("product_id").alias("_met")).where(
        F.size("_met") > 1).select("order_id", F.explode("_met").alias("product_id")).distinct()
    twice = several.join(stock.select("product_id", *_INSIGHT_KEYS), "product_id").groupBy(
        *_INSIGHT_KEYS, "order_id").agg((1 - F.count(F.lit(1))).alias("_orders"))
    counted = stock.select(*_INSIGHT_KEYS, "_orders", *[
        (F.col("_positions") * F.col(c)).alias(c) for c in sums]).unionByName(
        twice.drop("order_id"), allowMissingColumns=True)
    return (
        counted.groupBy(*_INSIGHT_KEYS).agg(
            F.sum("_quantity").alias("total_ordered"), F.sum("_orders").alias("number_of_orders"),
            F.try_divide(F.sum("_value").cast("double"), F.sum("_values"))
            .alias("customer_avg_order_value"))
        .withColumnRenamed("quantity", "current_stock")
        .orderBy(F.desc("inventory_score"), "product_name", "city", "warehouse_code",
                 "current_stock")
    )


def business_insights_by_customer(inventory: DataFrame, items: DataFrame, orders: DataFrame,
                                  patterns: DataFrame, *, as_of, days: int = 30) -> DataFrame:
    """Demand per stock position with each item counted once. Demand is summed per product before
    it meets the stock, so nothing fans out."""
    newest = orders.where(recent("order_date", days, as_of)).select("order_id", "customer_id")
    figures = patterns.select("customer_id", F.col("avg_order_value").cast("decimal(18,6)"))
    demand = (
        items.select("order_id", "product_id", "quantity").join(newest, "order_id")
        .join(figures, "customer_id", "left")
        .groupBy("product_id").agg(
            F.sum("quantity").alias("total_ordered"),
            F.count_distinct("order_id").alias("number_of_orders"),
            mean_of("avg_order_value").alias("customer_avg_order_value"),
        )
    )
    return (
        inventory.join(demand, "product_id")
        .select("product_id", *_INSIGHT_KEYS, "total_ordered", "number_of_orders",
                "customer_avg_order_value")
        .withColumnRenamed("quantity", "current_stock")
        .orderBy(F.desc("inventory_score"), "product_id", "warehouse_code")
    )


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key has no parent; a null key refers to nothing and is not an orphan.

    Only distinct keys are compared, so neither side sends the rows of a hot key to one task.
    """
    keys = child.select(child_key).where(F.col(child_key).isNotNull()).distinct()
    known = parent.select(F.col(parent_key).alias("_parent")).distinct()
    lost = keys.join(known, F.col(child_key) == F.col("_parent"), "left_anti")
    return child.join(lost, child_key, "left_semi")
