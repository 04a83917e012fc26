"""Grouped measures over sales, orders and stock."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import mean_of, seconds_between
from millrace.operators.joins import with_global
from millrace.operators.ordered import number_rows
from millrace.session import materialize


# -- sales by day -----------------------------------------------------------------------------

def daily_revenue(df: DataFrame, low, high, *, date: str = "order_date",
                  amount: str = "order_amount") -> DataFrame:
    """Revenue per day within an inclusive range, ordered by day."""
    return (
        df.where(F.col(date).between(F.lit(low), F.lit(high)))
        .groupBy(date).agg(F.sum(amount).alias("total_amount")).orderBy(date)
    )


def region_category_revenue(df: DataFrame, *, region: str = "region",
                            category: str = "product_category",
                            revenue: str = "revenue") -> DataFrame:
    return (
        df.groupBy(region, category).agg(F.sum(revenue).alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), region, category)
    )


def daily_sales_stats(df: DataFrame, *, date: str = "sale_date", amount: str = "amount",
                      high: float = 500) -> DataFrame:
    return df.groupBy(date).agg(
        F.sum(amount).alias("daily_revenue"),
        F.count(F.lit(1)).alias("transaction_count"),
        mean_of(amount).alias("avg_transaction_value"),
        F.count_if(F.col(amount) > high).alias("high_value_transactions"),
        F.min(amount).alias("min_transaction"),
        F.max(amount).alias("max_transaction"),
    )


def daily_stats_summary(stats: DataFrame) -> DataFrame:
    """Smallest, largest and mean day of three measures."""
    measures = {"revenue": "daily_revenue", "transactions": "transaction_count",
                "high_value": "high_value_transactions"}
    return stats.agg(*[
        agg(col).alias(f"{how}_{name}")
        for name, col in measures.items()
        for how, agg in (("min", F.min), ("max", F.max), ("avg", mean_of))
    ])


def daily_revenue_variance(stats: DataFrame, limit: int = 100, *,
                           date: str = "sale_date") -> DataFrame:
    """Days above half the mean revenue and count with a high-value sale, best revenue first.

    The days are written once, so that their means do not aggregate the sales a second time.
    """
    stats = materialize(stats, "days")
    means = stats.agg(mean_of("daily_revenue").alias("_revenue"),
                      mean_of("transaction_count").alias("_count"))
    revenue, count = F.col("daily_revenue").cast("double"), F.col("transaction_count")
    return (
        with_global(stats, means)
        .where((revenue > F.col("_revenue") * 0.5) & (count > F.col("_count") * 0.5)
               & (F.col("high_value_transactions") >= 1))
        .select(
            *stats.columns,
            (F.try_divide(revenue - F.col("_revenue"), F.col("_revenue")) * 100)
            .alias("revenue_variance_pct"),
            (F.col("high_value_transactions").cast("double") / count * 100)
            .alias("high_value_tx_pct"),
            F.try_divide((F.col("max_transaction") - F.col("min_transaction")).cast("double"),
                         F.col("avg_transaction_value")).alias("price_range_ratio"),
        )
        .orderBy(F.desc("daily_revenue"), date).limit(limit)
    )


# -- dashboard --------------------------------------------------------------------------------

def sales_by_day(df: DataFrame, grain: str = "day", *, date: str = "order_date",
                 amount: str = "amount") -> DataFrame:
    period = F.date_trunc(grain, F.col(date)).cast("date").alias("period")
    return df.groupBy(period).agg(F.sum(amount).alias("total_amount")).orderBy("period")


def top_products(df: DataFrame, k: int = 10, *, product: str = "product_id",
                 quantity: str = "quantity") -> DataFrame:
    return (
        df.groupBy(product).agg(F.sum(quantity).alias("total_quantity"))
        .orderBy(F.desc("total_quantity"), product).limit(k)
    )


def customer_distribution(df: DataFrame, *, customer: str = "customer_id") -> DataFrame:
    return (
        df.groupBy(customer).agg(F.count(F.lit(1)).alias("order_count"))
        .orderBy(F.desc("order_count"), customer)
    )


def sales_summary(df: DataFrame, *, date: str = "order_date", amount: str = "amount") -> DataFrame:
    """Grand total with the daily trend line; the running total runs over days, not rows."""
    days = materialize(df.groupBy(F.to_date(date).alias("day")).agg(
        F.sum(amount).alias("day_amount")), "days")
    trend = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = days.agg(F.sum("day_amount").alias("total_amount"))
    return with_global(
        days.withColumn("running_amount", F.sum("day_amount").over(trend)), total
    ).orderBy("day")


# -- departments ------------------------------------------------------------------------------

def department_cost(employees: DataFrame, *, department: str = "department",
                    salary: str = "salary") -> DataFrame:
    return employees.groupBy(department).agg(
        F.count(F.lit(1)).alias("employee_count"),
        F.round(F.sum(salary).cast("decimal(28,2)") / F.count(salary), 2)
        .cast("decimal(18,2)").alias("avg_salary"),
        F.sum(salary).alias("total_salary_cost"),
    )


def budget_metrics(df: DataFrame) -> DataFrame:
    """Rest and use of the budget, both to two decimals."""
    cost = F.col("total_salary_cost").cast("decimal(28,2)")
    budget = F.col("budget").cast("decimal(18,2)")
    return df.withColumns({
        "budget_remaining": F.round(budget - cost, 2).cast("decimal(28,2)"),
        "budget_utilization_percent": F.round(F.try_divide(cost, budget) * 100, 2)
        .cast("decimal(18,2)"),
    })


def partition_counts(df: DataFrame, partition: str = "partition") -> DataFrame:
    return df.groupBy(partition).agg(F.count(F.lit(1)).alias("order_count"))


def latest_value(df: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """Value of the newest row per key."""
    return df.groupBy(key).agg(F.max_by(value, F.struct(*order)).alias(value))


# -- customers --------------------------------------------------------------------------------

def customer_order_analytics(orders: DataFrame, *, customer: str = "customer_id",
                             date: str = "order_date", amount: str = "total_amount") -> DataFrame:
    """One row per customer and hour of day; the gap is the span over the order count less one."""
    first, last = (F.unix_timestamp(agg(date).cast("timestamp")) for agg in (F.min, F.max))
    return orders.groupBy(customer, F.hour(date).alias("peak_order_hour")).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum(amount).alias("total_spent"),
        mean_of(amount).alias("avg_order_value"),
        ((last - first) / (F.lit(86400.0) * F.greatest(F.count(F.lit(1)) - 1, F.lit(1))))
        .alias("avg_days_between_orders"),
    )


def order_hours(orders: DataFrame, *, customer: str = "customer_id", date: str = "order_date",
                amount: str = "total_amount") -> DataFrame:
    """Partials per customer and hour of day, at most 24 rows per customer."""
    return orders.groupBy(F.col(customer).alias("customer_id"), F.hour(date).alias("hour")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum(amount).alias("spent"),
        F.min(date).alias("first_at"), F.max(date).alias("last_at"),
    )


def customer_order_patterns(hours: DataFrame) -> DataFrame:
    """One row per customer from `order_hours`. The mean gap is the span over the number of gaps,
    null for one order or no span; among equally frequent hours the earliest is the peak."""
    orders = F.sum("orders")
    span = seconds_between(F.max("last_at"), F.min("first_at")) / 86400
    return hours.groupBy("customer_id").agg(
        orders.alias("total_orders"),
        F.sum("spent").alias("total_spent"),
        F.try_divide(F.sum("spent").cast("double"), orders).alias("avg_order_value"),
        F.nullif(F.try_divide(span, orders - 1), F.lit(0.0)).alias("avg_days_between_orders"),
        F.max_by("hour", F.struct(F.col("orders"), -F.col("hour"))).alias("peak_order_hour"),
    )


def customer_segments(patterns: DataFrame, n: int = 4) -> DataFrame:
    """Equal-sized segments by order frequency and by spend; VIP is the top segment of both.

    Ranks are row numbers by blocks, so no task sorts all customers. The patterns are written once, as
    both rankings, their samples and the count read them.
    """
    patterns = materialize(patterns, "patterns")
    size = patterns.agg(F.count(F.lit(1)).alias("_all"))

    def tile(df: DataFrame, col: str, name: str) -> DataFrame:
        ranked = with_global(number_rows(df, [], [col, "customer_id"], "_rank"), size)
        small, extra = F.floor(F.col("_all") / n), F.col("_all") % n
        head = extra * (small + 1)
        bucket = F.when(F.col("_rank") <= head,
                        F.ceil(F.col("_rank") / (small + 1))).otherwise(
            extra + F.ceil(F.try_divide(F.col("_rank") - head, small)))
        return ranked.withColumn(name, bucket.cast("int")).drop("_rank", "_all")

    tiled = tile(tile(patterns, "total_orders", "frequency_segment"),
                 "total_spent", "spend_segment")
    return tiled.withColumn(
        "is_vip", (F.col("frequency_segment") == n) & (F.col("spend_segment") == n)
    )


# -- stock ------------------------------------------------------------------------------------

def utilisation(inventory: DataFrame, locations: DataFrame) -> DataFrame:
    """Stock over capacity per warehouse; a warehouse without stock counts as empty."""
    used = inventory.groupBy("location_id").agg(F.sum("quantity").alias("_used"))
    joined = locations.join(used, "location_id", "left")
    return joined.select(
        "location_id", "warehouse_code", "capacity",
        F.coalesce("_used", F.lit(0)).alias("used"),
        F.try_divide(F.coalesce("_used", F.lit(0)).cast("double"), F.col("capacity"))
        .alias("utilisation"),
    )


def stock_status(inventory: DataFrame, low: float, high: float, *, quantity: str = "quantity",
                 capacity: str = "capacity") -> DataFrame:
    share = F.try_divide(F.col(quantity).cast("double"), F.col(capacity))
    return inventory.withColumn(
        "stock_status",
        F.when(share.isNull(), None).when(share < low, "needs_restock")
        .when(share > high, "overstocked").otherwise("ok"),
    )


def turnover(items: DataFrame, inventory: DataFrame, period: str = "month", *,
             date: str = "order_date") -> DataFrame:
    """Quantity sold per product and period over the mean stock of the product."""
    sold = items.groupBy("product_id", F.date_trunc(period, F.col(date)).cast("date")
                         .alias("period")).agg(F.sum("quantity").alias("sold"))
    stock = inventory.groupBy("product_id").agg(mean_of("quantity").alias("mean_stock"))
    return sold.join(stock, "product_id", "left").withColumn(
        "turnover", F.try_divide(F.col("sold").cast("double"), F.col("mean_stock"))
    )
