"""Physical layout, maintained aggregates and the comparison of layouts."""

from __future__ import annotations

import datetime
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.aggregates import daily_sales_stats
from millrace.session import materialize


def write_clustered(df: DataFrame, cols: list[str], path: str, parts: int | None = None) -> None:
    """Files hold disjoint ranges of `cols`, so min/max statistics skip files and row groups."""
    ranged = df.repartitionByRange(parts, *cols) if parts else df.repartitionByRange(*cols)
    ranged.sortWithinPartitions(*cols).write.mode("overwrite").parquet(path)


RANK_BITS = 8  # bits of a column's rank in the curve


def curve_position(df: DataFrame, cols: list[str], bits: int = RANK_BITS) -> DataFrame:
    """`df` with `_curve`: the bits of the range ranks of numeric, date or time columns interleaved, so
    that rows near in all columns are near in it.

    The rank of a value is the number of cut points at or before it; the 2**bits - 1 cut points of a
    column are quantiles, taken in the same plan by one aggregate. A null comes first.
    """
    def number(c: str) -> str:
        kind = df.schema[c].dataType.typeName()
        if kind == "date":
            return f"unix_date(`{c}`)"
        if kind.startswith("timestamp"):
            return f"unix_micros(cast(`{c}` as timestamp))"
        return f"cast(`{c}` as double)"

    shares = f"array({', '.join(f'{i / 2 ** bits}D' for i in range(1, 2 ** bits))})"
    cuts = df.select(F.expr("struct(" + ", ".join(
        f"array_sort(array_distinct(percentile_approx({number(c)}, {shares}))) as c{i}"
        for i, c in enumerate(cols)) + ")")).scalar()
    ranked = df.withColumn("_cuts", cuts)
    ranks = [f"""coalesce(aggregate(transform(sequence({bits - 1}, 0, -1), b -> shiftleft(1, b)), 0,
        (at, step) -> if(at + step <= size(_cuts.c{i}) and get(_cuts.c{i}, at + step - 1) <= {number(c)},
                         at + step, at)), 0)""" for i, c in enumerate(cols)]
    ranked = ranked.selectExpr("*", *[f"{r} as _rank{i}" for i, r in enumerate(ranks)])
    mixed = " | ".join(
        f"shiftleft(cast(shiftright(_rank{i}, {b}) & 1 as bigint), {b * len(cols) + i})"
        for b in range(bits) for i in range(len(cols)))
    return ranked.selectExpr(*[f"`{c}`" for c in df.columns], f"{mixed} as _curve")


def write_interleaved(df: DataFrame, cols: list[str], path: str, parts: int,
                      bits: int = RANK_BITS) -> None:
    """Files hold stretches of a space-filling curve over `cols`, so filters on any of these columns
    skip row groups; clustering by a list of columns serves the first one only."""
    placed = curve_position(df, cols, bits)
    placed.repartitionByRange(parts, "_curve", *cols).sortWithinPartitions("_curve", *cols).drop(
        "_curve").write.mode("overwrite").parquet(path)


def write_partitioned(df: DataFrame, cols: list[str], path: str,
                      max_records: int = 5_000_000) -> None:
    """One directory per value of `cols`. REBALANCE lets AQE split a large value over several tasks
    and merge small ones; `max_records` bounds a file."""
    (df.hint("rebalance", *cols).write.option("maxRecordsPerFile", max_records)
     .partitionBy(*cols).mode("overwrite").parquet(path))


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str) -> None:
    """Rows bucketed and sorted by key; a join of two such tables on the key needs no exchange."""
    (df.write.bucketBy(buckets, key).sortBy(key).option("path", path).mode("overwrite")
     .saveAsTable(table))


def fan_out(df: DataFrame, targets: dict[str, tuple[list[str], dict]], root: str,
            reuse: bool = False) -> None:
    """Project one frame into several tables of different layout.

    A target is (columns, layout), the layout one of {"cluster": cols}, {"partition": cols}, {}.
    Every target scans only its columns. With `reuse` a frame that is costly to compute is written
    once first and the targets read that.
    """
    if reuse:
        df = materialize(df, "fan_out")
    for name, (cols, layout) in targets.items():
        part, path = df.select(*cols), f"{root}/{name}"
        if "cluster" in layout:
            write_clustered(part, layout["cluster"], path)
        elif "partition" in layout:
            write_partitioned(part, layout["partition"], path)
        else:
            part.write.mode("overwrite").parquet(path)


# -- maintained daily statistics --------------------------------------------------------------

def create_daily_sales(base: DataFrame, path: str, *, date: str = "sale_date",
                       amount: str = "amount", high: float = 500) -> None:
    """The daily statistics in one directory per month, with the number of known amounts beside
    them, so that sums and means can be taken back."""
    stats = daily_sales_stats(base, date=date, amount=amount, high=high)
    known = base.groupBy(F.col(date).alias("_day")).agg(F.count(amount).alias("_known"))
    stats = stats.join(known, F.col(date).eqNullSafe(F.col("_day"))).drop("_day")
    write_partitioned(stats.withColumn("sale_month", F.date_format(date, "yyyy-MM")),
                      ["sale_month"], path)


def _signed(added: DataFrame, removed: DataFrame, date: str, amount: str, high: float) -> DataFrame:
    """One row per touched day: what to add to its sums and counts, and the extremes on both sides."""
    rows = added.select(date, amount, F.lit(1).alias("_sign")).unionByName(
        removed.select(date, amount, F.lit(-1).alias("_sign")))
    value, sign = F.col(amount), F.col("_sign")
    known, big = value.isNotNull().cast("int"), F.coalesce((value > high).cast("int"), F.lit(0))
    new, old = F.when(sign > 0, value), F.when(sign < 0, value)
    return rows.groupBy(F.col(date).alias("_day")).agg(
        F.sum(sign * value).alias("d_revenue"), F.sum(sign).alias("d_count"),
        F.sum(sign * known).alias("d_known"), F.sum(sign * big).alias("d_high"),
        F.min(new).alias("new_min"), F.max(new).alias("new_max"),
        F.min(old).alias("old_min"), F.max(old).alias("old_max"))


def _day_ranges(days: list[datetime.date]) -> list[tuple[datetime.date, datetime.date]]:
    """Runs of days as (first, day after the last)."""
    runs: list[list[datetime.date]] = []
    for day in sorted(days):
        if runs and runs[-1][1] == day:
            runs[-1][1] = day + datetime.timedelta(days=1)
        else:
            runs.append([day, day + datetime.timedelta(days=1)])
    return [(a, b) for a, b in runs]


def refresh_daily_sales(base: DataFrame, path: str, *, added: DataFrame | None = None,
                        removed: DataFrame | None = None, date: str = "sale_date",
                        amount: str = "amount", high: float = 500) -> list[datetime.date]:
    """Bring the statistics up to date with rows that came and rows that were taken back.

    Sums and counts change by signed rows. A smallest or largest amount is worked out again only for
    days from which it was taken, and only these days of `base`, the table after the change, are
    read; they are returned. Months that were not touched keep their files, one that has no rows left
    goes. Amounts should be decimal, as sums of doubles cannot be taken back exactly. Days and months
    that come to the driver are bounded by the calendar. `date` is a date without nulls.
    """
    spark, nothing = base.sparkSession, base.limit(0)
    deltas = materialize(_signed(nothing if added is None else added,
                                 nothing if removed is None else removed, date, amount, high), "deltas")
    months = sorted(r[0] for r in deltas.select(F.date_format("_day", "yyyy-MM")).distinct().collect()
                    if r[0])
    if not months:
        return []
    stored = spark.read.parquet(path)
    touched = stored.where(F.col("sale_month").cast("string").isin(months)).drop("sale_month")
    kinds = {f.name: f.dataType for f in touched.schema}
    both = touched.join(deltas, F.col(date) == F.col("_day"), "full")

    def total(column: str, change: str) -> Column:
        return (F.coalesce(column, F.lit(0)) + F.coalesce(change, F.lit(0))).cast(
            kinds[column]).alias(column)

    merged = materialize(both.select(
        F.coalesce(date, "_day").alias(date),
        F.when(F.coalesce("_known", F.lit(0)) + F.coalesce("d_known", F.lit(0)) > 0,
               total("daily_revenue", "d_revenue")).alias("daily_revenue"),
        total("transaction_count", "d_count"), total("_known", "d_known"),
        total("high_value_transactions", "d_high"),
        F.least("min_transaction", "new_min").alias("min_transaction"),
        F.greatest("max_transaction", "new_max").alias("max_transaction"),
        ((F.col("old_min") <= F.col("min_transaction"))
         | (F.col("old_max") >= F.col("max_transaction"))).alias("_lost"),
    ).where("transaction_count > 0"), "merged")
    lost = [r[0] for r in merged.where("_lost").select(F.col(date).cast("date")).collect()]
    if lost:
        # As text: Spark's parser makes a balanced tree of many ranges.
        inside = " or ".join(f"(`{date}` >= date'{low}' and `{date}` < date'{after}')"
                             for low, after in _day_ranges(lost))
        again = base.where(inside).groupBy(F.col(date).alias("_day")).agg(
            F.min(amount).alias("_min"), F.max(amount).alias("_max"))
        merged = merged.join(again, F.col(date) == F.col("_day"), "left").withColumns({
            "min_transaction": F.when(F.col("_lost"), F.col("_min")).otherwise(F.col("min_transaction")),
            "max_transaction": F.when(F.col("_lost"), F.col("_max")).otherwise(F.col("max_transaction"))})
    mean = F.try_divide(F.col("daily_revenue").cast("double"), F.col("_known"))
    final = materialize(
        merged.withColumn("avg_transaction_value", mean).select(*touched.columns)
        .withColumn("sale_month", F.date_format(date, "yyyy-MM")), "refreshed")
    (final.hint("rebalance", "sale_month").write.option("partitionOverwriteMode", "dynamic")
     .partitionBy("sale_month").mode("overwrite").parquet(path))
    # The overwrite replaces months that have rows; the others are taken away.
    still = {r[0] for r in final.select("sale_month").distinct().collect()}
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for month in months:
        if month not in still:
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/sale_month={month}"), True)
    return sorted(lost)


def read_daily_sales(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("sale_month", "_known")


# -- comparison -------------------------------------------------------------------------------

def _scan_metrics(df: DataFrame) -> dict[str, int]:
    """Files and bytes of the scans of an executed plan, and the rows that they handed on: rows of
    skipped row groups are not among them."""
    totals = {"files": 0, "bytes": 0, "scanned": 0}
    names = {"numFiles": "files", "filesSize": "bytes", "numOutputRows": "scanned"}
    todo = [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
        metrics = node.metrics()
        for metric, name in names.items():
            if metrics.contains("numFiles") and metrics.contains(metric):
                totals[name] += metrics.apply(metric).value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return totals


def compare(plain: DataFrame, optimised: DataFrame) -> dict:
    """Run a query on two layouts: equal answers, seconds, files and bytes read.

    The rows are counted on the executors from the frame's own plan, whose scan metrics are read
    afterwards.
    """
    report: dict = {}
    for name, df in (("plain", plain), ("optimised", optimised)):
        start = time.perf_counter()
        rows = df._jdf.queryExecution().toRdd().count()
        report[name] = {"rows": rows, "seconds": time.perf_counter() - start, **_scan_metrics(df)}
    report["same"] = (plain.exceptAll(optimised).isEmpty()
                      and optimised.exceptAll(plain).isEmpty())
    return report
