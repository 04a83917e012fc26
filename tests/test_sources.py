"""Readers, writers, discovery and layouts."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SMALL

from millrace import session
from millrace.operators import layout
from millrace.sources import files, jdbc, lake, payloads

PEOPLE = "name string, age int, city string"


@pytest.fixture
def people(spark):
    return spark.createDataFrame([("Ann", 25, "Oslo"), ("Bob", 30, "Rome"), ("Cy", 35, "Lima")],
                                 PEOPLE)


def test_columnar_json(spark, tmp_path):
    path = tmp_path / "sample.json"
    path.write_text('{"name": ["Ann", "Bob"],\n "age": [25, null],\n "city": ["Oslo", "Rome"]}')
    rows = files.read_columnar_json(spark, str(path),
                                    {"name": "string", "age": "int", "city": "string"})
    assert sorted(map(tuple, rows.collect())) == [("Ann", 25, "Oslo"), ("Bob", None, "Rome")]


def test_csv_null_text(spark, tmp_path):
    path = tmp_path / "departments.csv"
    path.write_text("id,name,manager\n1,HR,7\n2,Sales,null\n")
    rows = files.read_csv(spark, str(path), "id int, name string, manager int", "null").collect()
    assert [tuple(r) for r in rows] == [(1, "HR", 7), (2, "Sales", None)]


@pytest.mark.parametrize("source", ["csv", "json", "parquet", "orc"])
@pytest.mark.parametrize("target", ["csv", "json", "parquet", "orc"])
def test_convert(spark, people, tmp_path, source, target):
    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    files.WRITERS[source](people, src)
    assert files.convert_format(spark, src, source, dst, target, people.schema) == 3
    back = files.READERS[target](spark, dst, people.schema)
    assert sorted(back.collect()) == sorted(people.collect())


def test_avro_needs_support(spark, people, tmp_path):
    if files.avro_mode(spark) is None:
        with pytest.raises(RuntimeError):
            files.write_avro(people, str(tmp_path / "a"))
    else:
        files.write_avro(people, str(tmp_path / "a"))
        back = files.read_avro(spark, str(tmp_path / "a"), people.schema)
        assert sorted(back.collect()) == sorted(people.collect())


def test_bulk_load(spark, tmp_path):
    (tmp_path / "cleaned_sales.csv").write_text(
        "order_id,amount,day\n1,2.5,2024-01-01\nx,1,2024-01-01\n3,4\n4,1.0,2024-01-02\n")
    (tmp_path / "other.csv").write_text("order_id,amount,day\n9,9,2024-01-01\n")
    schema = T.StructType().add("order_id", "integer").add("amount", "double").add("day", "date")
    good, bad = files.bulk_load(spark, str(tmp_path), schema, "*cleaned_sales.csv")
    assert sorted(map(tuple, good.collect())) == [(1, 2.5, date(2024, 1, 1)),
                                                  (4, 1.0, date(2024, 1, 2))]
    assert sorted(r["line"] for r in bad.collect()) == ["3,4", "x,1,2024-01-01"]
    with pytest.raises(Exception):
        files.bulk_load(spark, str(tmp_path), schema, "*cleaned_sales.csv", "abort")


def test_publish_refuses_nothing(people, tmp_path):
    with pytest.raises(ValueError):
        files.publish(people.where("age > 99"), str(tmp_path / "p"))


def test_reconcile(people):
    found = {r["table"]: r["missing"] for r in files.reconcile(
        {"a": people, "b": people}, {"a": people, "b": people.limit(1)}).collect()}
    assert found == {"a": 0, "b": 2}


def test_jdbc_options():
    options = jdbc.scan_options("jdbc:x", "orders", partition_col="id", lower=1, upper=9, n=4)
    assert options["numPartitions"] == "4" and options["lowerBound"] == "1"
    assert "partitionColumn" not in jdbc.scan_options("jdbc:x", "orders")
    with pytest.raises(ValueError):
        jdbc.scan_options("jdbc:x", "orders", partition_col="id")


def test_discovery_reports_and_keeps(spark, people, tmp_path):
    root = str(tmp_path / "root")
    people.write.parquet(f"{root}/part=1")
    people.withColumn("extra", F.lit(1.5)).write.parquet(f"{root}/part=2")
    known = T.StructType().add("name", "string").add("gone", "integer").add("age", "string")
    schema, diff = lake.discover_schema(spark, root, known)
    assert set(schema.names) == {"name", "age", "city", "extra", "part", "gone"}
    assert diff == {"added": ["city", "extra", "part"], "missing": ["gone"], "changed": ["age"]}
    lake.register_table(spark, root, "discovered", schema, ["part"])
    rows = lake.read_partition(spark, "discovered", "part = 2")
    assert rows.count() == 3 and rows.agg(F.sum("extra")).first()[0] == 4.5
    spark.sql("drop table discovered")


def test_trades(spark):
    lines = ['{"e":"trade","s":"BTCUSDT","p":"1.5","q":"2","T":1700000000123}',
             '{"e":"quote","s":"BTCUSDT","p":"1","q":"2","T":1}', "{broken",
             '{"e":"trade","s":"ETHUSDT","p":"x","q":"2","T":1}',
             '{"e":"trade","s":"DOGE","p":"1","q":"2","T":1}']
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    rows = payloads.parse_trades(df, symbols=["btcusdt", "ethusdt"]).collect()
    assert [(r["symbol"], r["price"], r["volume"]) for r in rows] == [("btcusdt", 1.5, 2.0)]
    assert rows[0]["timestamp"].microsecond == 123000


# -- layout -----------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def sales(spark):
    return spark.range(20_000).select(
        F.col("id").alias("transaction_id"),
        F.date_add(F.lit("2023-01-01").cast("date"), (F.col("id") * 7919 % 365).cast("int"))
        .alias("sale_date"),
        (F.col("id") % 997).cast("decimal(10,2)").alias("amount"))


def test_clustered_layout_reads_less(spark, sales, tmp_path):
    plain, clustered = str(tmp_path / "plain"), str(tmp_path / "clustered")
    sales.repartition(8).write.parquet(plain)
    layout.write_clustered(sales, ["sale_date"], clustered, 8)

    def week(path):
        return spark.read.parquet(path).where("sale_date between '2023-03-01' and '2023-03-07'")

    report = layout.compare(week(plain), week(clustered))
    assert report["same"] and report["plain"]["rows"] == report["optimised"]["rows"] > 0
    ranges = spark.read.parquet(clustered).groupBy(F.input_file_name()).agg(
        F.min("sale_date").alias("low"), F.max("sale_date").alias("high")).orderBy("low").collect()
    assert all(a["high"] <= b["low"] for a, b in zip(ranges, ranges[1:]))


def test_partitioned_layout_prunes(spark, sales, tmp_path):
    plain, parted = str(tmp_path / "plain"), str(tmp_path / "parted")
    dated = sales.withColumns({"year": F.year("sale_date"), "month": F.month("sale_date")})
    dated.repartition(8).write.parquet(plain)
    layout.write_partitioned(dated, ["year", "month"], parted)

    def december(path):
        return spark.read.parquet(path).select(*dated.columns).where("year = 2023 and month = 12")

    report = layout.compare(december(plain), december(parted))
    assert report["same"]
    assert report["optimised"]["bytes"] < report["plain"]["bytes"]
    assert report["optimised"]["files"] < report["plain"]["files"]


def test_refresh_rewrites_touched_months_only(spark, sales, tmp_path):
    path = str(tmp_path / "daily")
    layout.create_daily_sales(sales, path)
    kept = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "daily" / "sale_month=2023-05").iterdir()}
    extra = spark.createDataFrame([(99_999, date(2023, 7, 1), Decimal("900.00"))], sales.schema)
    grown = sales.unionByName(extra)
    assert layout.refresh_daily_sales(grown, path, added=extra) == []
    again = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "daily" / "sale_month=2023-05").iterdir()}
    assert kept == again
    from millrace.operators.aggregates import daily_sales_stats
    direct, stored = daily_sales_stats(grown), layout.read_daily_sales(spark, path)
    assert direct.exceptAll(stored.select(*direct.columns)).isEmpty()
    # a month that lost all its rows goes, and the base is read for the touched days alone
    july = F.col("sale_date") >= F.lit("2023-07-01").cast("date")
    august = F.col("sale_date") >= F.lit("2023-08-01").cast("date")
    rest = grown.where(~(july & ~august))
    assert layout.refresh_daily_sales(rest, path, removed=grown.where(july & ~august)) == []
    direct, stored = daily_sales_stats(rest), layout.read_daily_sales(spark, path)
    assert direct.exceptAll(stored.select(*direct.columns)).isEmpty()
    assert stored.select(*direct.columns).exceptAll(direct).isEmpty()


def test_refresh_reads_the_base_only_where_an_extreme_was_taken(spark, sales, tmp_path):
    from millrace.operators.aggregates import daily_sales_stats

    path, where = str(tmp_path / "daily"), "sale_date = '2023-05-0{}'"
    layout.create_daily_sales(sales, path)
    fourth, fifth = (sales.where(where.format(d)) for d in (4, 5))
    largest = fourth.agg(F.max("amount")).first()[0]
    middle = fifth.orderBy("amount").collect()[5]["transaction_id"]
    gone = (F.col("sale_date") == F.lit("2023-05-04").cast("date")) & (F.col("amount") == largest)
    gone = gone | (F.col("transaction_id") == middle)
    base = str(tmp_path / "base")
    layout.write_clustered(sales.where(~gone), ["sale_date"], base, 8)
    rest = spark.read.parquet(base)
    again = layout.refresh_daily_sales(rest, path, removed=sales.where(gone))
    assert again == [date(2023, 5, 4)]
    direct, stored = daily_sales_stats(rest), layout.read_daily_sales(spark, path)
    assert direct.exceptAll(stored.select(*direct.columns)).isEmpty()
    assert stored.select(*direct.columns).exceptAll(direct).isEmpty()
    ranges = layout._day_ranges([date(2024, 2, 29), date(2024, 3, 1), date(2024, 1, 1)])
    assert ranges == [(date(2024, 1, 1), date(2024, 1, 2)), (date(2024, 2, 29), date(2024, 3, 2))]


def test_interleaved_layout_serves_both_columns(spark, sales, tmp_path):
    plain, mixed = str(tmp_path / "plain"), str(tmp_path / "mixed")
    sales.repartition(16).write.parquet(plain)
    layout.write_interleaved(sales, ["sale_date", "amount"], mixed, 16)
    for condition in ("sale_date between '2023-03-01' and '2023-03-07'", "amount between 100 and 130"):
        report = layout.compare(spark.read.parquet(plain).where(condition),
                                spark.read.parquet(mixed).where(condition))
        assert report["same"] and report["plain"]["scanned"] == 20_000
        assert report["optimised"]["scanned"] < 9_000
    odd = sales.withColumn("amount", F.when(F.col("amount") > 500, F.col("amount")))
    placed = layout.curve_position(odd, ["sale_date", "amount"], 3)
    assert placed.columns == [*odd.columns, "_curve"] and placed.where("_curve is null").isEmpty()
    assert placed.agg(F.max("_curve")).first()[0] == 63


def test_bucketed_join_has_no_exchange(spark, tmp_path):
    df = spark.range(5000)
    for name in ("left_b", "right_b"):
        layout.write_bucketed(df, name, "id", 4, str(tmp_path / name))
    joined = spark.table("left_b").hint("merge").join(spark.table("right_b"), "id")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.count() == 5000
    for name in ("left_b", "right_b"):
        spark.sql(f"drop table {name}")


def test_shared_folder_follows_the_session(spark):
    assert session.scratch(spark, "x").startswith(
        spark.sparkContext.getConf().get("spark.checkpoint.dir"))


def test_intermediates_are_deleted(spark, tmp_path):
    from pathlib import Path

    from millrace.plans import QUERIES

    root = Path(session.shared_folder(spark).removeprefix("file:"))
    before = set(root.glob("*"))
    with session.intermediates(spark):
        QUERIES["column_drift"](spark, SMALL).write.parquet(str(tmp_path / "out"))
        assert set(root.glob("*")) > before
    assert set(root.glob("*")) == before
    assert spark.read.parquet(str(tmp_path / "out")).count() > 0
