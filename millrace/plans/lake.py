"""Staff and department figures over a lake; landing, cataloguing and curating."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import money
from millrace.operators import aggregates as agg
from millrace.operators import joins
from millrace.operators.layout import write_partitioned
from millrace.plans.registry import query, table
from millrace.session import materialize, scratch
from millrace.sources import lake
from millrace.sources.files import write_curated
from millrace.streaming import ingest


def departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = table(spark, sf_dir, "region")
    return table(spark, sf_dir, "nation").join(
        regions, F.col("n_regionkey") == F.col("r_regionkey")
    ).select(
        F.col("n_nationkey").alias("department_id"), F.col("n_name").alias("department_name"),
        F.col("r_name").alias("location"),
        ((F.col("n_nationkey") + 1) * 1_000_000).cast("decimal(18,2)").alias("budget"))


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return table(spark, sf_dir, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    ).select(
        F.col("c_custkey").alias("employee_id"), F.col("c_name").alias("name"),
        F.col("n_name").alias("department"), money("c_acctbal").alias("salary"))


def raw_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both kinds of record in one table, told apart by their label."""
    staff = employees(spark, sf_dir).withColumn("partition_0", F.lit("employees"))
    units = departments(spark, sf_dir).withColumn("partition_0", F.lit("departments"))
    return staff.unionByName(units, allowMissingColumns=True)


EMPLOYEES = """(SELECT c_custkey AS employee_id, c_name AS name, n_name AS department,
    c_acctbal AS salary FROM customer JOIN nation ON c_nationkey = n_nationkey)"""
DEPARTMENTS = """(SELECT n_name AS department_name, r_name AS location,
    (n_nationkey + 1) * 1000000 AS budget
    FROM nation JOIN region ON n_regionkey = r_regionkey)"""


@query("department_summary", f"""
    WITH c AS (SELECT department, count(*) AS n,
                      (sum(salary::DECIMAL(18,2)) * 100)::HUGEINT AS cents
               FROM {EMPLOYEES} e GROUP BY 1)
    SELECT department_name, location, budget::DOUBLE AS budget, n AS employee_count,
           ((2 * cents + n) // (2 * n)) / 100::DOUBLE AS avg_salary,
           cents / 100::DOUBLE AS total_salary_cost,
           (budget::HUGEINT * 100 - cents) / 100::DOUBLE AS budget_remaining,
           ((2 * cents * 100 + budget) // (2 * budget)) / 100::DOUBLE
             AS budget_utilization_percent
    FROM {DEPARTMENTS} d LEFT JOIN c ON c.department = d.department_name
""")
def department_summary(spark, sf_dir):
    cost = agg.department_cost(employees(spark, sf_dir))
    return agg.budget_metrics(joins.department_summary(departments(spark, sf_dir), cost))


EMPLOYEE_SQL = f"""
    SELECT employee_id, name, department, location, salary
    FROM {EMPLOYEES} e JOIN {DEPARTMENTS} d ON e.department = d.department_name
"""


@query("employee_summary", EMPLOYEE_SQL)
def employee_summary(spark, sf_dir):
    return joins.employee_summary(
        employees(spark, sf_dir), departments(spark, sf_dir),
        ["employee_id", "name", "department", "location", "salary"])


@query("curated_sink", EMPLOYEE_SQL)
def curated_sink(spark, sf_dir):
    path = write_curated(employee_summary(spark, sf_dir), scratch(spark, "curated"),
                         "employee_summary")
    return spark.read.parquet(path)


@query("top_by_salary", f"""
    SELECT employee_id, name, department, salary FROM {EMPLOYEES} e
    ORDER BY salary DESC, employee_id LIMIT 5
""")
def top_by_salary(spark, sf_dir):
    staff = joins.labelled(raw_table(spark, sf_dir), "employees")
    return joins.top_k(staff, "salary", 5, "employee_id").select(
        "employee_id", "name", "department", "salary")


@query("top_joined", f"""
    SELECT employee_id, name, department, department_name, location, salary
    FROM {EMPLOYEES} e JOIN {DEPARTMENTS} d ON e.department = d.department_name
    ORDER BY salary DESC, employee_id LIMIT 5
""")
def top_joined(spark, sf_dir):
    return joins.employee_department_details(raw_table(spark, sf_dir))


@query("labelled_self_join", f"""
    SELECT employee_id, name, department, department_name, location, salary
    FROM {EMPLOYEES} e JOIN {DEPARTMENTS} d ON e.department = d.department_name
""")
def labelled_self_join(spark, sf_dir):
    return joins.employee_department_details(raw_table(spark, sf_dir), k=None)


@query("budgets_ordered",
       f"SELECT department_name, location, budget::DOUBLE AS budget FROM {DEPARTMENTS} d")
def budgets_ordered(spark, sf_dir):
    units = joins.labelled(raw_table(spark, sf_dir), "departments")
    return units.select("department_name", "location", "budget").orderBy(
        F.desc("budget"), "department_name")


@query("department_salary_stats", f"""
    SELECT department, location, count(*) AS employee_count,
           sum(salary::DECIMAL(18,2))::DOUBLE / count(*) AS avg_salary,
           min(salary) AS min_salary, max(salary) AS max_salary,
           sum(salary::DECIMAL(18,2))::DOUBLE AS total_salary_cost, budget::DOUBLE AS budget,
           (budget - sum(salary::DECIMAL(18,2)))::DOUBLE AS budget_remaining
    FROM {EMPLOYEES} e JOIN {DEPARTMENTS} d ON e.department = d.department_name
    GROUP BY department, location, budget
""")
def department_salary_stats(spark, sf_dir):
    return joins.department_salary_stats(raw_table(spark, sf_dir))


@query("catalog_partition_scan", f"SELECT employee_id, name, department, salary FROM {EMPLOYEES} e")
def catalog_partition_scan(spark, sf_dir):
    """A partition of a catalog entry over landed files; the entry goes when its rows are kept."""
    path, entry = scratch(spark, "raw"), f"raw_{uuid.uuid4().hex}"
    write_partitioned(raw_table(spark, sf_dir), ["partition_0"], path)
    lake.register_table(spark, path, entry, spark.read.parquet(path).schema, ["partition_0"])
    try:
        return materialize(lake.read_partition(spark, entry, "partition_0 = 'employees'").select(
            "employee_id", "name", "department", "salary"), "curated")
    finally:
        spark.sql(f"DROP TABLE {entry}")


@query("save_query_result", f"""
    SELECT employee_id, name, department, salary FROM {EMPLOYEES} e
    ORDER BY salary DESC, employee_id LIMIT 5
""")
def save_query_result(spark, sf_dir):
    saved = {"top_by_salary": lambda s: top_by_salary(s, sf_dir)}
    return lake.run_saved(spark, saved, "top_by_salary", scratch(spark, "results"))


# -- landing ----------------------------------------------------------------------------------

_HALF = "2024-01-15"


@query("raw_to_cleaned", """
    SELECT event_id || ',' || user_id || ',' || event_type AS value, TRUE AS has_origin
    FROM events
""")
def raw_to_cleaned(spark, sf_dir):
    raw, clean = scratch(spark, "landed"), scratch(spark, "cleaned")
    lines = F.concat_ws(",", "event_id", "user_id", "event_type").alias("value")
    table(spark, sf_dir, "events").select(lines).write.text(raw)
    ingest.run_available(ingest.land_to_clean(spark, raw, clean, scratch(spark, "checkpoint")))
    origin = F.col("source_key").contains("landed") & F.col("processed_timestamp").isNotNull()
    return spark.read.parquet(clean).select("value", origin.alias("has_origin"))


@query("incremental_ingest", "SELECT event_id, user_id, event_type, value FROM events")
def incremental_ingest(spark, sf_dir):
    """Two drops, loaded one after the other; a third run finds nothing new."""
    root, sink, mark = (scratch(spark, n) for n in ("drops", "loaded", "checkpoint"))
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value",
                                                   "ts")
    early = F.col("ts") < F.lit(_HALF).cast("timestamp_ntz")
    for drop in (events.where(early), events.where(~early)):
        drop.drop("ts").write.mode("append").parquet(root)
        ingest.ingest_new_files(spark, root, sink, mark, drop.drop("ts").schema)
    ingest.ingest_new_files(spark, root, sink, mark, events.drop("ts").schema)
    return spark.read.parquet(sink)


@query("discover_schema", f"""
    SELECT event_id, event_type, CASE WHEN ts >= TIMESTAMP '{_HALF}' THEN props END AS props
    FROM events
""")
def discover_schema(spark, sf_dir):
    """Older files lack a column; the merged schema reads both."""
    root = scratch(spark, "crawled")
    events = table(spark, sf_dir, "events")
    early = F.col("ts") < F.lit(_HALF).cast("timestamp_ntz")
    events.where(early).select("event_id", "event_type").write.parquet(f"{root}/batch=1")
    events.where(~early).select("event_id", "event_type", "props").write.parquet(
        f"{root}/batch=2")
    schema, _ = lake.discover_schema(spark, root)
    return spark.read.schema(schema).parquet(root).drop("batch")
