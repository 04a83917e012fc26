"""File readers and writers, format conversion and snapshots."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import materialize


# Text formats keep microseconds.
TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]",
         "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"}


def read_csv(spark: SparkSession, path: str, schema, null_value: str = "",
             mode: str = "FAILFAST") -> DataFrame:
    """Header CSV with a given schema; `null_value` is the text that stands for null."""
    return (spark.read.schema(schema).option("header", True).option("nullValue", null_value)
            .option("mode", mode).options(**TIMES).csv(path))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).options(**TIMES).csv(path)


def read_parquet(spark: SparkSession, path: str, schema=None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_orc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.orc(path)


def write_orc(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").orc(path)


def read_json(spark: SparkSession, path: str, schema) -> DataFrame:
    """One JSON object per line."""
    return spark.read.schema(schema).option("mode", "FAILFAST").options(**TIMES).json(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).options(**TIMES).json(path)


def read_columnar_json(spark: SparkSession, path: str, fields: dict[str, str],
                       multi_line: bool = True) -> DataFrame:
    """Rows of JSON objects that hold one array per column; `fields` gives the element types.

    A file is one object, or with multi_line=False one object per line.
    """
    schema = ", ".join(f"`{name}` array<{kind}>" for name, kind in fields.items())
    documents = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    return documents.select(F.inline(F.arrays_zip(*fields)))


# -- Avro -------------------------------------------------------------------------------------

def avro_mode(spark: SparkSession) -> str | None:
    """`package` with the Avro data source, `hive` with the SerDe of a Hive session, else None."""
    try:
        spark.read.format("avro").schema("a int").load([])
        return "package"
    except AnalysisException:
        pass
    hive = spark.conf.get("spark.sql.catalogImplementation", "in-memory") == "hive"
    return "hive" if hive else None


def _avro_table(spark: SparkSession, path: str, schema: T.StructType) -> str:
    name = f"avro_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE EXTERNAL TABLE {name} ({columns}) STORED AS AVRO LOCATION '{path}'")
    return name


def _need_avro(spark: SparkSession) -> str:
    mode = avro_mode(spark)
    if mode is None:
        raise RuntimeError("Avro needs the spark-avro package or a session with Hive support")
    return mode


def write_avro(df: DataFrame, path: str) -> None:
    spark = df.sparkSession
    if _need_avro(spark) == "package":
        df.write.mode("overwrite").format("avro").save(path)
        return
    table = _avro_table(spark, path, df.schema)
    try:
        df.write.mode("overwrite").insertInto(table)
    finally:
        spark.sql(f"DROP TABLE {table}")


def read_avro(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if _need_avro(spark) == "package":
        return spark.read.schema(schema).format("avro").load(path)
    return spark.table(_avro_table(spark, path, schema))


# -- conversion -------------------------------------------------------------------------------

READERS: dict[str, Callable] = {
    "csv": read_csv, "json": read_json, "avro": read_avro,
    "parquet": lambda spark, path, schema: read_parquet(spark, path, schema),
    "orc": lambda spark, path, schema: spark.read.schema(schema).orc(path),
    "columnar_json": lambda spark, path, schema: read_columnar_json(
        spark, path, {f.name: f.dataType.simpleString() for f in schema}),
}
WRITERS: dict[str, Callable] = {
    "csv": write_csv, "json": write_json, "avro": write_avro, "parquet": write_parquet,
    "orc": write_orc,
}


def convert_format(spark: SparkSession, src: str, src_format: str, dst: str, dst_format: str,
                   schema: T.StructType) -> int:
    """Rewrite files in another format; returns the row count, equal on both sides.

    The source rows are counted while they are written.
    """
    seen = Observation()
    source = READERS[src_format](spark, src, schema).observe(seen, F.count(F.lit(1)).alias("rows"))
    WRITERS[dst_format](source, dst)
    rows, copied = seen.get["rows"], READERS[dst_format](spark, dst, schema).count()
    if rows != copied:
        raise RuntimeError(f"{src} has {rows} rows, {dst} has {copied}")
    return rows


# -- sinks ------------------------------------------------------------------------------------

def write_snapshot(df: DataFrame, roots: list[str], table: str, run_date: str) -> list[str]:
    """Overwrite <root>/<table>/<run_date> under every root. The frame is computed for the first
    root; the others copy what was written, so they hold the same rows."""
    paths = [f"{root.rstrip('/')}/{table}/{run_date}" for root in roots]
    df.write.mode("overwrite").parquet(paths[0])
    written = df.sparkSession.read.schema(df.schema).parquet(paths[0])
    for path in paths[1:]:
        written.write.mode("overwrite").parquet(path)
    return paths


def publish(df: DataFrame, path: str, require_rows: bool = True) -> None:
    """Write a final table; an empty one is an error."""
    if require_rows and df.isEmpty():
        raise ValueError("nothing to publish: the table is empty")
    df.write.mode("overwrite").parquet(path)


def write_curated(df: DataFrame, root: str, name: str) -> str:
    path = f"{root.rstrip('/')}/data/{name}"
    df.write.mode("overwrite").parquet(path)
    return path


# -- bulk load --------------------------------------------------------------------------------

def bulk_load(spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.csv",
              on_error: str = "continue") -> tuple[DataFrame, DataFrame]:
    """Rows of the header CSV files that match a glob, and the lines that do not fit the schema.

    The files are parsed once into a staged table that both results filter. With on_error="abort" a
    bad line is an error.
    """
    corrupt = T.StructField("_corrupt", T.StringType())
    mode = "FAILFAST" if on_error == "abort" else "PERMISSIVE"
    rows = (
        spark.read.schema(T.StructType([*schema.fields, corrupt])).option("header", True)
        .option("mode", mode).option("columnNameOfCorruptRecord", "_corrupt").options(**TIMES)
        .option("pathGlobFilter", pattern).csv(folder)
    )
    staged = materialize(rows.withColumn("_file", F.col("_metadata.file_path")), "staged")
    good = staged.where(F.col("_corrupt").isNull()).drop("_corrupt", "_file")
    rejects = staged.where(F.col("_corrupt").isNotNull()).select(
        F.col("_corrupt").alias("line"), F.col("_file").alias("file"))
    return good, rejects


def reconcile(source: dict[str, DataFrame], sink: dict[str, DataFrame]) -> DataFrame:
    """Row counts of every table on both sides and their difference."""
    def counts(tables: dict[str, DataFrame], name: str) -> DataFrame:
        parts = [df.agg(F.count(F.lit(1)).alias(name)).withColumn("table", F.lit(t))
                 for t, df in tables.items()]
        merged = parts[0]
        for part in parts[1:]:
            merged = merged.unionByName(part)
        return merged

    both = counts(source, "source_rows").join(counts(sink, "sink_rows"), "table", "full")
    return both.select("table", "source_rows", "sink_rows", (
        F.coalesce("source_rows", F.lit(0)) - F.coalesce("sink_rows", F.lit(0))).alias("missing"))
