"""Lake folders: schema discovery, partition scans and saved queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T


def discover_schema(spark: SparkSession, root: str, known: T.StructType | None = None,
                    fmt: str = "parquet") -> tuple[T.StructType, dict[str, list[str]]]:
    """Merged schema of all files below root, and what changed against the known one.

    Columns that are gone are only reported; the merged schema keeps them.
    """
    found = spark.read.format(fmt).option("mergeSchema", True).load(root).schema
    known = known or T.StructType()
    old, new = ({f.name: f.dataType for f in s} for s in (known, found))
    diff = {
        "added": [n for n in new if n not in old],
        "missing": [n for n in old if n not in new],
        "changed": [n for n in new if n in old and new[n] != old[n]],
    }
    kept = [f for f in known if f.name not in new]
    return T.StructType([*found.fields, *kept]), diff


def register_table(spark: SparkSession, root: str, table: str, schema: T.StructType,
                   partitions: list[str], fmt: str = "parquet") -> None:
    """Catalog entry over existing files, with the partitions found there."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    split = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    spark.sql(f"CREATE TABLE {table} ({columns}) USING {fmt} {split} LOCATION '{root}'")
    if partitions:
        spark.catalog.recoverPartitions(table)


def read_partition(spark: SparkSession, table: str, predicate: str | Column) -> DataFrame:
    """Rows of a catalog table or folder; a predicate on its partition columns prunes files."""
    source = spark.read.parquet(table) if "/" in table else spark.table(table)
    return source.where(predicate)


def run_saved(spark: SparkSession, queries: dict[str, Callable[[SparkSession], DataFrame]],
              name: str, root: str) -> DataFrame:
    """Run a named query and keep its result below the results root."""
    path = f"{root.rstrip('/')}/{name}"
    queries[name](spark).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
