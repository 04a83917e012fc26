"""Tables over JDBC. The database must be one that every executor can reach."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession


def scan_options(url: str, table: str, *, partition_col: str | None = None, lower=None, upper=None,
                 n: int = 1, **options: str) -> dict[str, str]:
    """Reader options; with `partition_col` the table is read in n ranges at once.

    Rows outside lower..upper go to the first and last range, so no row is left out.
    """
    chosen = {"url": url, "dbtable": table, "fetchsize": "10000", **options}
    if partition_col:
        if lower is None or upper is None:
            raise ValueError("a partitioned read needs lower and upper")
        chosen |= {"partitionColumn": partition_col, "lowerBound": str(lower),
                   "upperBound": str(upper), "numPartitions": str(n)}
    return chosen


def read_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**scan_options(url, table, **options)).load()


def append_table(df: DataFrame, url: str, table: str, batch: int = 10_000,
                 **options: str) -> None:
    """Append rows in batches; every partition writes over its own connection."""
    (df.write.format("jdbc").options(url=url, dbtable=table, batchsize=str(batch), **options)
     .mode("append").save())


def load_tables(spark: SparkSession, reader: Callable[[str], DataFrame],
                names: Iterable[str]) -> dict[str, DataFrame]:
    """Read tables and register each as a temporary view of its name."""
    tables = {name: reader(name) for name in names}
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return tables
