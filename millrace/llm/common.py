"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import materialize, tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"
#: Lowers A-Z in UTF-8 bytes. `bytes.split()` parts at 0x20 and 0x09-0x0D, which is what WORD says.
LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def query(name: str, sql: str | None = None):
    """Register a query of this package."""
    def register(plan: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plan(set_up(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return plan

    return register


def set_up(spark: SparkSession) -> SparkSession:
    """The library's settings, with Arrow batches bounded in rows and bytes: texts can be long."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def const_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table of constants, made by SQL alone (no Python rows)."""
    kinds = [part.split() for part in schema.split(",")]
    made = [F.struct(*[F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(row, kinds)])
            for row in rows]
    one = spark.range(1)
    if not made:
        return one.select(*[F.lit(None).cast(kind).alias(name) for name, kind in kinds]).limit(0)
    return one.select(F.inline(F.array(*made)))


def join_small(rows: DataFrame, small: DataFrame, on: list[str], how: str = "inner",
               most: int = 100_000) -> DataFrame:
    """Join with a written table that is usually small: broadcast if it has `most` rows at most
    (which the file footers say), else an ordinary join, which Spark splits where a key is skewed."""
    return rows.join(F.broadcast(small) if small.count() <= most else small, on, how)


def unsigned_part(hexed: Column, first: int, digits: int) -> Column:
    """`digits` (up to 15) hexadecimal digits from `first` (from 1) as a long."""
    return F.conv(F.substring(hexed, first, digits), 16, 10).cast("long")


__all__ = ["LOWER_BYTES", "ORACLES", "QUERIES", "WORD", "ascii_lower", "const_rows", "join_small",
           "materialize", "query", "set_up", "table", "unsigned_part"]
