"""Keyed table with upsert on plain Parquet.

Every micro-batch writes its newest row per key to its own `batch_id` directory. Writing a batch
again replaces that directory, so a replay after a failure changes nothing, and the cost of a batch
does not grow with the table. Readers take the newest row per key over the last snapshot and the
batches after it; `compact` writes a new snapshot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace.operators.series import latest_per_key


def upsert(batch: DataFrame, batch_id: int, path: str, keys: list[str],
           order: list[str]) -> None:
    newest = latest_per_key(batch, keys, order)
    newest.write.mode("overwrite").parquet(f"{path}/changes/batch_id={batch_id}")


def _snapshot(spark: SparkSession, path: str) -> int | None:
    """Last batch id of the newest complete snapshot."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/snapshots")
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return None
    done = [
        int(status.getPath().getName().split("=")[1]) for status in fs.listStatus(root)
        if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS"))
    ]
    return max(done, default=None)


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", f"{path}/changes").parquet(f"{path}/changes").withColumn(
        "batch_id", F.col("batch_id").cast("long"))


def read_current(spark: SparkSession, path: str, keys: list[str], order: list[str], *,
                 by_arrival: bool = True) -> DataFrame:
    """Newest row per key: a later batch wins, within a batch the larger `order`. Without
    `by_arrival` the larger `order` wins whenever it arrived."""
    upto = _snapshot(spark, path)
    changes = read_changes(spark, path)
    if upto is not None:
        base = spark.read.parquet(f"{path}/snapshots/upto={upto}").withColumn(
            "batch_id", F.lit(upto).cast("long"))
        changes = base.unionByName(changes.where(F.col("batch_id") > upto))
    rank = ["batch_id", *order] if by_arrival else [*order, "batch_id"]
    return latest_per_key(changes, keys, rank).drop("batch_id")


def compact(spark: SparkSession, path: str, keys: list[str], order: list[str], *,
            by_arrival: bool = True) -> int:
    """Write the current state as a snapshot; returns the last batch it holds.

    The batches that the snapshot before it had already taken in are deleted, and so are all
    snapshots but the last two; a reader that is at work on the one before is not disturbed.
    """
    before = _snapshot(spark, path)
    upto = read_changes(spark, path).agg(F.max("batch_id")).first()[0]
    if upto is None or before == upto:
        return before
    read_current(spark, path, keys, order, by_arrival=by_arrival).write.mode("overwrite").parquet(
        f"{path}/snapshots/upto={upto}")
    if before is not None:
        _delete(spark, f"{path}/changes", "batch_id", before)
        _delete(spark, f"{path}/snapshots", "upto", before - 1)
    return upto


def _delete(spark: SparkSession, root: str, label: str, upto: int) -> None:
    """Delete the directories `label=n` with n up to `upto`."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith(f"{label}=") and int(name.split("=")[1]) <= upto:
            fs.delete(status.getPath(), True)


def upsert_latest(stream: DataFrame, path: str, keys: list[str], order: list[str],
                  checkpoint: str) -> DataStreamWriter:
    """Keep the newest row per key of a stream, such as the rows of a feature view."""
    def write(batch: DataFrame, batch_id: int) -> None:
        upsert(batch, batch_id, path, keys, order)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
