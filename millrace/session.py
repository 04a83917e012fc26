"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that can be changed on a running session.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

_local_folders: dict[str, str] = {}
_made: dict[str, list[str]] = {}


def build_session(app: str = "millrace", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; `extra` takes config keys as given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by `spark.checkpoint.dir`.

    Only a local-mode session without that setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folders.setdefault(
        context.applicationId, tempfile.mkdtemp(prefix="millrace-")
    )


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Delete on leaving what was written below the shared folder since entering.

        with intermediates(spark):
            query(spark, folder).write.parquet(result)

    Frames are lazy and read their intermediate tables when they are written, so the result has to
    be written (or collected) inside.
    """
    made = _made.setdefault(spark.sparkContext.applicationId, [])
    first = len(made)
    try:
        yield
    finally:
        for path in made[first:]:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        del made[first:]


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back.

    Cuts the lineage like a checkpoint, but stays columnar, so later reads are pruned.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
