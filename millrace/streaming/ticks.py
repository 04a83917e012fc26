"""Trade ticks: collection windows and the running VWAP."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace.operators.ordered import over_series


def tick_windows(ticks: DataFrame, seconds: int = 60, minimum: int = 5, *,
                 watermark: str | None = "10 minutes") -> DataFrame:
    """Ticks per symbol and window; a window with fewer than `minimum` ticks is not sufficient.

    Partial aggregation merges the ticks of a hot symbol before the shuffle.
    """
    if watermark and ticks.isStreaming:
        ticks = ticks.withWatermark("timestamp", watermark)
    return ticks.groupBy("symbol", F.window("timestamp", f"{seconds} seconds").alias("_w")).agg(
        F.count(F.lit(1)).alias("points"), F.min("price").alias("low"), F.max("price").alias("high"),
        F.sum("volume").alias("volume"),
    ).select("symbol", F.col("_w.start").alias("window_start"),
             F.col("_w.end").alias("window_end"), "points", "low", "high", "volume",
             (F.col("points") >= minimum).alias("sufficient"))


WINDOW_KEYS = ["symbol", "window_start", "window_end"]


def window_table(ticks: DataFrame, path: str, checkpoint: str, seconds: int = 60
                 ) -> DataStreamWriter:
    """Writer of collection windows that loses no late tick: every batch writes what it adds to
    each window to a directory of its own, which a replay replaces."""
    def write(batch: DataFrame, batch_id: int) -> None:
        tick_windows(batch, seconds, watermark=None).drop("sufficient").write.mode(
            "overwrite").parquet(f"{path}/batch_id={batch_id}")

    return ticks.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def read_windows(spark: SparkSession, path: str, minimum: int = 5) -> DataFrame:
    """The windows over all batches so far."""
    return spark.read.parquet(path).groupBy(*WINDOW_KEYS).agg(
        F.sum("points").alias("points"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.sum("volume").alias("volume")).withColumn("sufficient", F.col("points") >= minimum)


def vwap_batch(batch: DataFrame, batch_id: int, path: str, *, order: list[str],
               **limits: int) -> None:
    """Running VWAP of one micro-batch, continued from the totals of the batches before it.

    The totals of a batch are one row per symbol, kept beside its output. A hot symbol is worked in
    blocks, so no task or state entry holds its ticks.
    """
    spark = batch.sparkSession
    batch = batch.persist()
    try:
        traded = {"_pv": F.col("price") * F.col("volume"), "_v": F.col("volume")}
        rows = over_series(batch, ["symbol"], order, lambda s: s.running(**traded), **limits)
        # Totals are cumulative, so the batch before holds every symbol seen so far.
        before = None
        if batch_id > 0:
            before = spark.read.parquet(f"{path}/totals/batch_id={batch_id - 1}")
        if before is None:
            carried = rows.withColumns({"_pv0": F.lit(0.0), "_v0": F.lit(0.0)})
        else:
            carried = rows.join(before, "symbol", "left").fillna({"_pv0": 0.0, "_v0": 0.0})
        out = carried.withColumn(
            "vwap", F.try_divide(F.col("_pv") + F.col("_pv0"), F.col("_v") + F.col("_v0")))
        out.select(*batch.columns, "vwap").write.mode("overwrite").parquet(
            f"{path}/rows/batch_id={batch_id}")
        sums = batch.groupBy("symbol").agg(
            F.sum(F.col("price") * F.col("volume")).alias("_pv0"), F.sum("volume").alias("_v0"))
        if before is not None:
            sums = sums.unionByName(before).groupBy("symbol").agg(
                F.sum("_pv0").alias("_pv0"), F.sum("_v0").alias("_v0"))
        sums.write.mode("overwrite").parquet(f"{path}/totals/batch_id={batch_id}")
    finally:
        batch.unpersist()


def stream_vwap(ticks: DataFrame, path: str, checkpoint: str, *, order: list[str],
                **limits: int) -> DataStreamWriter:
    """Writer of the running VWAP; rows are ordered within a batch, batches follow one another."""
    return ticks.writeStream.foreachBatch(
        lambda batch, batch_id: vwap_batch(batch, batch_id, path, order=order, **limits)
    ).option("checkpointLocation", checkpoint)
