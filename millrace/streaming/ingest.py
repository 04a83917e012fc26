"""File streams: landing to cleaned, incremental loads, triggers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                **options) -> DataFrame:
    return spark.readStream.schema(schema).format(fmt).options(**options).load(path)


FILE_ROWS = 1_000_000


def _cuts(df: DataFrame, micros: Column, batches: int) -> tuple[int, list[int]]:
    """Rows of `df` and the times that part it into `batches` ranges of about equal size."""
    row = df.select(F.count(F.lit(1)).alias("n"), F.percentile_approx(
        micros, [i / batches for i in range(1, batches)]).alias("cuts")).first()
    return row["n"], sorted(set(row["cuts"] or []))


def land_in_batches(df: DataFrame, path: str, batches: int = 4, *, order: str | None = None,
                    file_rows: int = FILE_ROWS) -> DataFrame:
    """Write `df` in `batches` goes of files of about `file_rows` rows, and read it back as a stream
    that takes the files of one go at a time.

    With `order` the goes are ranges of that time, one after the other; rows without a time come
    first, as they do in a sort. Without it, every file holds rows from everywhere.
    """
    spark, schema = df.sparkSession, df.schema
    if order is None:
        files = max(1, -(-df.count() // (batches * file_rows)))
        df.repartition(batches * files).write.parquet(path)
    else:
        micros = F.unix_micros(F.col(order).cast("timestamp"))
        rows, cuts = _cuts(df, micros, batches)
        files = max(1, -(-rows // (batches * file_rows)))
        go = sum((F.when(micros > c, 1).otherwise(0) for c in cuts), F.lit(0))
        for i in range(len(cuts) + 1):
            # Rows of a go are dealt out evenly, so each go has as many files as the others and
            # one trigger takes exactly one go. Later goes have later files.
            df.where(go == i).repartition(files).write.mode("append").parquet(path)
    return file_stream(spark, path, schema, maxFilesPerTrigger=files)


def run_goes(df: DataFrame, go: Column, goes: int, path: str,
             writer: Callable[[DataFrame], DataStreamWriter]) -> None:
    """Write the rows of go 0, 1, ... one after the other and let the stream of `writer` take in
    each before the next one is written, continued from its checkpoint. A null go is go 0."""
    for i in range(goes):
        df.where(F.coalesce(go, F.lit(0)) == i).write.mode("append").parquet(path)
        run_available(writer(file_stream(df.sparkSession, path, df.schema)))


def with_source(df: DataFrame) -> DataFrame:
    """Processing time, bucket and key of the file a row came from."""
    path = F.col("_metadata.file_path")
    return df.select("*", F.current_timestamp().alias("processed_timestamp"),
                     F.try_parse_url(path, F.lit("HOST")).alias("source_bucket"),
                     F.try_parse_url(path, F.lit("PATH")).alias("source_key"))


def land_to_clean(spark: SparkSession, raw: str, clean: str, checkpoint: str, *, schema=None,
                  fmt: str = "text") -> DataStreamWriter:
    """Copy the records of every landed file with their origin; large files are split by Spark."""
    landed = file_stream(spark, raw, schema or "value string", fmt, recursiveFileLookup=True)
    return (with_source(landed).writeStream.format("parquet").option("path", clean)
            .option("checkpointLocation", checkpoint))


def ingest_new_files(spark: SparkSession, root: str, sink: str, checkpoint: str, schema,
                     fmt: str = "parquet") -> StreamingQuery:
    """Load the files not loaded before, then stop; the checkpoint remembers them."""
    return run_available(
        file_stream(spark, root, schema, fmt).writeStream.format("parquet").option("path", sink)
        .option("checkpointLocation", checkpoint))


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Process what has arrived and wait for the end."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_periodic(writer: DataStreamWriter, every: str = "5 minutes") -> StreamingQuery:
    return writer.trigger(processingTime=every).start()
