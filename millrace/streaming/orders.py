"""Order stream: JSON messages to a keyed order table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace.functions.columns import line_total, parse_ts, route
from millrace.operators.aggregates import daily_sales_stats
from millrace.streaming.store import upsert

ORDER = ("order_id string, customer_name string, product string, category string, "
         "quantity string, price string, timestamp string")
KEYS = ["partition", "order_id"]
ORDER_BY = ["timestamp", "total_amount", "product", "customer_name"]


def order_stream(spark: SparkSession, transport: dict,
                 max_per_trigger: int | None = None) -> DataFrame:
    """Messages as a `value` text column; `max_per_trigger` files, or messages of a topic, make a
    batch at most.

    transport {"format": "kafka", "kafka.bootstrap.servers": ..., "subscribe": ...} reads a topic
    from its start; {"format": "text", "path": ...} reads files as they arrive.
    """
    options = dict(transport)
    fmt = options.pop("format")
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        options = {"startingOffsets": "earliest", **options}
        if max_per_trigger:
            options = {"maxOffsetsPerTrigger": max_per_trigger, **options}
        return reader.options(**options).load().select(
            F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))
    if max_per_trigger:
        options = {"maxFilesPerTrigger": max_per_trigger, **options}
    return reader.options(**options).load()


def to_messages(df: DataFrame, key: str) -> DataFrame:
    """Rows as (key, value) messages; decimals become text, so no digit is lost."""
    fields = [F.col(f.name).cast("string").alias(f.name)
              if f.dataType.typeName() == "decimal" else F.col(f.name) for f in df.schema]
    return df.select(F.col(key).cast("string").alias("key"),
                     F.to_json(F.struct(*fields)).alias("value"))


def publish(stream: DataFrame, key: str, transport: dict, checkpoint: str) -> DataStreamWriter:
    """Writer of the messages to a topic or folder."""
    options = dict(transport)
    fmt = options.pop("format")
    messages = to_messages(stream, key)
    if fmt != "kafka":
        messages = messages.select("value")
    return messages.writeStream.format(fmt).options(**options).option(
        "checkpointLocation", checkpoint)


def parse_orders(messages: DataFrame) -> DataFrame:
    """Messages read by the order schema; `_bad` holds the text of one that lacks a usable id,
    price, quantity or time."""
    # A generator is computed once; a condition on a plain parsed column would parse again below.
    order = F.explode(F.array(F.from_json("value", ORDER)))
    parsed = messages.select("value", order.alias("_o")).withColumns({
        "_total": line_total("_o.price", "_o.quantity"), "_at": parse_ts("_o.timestamp"),
    })
    usable = F.expr("_o.order_id is not null and _total is not null and _at is not null")
    return parsed.withColumn("_bad", F.when(~usable, F.col("value"))).drop("value")


def split_bad(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readable orders, and the text of the others."""
    parsed = parse_orders(messages)
    return (parsed.where(F.col("_bad").isNull()).drop("_bad"),
            parsed.where(F.col("_bad").isNotNull()).select(F.col("_bad").alias("value")))


def enrich_orders(parsed: DataFrame, *keep: str, partitions: int = 3) -> DataFrame:
    """Typed order with its total and the partition of its product, and the columns `keep`. What
    cannot be read is null."""
    return parsed.select(
        "_o.order_id", route("_o.product", partitions).alias("partition"), "_o.customer_name",
        "_o.product", "_o.category", F.col("_o.quantity").try_cast("int").alias("quantity"),
        F.col("_o.price").try_cast("decimal(10,2)").alias("price"), F.col("_at").alias("timestamp"),
        F.col("_total").cast("decimal(18,2)").alias("total_amount"), *keep,
    )


def upsert_stream(messages: DataFrame, path: str, dead_letters: str,
                  checkpoint: str) -> DataStreamWriter:
    """Write good orders to the keyed table and bad messages to `dead_letters`; both writes
    replace the batch's own directory, so a replay is harmless. A batch is read and parsed once, and
    kept as typed columns, which take less room than the parsed text."""
    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = enrich_orders(parse_orders(batch), "_bad").persist()
        try:
            good = parsed.where(F.col("_bad").isNull()).drop("_bad")
            upsert(good, batch_id, path, KEYS, ORDER_BY)
            bad = parsed.where(F.col("_bad").isNotNull()).select(F.col("_bad").alias("value"))
            bad.write.mode("overwrite").parquet(f"{dead_letters}/batch_id={batch_id}")
        finally:
            parsed.unpersist()

    return messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def _first_copies(key: str) -> Callable[[Iterator], Iterator]:
    """Drops the copies of a key within an Arrow batch; null is a key."""
    def keep(batches: Iterator) -> Iterator:
        for batch in batches:
            values = batch.column(batch.schema.get_field_index(key))
            codes = values.dictionary_encode(null_encoding="encode").indices
            first = np.unique(codes.to_numpy(), return_index=True)[1]
            yield batch.take(pa.array(np.sort(first)))

    return keep


def dedup(stream: DataFrame, key: str, within: str = "10 minutes", salts: int = 0) -> DataFrame:
    """One row per key; a copy is a row of the same key that arrives `within` that time of the one
    before it.

    The watermark is on the time of arrival, so it bounds the state, and no row is ever late: an
    old event that arrives for the first time is kept. Copies are first dropped within each Arrow
    batch, before the shuffle and without state, so of a row that was sent very often one in 10,000
    reaches the task of its key. With `salts` they are also dropped, with state, among the input
    partitions of the same salt, so it reaches that task `salts` times at most.
    """
    thinned = stream.mapInArrow(_first_copies(key), stream.schema).withColumn(
        "_arrived", F.current_timestamp()).withWatermark("_arrived", within)
    if salts:
        thinned = thinned.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts))
                                     ).dropDuplicatesWithinWatermark([key, "_salt"]).drop("_salt")
    return thinned.dropDuplicatesWithinWatermark([key]).drop("_arrived")


def sample_partition(df: DataFrame, partition: int, n: int, unique: str = "order_id") -> DataFrame:
    """First n rows of one partition."""
    return df.where(F.col("partition") == partition).orderBy(unique).limit(n)


def stream_daily_stats(stream: DataFrame, path: str, checkpoint: str, *, date: str = "sale_date",
                       amount: str = "amount", high: float = 500) -> DataStreamWriter:
    """Keep the daily statistics current as rows arrive.

    Every batch emits the days it changed with their whole aggregate from the state store; they
    replace the earlier rows of those days in the keyed table.
    """
    stats = daily_sales_stats(stream, date=date, amount=amount, high=high)

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert(batch, batch_id, path, [date], ["transaction_count"])

    return (stats.writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", checkpoint))
