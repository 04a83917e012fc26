"""Ticks with state that Spark keeps: totals per symbol, windows closed by event-time timers.

Both first add up what an Arrow batch holds per key, on the map side, so a hot symbol reaches its
state as one row per batch of 10,000 ticks. State is in the state store: a replayed batch starts from
the state before it, and what a batch gives is written to a directory of its own, which a replay
replaces.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

_MEASURES = "points long, low double, high double, volume double, traded double"
#: Column, how it is added up, and the name under which it goes on.
_ADDED = [("price", "min", "low"), ("price", "max", "high"), ("volume", "sum", "volume"),
          ("traded", "sum", "traded")]
_ARROW = [("points", pa.int64()), *[(name, pa.float64()) for _, _, name in _ADDED]]


def _partial_sums(ticks: DataFrame, keys: str) -> DataFrame:
    """One row per key and Arrow batch; `ticks` holds the keys, price, volume and traded."""
    names = [part.split()[0] for part in keys.split(",")]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            sums = rows.group_by(names).aggregate([([], "count_all"), *[a[:2] for a in _ADDED]])
            found = {"points": sums["count_all"],
                     **{name: sums[f"{column}_{how}"] for column, how, name in _ADDED}}
            schema = pa.schema([*[(n, sums.schema.field(n).type) for n in names], *_ARROW])
            yield from pa.table([*[sums[n] for n in names], *[found[n] for n, _ in _ARROW]],
                                schema=schema).to_batches()

    return ticks.mapInArrow(add_up, f"{keys}, {_MEASURES}")


def _measures(ticks: DataFrame, *keys) -> DataFrame:
    price, volume = F.col("price").cast("double"), F.col("volume").cast("double")
    return ticks.select(*keys, price.alias("price"), volume.alias("volume"),
                        (price * volume).alias("traded"))


def _known(value) -> float | None:
    return None if value is None or pd.isna(value) else float(value)


def _merged(held: tuple | None, frames: Iterator[pd.DataFrame]) -> tuple:
    """State (points, low, high, volume, traded) with the partial sums of `frames` added."""
    points, low, high, volume, traded = held or (0, None, None, None, None)
    for frame in frames:
        points += int(frame["points"].sum())
        lows = [v for v in (low, _known(frame["low"].min())) if v is not None]
        highs = [v for v in (high, _known(frame["high"].max())) if v is not None]
        low, high = min(lows, default=None), max(highs, default=None)
        volumes = [v for v in (volume, _known(frame["volume"].sum(min_count=1))) if v is not None]
        sums = [v for v in (traded, _known(frame["traded"].sum(min_count=1))) if v is not None]
        volume, traded = sum(volumes) if volumes else None, sum(sums) if sums else None
    return points, low, high, volume, traded


def _frame(columns: dict, sums: tuple) -> pd.DataFrame:
    points, *rest = sums
    made = pd.DataFrame({**{k: [v] for k, v in columns.items()}, "points": [points]})
    for name, value in zip(("low", "high", "volume", "traded"), rest):
        made[name] = pd.Series([value], dtype="float64")
    return made


class _Totals(StatefulProcessor):
    """Totals of one sub-key of a symbol: a value state of five numbers."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._sums = handle.getValueState("sums", _MEASURES)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        sums = _merged(self._sums.get(), rows)
        self._sums.update(sums)
        yield _frame({"symbol": key[0], "part": key[1]}, sums)

    def close(self) -> None:
        pass


def _write_batches(rows: DataFrame, path: str, checkpoint: str, *partitions: str
                   ) -> DataStreamWriter:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy(*partitions).parquet(f"{path}/batch_id={batch_id}")

    return (rows.writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", checkpoint))


def vwap_totals(ticks: DataFrame, path: str, checkpoint: str, *, parts: int = 16
                ) -> DataStreamWriter:
    """Writer of the totals per symbol after every batch, continued from value state.

    A symbol has up to `parts` sub-keys, by the partition its ticks were read in, so its totals come
    together in `parts` tasks at most and no task holds a hot symbol alone. A tick without price or
    volume adds nothing to the traded amount; one without a time counts like any other.
    """
    part = (F.spark_partition_id() % parts).alias("part")
    keyed = _measures(ticks, F.col("symbol").cast("string").alias("symbol"), part)
    sums = _partial_sums(keyed, "symbol string, part int").groupBy("symbol", "part")
    return _write_batches(sums.transformWithStateInPandas(
        _Totals(), f"symbol string, part int, {_MEASURES}", "Update", "None"), path, checkpoint)


def read_vwap(spark: SparkSession, path: str, batch: int | None = None) -> DataFrame:
    """Points, volume and VWAP per symbol after `batch` (the last one, if None)."""
    rows = spark.read.schema(f"symbol string, part int, {_MEASURES}, batch_id long").parquet(path)
    if batch is not None:
        rows = rows.where(F.col("batch_id") <= batch)
    newest = rows.groupBy("symbol", "part").agg(
        F.max_by(F.struct("points", "volume", "traded"), "batch_id").alias("_t"))
    return newest.groupBy("symbol").agg(
        F.sum("_t.points").alias("points"), F.sum("_t.volume").alias("volume"),
        F.sum("_t.traded").alias("_traded"),
    ).select("symbol", "points", "volume", F.try_divide("_traded", "volume").alias("vwap"))


#: The window of ticks without a time. Integer keys of state must not be null: beside a null, pandas
#: turns the others to floats, which the state store does not take for its keys.
UNTIMED = -(1 << 62)


class _Windows(StatefulProcessor):
    """One window of a symbol: kept until the watermark passes its end, then given out."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._sums = handle.getValueState("window", _MEASURES)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        symbol, end = key[0], int(key[1])
        if end == UNTIMED or end < timerValues.getCurrentWatermarkInMs():
            kind = "untimed" if end == UNTIMED else "late"
            yield _frame({"kind": kind, "symbol": symbol, "end_ms": end}, _merged(None, rows))
            return
        held = self._sums.get()
        if held is None:
            self._handle.registerTimer(end)
        self._sums.update(_merged(held, rows))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self._sums.get()
        self._sums.clear()
        if held is not None:
            yield _frame({"kind": "closed", "symbol": key[0], "end_ms": int(key[1])}, held)

    def close(self) -> None:
        pass


def timed_windows(ticks: DataFrame, path: str, checkpoint: str, seconds: int = 60, *,
                  delay: str = "10 minutes") -> DataStreamWriter:
    """Writer of windows of `seconds` that are given out once, when the watermark passes their end.

    Ticks whose window had ended before the watermark are not lost and do not open it again: they go
    to a side table, summed up per symbol, window and batch. Ticks without a time go to another.
    Windows of a symbol are state entries of their own, so they are dealt over all tasks.
    """
    watched = ticks.withWatermark("timestamp", delay)
    length = seconds * 1000
    end = (F.floor(F.unix_millis("timestamp") / length) + 1) * length
    # The event time itself is not handed on: Spark would leave out late rows before the operator.
    keyed = _measures(watched, F.col("symbol").cast("string").alias("symbol"),
                      F.coalesce(end.cast("long"), F.lit(UNTIMED)).alias("end_ms"))
    rows = _partial_sums(keyed, "symbol string, end_ms long").groupBy("symbol", "end_ms")
    return _write_batches(rows.transformWithStateInPandas(
        _Windows(), f"kind string, symbol string, end_ms long, {_MEASURES}", "Update", "EventTime"),
        path, checkpoint, "kind")


def read_timed_windows(spark: SparkSession, path: str, seconds: int = 60, minimum: int = 5
                       ) -> DataFrame:
    """Windows by `kind`: `closed` ones, `late` ticks per window, `untimed` ticks (null window)."""
    schema = f"symbol string, end_ms long, {_MEASURES}, batch_id long, kind string"
    sums = spark.read.schema(schema).parquet(path).groupBy("kind", "symbol", "end_ms").agg(
        F.sum("points").alias("points"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.sum("volume").alias("volume"))
    end = F.when(F.col("end_ms") != UNTIMED, F.col("end_ms"))
    return sums.select(
        "kind", "symbol", F.timestamp_millis(end - seconds * 1000).alias("window_start"),
        F.timestamp_millis(end).alias("window_end"), "points", "low", "high", "volume",
        (F.col("points") >= minimum).alias("sufficient"))
