"""The pandas UDF surface. The native expressions are the default; these serve SQL callers."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def inventory_score_udf(as_of):
    """Arrow-batched twin of the native score for a fixed time."""
    now = pd.Timestamp(as_of)

    @F.pandas_udf("double")
    def score(quantity: pd.Series, capacity: pd.Series, updated: pd.Series) -> pd.Series:
        days = (now - pd.to_datetime(updated)).dt.total_seconds() / 86400
        share = quantity / capacity.where(capacity != 0)
        return ((1 - (share - 0.5).abs() * 2) * 100 - days * 2).clip(0, 100)

    return score


def register_udfs(spark: SparkSession, as_of) -> None:
    spark.udf.register("calculate_inventory_score", inventory_score_udf(as_of))


PATTERNS = (
    "customer_id long, total_orders long, total_spent double, avg_order_value double, "
    "avg_days_between_orders double, peak_order_hour int"
)
_ARROW = pa.schema([
    ("customer_id", pa.int64()), ("total_orders", pa.int64()), ("total_spent", pa.float64()),
    ("avg_order_value", pa.float64()), ("avg_days_between_orders", pa.float64()),
    ("peak_order_hour", pa.int32()),
])


def order_patterns_grouped(hours: DataFrame) -> DataFrame:
    """Python form of the order patterns over Arrow batches.

    Takes the per-hour partials of `aggregates.order_hours`. Those of a customer, 24 at most, are
    gathered into one row, so a batch holds many customers and Python is called once for all.
    """
    def patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for customer, parts in zip(batch.column("customer_id").to_pylist(),
                                       batch.column("parts").to_pylist()):
                orders = sum(p["orders"] for p in parts)
                spent = float(sum(p["spent"] for p in parts))
                span = max(p["last_at"] for p in parts) - min(p["first_at"] for p in parts)
                gap = span.total_seconds() / 86400 / (orders - 1) if orders > 1 else None
                peak = min(parts, key=lambda p: (-p["orders"], p["hour"]))["hour"]
                rows.append((customer, orders, spent, spent / orders, gap or None, peak))
            columns = zip(*rows) if rows else [()] * len(_ARROW)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)

    parts = F.collect_list(F.struct("hour", "orders", "spent", "first_at", "last_at"))
    return hours.groupBy("customer_id").agg(parts.alias("parts")).mapInArrow(patterns, PATTERNS)
