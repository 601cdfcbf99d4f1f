"""Comparison of streamed totals with the batch totals of the same orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile(batch: DataFrame, stream: DataFrame, key: str = "product_id") -> DataFrame:
    """Full outer comparison of two revenue tables, one row per key.

    Both sides are aggregates with unique keys, so the join cannot skew. The
    comparison treats NULL keys as equal to each other.
    """
    b, s = batch.alias("b"), stream.alias("s")

    def side(name: str, column: str):
        return F.coalesce(F.col(f"{name}.{column}"), F.lit(0))

    joined = b.join(s, F.col(f"b.{key}").eqNullSafe(F.col(f"s.{key}")), "full")
    return joined.select(
        F.coalesce(f"b.{key}", f"s.{key}").alias(key),
        side("b", "total_orders").alias("batch_orders"),
        side("s", "total_orders").alias("stream_orders"),
        (side("s", "total_orders") - side("b", "total_orders")).alias("orders_diff"),
        (side("s", "total_revenue") - side("b", "total_revenue")).alias("revenue_diff"),
    )
