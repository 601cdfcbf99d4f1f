"""Row-wise projections of orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.functions import orders as fn


def normalize_status(orders: DataFrame) -> DataFrame:
    return orders.withColumn("status", fn.normalized_status(F.col("status")))


def derive_columns(orders: DataFrame) -> DataFrame:
    return orders.withColumns(fn.derived_columns())


def classify_orders(orders: DataFrame) -> DataFrame:
    """Add ``order_class``; expects normalised statuses."""
    return orders.withColumn("order_class", fn.order_class(F.col("status")))
