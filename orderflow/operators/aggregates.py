"""Revenue aggregates over clean orders with derived columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REVENUE_KEYS = ["order_date", "product_id", "hour_of_day"]


def _revenue(count_as: str = "total_orders") -> list[Column]:
    return [
        F.count("order_id").alias(count_as),
        F.sum("total_amount").alias("total_revenue"),
    ]


def revenue_by(orders: DataFrame, key: str) -> DataFrame:
    """Orders and revenue per key, unordered; also valid on a stream."""
    return orders.groupBy(key).agg(*_revenue())


def daily_revenue(orders: DataFrame) -> DataFrame:
    return revenue_by(orders, "order_date").orderBy("order_date")


def hourly_revenue(orders: DataFrame) -> DataFrame:
    return revenue_by(orders, "hour_of_day").orderBy("hour_of_day")


def by_revenue(revenue: DataFrame) -> DataFrame:
    """Best products first; equal revenue is ordered by product."""
    return revenue.orderBy(F.col("total_revenue").desc(), "product_id")


def product_revenue(orders: DataFrame) -> DataFrame:
    return by_revenue(revenue_by(orders, "product_id"))


def top_products(orders: DataFrame, n: int = 10) -> DataFrame:
    return product_revenue(orders).limit(n)


def product_totals(orders: DataFrame) -> DataFrame:
    """Running totals when ``orders`` is a stream."""
    return revenue_by(orders, "product_id")


def windowed_revenue(orders: DataFrame, duration: str = "10 minutes") -> DataFrame:
    """Orders and revenue per tumbling event-time window and product."""
    grouped = orders.groupBy(F.window("order_timestamp", duration), "product_id")
    return grouped.agg(*_revenue("orders_count")).select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "product_id",
        "orders_count",
        "total_revenue",
    )


def revenue_rollup(orders: DataFrame, *extra: Column, within: tuple[str, ...] = ()) -> DataFrame:
    """Daily, product and hourly revenue from a single scan.

    One row per key of each kind (and per value of ``within``); ``revenue_key``
    names the kind. Orders are clean here, so each row counts and the id
    column need not be read. ``rollup_part`` picks one kind.
    """
    keys = [F.col(k) for k in REVENUE_KEYS]
    fixed = [F.col(c) for c in within]
    number = F.when(F.grouping("order_date") == 0, 1).when(F.grouping("product_id") == 0, 2)
    kind = F.element_at(F.array(*[F.lit(k) for k in REVENUE_KEYS]), number.otherwise(3))
    return orders.groupingSets([[*fixed, k] for k in keys], *fixed, *keys).agg(
        kind.alias("revenue_key"),
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("total_amount").alias("total_revenue"),
        *extra,
    )


def rollup_part(rollup: DataFrame, key: str) -> DataFrame:
    part = rollup.filter(F.col("revenue_key") == key)
    return part.select(key, "total_orders", "total_revenue")
