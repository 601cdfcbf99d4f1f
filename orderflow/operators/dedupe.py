"""Deduplication of a static order table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Earliest event first; the rest only makes the choice unique.
TIE_BREAK = ["order_timestamp", "product_id", "customer_id", "quantity", "price", "status"]


def first_row(columns: list[str]) -> Column:
    """Aggregate that keeps the first row of a group as a struct.

    Rows with a known event time come before rows without one. Columns beyond
    the tie-break list take part too, so the choice never depends on how rows
    are spread over tasks.
    """
    ranked = [c for c in TIE_BREAK if c in columns]
    ranked += [c for c in columns if c not in ranked]
    no_time = F.col("order_timestamp").isNull().alias("_no_time")
    return F.min(F.struct(no_time, *ranked))


def dedupe_orders(orders: DataFrame, copies: str | None = None) -> DataFrame:
    """Keep the first row per ``order_id``; optionally count the copies.

    This is an aggregate rather than a ranking so that each map task ships at
    most one row per id: an id with a huge number of copies costs one row per
    task in the shuffle, and the copies are counted on the way. The minimum of a
    struct is a sort-based aggregate in Spark, so rows are sorted by id before
    and after the shuffle.
    """
    rest = [c for c in orders.columns if c != "order_id"]
    aggregates = [first_row(rest).alias("_first")]
    if copies:
        aggregates.append(F.count(F.lit(1)).alias(copies))
    columns = [F.col(c) if c == "order_id" else F.col(f"_first.{c}") for c in orders.columns]
    kept = orders.groupBy("order_id").agg(*aggregates)
    return kept.select(*columns, *([copies] if copies else []))
