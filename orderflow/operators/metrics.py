"""Counts that account for every order that enters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow import schema as S
from orderflow.functions import orders as fn
from orderflow.operators.dedupe import first_row
from orderflow.operators.derive import derive_columns, normalize_status


def long_form(counts: DataFrame) -> DataFrame:
    """One (stage, n_rows) row per column of a one-row frame of counts."""
    return counts.unpivot([], counts.columns, "stage", "n_rows")


def _total(value: Column, when: Column) -> Column:
    return F.coalesce(F.sum(F.when(when, value)), F.lit(0)).cast("bigint")


def stage_counts(orders: DataFrame) -> DataFrame:
    """Rows per stage of the batch job, from one scan and one shuffle.

    All rejected rows of a reason collapse into one group; valid rows group by
    id as in the deduplication, so their copies are counted there.
    """
    rows = normalize_status(orders).withColumn("_reason", fn.reject_reason())
    rest = [c for c in orders.columns if c != "order_id"]
    grouped = rows.groupBy(
        "_reason", F.when(F.col("_reason").isNull(), F.col("order_id")).alias("_id")
    ).agg(F.count(F.lit(1)).alias("_copies"), first_row(rest).alias("_first"))
    kept = derive_columns(grouped.select("_reason", "_copies", "_first.*"))
    kept = kept.withColumn("_class", fn.order_class(F.col("status")))

    copies, one = F.col("_copies"), F.lit(1)
    valid = F.col("_reason").isNull()
    is_active = valid & (F.col("_class") == S.ACTIVE)

    def rejected(reason: str) -> Column:
        return _total(copies, F.col("_reason") == reason)

    def groups(key: str) -> Column:
        return F.count_distinct(F.when(is_active, F.col(key)))

    counts = kept.agg(
        F.coalesce(F.sum(copies), F.lit(0)).alias("input"),
        rejected(S.MISSING_ORDER_ID).alias(S.MISSING_ORDER_ID),
        rejected(S.INVALID_VALUES).alias(S.INVALID_VALUES),
        rejected(S.INDETERMINATE_VALUES).alias(S.INDETERMINATE_VALUES),
        _total(copies, valid).alias("before_dedupe"),
        _total(one, valid).alias("after_dedupe"),
        _total(copies - 1, valid).alias("duplicates"),
        _total(one, valid & (F.col("_class") == S.CANCELLED)).alias(S.CANCELLED),
        _total(one, valid & (F.col("_class") == S.UNCLASSIFIED)).alias(S.UNCLASSIFIED),
        _total(one, is_active).alias(S.ACTIVE),
        groups("order_date").alias("revenue_days"),
        groups("product_id").alias("revenue_products"),
        groups("hour_of_day").alias("revenue_hours"),
    )
    return long_form(counts)


def row_count(frame: DataFrame, stage: str) -> DataFrame:
    return frame.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(stage).alias("stage"), "n_rows")


def event_stats(orders: DataFrame) -> DataFrame:
    """Row count and event-time range."""
    return orders.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("order_timestamp").alias("min_event_time"),
        F.max("order_timestamp").alias("max_event_time"),
    )
