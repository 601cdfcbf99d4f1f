"""Cleaning of an order stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow import schema as S
from orderflow.functions import orders as fn
from orderflow.operators.derive import classify_orders, derive_columns, normalize_status
from orderflow.operators.quality import rejected_orders, split_cancelled, valid_orders

WATERMARK_DELAY = "30 minutes"

#: Columns of cleaned orders.
CLEANED = f"{S.ORDERS}, {S.DERIVED}, order_class string"
REASONS = (S.MISSING_ORDER_ID, S.INVALID_VALUES, S.INDETERMINATE_VALUES)


def observed(orders: DataFrame) -> DataFrame:
    """Counts the rows of each batch that come in, and those rejected, by reason. Filters
    stay above the count, so the scan drops nothing before it."""
    reason = fn.reject_reason()
    rejected = [F.count_if(F.coalesce(reason == r, F.lit(False))).alias(r) for r in REASONS]
    return orders.observe("received", F.count(F.lit(1)).alias("rows_in"), *rejected)


def dedupe_stream(orders: DataFrame, delay: str = WATERMARK_DELAY, parts: int = 1) -> DataFrame:
    """The first on-time copy of each order within the watermark.

    Deduplication sends all copies of an id to one task. With ``parts`` above 1 they are
    first deduplicated within as many parts, by the task that read them, so that a hot
    id is spread over as many tasks and each sends on one copy. This takes a second
    state. Copies that agree in time, or whose times differ by less than the delay, give
    the same rows. If they differ by more, a copy that plain deduplication would let
    through again, after the first one's state has ended, may be held back by one in
    between.
    """
    marked = orders.withWatermark("order_timestamp", delay)
    if parts > 1:
        part = F.pmod(F.spark_partition_id(), F.lit(parts))
        marked = marked.withColumn("_part", part)
        marked = marked.dropDuplicatesWithinWatermark(["order_id", "_part"]).drop("_part")
    return marked.dropDuplicatesWithinWatermark(["order_id"])


def cleaned_stream(orders: DataFrame, delay: str = WATERMARK_DELAY, parts: int = 1) -> DataFrame:
    """Valid, deduplicated orders of every class, with derived columns.

    The id and value filters stand below the watermark, so rejected rows never advance
    it.
    """
    rows = dedupe_stream(normalize_status(valid_orders(orders)), delay, parts)
    return classify_orders(derive_columns(rows))


def clean_stream(orders: DataFrame, delay: str = WATERMARK_DELAY, parts: int = 1) -> DataFrame:
    """Valid, deduplicated, not cancelled orders of a stream; cancelled rows advance the
    watermark."""
    rows = dedupe_stream(normalize_status(valid_orders(orders)), delay, parts)
    return split_cancelled(rows).active


def clean_and_derive(orders: DataFrame, delay: str = WATERMARK_DELAY, parts: int = 1) -> DataFrame:
    return derive_columns(clean_stream(orders, delay, parts))


def active_only(cleaned: DataFrame) -> DataFrame:
    """Cleaned orders of which only active ones count in an aggregate. The others stay,
    as they advance the watermark."""
    active = F.col("order_class") == S.ACTIVE
    return cleaned.withColumns(
        {c: F.when(active, F.col(c)) for c in ("order_id", "total_amount")}
    )


def rejected_stream(orders: DataFrame) -> DataFrame:
    """Rejected rows of a stream with their reason; needs no state."""
    return rejected_orders(orders)
