"""Splits between clean, rejected, cancelled and unclassified orders."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow import schema as S
from orderflow.functions import orders as fn


class IdSplit(NamedTuple):
    valid: DataFrame
    missing: DataFrame


class ValueSplit(NamedTuple):
    valid: DataFrame
    invalid: DataFrame
    indeterminate: DataFrame


class StatusSplit(NamedTuple):
    active: DataFrame
    cancelled: DataFrame
    unclassified: DataFrame


def split_missing_id(orders: DataFrame) -> IdSplit:
    has_id = F.col("order_id").isNotNull()
    return IdSplit(orders.filter(has_id), orders.filter(~has_id))


def split_values(orders: DataFrame) -> ValueSplit:
    """Valid and invalid follow three-valued logic, so a row with a missing
    measure may be in neither; those rows are the third output."""
    valid, invalid = fn.has_valid_values(), fn.has_invalid_values()
    known = F.coalesce(valid | invalid, F.lit(False))
    return ValueSplit(orders.filter(valid), orders.filter(invalid), orders.filter(~known))


def split_cancelled(orders: DataFrame) -> StatusSplit:
    """Expects normalised statuses."""
    status = F.col("status")
    return StatusSplit(
        orders.filter(status != S.CANCELLED),
        orders.filter(status == S.CANCELLED),
        orders.filter(status.isNull()),
    )


def valid_orders(orders: DataFrame) -> DataFrame:
    """Rows with an id and valid values, as predicates a Parquet scan can use."""
    return orders.filter(F.col("order_id").isNotNull() & fn.has_valid_values())


def tag_rejects(orders: DataFrame) -> DataFrame:
    """Add ``reject_reason``; NULL marks a valid row."""
    return orders.withColumn("reject_reason", fn.reject_reason())


def rejected_orders(orders: DataFrame) -> DataFrame:
    """All rejected rows with their reason, found in one scan."""
    return tag_rejects(orders).filter(F.col("reject_reason").isNotNull())
