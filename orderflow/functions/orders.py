"""Column expressions shared by the batch and the streaming paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderflow import schema as S


def normalized_status(status: Column) -> Column:
    """Lower-case, strip spaces and replace synonyms; NULL stays NULL."""
    word = F.lower(F.trim(status))
    pairs = [F.lit(text) for pair in S.STATUS_SYNONYMS.items() for text in pair]
    return F.coalesce(F.create_map(*pairs)[word], word)


def has_valid_values() -> Column:
    """Quantity above zero and price not negative; NaN prices count as valid."""
    return (F.col("quantity") > 0) & (F.col("price") >= 0)


def has_invalid_values() -> Column:
    """At least one measure is known to be out of range."""
    return (F.col("quantity") <= 0) | (F.col("price") < 0)


def reject_reason() -> Column:
    """Why a row is kept out of the clean orders, or NULL for a valid row.

    Rows whose missing measures leave both value tests unknown are
    ``indeterminate_values``: neither valid nor provably invalid.
    """
    return (
        F.when(F.col("order_id").isNull(), S.MISSING_ORDER_ID)
        .when(has_invalid_values(), S.INVALID_VALUES)
        .when(~F.coalesce(has_valid_values(), F.lit(False)), S.INDETERMINATE_VALUES)
    )


def order_class(status: Column) -> Column:
    """active / cancelled / unclassified (no status) for a normalised status."""
    return (
        F.when(status.isNull(), S.UNCLASSIFIED)
        .when(status == S.CANCELLED, S.CANCELLED)
        .otherwise(S.ACTIVE)
    )


def derived_columns() -> dict[str, Column]:
    """Calendar columns of the event time and the order amount."""
    at = F.col("order_timestamp")
    return {
        "order_date": F.to_date(at),
        "order_day_of_week": F.dayofweek(at),  # 1 = Sunday
        "hour_of_day": F.hour(at),
        "total_amount": F.col("quantity") * F.col("price"),
    }
