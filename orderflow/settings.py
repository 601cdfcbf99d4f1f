"""Session settings that hold for one action only."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


@contextmanager
def session_setting(spark: SparkSession, key: str, value: str | None) -> Iterator[None]:
    """Set ``key`` and put the old value back; None leaves it alone."""
    if value is None:
        yield
        return
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)
