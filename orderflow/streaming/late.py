"""Orders that arrive too late for the watermark.

Spark drops them inside its stateful operators and only counts them. Here a query
without state finds them by the same rule and stores them: a batch drops by the
watermark of the batch before, so by the latest event time up to two batches ago, less
the delay.

The latest event time so far is kept per batch in a small table beside the rows, which
are collected in levelled runs (see ``deltas``). A batch that repeats reads the same marks
and stores the same rows. The batches are the query's own; they are those of a cleaning
query that takes the same input in the same portions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.schema import ORDERS
from orderflow.sinks.commits import drop_older, newest_batch
from orderflow.sinks.files import write_parquet
from orderflow.streaming.deltas import read_deltas, store_deltas

_MARK = "latest timestamp"


def _mark(spark: SparkSession, path: str, batch_id: int):
    """Latest event time of the batches up to this one; None if there was none."""
    if batch_id < 0 or newest_batch(spark, path, "batch_id=") is None:
        return None
    return spark.read.schema(_MARK).parquet(f"{path}/batch_id={batch_id}").head()[0]


def read_late_rows(spark: SparkSession, path: str) -> DataFrame:
    return read_deltas(spark, f"{path}/rows", ORDERS)


def store_late_rows(path: str, session: SparkSession, delay: str):
    """Handler that stores the late rows of each batch below ``path``."""
    collect = store_deltas(f"{path}/rows", session, ORDERS)

    def store(batch: DataFrame, batch_id: int) -> None:
        limit = _mark(session, f"{path}/marks", batch_id - 2)
        before = _mark(session, f"{path}/marks", batch_id - 1)
        mark = F.lit(limit).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        late = batch.where(F.col("order_timestamp") <= mark)
        collect(late, batch_id)
        latest = batch.agg(F.max("order_timestamp")).head()[0]
        latest = max(filter(None, (before, latest)), default=None)
        marks = session.range(1).select(F.lit(latest).cast("timestamp").alias("latest"))
        write_parquet(marks.coalesce(1), f"{path}/marks/batch_id={batch_id}")
        drop_older(session, f"{path}/marks", "batch_id=", keep=4)

    return store
