"""foreachBatch handlers whose output does not change when a batch repeats.

Spark may run a batch again after a failure. Every handler that stores data
therefore owns one directory per batch id and replaces it, with nothing if the
repeat is empty. Readers take complete directories only. They are for batches that
need more than one write, and for complete mode; rows that are only appended go
through Spark's file sink (see ``tables``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.operators.aggregates import by_revenue
from orderflow.operators.enrich import (
    BROADCAST_LIMIT,
    Dimension,
    enrich_with_dimensions,
    hot_keys,
    reduced_dimension,
)
from orderflow.schema import column_names
from orderflow.sinks.commits import committed_batches, drop_older, newest_batch
from orderflow.sinks.files import write_parquet
from orderflow.sources.files import write_csv
from orderflow.streaming.deltas import read_deltas
from orderflow.streaming.tables import dealt, default_writers

Handler = Callable[[DataFrame, int], None]
#: Takes a title and the few rows to show.
Show = Callable[[str, DataFrame], None]

WINDOWS = (
    "window_start timestamp, window_end timestamp, product_id string, "
    "orders_count bigint, total_revenue double"
)
TOTALS = "product_id string, total_orders bigint, total_revenue double"


def enriching(
    handle: Handler,
    customers: Dimension,
    products: Dimension,
    staging: str,
    broadcast_limit: int = BROADCAST_LIMIT,
    hot: dict[str, list] | None = None,
    **how,
) -> Handler:
    """Add the dimensions to each batch before it is handled.

    For dimensions too large to broadcast. The batch is first written below
    ``staging``, so its state operators run once and its rows survive a lost
    executor, and each dimension is reduced to the batch's keys, whose size
    decides on the join. All of it runs in the dimensions' own session: the one
    that Spark hands to a batch of a stateful query has adaptive execution
    turned off.
    """

    def enrich(batch: DataFrame, batch_id: int) -> None:
        folder = f"batch_id={batch_id}"
        write_parquet(batch, f"{staging}/orders/{folder}")
        session = customers.frame.sparkSession
        rows = session.read.schema(batch.schema).parquet(f"{staging}/orders/{folder}")
        reduced = []
        for dimension in (customers, products):
            if dimension.size_bytes > broadcast_limit:
                path = f"{staging}/{dimension.key}/{folder}"
                dimension = reduced_dimension(dimension, rows, path)
            reduced.append(dimension)
        large = [d.key for d in reduced if d.size_bytes > broadcast_limit]
        found = hot
        if large and hot is None:
            # The rows are written already, so they are not written again for it.
            found = hot_keys(rows, *large)
        enriched = enrich_with_dimensions(
            rows, *reduced, broadcast_limit=broadcast_limit, hot=found, **how
        )
        handle(enriched, batch_id)
        for name in ("orders", customers.key, products.key):
            drop_older(session, f"{staging}/{name}", "batch_id=", keep=2)

    return enrich


def print_rows(title: str, rows: DataFrame) -> None:
    print(title)
    rows.show(rows.count(), truncate=False)


def show_rows(n: int = 20, show: Show = print_rows) -> Handler:
    """Show the first rows of each batch that has any, in order of their columns."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        _show(batch.orderBy(*batch.columns), n, f"batch {batch_id}", show)

    return handle


def show_top_products(n: int = 10, stored: str | None = None, show: Show = print_rows) -> Handler:
    """Show the best products of the totals so far: the batch's, or those stored as
    deltas if batches hold changed products only."""

    def handle(totals: DataFrame, batch_id: int) -> None:
        if stored is not None:
            totals = read_deltas(totals.sparkSession, stored, TOTALS, ["product_id"])
        _show(by_revenue(totals), n, f"batch {batch_id}: top {n} products by revenue", show)

    return handle


def _show(ordered: DataFrame, n: int, title: str, show: Show) -> None:
    """The first rows of all tasks are found in one job that reads every row, so state
    operators run to their end and no more than n rows of a task go to the driver."""
    first = ordered.limit(n).collect()
    if first:
        show(title, ordered.sparkSession.createDataFrame(first, ordered.schema))


def after(*handlers: Handler) -> Handler:
    """Handlers one after the other, for batches of which only the first reads rows."""

    def run(batch: DataFrame, batch_id: int) -> None:
        for handle in handlers:
            handle(batch, batch_id)

    return run


def store_batches(path: str, partition_by: str | None = None, writers: int | None = None) -> Handler:
    """Parquet under ``path/batch_id=<id>``, also for an empty batch."""

    def store(batch: DataFrame, batch_id: int) -> None:
        rows = dealt(batch, writers or default_writers(batch.sparkSession))
        write_parquet(rows, f"{path}/batch_id={batch_id}", partition_by)

    return store


def store_top_products(path: str, n: int = 10) -> Handler:
    """The best products of each batch's totals, as Parquet."""

    def store(totals: DataFrame, batch_id: int) -> None:
        write_parquet(by_revenue(totals).limit(n), f"{path}/batch_id={batch_id}")

    return store


def store_snapshots(path: str, keep: int | None = None) -> Handler:
    """Each batch's totals as CSV, best product first, in ``path/batch_<id>``.

    The sort leaves one file while the totals are small; larger totals are
    spread over files whose names follow the order. With ``keep``, only that
    many complete snapshots stay; else all do.
    """

    def store(totals: DataFrame, batch_id: int) -> None:
        write_csv(by_revenue(totals), f"{path}/batch_{batch_id:04d}")
        if keep is not None:
            drop_older(totals.sparkSession, path, "batch_", keep)

    return store


def read_batches(spark: SparkSession, path: str, ddl: str, partition_by: str | None = None) -> DataFrame:
    """All rows of the complete batches below ``path``.

    ``partition_by`` is the column definition of the directories inside a batch;
    it and ``batch_id bigint`` may be in ``ddl`` or not. Filters on them prune
    directories.
    """
    folders = committed_batches(spark, path, "batch_id=")
    columns = column_names(ddl)
    layout = ["batch_id bigint", *([partition_by] if partition_by else [])]
    schema = ", ".join([ddl, *(c for c in layout if c.split()[0] not in columns)])
    if not folders:
        return spark.createDataFrame([], schema).select(*columns)
    reader = spark.read.schema(schema).option("basePath", path)
    return reader.parquet(*folders).select(*columns)


def read_latest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the newest complete CSV snapshot; none before the first batch."""
    newest = newest_batch(spark, path, "batch_")
    if newest is None:
        return spark.createDataFrame([], TOTALS)
    return spark.read.schema(TOTALS).option("header", True).csv(newest)


def read_latest_batch(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Rows of the newest complete Parquet batch; none before the first batch."""
    newest = newest_batch(spark, path, "batch_id=")
    if newest is None:
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).parquet(newest)
