"""The batch job: raw orders in, clean tables and revenue reports out.

A run writes all its tables into a folder of its own. Only when they are complete does a
small file that names the folder change, at once, so a reader finds the tables of one
run, whatever happens to the next.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow import schema as S
from orderflow.functions.orders import derived_columns, order_class
from orderflow.operators.aggregates import REVENUE_KEYS, by_revenue, revenue_rollup, rollup_part
from orderflow.operators.dedupe import dedupe_orders
from orderflow.operators.derive import classify_orders, derive_columns, normalize_status
from orderflow.operators.enrich import (
    BROADCAST_LIMIT,
    check_dimension,
    enrich_with_dimensions,
    enriched_layout,
    hot_keys,
)
from orderflow.operators.metrics import long_form
from orderflow.operators.quality import rejected_orders, valid_orders
from orderflow.settings import session_setting
from orderflow.sinks.commits import delete, folder_names, publish, published
from orderflow.sinks.files import (
    read_parquet,
    read_quarantine,
    rebalanced,
    write_parquet,
    write_quarantine,
)

_LAYOUT = ["order_class", "order_date"]
_ADDED = [
    column
    for ddl in (S.CUSTOMERS, S.PRODUCTS)
    for column in ddl.split(", ")
    if column.split()[0] not in ("customer_id", "product_id")
]
ORDERS_TABLE = ", ".join([S.ORDERS, S.DERIVED, *_ADDED, "n_copies bigint, order_class string"])

_TOTALS = "total_orders bigint, total_revenue double"
_KEY_TYPES = "order_date date, product_id string, hour_of_day int"
ROLLUP_TABLE = f"order_class string, {_KEY_TYPES}, {_TOTALS}, n_copies bigint, revenue_key string"


#: File that names the current run.
CURRENT = "CURRENT"
_RUN = r"run-\d{20}-[0-9a-f]{8}"


@dataclass(frozen=True)
class BatchTables:
    """Where one run of the batch job keeps its results."""

    spark: SparkSession
    root: str
    n_customers: int
    n_products: int

    @property
    def orders_path(self) -> str:
        return f"{self.root}/orders"

    def quarantine(self) -> DataFrame:
        return read_quarantine(self.spark, f"{self.root}/quarantine")

    def all_orders(self) -> DataFrame:
        """Every kept order with its class and the number of copies seen."""
        return read_parquet(self.spark, self.orders_path, ORDERS_TABLE)

    def rollup(self) -> DataFrame:
        """Orders, revenue and copies per class and day, product or hour."""
        return read_parquet(self.spark, f"{self.root}/revenue_rollup", ROLLUP_TABLE)

    def _report(self, name: str, key: str) -> DataFrame:
        return read_parquet(self.spark, f"{self.root}/{name}", f"{key}, {_TOTALS}")

    def _of_class(self, name: str) -> DataFrame:
        return self.all_orders().filter(F.col("order_class") == name)

    def orders(self) -> DataFrame:
        """Active orders with both dimensions."""
        return enriched_layout(self._of_class(S.ACTIVE))

    def cancelled(self) -> DataFrame:
        return self._of_class(S.CANCELLED).select(
            *S.column_names(S.ORDERS), *S.column_names(S.DERIVED)
        )

    def daily_revenue(self) -> DataFrame:
        return self._report("daily_revenue", "order_date date")

    def product_revenue(self) -> DataFrame:
        return self._report("product_revenue", "product_id string")

    def hourly_revenue(self) -> DataFrame:
        return self._report("hourly_revenue", "hour_of_day int")

    def top_products(self, n: int = 10) -> DataFrame:
        return by_revenue(self.product_revenue()).limit(n)

    def stage_counts(self) -> DataFrame:
        """Rows per stage, read from the written tables.

        Counters kept while a job runs may count a repeated task twice; tables
        do not. The roll-up holds the copies seen per order, so neither the
        input nor the orders are read again.
        """
        reason = F.col("reject_reason")
        rejects = self.quarantine().agg(
            *[
                F.count_if(reason == name).alias(name)
                for name in (S.MISSING_ORDER_ID, S.INVALID_VALUES, S.INDETERMINATE_VALUES)
            ]
        )
        by_day = F.col("revenue_key") == "order_date"
        is_active = F.col("order_class") == S.ACTIVE
        n_orders, n_copies = F.col("total_orders"), F.col("n_copies")

        def total(value: Column, when: Column = F.lit(True)) -> Column:
            return F.coalesce(F.sum(F.when(by_day & when, value)), F.lit(0))

        kept = self.rollup().agg(
            total(n_copies).alias("before_dedupe"),
            total(n_orders).alias("after_dedupe"),
            total(n_copies - n_orders).alias("duplicates"),
            *[
                total(n_orders, F.col("order_class") == name).alias(name)
                for name in (S.CANCELLED, S.UNCLASSIFIED, S.ACTIVE)
            ],
            *[
                F.count_if((F.col("revenue_key") == key) & is_active & F.col(key).isNotNull()).alias(name)
                for key, name in zip(REVENUE_KEYS, ("revenue_days", "revenue_products", "revenue_hours"))
            ],
        )
        counts = long_form(rejects).unionByName(long_form(kept))
        entered = ["before_dedupe", S.MISSING_ORDER_ID, S.INVALID_VALUES, S.INDETERMINATE_VALUES]
        total_in = counts.agg(F.sum(F.when(F.col("stage").isin(entered), F.col("n_rows"))).alias("n_rows"))
        dims = self.spark.createDataFrame(
            [("customers", self.n_customers), ("products", self.n_products)],
            "stage string, n_rows bigint",
        )
        return (
            total_in.select(F.lit("input").alias("stage"), "n_rows").unionByName(counts).unionByName(dims)
        )


def run_batch(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    output: str,
    broadcast_limit: int = BROADCAST_LIMIT,
    shuffle_partitions: int | None = None,
    hot: dict[str, list] | None = None,
    min_partition_size: str | None = None,
    keep_runs: int = 2,
) -> BatchTables:
    """Run the whole job and return its tables, which then are those that
    ``open_batch(spark, output)`` finds. The run before stays too, so its readers are
    not cut off at once; ``keep_runs`` may be more. Runs that ended half-way go.

    ``shuffle_partitions`` replaces the session's number while the job runs.
    The deduplication cannot split a partition, so plan for a few GB each at
    most; adaptive execution merges what turns out small.

    ``hot`` names the dimension keys of many orders, if known (``hot_keys``); it
    matters for dimensions above ``broadcast_limit`` only. ``min_partition_size``
    is for the order table (see ``write_parquet``).
    """
    spark = orders.sparkSession
    partitions = None if shuffle_partitions is None else str(shuffle_partitions)
    run = f"run-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    with session_setting(spark, "spark.sql.shuffle.partitions", partitions):
        tables = _run_batch(
            orders, customers, products, f"{output}/{run}", broadcast_limit, hot, min_partition_size
        )
    before = _current(spark, output)
    runs = [run, *(before["runs"] if before else [])][: max(1, keep_runs)]
    current = {"runs": runs, "customers": tables.n_customers, "products": tables.n_products}
    publish(spark, output, CURRENT, json.dumps(current))
    for name in folder_names(spark, output, _RUN):
        # A newer one may be another run at work.
        if name not in runs and name < run:
            delete(spark, f"{output}/{name}")
    return tables


def _current(spark: SparkSession, output: str) -> dict | None:
    text = published(spark, output, CURRENT)
    return None if text is None else json.loads(text)


def open_batch(spark: SparkSession, output: str) -> BatchTables | None:
    """The tables of the last run that was completed; None before the first."""
    current = _current(spark, output)
    if current is None:
        return None
    root = f"{output}/{current['runs'][0]}"
    return BatchTables(spark, root, current["customers"], current["products"])


def _run_batch(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    output: str,
    broadcast_limit: int,
    hot: dict[str, list] | None,
    min_partition_size: str | None,
) -> BatchTables:
    """The steps of the job.

    The input is read twice, once for the rejects and once for the clean
    orders, and shuffled by id once. Above ``broadcast_limit`` the clean orders
    are first written as they are, and hot keys come from their key columns. Active and cancelled orders go into one
    table with a directory per class, so they need no common intermediate
    copy; only active orders are enriched. Reports and counts come from a
    roll-up, made in a single scan of a few columns of that table.
    """
    spark = orders.sparkSession
    customers_dim = check_dimension(customers, "customer_id")
    products_dim = check_dimension(products, "product_id")
    tables = BatchTables(spark, output, customers_dim.rows, products_dim.rows)

    write_quarantine(rejected_orders(orders), f"{output}/quarantine")

    kept = dedupe_orders(normalize_status(valid_orders(orders)), copies="n_copies")
    is_active = order_class(F.col("status")) == S.ACTIVE
    how = {"only": is_active, "broadcast_limit": broadcast_limit}
    if max(customers_dim.size_bytes, products_dim.size_bytes) <= broadcast_limit:
        # Lay rows out for the writer first: broadcast joins keep the layout
        # and the shuffle carries no dimension columns.
        kept = rebalanced(derive_columns(classify_orders(kept)), _LAYOUT)
        enriched = enrich_with_dimensions(kept, customers_dim, products_dim, hot=hot, **how)
    else:
        write_parquet(kept, f"{output}/kept", compression="zstd")
        kept = spark.read.schema(kept.schema).parquet(f"{output}/kept")
        hot = hot_keys(kept.filter(is_active), "customer_id", "product_id") if hot is None else hot
        enriched = enrich_with_dimensions(kept, customers_dim, products_dim, hot=hot, **how)
        # Only the day goes through the shuffles; what else follows from an order's own
        # columns is derived where the order is written.
        by_day = enriched.withColumn("order_date", derived_columns()["order_date"])
        enriched = derive_columns(classify_orders(rebalanced(by_day, ["order_date"])))
    columns = S.column_names(ORDERS_TABLE)
    write_parquet(
        enriched.select(*columns), tables.orders_path, _LAYOUT, min_partition_size=min_partition_size
    )

    copies = F.sum("n_copies").alias("n_copies")
    rollup = revenue_rollup(tables.all_orders(), copies, within=("order_class",))
    write_parquet(rollup, f"{output}/revenue_rollup", "revenue_key")
    active = tables.rollup().filter(F.col("order_class") == S.ACTIVE)
    daily = rollup_part(active, "order_date").orderBy("order_date")
    write_parquet(daily, f"{output}/daily_revenue")
    write_parquet(by_revenue(rollup_part(active, "product_id")), f"{output}/product_revenue")
    hourly = rollup_part(active, "hour_of_day").orderBy("hour_of_day")
    write_parquet(hourly, f"{output}/hourly_revenue")
    return tables
