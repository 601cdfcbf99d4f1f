"""Every query by name, over the retail tables.

Each takes a session and a table directory. Revenue is rounded to cents and
times lose their zone here, so results compare by value with other engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderflow import schema as S
from orderflow.functions.draws import draw_chance
from orderflow.operators import aggregates, dedupe, derive, enrich, metrics, quality, synth
from orderflow.operators.reconcile import reconcile as compare_totals
from orderflow.plans.batch import BatchTables, run_batch
from orderflow.plans.scratch import scratch_dir
from orderflow.plans.stream import (
    StreamTables,
    kept_state,
    replay_batches,
    run_record_stream,
    run_stream,
    start_query,
    start_table,
    wait_and_stop,
)
from orderflow.settings import session_setting
from orderflow.sinks.files import (
    read_quarantine,
    write_cancelled_orders,
    write_parquet,
    write_quarantine,
)
from orderflow.sources import files, kafka, retail
from orderflow.streaming import deltas, sinks, tables
from orderflow.streaming.clean import (
    clean_and_derive,
    clean_stream,
    dedupe_stream,
    rejected_stream,
)

Query = Callable[[SparkSession, str], DataFrame]

#: The test tables hold little data per day, spread over thousands of days.
SMALL_DAYS = "64KB"
#: No key of the test tables holds the share of a shuffle task; these few are the largest.
HOT_SHARE = 0.001


def comparable(frame: DataFrame) -> DataFrame:
    """Zone-free times and revenue in whole cents; adding zero drops the sign
    of a difference that rounds to it."""
    fixed = {n: F.col(n).cast("timestamp_ntz") for n, t in frame.dtypes if t == "timestamp"}
    fixed |= {
        c: F.round(c, 2) + F.lit(0.0) for c in ("total_revenue", "revenue_diff") if c in frame.columns
    }
    return frame.withColumns(fixed) if fixed else frame


# --- stages of the clean orders --------------------------------------------


def _normalized(spark: SparkSession, sf: str) -> DataFrame:
    return derive.normalize_status(quality.valid_orders(retail.orders_raw(spark, sf)))


def _kept(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe.dedupe_orders(_normalized(spark, sf))


def _active(spark: SparkSession, sf: str) -> DataFrame:
    return derive.derive_columns(quality.split_cancelled(_kept(spark, sf)).active)


def _cancelled(spark: SparkSession, sf: str) -> DataFrame:
    return derive.derive_columns(quality.split_cancelled(_kept(spark, sf)).cancelled)


def _value_split(spark: SparkSession, sf: str) -> quality.ValueSplit:
    return quality.split_values(quality.split_missing_id(retail.orders_raw(spark, sf)).valid)


# --- sources and sinks ------------------------------------------------------


def csv_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Raw orders written as CSV and scanned again with the fixed schema."""
    path = scratch_dir(spark, "orders-csv")
    files.write_csv(retail.orders_raw(spark, sf), path)
    return files.read_orders_csv(spark, path)


def csv_products(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "products-csv")
    files.write_csv(retail.products(spark, sf), path)
    return files.read_products_csv(spark, path)


def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Rejects written by reason and read back."""
    path = scratch_dir(spark, "quarantine")
    write_quarantine(quality.rejected_orders(retail.orders_raw(spark, sf)), path)
    return read_quarantine(spark, path)


def _event_kept(spark: SparkSession, sf: str) -> DataFrame:
    valid = quality.valid_orders(retail.event_orders(spark, sf))
    return dedupe.dedupe_orders(derive.normalize_status(valid))


def _event_active(spark: SparkSession, sf: str) -> DataFrame:
    return derive.derive_columns(quality.split_cancelled(_event_kept(spark, sf)).active)


def _cancelled_stored(cancelled: DataFrame) -> DataFrame:
    spark = cancelled.sparkSession
    path = scratch_dir(spark, "cancelled")
    write_cancelled_orders(cancelled, path, SMALL_DAYS)
    return spark.read.schema(cancelled.schema).parquet(path)


def cancelled_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Cancelled orders written by day and read back."""
    return _cancelled_stored(_cancelled(spark, sf))


def cancelled_roundtrip_events(spark: SparkSession, sf: str) -> DataFrame:
    """The same over a month of events."""
    return _cancelled_stored(
        derive.derive_columns(quality.split_cancelled(_event_kept(spark, sf)).cancelled)
    )


def _enriched_stored(active: DataFrame, sf: str) -> DataFrame:
    spark = active.sparkSession
    path = scratch_dir(spark, "enriched")
    enriched = enrich.enrich_with_dimensions(
        active, retail.customers(spark, sf), retail.products(spark, sf)
    )
    write_parquet(enriched, path, "order_date", rebalance=True, min_partition_size=SMALL_DAYS)
    return spark.read.schema(enriched.schema).parquet(path).select(*enriched.columns)


def parquet_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Enriched orders written by day and read back."""
    return _enriched_stored(_active(spark, sf), sf)


def parquet_roundtrip_events(spark: SparkSession, sf: str) -> DataFrame:
    """The same over a month of events."""
    return _enriched_stored(_event_active(spark, sf), sf)


def kafka_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return kafka.decode_orders(kafka.encode_orders(retail.event_orders(spark, sf)))


# --- enrichment and aggregates ----------------------------------------------


def enrich_customers(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.enrich_with_customers(_active(spark, sf), retail.customers(spark, sf))


def enrich_products(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.enrich_with_products(_active(spark, sf), retail.products(spark, sf))


def enrich_dimensions(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.enrich_with_dimensions(
        _active(spark, sf), retail.customers(spark, sf), retail.products(spark, sf)
    )


def enrich_large_dimensions(spark: SparkSession, sf: str) -> DataFrame:
    """The same result by the joins for dimensions too large to broadcast, with
    few hot keys and many others. The orders are written first: they are read for the
    hot keys and for the joins."""
    active, path = _active(spark, sf), scratch_dir(spark, "active")
    write_parquet(active, path)
    active = spark.read.schema(active.schema).parquet(path)
    hot = enrich.hot_keys(active, "customer_id", "product_id", share=HOT_SHARE)
    return enrich.enrich_with_dimensions(
        active,
        retail.customers(spark, sf),
        retail.products(spark, sf),
        broadcast_limit=0,
        hot=hot,
    )


def dq_metrics(spark: SparkSession, sf: str) -> DataFrame:
    counts = metrics.stage_counts(retail.orders_raw(spark, sf))
    for stage, frame in (
        ("customers", retail.customers(spark, sf)),
        ("products", retail.products(spark, sf)),
    ):
        counts = counts.unionByName(metrics.row_count(frame, stage))
    return counts


def _batch(orders: DataFrame, sf: str) -> BatchTables:
    spark = orders.sparkSession
    return run_batch(
        orders,
        retail.customers(spark, sf),
        retail.products(spark, sf),
        scratch_dir(spark, "batch"),
        min_partition_size=SMALL_DAYS,
    )


def batch_job(spark: SparkSession, sf: str) -> DataFrame:
    """The whole batch job over the order lines; returns its stage counts."""
    return _batch(retail.orders_raw(spark, sf), sf).stage_counts()


def batch_job_orders(spark: SparkSession, sf: str) -> DataFrame:
    """The same job; returns the enriched orders."""
    return _batch(retail.orders_raw(spark, sf), sf).orders()


def batch_daily(spark: SparkSession, sf: str) -> DataFrame:
    """The same job; returns its written revenue by day."""
    return _batch(retail.orders_raw(spark, sf), sf).daily_revenue()


def batch_products(spark: SparkSession, sf: str) -> DataFrame:
    return _batch(retail.orders_raw(spark, sf), sf).product_revenue()


def batch_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return _batch(retail.orders_raw(spark, sf), sf).hourly_revenue()


def batch_job_events(spark: SparkSession, sf: str) -> DataFrame:
    """The whole batch job over a month of events; returns the enriched orders."""
    return _batch(retail.event_orders(spark, sf), sf).orders()


def rollup(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.revenue_rollup(_active(spark, sf))


# --- streams ----------------------------------------------------------------


def _run_to_table(
    frame: DataFrame, name: str, mode: str, make_handler: Callable[[str], sinks.Handler]
) -> str:
    """Run one query over all available input; returns where it stored rows."""
    spark = frame.sparkSession
    root = scratch_dir(spark, name)
    path = f"{root}/out"
    query = start_query(
        frame,
        name,
        mode,
        make_handler(path),
        f"{root}/checkpoint",
        {"availableNow": True},
        state_partitions=spark.sparkContext.defaultParallelism,
    )
    wait_and_stop([query], all_must_end=True)
    return path


def _append(frame: DataFrame, name: str, path: str, checkpoint: str, **how) -> None:
    """Run one query that appends all available input to a table."""
    query = start_table(
        frame,
        name,
        path,
        checkpoint,
        {"availableNow": True},
        state_partitions=frame.sparkSession.sparkContext.defaultParallelism,
        **how,
    )
    wait_and_stop([query], all_must_end=True)


def _streamed(frame: DataFrame, name: str, **how) -> DataFrame:
    """Rows of an append-mode stream, stored through the file sink and read back."""
    spark = frame.sparkSession
    root = scratch_dir(spark, name)
    _append(frame, name, f"{root}/out", f"{root}/checkpoint", **how)
    ddl = ", ".join(f"{n} {t}" for n, t in frame.dtypes)
    return tables.read_table(spark, f"{root}/out", ddl)


def stream_clean(spark: SparkSession, sf: str) -> DataFrame:
    return _streamed(clean_stream(retail.event_orders_stream(spark, sf)), "stream-clean")


def stream_clean_thinned(spark: SparkSession, sf: str) -> DataFrame:
    """Same rows with copies first thinned out within four parts of each id."""
    rows = clean_stream(retail.event_orders_stream(spark, sf), parts=4)
    return _streamed(rows, "stream-thinned")


def stream_clean_kafka(spark: SparkSession, sf: str) -> DataFrame:
    """Same rows when the stream carries JSON records."""
    records = kafka.encode_orders(retail.event_orders_stream(spark, sf))
    return _streamed(clean_stream(kafka.decode_orders(records)), "stream-kafka")


def stream_clean_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Same rows when they arrive as CSV files."""
    path = scratch_dir(spark, "events-csv")
    files.write_csv(retail.event_orders(spark, sf), path)
    orders = files.stream_orders_csv(spark, path, max_files_per_trigger=None)
    return _streamed(clean_stream(orders), "stream-csv")


def stream_triggered(spark: SparkSession, sf: str) -> DataFrame:
    """Same rows when a query that runs on, with a trigger at an interval, is stopped
    once it has used up its input."""
    root = scratch_dir(spark, "stream-triggered")
    rows = clean_stream(retail.event_orders_stream(spark, sf))
    cores = spark.sparkContext.defaultParallelism
    query = start_table(
        rows,
        "stream-triggered",
        f"{root}/out",
        f"{root}/checkpoint",
        {"processingTime": "1 second"},
        state_partitions=cores,
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return tables.read_table(spark, f"{root}/out", S.ORDERS)


def stream_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """Watermark and deduplication alone, on rows with an id."""
    rows = quality.split_missing_id(retail.event_orders_stream(spark, sf)).valid
    return _streamed(dedupe_stream(rows), "stream-dedupe")


def _enriched_by_batch(
    rows: DataFrame, customers: enrich.Dimension, products: enrich.Dimension, name: str, **how
) -> DataFrame:
    """Each batch of a stream enriched against the dimension rows that it needs."""

    def handler(path: str) -> sinks.Handler:
        store = sinks.store_batches(path)
        return sinks.enriching(store, customers, products, f"{path}-staging", **how)

    path = _run_to_table(rows, name, "append", handler)
    ddl = f"{S.ORDERS}, {S.DERIVED}, {S.CUSTOMERS}, {S.PRODUCTS}"
    fields = {field.split()[0]: field for field in ddl.split(", ")}
    ddl = ", ".join(fields[c] for c in S.ENRICHED_COLUMNS)
    return sinks.read_batches(rows.sparkSession, path, ddl)


def _event_dimensions(spark: SparkSession, sf: str) -> tuple[enrich.Dimension, enrich.Dimension]:
    return (
        enrich.check_dimension(retail.customers(spark, sf), "customer_id"),
        enrich.check_dimension(retail.products(spark, sf), "product_id"),
    )


def stream_enrich_large(spark: SparkSession, sf: str) -> DataFrame:
    """Batches enriched one by one, as for dimensions too large to broadcast."""
    rows = clean_and_derive(retail.event_orders_stream(spark, sf))
    dimensions = _event_dimensions(spark, sf)
    return _enriched_by_batch(rows, *dimensions, "stream-enrich-large", broadcast_limit=0)


def stream_enrich(
    spark: SparkSession, sf: str, broadcast_limit: int = enrich.BROADCAST_LIMIT
) -> DataFrame:
    """Dimensions joined to the stream itself; batch by batch if one is too large for
    that."""
    rows = clean_and_derive(retail.event_orders_stream(spark, sf))
    dimensions = _event_dimensions(spark, sf)
    if any(d.size_bytes > broadcast_limit for d in dimensions):
        return _enriched_by_batch(
            rows, *dimensions, "stream-enrich", broadcast_limit=broadcast_limit
        )
    return _streamed(enrich.enrich_with_dimensions(rows, *dimensions), "stream-enrich")


def _event_windows(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.windowed_revenue(clean_and_derive(retail.event_orders_stream(spark, sf)))


def stream_windowed_revenue(spark: SparkSession, sf: str) -> DataFrame:
    """Closed windows, stored by day."""
    rows = _event_windows(spark, sf).withColumn("window_date", F.to_date("window_start"))
    return _streamed(rows, "stream-windows", partition_by="window_date").drop("window_date")


def stream_windows_by_product(spark: SparkSession, sf: str) -> DataFrame:
    """The same windows stored in a directory per product."""
    rows = _event_windows(spark, sf)
    return _streamed(rows, "stream-products", partition_by="product_id", together=True)


def _stream_totals(spark: SparkSession, sf: str) -> DataFrame:
    rows = clean_and_derive(retail.event_orders_stream(spark, sf))
    return aggregates.product_totals(rows)


def stream_product_totals(spark: SparkSession, sf: str) -> DataFrame:
    path = _run_to_table(_stream_totals(spark, sf), "stream-totals", "complete", sinks.store_batches)
    return sinks.read_latest_batch(spark, path, sinks.TOTALS)


def stream_top_products(spark: SparkSession, sf: str) -> DataFrame:
    path = _run_to_table(_stream_totals(spark, sf), "stream-top", "complete", sinks.store_top_products)
    return sinks.read_latest_batch(spark, path, sinks.TOTALS)


def snapshot_latest(spark: SparkSession, sf: str) -> DataFrame:
    path = _run_to_table(_stream_totals(spark, sf), "snapshots", "complete", sinks.store_snapshots)
    return sinks.read_latest_snapshot(spark, path)


def stream_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    return _streamed(rejected_stream(retail.event_orders_stream(spark, sf)), "stream-rejects")


def _job(spark: SparkSession, sf: str, **options) -> StreamTables:
    root = scratch_dir(spark, "stream-job")
    return run_stream(
        retail.event_orders_stream(spark, sf),
        f"{root}/out",
        f"{root}/checkpoint",
        available_now=True,
        state_partitions=spark.sparkContext.defaultParallelism,
        **options,
    )


def stream_job(spark: SparkSession, sf: str) -> DataFrame:
    """All queries of the streaming job at once; returns the final totals."""
    return _job(spark, sf).product_totals()


def stream_job_windows(spark: SparkSession, sf: str) -> DataFrame:
    """The same job; returns its windows."""
    return _job(spark, sf).windowed_revenue().drop("window_date")


def stream_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """The same job with snapshots of all totals; returns the last one."""
    return _job(spark, sf, names=("snapshots",)).latest_snapshot()


def stream_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    """The table that the reports read; returns its active orders."""
    rows = _job(spark, sf, names=("clean",)).cleaned()
    return rows.where(F.col("order_class") == S.ACTIVE).select(*S.column_names(S.ORDERS))


def stream_quarantine_stored(spark: SparkSession, sf: str) -> DataFrame:
    """Rejects as the job stores them by reason."""
    return _job(spark, sf, names=("quarantine",)).quarantine()


def stream_dead_letters_stored(spark: SparkSession, sf: str) -> DataFrame:
    """Dead letters as the job stores them by reason."""
    root = scratch_dir(spark, "stream-dead-letters")
    return run_record_stream(
        retail.event_records_stream(spark, sf),
        f"{root}/out",
        f"{root}/checkpoint",
        available_now=True,
        names=("dead_letters",),
    ).dead_letters()


# --- streams of several batches ---------------------------------------------

SLICE_SECONDS = 3 * 86_400
LAST_SLICE = 9
FILES_PER_SLICE = 4
DELAYED_SHARE = 0.1
REPEATED_SHARE = 0.1
#: The batch at which the restarted stream goes on.
RESTART_AT = 6


def _deliveries(orders: DataFrame) -> DataFrame:
    """Adds the batch that an order arrives in: its slice of the month by arrival
    time, or, for some, two batches later."""
    start = F.unix_seconds(F.lit("2026-01-01").cast("timestamp"))
    place = F.floor((F.unix_seconds("arrival_time") - start) / SLICE_SECONDS)
    key = [F.col("order_id"), F.unix_micros("arrival_time")]
    key += [F.col("copy")] if "copy" in orders.columns else []
    delayed = draw_chance(42, "delayed", DELAYED_SHARE, *key)
    return orders.withColumn(
        "delivery", (F.least(place, F.lit(LAST_SLICE)) + F.when(delayed, 2).otherwise(0)).cast("int")
    )


def _deliver(deliveries: DataFrame, directory: str, batches: range) -> None:
    """Files of the batches, written one batch after the other."""
    for batch in batches:
        rows = deliveries.where(F.col("delivery") == batch).select(*S.column_names(S.ORDERS))
        files.write_csv(rows.repartition(FILES_PER_SLICE), f"{directory}/b{batch:02d}")


def _late_orders(spark: SparkSession, sf: str) -> DataFrame:
    return synth.inject_late(synth.inject_negative(synth_orders(spark, sf), "quantity"))


def _with_repeats(spark: SparkSession, sf: str) -> DataFrame:
    """Late rows, missing ids, and orders that are delivered twice, each copy on its
    own way. Copies are equal, so which of them comes first makes no difference."""
    rows = _late_orders(spark, sf)
    key = [F.col("order_id"), F.unix_micros("arrival_time")]
    twice = draw_chance(42, "repeat", REPEATED_SHARE, *key)
    copies = F.when(twice, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return _stored_deliveries(synth.inject_missing_id(rows.withColumn("copy", F.explode(copies))))


def _without_repeats(spark: SparkSession, sf: str) -> DataFrame:
    return _stored_deliveries(_late_orders(spark, sf))


def _stored_deliveries(orders: DataFrame) -> DataFrame:
    path = scratch_dir(orders.sparkSession, "deliveries")
    rows = _deliveries(orders)
    # A folder per batch: each is delivered without reading the others.
    rows.write.partitionBy("delivery").parquet(path)
    return orders.sparkSession.read.schema(rows.schema).parquet(path)


ALL_BATCHES = range(LAST_SLICE + 3)
IN_PARTS = [ALL_BATCHES[:RESTART_AT], ALL_BATCHES[RESTART_AT:]]


def _arrivals(spark: SparkSession, deliveries: DataFrame, parts: list[range], run) -> str:
    """Delivers the batches part by part and calls ``run(orders, root)`` after each."""
    root = scratch_dir(spark, "stream-parts")
    for part in parts:
        _deliver(deliveries, f"{root}/in", part)
        run(files.stream_orders_csv(spark, f"{root}/in/*", FILES_PER_SLICE), root)
    return root


def _emitted(rows: DataFrame) -> DataFrame:
    """How often each order came out; anything but 1 is a repeat."""
    return rows.groupBy(*S.column_names(S.ORDERS)).agg(F.count(F.lit(1)).alias("n_rows"))


def _cleaned_in_parts(spark: SparkSession, sf: str, parts: list[range]) -> DataFrame:
    """Orders that a cleaned stream lets through; each part is a new start of it."""

    def run(orders: DataFrame, root: str) -> None:
        _append(clean_stream(orders), "stream-parts", f"{root}/out", f"{root}/checkpoint")

    root = _arrivals(spark, _with_repeats(spark, sf), parts, run)
    return _emitted(tables.read_table(spark, f"{root}/out", S.ORDERS))


def stream_late_dropped(spark: SparkSession, sf: str) -> DataFrame:
    """A stream with rows that arrive too late and orders that arrive twice."""
    return _cleaned_in_parts(spark, sf, [ALL_BATCHES])


def stream_restart(spark: SparkSession, sf: str) -> DataFrame:
    """The same stream, stopped and started again on its checkpoint."""
    return _cleaned_in_parts(spark, sf, IN_PARTS)


def stream_replay(spark: SparkSession, sf: str) -> DataFrame:
    """The restarted stream's files read once more from the beginning, into the folder
    that holds its batches."""
    cores = spark.sparkContext.defaultParallelism

    def run(orders: DataFrame, root: str) -> None:
        handler, now = sinks.store_batches(f"{root}/out"), {"availableNow": True}
        query = start_query(
            clean_stream(orders), "stream-parts", "append", handler, f"{root}/checkpoint", now, cores
        )
        wait_and_stop([query], all_must_end=True)

    root = _arrivals(spark, _with_repeats(spark, sf), IN_PARTS, run)
    orders = files.stream_orders_csv(spark, f"{root}/in/*", FILES_PER_SLICE)
    replay_batches(clean_stream(orders), "replay", f"{root}/out", f"{root}/replayed", cores)
    return _emitted(sinks.read_batches(spark, f"{root}/out", S.ORDERS))


def stream_state(spark: SparkSession, sf: str) -> DataFrame:
    """What the stopped stream holds in its state until it is started again."""

    def run(orders: DataFrame, root: str) -> None:
        _append(clean_stream(orders), "stream-parts", f"{root}/out", f"{root}/checkpoint")

    root = _arrivals(spark, _with_repeats(spark, sf), IN_PARTS[:1], run)
    return kept_state(spark, f"{root}/checkpoint", "stream-parts")


def _job_over_arrivals(spark: SparkSession, sf: str, **options) -> StreamTables:
    done = []

    def run(orders: DataFrame, root: str) -> None:
        cores = spark.sparkContext.defaultParallelism
        options.update(available_now=True, state_partitions=cores)
        done.append(run_stream(orders, f"{root}/job", f"{root}/checkpoint", **options))

    _arrivals(spark, _with_repeats(spark, sf), [ALL_BATCHES], run)
    return done[0]


def stream_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The rows behind the watermark, as the job stores them."""
    return _job_over_arrivals(spark, sf, names=("late_orders",)).late_orders()


def stream_summary(spark: SparkSession, sf: str) -> DataFrame:
    """What the job's summary says of its cleaning query, but for times."""
    summary = _job_over_arrivals(spark, sf, names=("clean",)).summary
    return summary.select(
        "query", "input_rows", "late_rows", "min_event_time", "max_event_time", "complete"
    )


def stream_batch_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Rows received, rejected and kept in each batch, as Spark observed them."""
    return _job_over_arrivals(spark, sf, names=("clean",)).batches.drop("query")


def _windows_of_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    directory = f"{scratch_dir(spark, 'stream-updates')}/in"
    _deliver(_without_repeats(spark, sf), directory, ALL_BATCHES)
    orders = files.stream_orders_csv(spark, f"{directory}/*", FILES_PER_SLICE)
    return clean_and_derive(orders)


def stream_windows_update(spark: SparkSession, sf: str) -> DataFrame:
    """Windows in update mode, late rows dropped, merged into the days they belong to."""
    frame = aggregates.windowed_revenue(_windows_of_arrivals(spark, sf))
    frame = frame.withColumn("window_date", F.to_date("window_start"))
    ddl = f"{sinks.WINDOWS}, window_date date"
    key = ["window_date", "window_start", "product_id"]

    def handler(path: str) -> sinks.Handler:
        return deltas.store_upserts(path, f"{path}-staging", spark, ddl, key, "window_date")

    path = _run_to_table(frame, "stream-updates", "update", handler)
    return spark.read.schema(ddl).parquet(path).drop("window_date")


def stream_console(spark: SparkSession, sf: str) -> DataFrame:
    """What the console shows of the changed windows: the first rows of each batch, and
    nothing of a batch without rows."""
    frame = aggregates.windowed_revenue(_windows_of_arrivals(spark, sf))
    shown = []

    def show(title: str, rows: DataFrame) -> None:
        batch_id = F.lit(int(title.removeprefix("batch "))).cast("bigint")
        shown.append(rows.withColumn("batch_id", batch_id))

    _run_to_table(frame, "stream-console", "update", lambda path: sinks.show_rows(show=show))
    rows = shown[0]
    for more in shown[1:]:
        rows = rows.unionByName(more)
    return rows


def stream_totals_deltas(spark: SparkSession, sf: str) -> DataFrame:
    """Totals in update mode: the changed products of each batch, merged in levels."""
    frame = aggregates.product_totals(_windows_of_arrivals(spark, sf))

    def handler(path: str) -> sinks.Handler:
        return deltas.store_deltas(path, spark, sinks.TOTALS, ["product_id"], fanout=3)

    path = _run_to_table(frame, "stream-deltas", "update", handler)
    return deltas.read_deltas(spark, path, sinks.TOTALS, ["product_id"])


def reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """Streamed totals against batch totals of the same events."""
    batch = aggregates.product_totals(_event_active(spark, sf))
    return compare_totals(batch, stream_product_totals(spark, sf))


def _windowed_batch(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.windowed_revenue(_active(spark, sf))


# --- data synthesis over the keys of the given tables -----------------------


def _ids(spark: SparkSession, sf: str, name: str, key: str) -> DataFrame:
    return retail.table(spark, sf, name).select(F.col(key).alias("id"))


def synth_orders(spark: SparkSession, sf: str) -> DataFrame:
    return synth.synth_orders(_ids(spark, sf, "orders", "o_orderkey"))


def synth_defects(spark: SparkSession, sf: str) -> DataFrame:
    return synth.inject_defects(synth_orders(spark, sf))


ROWS_PER_FILE = 100
#: What opening one of these files is worth, in bytes read.
SMALL_FILE = "64KB"


def microbatch_files(spark: SparkSession, sf: str) -> DataFrame:
    """Defective orders split into files by time and read back, with two flags:
    whether the row's file has its exact size (the last one may be short) and whether no
    earlier file, by name, holds a later time.

    Names give a task and a number within the task, so files are compared within their
    task and tasks, few of them, with each other.
    """
    path = scratch_dir(spark, "microbatches")
    synth.split_microbatches(
        synth_defects(spark, sf), path, rows_per_file=ROWS_PER_FILE, order_by="order_timestamp"
    )
    name = F.col("_metadata.file_name")
    named = files.read_orders_csv(spark, path).withColumns(
        {
            "task": F.regexp_extract(name, r"part-(\d+)-", 1).cast("int"),
            "file": F.regexp_extract(name, r"-c(\d+)\.", 1).cast("int"),
        }
    )
    # The many files are opened once, thousands by a task, and not again for the join.
    staged = scratch_dir(spark, "microbatch-read")
    with session_setting(spark, "spark.sql.files.openCostInBytes", SMALL_FILE):
        named.write.parquet(staged)
    rows = spark.read.schema(named.schema).parquet(staged)
    per_file = rows.groupBy("task", "file").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("order_timestamp").alias("first"),
        F.max("order_timestamp").alias("last"),
    )
    before, after = Window.unboundedPreceding, Window.unboundedFollowing
    tasks = Window.orderBy("task")
    per_task = per_file.groupBy("task").agg(F.max("last").alias("last"), F.max("file").alias("files"))
    per_task = per_task.select(
        "task",
        "files",
        F.max("last").over(tasks.rowsBetween(before, -1)).alias("passed"),
        (F.max("task").over(tasks.rowsBetween(before, after)) == F.col("task")).alias("is_last"),
    )
    earlier = Window.partitionBy("task").orderBy("file").rowsBetween(before, -1)
    latest = F.greatest(F.max("last").over(earlier), F.col("passed"))
    short = F.col("is_last") & (F.col("file") == F.col("files")) & (F.col("n_rows") < ROWS_PER_FILE)
    flags = per_file.join(per_task, "task").select(
        "task",
        "file",
        ((F.col("n_rows") == ROWS_PER_FILE) | short).alias("size_kept"),
        F.coalesce(latest <= F.col("first"), F.lit(True)).alias("order_kept"),
    )
    return rows.join(flags, ["task", "file"]).drop("task", "file")


def synth_customers(spark: SparkSession, sf: str) -> DataFrame:
    return synth.synth_customers(_ids(spark, sf, "customer", "c_custkey"))


def synth_products(spark: SparkSession, sf: str) -> DataFrame:
    return synth.synth_products(_ids(spark, sf, "part", "p_partkey"))


QUERIES: dict[str, Query] = {
    "scan_orders": retail.orders_raw,
    "scan_customers": retail.customers,
    "scan_products": retail.products,
    "csv_orders": csv_orders,
    "csv_products": csv_products,
    "missing_id_valid": lambda s, d: quality.split_missing_id(retail.orders_raw(s, d)).valid,
    "missing_id_rejects": lambda s, d: quality.split_missing_id(retail.orders_raw(s, d)).missing,
    "value_valid": lambda s, d: _value_split(s, d).valid,
    "value_rejects": lambda s, d: _value_split(s, d).invalid,
    "quarantine": quarantine,
    "normalize_status": _normalized,
    "dedupe_orders": _kept,
    "derive_columns": lambda s, d: derive.derive_columns(_kept(s, d)),
    "active_orders": _active,
    "cancelled_orders": _cancelled,
    "cancelled_roundtrip": cancelled_roundtrip,
    "cancelled_roundtrip_events": cancelled_roundtrip_events,
    "enrich_customers": enrich_customers,
    "enrich_products": enrich_products,
    "enrich_dimensions": enrich_dimensions,
    "enrich_large_dimensions": enrich_large_dimensions,
    "daily_revenue": lambda s, d: aggregates.daily_revenue(_active(s, d)),
    "product_revenue": lambda s, d: aggregates.product_revenue(_active(s, d)),
    "hourly_revenue": lambda s, d: aggregates.hourly_revenue(_active(s, d)),
    "top_products": lambda s, d: aggregates.top_products(_active(s, d)),
    "revenue_rollup": rollup,
    "dq_metrics": dq_metrics,
    "batch_event_stats": lambda s, d: metrics.event_stats(retail.event_orders(s, d)),
    "windowed_revenue_batch": _windowed_batch,
    "parquet_roundtrip": parquet_roundtrip,
    "parquet_roundtrip_events": parquet_roundtrip_events,
    "run_batch": batch_job,
    "run_batch_orders": batch_job_orders,
    "run_batch_events": batch_job_events,
    "batch_daily": batch_daily,
    "batch_products": batch_products,
    "batch_hourly": batch_hourly,
    "kafka_decode": lambda s, d: kafka.decode_orders(retail.event_records(s, d)),
    "kafka_roundtrip": kafka_roundtrip,
    "kafka_dead_letter": lambda s, d: kafka.dead_letters(retail.event_records(s, d), "offset"),
    "stream_clean": stream_clean,
    "stream_clean_thinned": stream_clean_thinned,
    "stream_clean_csv": stream_clean_csv,
    "stream_clean_kafka": stream_clean_kafka,
    "stream_dedupe": stream_dedupe,
    "stream_enrich": stream_enrich,
    "stream_enrich_large": stream_enrich_large,
    "stream_windowed_revenue": stream_windowed_revenue,
    "stream_windows_by_product": stream_windows_by_product,
    "stream_windows_update": stream_windows_update,
    "stream_late_dropped": stream_late_dropped,
    "stream_restart": stream_restart,
    "stream_replay": stream_replay,
    "stream_state": stream_state,
    "stream_late_rows": stream_late_rows,
    "stream_batch_metrics": stream_batch_metrics,
    "stream_summary": stream_summary,
    "stream_console": stream_console,
    "stream_triggered": stream_triggered,
    "stream_totals_deltas": stream_totals_deltas,
    "stream_cleaned": stream_cleaned,
    "stream_snapshots": stream_snapshots,
    "stream_product_totals": stream_product_totals,
    "stream_top_products": stream_top_products,
    "snapshot_latest": snapshot_latest,
    "stream_quarantine": stream_quarantine,
    "stream_quarantine_stored": stream_quarantine_stored,
    "stream_dead_letters_stored": stream_dead_letters_stored,
    "run_stream": stream_job,
    "run_stream_windows": stream_job_windows,
    "reconcile": reconcile,
    "synth_orders": synth_orders,
    "synth_defects": synth_defects,
    "microbatch_files": microbatch_files,
    "synth_customers": synth_customers,
    "synth_products": synth_products,
}


def _comparable_query(query: Query) -> Query:
    return lambda spark, directory: comparable(query(spark, directory))


def queries() -> dict[str, Query]:
    return {name: _comparable_query(query) for name, query in QUERIES.items()}
