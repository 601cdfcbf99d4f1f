"""The streaming job: one cleaning query, and reports that read its table.

The cleaning query is the only one that deduplicates. It appends to an exactly-once
table, which the windows, totals and console queries read as a stream; so orders are
scanned once for it, however many reports there are, and a new report can start from
the table. Rejected rows, rows that come too late and lost payloads are kept by queries
of their own, which need no state.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderflow import schema as S
from orderflow.operators.aggregates import product_totals, windowed_revenue
from orderflow.operators.quality import valid_orders
from orderflow.settings import session_setting
from orderflow.sinks.commits import drop_newer, exists
from orderflow.sources.files import stream_orders_csv
from orderflow.sources.kafka import dead_letters, decode_orders, stream_records
from orderflow.streaming import sinks, tables
from orderflow.streaming.clean import (
    CLEANED,
    WATERMARK_DELAY,
    active_only,
    cleaned_stream,
    observed,
    rejected_stream,
)
from orderflow.streaming.deltas import read_deltas, store_deltas, store_upserts
from orderflow.streaming.late import read_late_rows, store_late_rows
from orderflow.streaming.progress import ProgressLog

#: Queries over the incoming orders, and reports over the cleaned ones. Windows are
#: printed as they change and stored once they are closed, so they take two queries.
INTAKE = ("clean", "quarantine", "late_orders", "dead_letters")
REPORTS = ("console", "windowed_revenue", "product_totals", "current_windows", "snapshots")
ALL_QUERIES = ("clean", "quarantine", "late_orders", "console", "windowed_revenue", "product_totals")
KAFKA_QUERIES = (*ALL_QUERIES, "dead_letters")


@dataclass(frozen=True)
class StreamTables:
    """Where a streaming job keeps its results, and how it went."""

    spark: SparkSession
    root: str
    summary: DataFrame | None = None
    #: Rows received, rejected and kept, by batch of the cleaning query.
    batches: DataFrame | None = None

    def _appended(self, name: str, ddl: str, partition_by: str) -> DataFrame:
        return tables.read_table(self.spark, f"{self.root}/{name}", ddl, partition_by)

    def cleaned(self) -> DataFrame:
        """Valid, deduplicated orders; filters on ``order_class`` prune directories."""
        return self._appended("clean", CLEANED, "order_class string")

    def windowed_revenue(self) -> DataFrame:
        """Closed windows, with ``window_date``, whose filters prune directories."""
        return self._appended(
            "windowed_revenue", f"{sinks.WINDOWS}, window_date date", "window_date date"
        )

    def current_windows(self) -> DataFrame:
        """All windows as of the last batch, open ones too."""
        ddl, path = f"{sinks.WINDOWS}, window_date date", f"{self.root}/current_windows"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], ddl)
        return self.spark.read.schema(ddl).parquet(path)

    def quarantine(self) -> DataFrame:
        """Rejected orders with their reason."""
        return self._appended(
            "quarantine", f"{S.ORDERS}, reject_reason string", "reject_reason string"
        )

    def late_orders(self) -> DataFrame:
        """Valid orders that came behind the watermark."""
        return read_late_rows(self.spark, f"{self.root}/late_orders")

    def dead_letters(self) -> DataFrame:
        """Payloads that decoding lost content of, with the reason."""
        return self._appended("dead_letters", "payload string, reason string", "reason string")

    def product_totals(self) -> DataFrame:
        """Totals as of the last batch."""
        return read_deltas(self.spark, f"{self.root}/product_totals", sinks.TOTALS, ["product_id"])

    def latest_snapshot(self) -> DataFrame:
        return sinks.read_latest_snapshot(self.spark, f"{self.root}/product_totals_snapshots")


def _start(writer, frame: DataFrame, name: str, checkpoint: str, trigger: dict, partitions) -> StreamingQuery:
    writer = writer.queryName(name).option("checkpointLocation", f"{checkpoint}/{name}")
    partitions = None if partitions is None else str(partitions)
    with session_setting(frame.sparkSession, "spark.sql.shuffle.partitions", partitions):
        return writer.trigger(**trigger).start()


def start_query(
    frame: DataFrame,
    name: str,
    mode: str,
    handler: sinks.Handler,
    checkpoint: str,
    trigger: dict,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Start one query that hands its batches to ``handler``.

    ``state_partitions`` sets how far the state is spread, else the session's
    shuffle partitions do. The first start fixes it for the checkpoint, so it
    should fit the cluster: about one per core.
    """
    writer = frame.writeStream.outputMode(mode).foreachBatch(handler)
    return _start(writer, frame, name, checkpoint, trigger, state_partitions)


def start_table(
    frame: DataFrame,
    name: str,
    path: str,
    checkpoint: str,
    trigger: dict,
    partition_by: str | None = None,
    writers: int | None = None,
    state_partitions: int | None = None,
    together: bool = False,
) -> StreamingQuery:
    """Start one query that appends to the table at ``path`` through Spark's file sink.

    ``writers`` bounds the files of a batch per directory (see ``tables.dealt``);
    ``together`` writes the rows of a directory to one file.
    """
    writers = writers or tables.default_writers(frame.sparkSession)
    rows = tables.dealt(frame, writers, partition_by if together else None)
    writer = rows.writeStream.outputMode("append").format("parquet").option("path", path)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    return _start(writer, frame, name, checkpoint, trigger, state_partitions)


@dataclass(frozen=True)
class _Job:
    """What all queries of a job share."""

    spark: SparkSession
    output: str
    checkpoint: str
    delay: str
    window: str
    available_now: bool
    state_partitions: int | None
    writers: int | None

    def trigger(self, every: str) -> dict:
        return {"availableNow": True} if self.available_now else {"processingTime": every}

    def table(self, frame: DataFrame, name: str, partition_by: str) -> StreamingQuery:
        path, trigger = f"{self.output}/{name}", self.trigger("10 seconds")
        return start_table(
            frame, name, path, self.checkpoint, trigger, partition_by, self.writers, self.state_partitions
        )

    def query(self, frame: DataFrame, name: str, mode: str, handler, every: str) -> StreamingQuery:
        trigger = self.trigger(every)
        return start_query(
            frame, name, mode, handler, self.checkpoint, trigger, self.state_partitions
        )

    def cleaned(self) -> DataFrame:
        return tables.stream_table(self.spark, f"{self.output}/clean", CLEANED)

    def windows(self) -> DataFrame:
        """Windows of active orders, also those of the day they begin in."""
        rows = active_only(self.cleaned().withWatermark("order_timestamp", self.delay))
        return windowed_revenue(rows, self.window).where("orders_count > 0")

    def totals(self) -> DataFrame:
        return product_totals(self.cleaned().where(F.col("order_class") == S.ACTIVE))


def _start_intake(job: _Job, name: str, orders: DataFrame, records: DataFrame | None, parts: int):
    if name == "clean":
        rows = cleaned_stream(observed(orders), job.delay, parts)
        rows = rows.observe("cleaned", F.count(F.lit(1)).alias("kept"))
        return job.table(rows, name, "order_class")
    if name == "quarantine":
        return job.table(rejected_stream(orders), name, "reject_reason")
    if name == "late_orders":
        store = store_late_rows(f"{job.output}/{name}", job.spark, job.delay)
        return job.query(valid_orders(orders), name, "append", store, "10 seconds")
    return job.table(dead_letters(records), name, "reason")


def _start_report(job: _Job, name: str, keep_snapshots: int | None) -> StreamingQuery:
    path = f"{job.output}/{name}"
    if name == "console":
        return job.query(job.windows(), name, "update", sinks.show_rows(), "5 seconds")
    if name == "windowed_revenue":
        rows = job.windows().withColumn("window_date", F.to_date("window_start"))
        return job.table(rows, name, "window_date")
    if name == "current_windows":
        rows = job.windows().withColumn("window_date", F.to_date("window_start"))
        key = ["window_date", "window_start", "product_id"]
        ddl = f"{sinks.WINDOWS}, window_date date"
        staging = f"{job.checkpoint}/{name}-staging"
        store = store_upserts(path, staging, job.spark, ddl, key, "window_date")
        return job.query(rows, name, "update", store, "10 seconds")
    if name == "product_totals":
        store = store_deltas(path, job.spark, sinks.TOTALS, ["product_id"])
        handler = sinks.after(store, sinks.show_top_products(stored=path))
        return job.query(job.totals(), name, "update", handler, "10 seconds")
    store = sinks.store_snapshots(f"{job.output}/product_totals_snapshots", keep_snapshots)
    return job.query(job.totals(), name, "complete", store, "10 seconds")


def start_queries(
    orders: DataFrame,
    output: str,
    checkpoint: str,
    names: tuple[str, ...] = ALL_QUERIES,
    delay: str = WATERMARK_DELAY,
    window: str = "10 minutes",
    parts: int = 1,
    available_now: bool = False,
    state_partitions: int | None = None,
    records: DataFrame | None = None,
    writers: int | None = None,
    keep_snapshots: int | None = None,
) -> list[StreamingQuery]:
    """Start the named queries; each has its own checkpoint. Reports read the table of
    ``clean``, which is started with them if it is not named.

    With ``available_now`` the reports start once the intake queries have used up the
    input. Totals and windows need no dimension columns, and dimension keys are unique,
    so the aggregates read the orders before any lookup. ``parts`` is for ids that hold
    much of a micro-batch (see ``dedupe_stream``). ``product_totals`` is kept by changed
    products (see ``store_deltas``); ``snapshots`` writes all of them as CSV at each
    trigger, of which ``keep_snapshots`` stay. ``current_windows`` is a table of all
    windows, open ones too.
    """
    unknown = set(names) - {*INTAKE, *REPORTS}
    if unknown:
        raise ValueError(f"unknown queries: {sorted(unknown)}")
    job = _Job(
        orders.sparkSession, output, checkpoint, delay, window, available_now, state_partitions, writers
    )
    reports = [name for name in REPORTS if name in names]
    wanted = {*names, *(["clean"] if reports else [])}
    intake = [name for name in INTAKE if name in wanted and (name != "dead_letters" or records is not None)]
    started = [_start_intake(job, name, orders, records, parts) for name in intake]
    if available_now and reports:
        wait_and_stop(started, all_must_end=True)
    return started + [_start_report(job, name, keep_snapshots) for name in reports]


def wait_and_stop(
    queries: list[StreamingQuery], timeout: float | None = None, all_must_end: bool = False
) -> None:
    """Wait until one query ends (or all of them, or the time is up), then
    stop the rest. A failed query ends the wait with its error."""
    deadline = None if timeout is None else time.monotonic() + timeout
    try:
        while deadline is None or time.monotonic() < deadline:
            ended = [query.awaitTermination(0.2) for query in queries]
            if all(ended) or (any(ended) and not all_must_end):
                break
    finally:
        for query in queries:
            query.stop()


def replay_batches(
    frame: DataFrame,
    name: str,
    path: str,
    checkpoint: str,
    state_partitions: int | None = None,
) -> None:
    """Read all available input once more, with a fresh checkpoint, into the folder
    that holds the batches of an earlier run (``sinks.store_batches``). Each batch
    replaces the one of its number; those that the replay does not reach go."""
    handler = sinks.store_batches(path)
    now = {"availableNow": True}
    query = start_query(frame, name, "append", handler, checkpoint, now, state_partitions)
    wait_and_stop([query], all_must_end=True)
    reached = query.recentProgress
    drop_newer(frame.sparkSession, path, "batch_id=", reached[-1].batchId if reached else -1)


def kept_state(spark: SparkSession, checkpoint: str, name: str) -> DataFrame:
    """The ids that a query with one deduplication holds in its state, and when it lets
    go of each; read from the checkpoint by Spark's state data source."""
    state = spark.read.format("statestore").load(f"{checkpoint}/{name}")
    expiry = F.timestamp_micros("value.expiresAtMicros")
    return state.select("key.order_id", expiry.alias("expires_at"))


def run_stream(
    orders: DataFrame,
    output: str,
    checkpoint: str,
    timeout: float | None = None,
    log=None,
    **options,
) -> StreamTables:
    """Run the streaming job over any order stream (files or Kafka).

    Stops after ``timeout`` seconds, or when the input is used up with
    ``available_now=True``, or never.
    """
    spark = orders.sparkSession
    progress = ProgressLog(log)
    spark.streams.addListener(progress)
    try:
        queries = start_queries(orders, output, checkpoint, **options)
        wait_and_stop(queries, timeout, all_must_end=options.get("available_now", False))
        progress.wait_ended([q.runId for q in queries])
        return StreamTables(spark, output, progress.summary(spark), progress.batches(spark))
    finally:
        spark.streams.removeListener(progress)


def run_file_stream(
    spark: SparkSession,
    directory: str,
    output: str,
    checkpoint: str,
    max_files_per_trigger: int | None = 2,
    **options,
) -> StreamTables:
    """The streaming job over CSV files that arrive in a directory."""
    orders = stream_orders_csv(spark, directory, max_files_per_trigger)
    return run_stream(orders, output, checkpoint, **options)


def run_kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    output: str,
    checkpoint: str,
    source: dict | None = None,
    **options,
) -> StreamTables:
    """The streaming job over a Kafka topic; runs without end by default."""
    records = stream_records(spark, servers, topic, **(source or {}))
    return run_record_stream(records, output, checkpoint, **options)


def run_record_stream(records: DataFrame, output: str, checkpoint: str, **options) -> StreamTables:
    """The streaming job over any stream of JSON records in ``value``."""
    options = {"names": KAFKA_QUERIES, "records": records, **options}
    return run_stream(decode_orders(records), output, checkpoint, **options)
