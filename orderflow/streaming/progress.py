"""Metrics of running streams, taken from Spark's own progress reports."""

from __future__ import annotations

import threading
import time
from collections import deque
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

SUMMARY = (
    "query string, batches bigint, input_rows bigint, rows_per_batch double, "
    "rows_per_second double, late_rows bigint, min_event_time timestamp, "
    "max_event_time timestamp, elapsed_seconds double, complete boolean"
)

#: What ``observed`` and the cleaning query count in each batch.
BATCHES = (
    "query string, batch_id bigint, rows_in bigint, missing_order_id bigint, "
    "invalid_values bigint, indeterminate_values bigint, kept bigint"
)


@dataclass
class _Totals:
    name: str
    started: float = field(default_factory=time.monotonic)
    last: float = field(default_factory=time.monotonic)
    batches: int = 0
    input_rows: int = 0
    late_rows: int = 0
    min_time: str | None = None
    max_time: str | None = None
    ended: threading.Event = field(default_factory=threading.Event)


class ProgressLog(StreamingQueryListener):
    """Adds up the progress of named queries without extra jobs.

    Counts are rows that leave the source scan (a scan that filters by itself
    leaves out what it drops), and event times are those Spark saw for the
    watermark. One small record per query is kept, however long it runs, and the
    observed counts of the last ``batches`` batches.
    """

    def __init__(self, log=None, batches: int = 10_000):
        self._log = log
        self._totals: dict[str, _Totals] = {}
        self._observed: deque[tuple] = deque(maxlen=batches)

    def onQueryStarted(self, event):
        self._totals[str(event.runId)] = _Totals(event.name or str(event.id))

    def onQueryProgress(self, event):
        progress = event.progress
        totals = self._totals.get(str(progress.runId))
        if totals is None:
            return
        totals.batches += 1
        totals.last = time.monotonic()
        totals.input_rows += progress.numInputRows
        totals.late_rows += sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
        observed = {k: v for row in progress.observedMetrics.values() for k, v in row.asDict().items()}
        if observed.get("rows_in"):
            names = [column.split()[0] for column in BATCHES.split(", ")[2:]]
            counts = [observed.get(name) for name in names]
            self._observed.append((totals.name, progress.batchId, *counts))
        times = progress.eventTime
        if progress.numInputRows and "min" in times:
            totals.min_time = min(filter(None, (totals.min_time, times["min"])))
            totals.max_time = max(filter(None, (totals.max_time, times["max"])))
        if self._log:
            self._log(
                f"[{totals.name}] batch {progress.batchId}: {progress.numInputRows} rows, "
                f"event time {times.get('min')} to {times.get('max')}"
            )

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        totals = self._totals.get(str(event.runId))
        if totals is not None:
            totals.ended.set()

    def wait_ended(self, run_ids, seconds: float = 60.0) -> bool:
        """Wait until the reports of ended queries have come in; whether all have
        within the time. ``summary`` tells for each query."""
        deadline = time.monotonic() + seconds
        ended = [self._totals[str(i)].ended for i in run_ids if str(i) in self._totals]
        return all([e.wait(max(0.0, deadline - time.monotonic())) for e in ended])

    def batches(self, spark: SparkSession) -> DataFrame:
        """Observed counts of each batch that had rows. A batch that was repeated may
        be there twice, with the same numbers."""
        return spark.createDataFrame(list(self._observed), BATCHES)

    def summary(self, spark: SparkSession) -> DataFrame:
        """One row per query; ``complete`` is false while reports may be missing."""
        rows = []
        for t in self._totals.values():
            elapsed = t.last - t.started
            rows.append(
                (
                    t.name,
                    t.batches,
                    t.input_rows,
                    t.input_rows / t.batches if t.batches else 0.0,
                    t.input_rows / elapsed if elapsed > 0 else 0.0,
                    t.late_rows,
                    t.min_time,
                    t.max_time,
                    elapsed,
                    t.ended.is_set(),
                )
            )
        text = SUMMARY.replace("event_time timestamp", "event_time string")
        frame = spark.createDataFrame(rows, text)
        times = {c: F.col(c).cast("timestamp") for c in ("min_event_time", "max_event_time")}
        return frame.withColumns(times)
