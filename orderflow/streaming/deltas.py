"""Tables that a stream's batches add up to.

- ``store_deltas`` writes what a batch hands over as a run of its own and merges runs in
  levels. In update mode these are the rows that the batch changed, with their new
  values: what a batch writes follows them, and each row is rewritten once per level,
  not once per batch. Without a key, rows are only collected. Either way the number of
  runs grows with the logarithm of the number of batches, so readers list few folders.
- ``store_upserts`` merges changed rows into the directories they belong to and replaces
  just those directories.

Both may repeat a batch.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.schema import column_names
from orderflow.sinks.commits import delete, drop_older, exists, folders_matching
from orderflow.sinks.files import write_parquet

Handler = Callable[[DataFrame, int], None]

_RUN = r"run_\d{12}_\d{12}"


def _runs(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """First and last batch of the runs that count, newest first. A run that lies in a
    larger one was merged into it."""
    found = []
    for name in folders_matching(spark, path, _RUN):
        first, last = map(int, re.findall(r"\d+", name))
        found.append((first, last))
    found.sort(key=lambda run: (run[0], -run[1]))
    kept: list[tuple[int, int]] = []
    for first, last in found:
        if not kept or last > kept[-1][1]:
            kept.append((first, last))
    return kept[::-1]


def _folder(path: str, run: tuple[int, int]) -> str:
    return f"{path}/run_{run[0]:012d}_{run[1]:012d}"


def _newest(
    spark: SparkSession, path: str, runs: list, ddl: str, key: list[str] | None
) -> DataFrame:
    """The newest row of each key in the runs; all rows without a key."""
    parts = [
        spark.read.schema(ddl).parquet(_folder(path, run)).withColumn("_batch", F.lit(run[1]))
        for run in runs
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.union(part)
    columns = column_names(ddl)
    if key is None:
        return rows.select(*columns)
    rest = [c for c in columns if c not in key]
    newest = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), "_batch").alias("_row"))
    return newest.select(*(F.col(c) if c in key else F.col(f"_row.{c}") for c in columns))


def read_deltas(
    spark: SparkSession, path: str, ddl: str, key: list[str] | None = None
) -> DataFrame:
    """The table as of the last batch; empty before the first."""
    runs = _runs(spark, path)
    if not runs:
        return spark.createDataFrame([], ddl)
    return _newest(spark, path, runs, ddl, key)


def store_deltas(
    path: str, session: SparkSession, ddl: str, key: list[str] | None = None, fanout: int = 8
) -> Handler:
    """Each batch's rows as a run; ``fanout`` runs of a level become one of the
    next. A level's runs span ``fanout`` times as many batches as those below."""

    def span(run: tuple[int, int]) -> int:
        level, size = 0, run[1] - run[0] + 1
        while size >= fanout:
            level, size = level + 1, size // fanout
        return level

    def store(batch: DataFrame, batch_id: int) -> None:
        runs = _runs(session, path)
        # A repeated batch that is in a merged run already has nothing to add.
        if not any(first <= batch_id <= last and first < last for first, last in runs):
            write_parquet(batch.select(*column_names(ddl)), _folder(path, (batch_id, batch_id)))
        while True:
            runs = _runs(session, path)
            level = [run for run in runs if span(run) == span(runs[0])]
            if len(level) < fanout:
                break
            merged = (level[-1][0], level[0][1])
            rows = _newest(session, path, level, ddl, key)
            write_parquet(rows.hint("rebalance"), _folder(path, merged))
            for run in level:
                delete(session, _folder(path, run))

    return store


def store_upserts(
    path: str, staging: str, session: SparkSession, ddl: str, key: list[str], partition_by: str
) -> Handler:
    """Merges each batch's rows into the directories of ``partition_by`` that they
    belong to.

    The merged directories are first written below ``staging`` and then put in place. A
    repeated batch whose staged rows are complete only puts them in place once more,
    since the old ones may be gone by then.
    """
    columns = column_names(ddl)
    rest = [c for c in columns if c not in key]

    def store(batch: DataFrame, batch_id: int) -> None:
        staged = f"{staging}/merged/batch_id={batch_id}"
        if not exists(session, f"{staged}/_SUCCESS"):
            changed = f"{staging}/changed/batch_id={batch_id}"
            write_parquet(batch.select(*columns), changed)
            new = session.read.schema(ddl).parquet(changed)
            rows = new.withColumn("_new", F.lit(True))
            if exists(session, path):
                old = session.read.schema(ddl).parquet(path).select(*columns)
                days = new.select(partition_by).distinct()
                old = old.join(days, partition_by, "left_semi").select(*columns)
                rows = rows.union(old.withColumn("_new", F.lit(False)))
            merged = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), "_new").alias("_row"))
            merged = merged.select(
                *(F.col(c) if c in key else F.col(f"_row.{c}") for c in columns)
            )
            write_parquet(merged, staged)
        ready = session.read.schema(ddl).parquet(staged)
        if not ready.isEmpty():
            writer = ready.hint("rebalance", F.col(partition_by)).write.mode("overwrite")
            writer.option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path)
        for name in ("changed", "merged"):
            drop_older(session, f"{staging}/{name}", "batch_id=", keep=2)

    return store
