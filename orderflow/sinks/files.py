"""Parquet tables of the batch job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow import schema as S
from orderflow.settings import session_setting

_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_MIN_PARTITION = "spark.sql.adaptive.coalescePartitions.minPartitionSize"


def write_parquet(
    frame: DataFrame,
    path: str,
    partition_by: str | list[str] | None = None,
    mode: str = "overwrite",
    rebalance: bool = False,
    min_partition_size: str | None = None,
    compression: str | None = None,
) -> None:
    """Write a table, replacing all of it by default, also when it is empty.

    ``rebalance`` shuffles rows so that each directory gets few, evenly sized
    files; adaptive execution splits directories that hold many rows.
    ``min_partition_size`` is the least that adaptive execution gives a task
    while it writes; else the session's setting holds. Lower it where many
    directories hold little data each, as opening files then takes the time.
    """
    keys = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    if rebalance:
        frame = rebalanced(frame, keys)
    writer = frame.write.mode(mode).option("partitionOverwriteMode", "static")
    if keys:
        writer = writer.partitionBy(*keys)
    if compression:
        writer = writer.option("compression", compression)
    with session_setting(frame.sparkSession, _MIN_PARTITION, min_partition_size):
        writer.parquet(path)


def rebalanced(frame: DataFrame, keys: list[str]) -> DataFrame:
    """Bring rows of a directory together (or just even out the files of an
    unpartitioned table), as far as sizes allow."""
    return frame.hint("rebalance", *[F.col(k) for k in keys])


def write_quarantine(rejects: DataFrame, path: str, reason: str | None = None) -> None:
    """Store rejected orders.

    With a reason, ``rejects`` are that reason's rows and go to
    ``path/<reason>``. Without one they carry ``reject_reason`` and all reasons
    are written in one pass, one directory each.
    """
    if reason is not None:
        write_parquet(rejects, f"{path}/{reason}")
    else:
        write_parquet(rejects, path, partition_by="reject_reason", rebalance=True)


def write_cancelled_orders(
    cancelled: DataFrame, path: str, min_partition_size: str | None = None
) -> None:
    """Store cancelled orders with their derived columns, by day."""
    write_parquet(
        cancelled, path, "order_date", rebalance=True, min_partition_size=min_partition_size
    )


def read_parquet(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Read a table with a fixed schema. Many directories are listed by one
    task per core instead of one task each."""
    cores = str(spark.sparkContext.defaultParallelism)
    with session_setting(spark, _LISTING, cores):
        return spark.read.schema(ddl).parquet(path)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Read back all reasons; the schema is fixed because directory names
    carry no types."""
    return read_parquet(spark, path, f"{S.ORDERS}, reject_reason string")
