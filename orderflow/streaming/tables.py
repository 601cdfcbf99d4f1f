"""Tables that a stream appends to, through Spark's own file sink.

The sink keeps a compacted log of the files of each committed batch beside the data.
A batch that repeats adds nothing, and a reader takes the files from the log: no
directory is listed and no marker looked up, however many batches there were. A stream
may read such a table too, each row once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.schema import column_names
from orderflow.sinks.commits import exists, make_folder

LOG = "_spark_metadata"


def default_writers(spark: SparkSession) -> int:
    """One task in four writes a batch, but eight at least."""
    return max(8, spark.sparkContext.defaultParallelism // 4)


def dealt(frame: DataFrame, writers: int, by: str | None = None) -> DataFrame:
    """Rows dealt to ``writers`` tasks by their values, or by one column.

    A batch has as many partitions as its scan or its state; dealt out, it leaves at
    most ``writers`` files per directory, and one directory's rows are still written by
    all tasks. With ``by``, the rows of a value go to one file. Merging partitions
    instead would run the state operators in as few tasks, and adaptive execution is
    off in a stateful query.
    """
    key = F.col(by) if by else F.xxhash64(*frame.columns)
    return frame.repartition(writers, key)


def read_table(spark: SparkSession, path: str, ddl: str, partition_by: str | None = None) -> DataFrame:
    """All committed rows; none before the first batch.

    ``partition_by`` is the column definition of the directories; it may be in ``ddl``
    or not. Filters on it prune directories.
    """
    columns = column_names(ddl)
    extra = [partition_by] if partition_by and partition_by.split()[0] not in columns else []
    schema = ", ".join([ddl, *extra])
    if not exists(spark, f"{path}/{LOG}"):
        return spark.createDataFrame([], schema).select(*columns)
    return spark.read.schema(schema).parquet(path).select(*columns)


def stream_table(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """The table as a stream, also before its first batch."""
    make_folder(spark, path)
    return spark.readStream.schema(ddl).parquet(path)
