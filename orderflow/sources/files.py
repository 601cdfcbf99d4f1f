"""Order and dimension files, static and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow import schema as S

# White space belongs to the value until statuses are normalised.
CSV_OPTIONS = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_orders_csv(spark: SparkSession, directory: str) -> DataFrame:
    """All ``*.csv`` files of a directory. Fields that do not parse are NULL."""
    reader = spark.read.schema(S.ORDERS).options(**CSV_OPTIONS)
    return reader.option("pathGlobFilter", "*.csv").csv(directory)


def read_dimension_csv(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    return spark.read.schema(ddl).options(**CSV_OPTIONS).csv(path)


def read_customers_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_dimension_csv(spark, path, S.CUSTOMERS)


def read_products_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_dimension_csv(spark, path, S.PRODUCTS)


def stream_orders_csv(
    spark: SparkSession, directory: str, max_files_per_trigger: int | None = 2
) -> DataFrame:
    """New CSV files of a directory, a few per micro-batch; None means all."""
    reader = spark.readStream.schema(S.ORDERS).options(**CSV_OPTIONS)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(directory)


def write_csv(
    frame: DataFrame, path: str, rows_per_file: int = 0, options: dict[str, str] | None = None
) -> None:
    """Write CSV with a header, with at most ``rows_per_file`` rows a file if set;
    ``options`` are further options of the writer.

    Times are written as text like ``2026-01-01 10:00:00``, with a fraction only
    where there is one; the writer's own format would cut them to milliseconds."""
    times = {n: F.col(n).cast("string") for n, t in frame.dtypes if t == "timestamp"}
    text = frame.withColumns(times) if times else frame
    writer = text.write.mode("overwrite").options(**CSV_OPTIONS, **(options or {}))
    writer.option("maxRecordsPerFile", rows_per_file).csv(path)
