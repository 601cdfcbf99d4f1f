"""The order model as views of the retail tables (lineitem, orders, customer,
part, events).

Defects are set by arithmetic on the keys, so every engine sees the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Status spellings of the order lines, by number.
LINE_STATUSES = [
    "completed", "Completed", "COMPLETED", "Complete",
    "cancelled", "Cancelled", "canceled",
    " pending", "Pending", "PENDING ",
    "processing", "Done", "done",
]


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def _negated_if(value: Column, condition: Column) -> Column:
    return F.when(condition, -value).otherwise(value)


def _numbered(letter: str, key: Column) -> Column:
    return F.concat(F.lit(letter), key)


def orders_raw(spark: SparkSession, directory: str) -> DataFrame:
    """One raw order per order line, with repeats, missing ids and bad values."""
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    part, supplier = F.col("l_partkey"), F.col("l_suppkey")
    missing = (key * 7 + line) % 100 == 0
    seconds = (part * 37 + line * 6101 + key * 13) % 86400
    shipped = F.unix_micros(F.col("l_shipdate").cast("timestamp"))
    spelling = ((key + line) % len(LINE_STATUSES) + 1).cast("int")

    owners = table(spark, directory, "orders").select("o_orderkey", "o_custkey")
    # The supplier only sets a sign: the join need not carry it.
    lines = table(spark, directory, "lineitem").select(
        key,
        line,
        part,
        "l_shipdate",
        _negated_if(F.col("l_quantity").cast("int"), part % 20 == 3).alias("quantity"),
        _negated_if(F.col("l_extendedprice"), supplier % 20 == 7).alias("price"),
    )
    return lines.join(owners, key == F.col("o_orderkey"), "left").select(
        F.when(~missing, F.concat(F.lit("o"), key, F.lit("-"), line)).alias("order_id"),
        _numbered("c", F.col("o_custkey")).alias("customer_id"),
        _numbered("p", part).alias("product_id"),
        F.timestamp_micros(shipped + seconds * 1_000_000).alias("order_timestamp"),
        "quantity",
        "price",
        F.element_at(F.array(*[F.lit(s) for s in LINE_STATUSES]), spelling).alias("status"),
    )


def customers(spark: SparkSession, directory: str) -> DataFrame:
    """The table has no e-mail and no registration date; both are NULL."""
    return table(spark, directory, "customer").select(
        _numbered("c", F.col("c_custkey")).alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.lit(None).cast("string").alias("customer_email"),
        F.col("c_mktsegment").alias("customer_segment"),
        F.lit(None).cast("string").alias("registration_date"),
    )


def products(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "part").select(
        _numbered("p", F.col("p_partkey")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("list_price"),
    )


def _event_orders(events: DataFrame) -> DataFrame:
    event = F.col("event_id")
    kind = F.col("event_type")
    status = F.when(kind == "purchase", "Done").when(kind == "error", "canceled").otherwise(kind)
    quantity = (event % 10 + 1).cast("int")
    product = F.from_json("props", "k int")["k"]
    repeats = F.sequence(F.lit(1), F.when(event % 50 == 0, 2).otherwise(1))
    return events.withColumn("_copy", F.explode(repeats)).select(
        F.when(event % 101 != 0, _numbered("o", event)).alias("order_id"),
        _numbered("c", F.col("user_id")).alias("customer_id"),
        _numbered("p", product).alias("product_id"),
        F.col("ts").cast("timestamp").alias("order_timestamp"),
        _negated_if(quantity, event % 37 == 5).alias("quantity"),
        F.col("value").alias("price"),
        status.alias("status"),
    )


def event_orders(spark: SparkSession, directory: str) -> DataFrame:
    """One raw order per event, some of them twice."""
    return _event_orders(table(spark, directory, "events"))


def event_orders_stream(
    spark: SparkSession, directory: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The same orders as a stream. The pattern matches one file as well as a
    directory of files."""
    return _event_orders(_events_stream(spark, directory, max_files_per_trigger))


def _events_stream(
    spark: SparkSession, directory: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(table(spark, directory, "events").schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(f"{directory}/events.parquet*")


def event_records(spark: SparkSession, directory: str) -> DataFrame:
    """Events as records of a topic (see ``_event_records``)."""
    return _event_records(table(spark, directory, "events"))


def event_records_stream(spark: SparkSession, directory: str) -> DataFrame:
    """The same records as a stream."""
    return _event_records(_events_stream(spark, directory))


def _event_records(events: DataFrame) -> DataFrame:
    """Events as the JSON records a topic would hold, some of them broken.

    By event number: no JSON at all, nothing, blanks, text or a second record
    behind the first, no known field, a quantity that is no number, an
    unreadable time, or a missing id written as NaN.
    """
    event = F.col("event_id")
    quantity = F.when(event % 89 == 4, '"x"').otherwise((event % 10 + 1).cast("string"))
    at = F.when(event % 83 == 6, "garbage").otherwise(F.col("ts").cast("string"))
    order_id = F.when(event % 101 == 0, "NaN").otherwise(
        F.concat(F.lit('"o'), event, F.lit('"'))
    )
    product = F.from_json("props", "k int")["k"]
    json = F.concat(
        F.lit('{"order_id": '), order_id,
        F.lit(', "customer_id": "c'), F.col("user_id"),
        F.lit('", "product_id": "p'), product,
        F.lit('", "order_timestamp": "'), at,
        F.lit('", "quantity": '), quantity,
        F.lit(', "price": '), F.col("value"),
        F.lit(', "status": "'), F.col("event_type"), F.lit('"}'),
    )
    kind = event % 97
    payload = (
        F.when(kind == 3, "{bad")
        .when(kind == 13, F.lit(None))
        .when(kind == 23, "  ")
        .when(kind == 33, F.concat(json, F.lit(" trailing")))
        .when(kind == 43, F.concat(json, json))
        .when(kind == 53, "{}")
        .when(kind == 63, F.concat(F.lit('{"Order_ID": "o'), event, F.lit('"}')))
        .otherwise(json)
    )
    return events.select(
        event.alias("offset"), payload.cast("binary").alias("value")
    )
