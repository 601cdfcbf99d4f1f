"""Orders as JSON records of a Kafka topic.

The source and the sink need Spark's Kafka connector on the cluster
(``connector_package`` names the matching artifact). Encoding and decoding are
plain column functions and work on any frame with a ``value`` column.
"""

from __future__ import annotations

import pyspark
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow import schema as S

# What a JSON writer without a NULL for numbers leaves in a text field.
_NAN_TEXT = '"NaN"'


def connector_package(scala: str = "2.13") -> str:
    """Maven coordinate of the connector for the Spark that is running."""
    return f"org.apache.spark:spark-sql-kafka-0-10_{scala}:{pyspark.__version__}"


def source_options(
    servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = False,
    group_id: str | None = None,
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if group_id:
        options["kafka.group.id"] = group_id
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def stream_records(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Raw records of a topic."""
    return spark.readStream.format("kafka").options(**source_options(servers, topic, **options)).load()


def stream_orders_kafka(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    return decode_orders(stream_records(spark, servers, topic, **options))


def _parsed(records: DataFrame, *keep: str) -> DataFrame:
    """Add ``payload`` text and the parsed ``order`` struct."""
    ddl = f"{S.ORDERS_JSON}, _corrupt string"
    with_text = records.select(*keep, F.col("value").cast("string").alias("payload"))
    order = F.from_json("payload", ddl, {"columnNameOfCorruptRecord": "_corrupt"})
    return with_text.withColumn("order", order)


def decode_orders(records: DataFrame) -> DataFrame:
    """Records to order rows.

    Text that is not JSON gives a row of NULLs, a field of the wrong type or
    an unreadable time gives NULL in that column; nothing stops the query.
    """
    rows = _parsed(records).select("order.*").drop("_corrupt")
    return rows.withColumns(
        {
            "order_id": F.nullif("order_id", F.lit(_NAN_TEXT)),
            "order_timestamp": F.col("order_timestamp").try_cast("timestamp"),
        }
    )


def dead_letters(records: DataFrame, *keep: str) -> DataFrame:
    """Records that lose content in decoding, with the payload and a reason:
    empty, malformed_json, trailing_content (text behind the first object),
    no_known_field or bad_timestamp, the first that holds."""
    payload, at = F.col("payload"), F.col("order.order_timestamp")
    # One object and nothing else makes a list of one.
    listed = F.from_json(
        F.concat(F.lit("["), payload, F.lit("]")), f"array<struct<{_fields(S.ORDERS_JSON)}>>"
    )
    known = F.array(*map(F.lit, S.column_names(S.ORDERS_JSON)))
    keys = F.map_keys(F.from_json(payload, "map<string,string>"))
    fields = F.coalesce(F.size(F.array_intersect(keys, known)), F.lit(0))
    reason = (
        F.when(payload.isNull() | (F.trim(payload) == ""), "empty")
        .when(F.col("order._corrupt").isNotNull(), "malformed_json")
        .when(F.coalesce(F.size(listed), F.lit(-1)) != 1, "trailing_content")
        .when(fields < 1, "no_known_field")
        .when(at.isNotNull() & at.try_cast("timestamp").isNull(), "bad_timestamp")
    )
    tagged = _parsed(records, *keep).select(*keep, "payload", reason.alias("reason"))
    return tagged.filter(F.col("reason").isNotNull())


def _fields(ddl: str) -> str:
    return ", ".join(":".join(field.split()) for field in ddl.split(","))


def encode_orders(orders: DataFrame, key: str | None = None) -> DataFrame:
    """Order rows to records with a JSON ``value`` (and ``key``, if named).

    Without a key Kafka balances its partitions even if one id dominates.
    """
    fields = [
        F.col(c).cast("string").alias(c) if c == "order_timestamp" else F.col(c)
        for c in S.column_names(S.ORDERS)
    ]
    value = F.to_json(F.struct(*fields)).cast("binary").alias("value")
    return orders.select(*([F.col(key).cast("binary").alias("key")] if key else []), value)


def write_orders_kafka(orders: DataFrame, servers: str, topic: str, key: str | None = None) -> None:
    writer = encode_orders(orders, key).write.format("kafka")
    writer.option("kafka.bootstrap.servers", servers).option("topic", topic).save()
