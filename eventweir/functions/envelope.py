"""The message envelope: the columns of Spark's Kafka source, and messages to send."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

# The record columns carried next to the payload, in output order.
TABLE_METADATA = ("key", "topic", "partition", "offset", "eventTime", "timestampType")
ROUTE_METADATA = ("key", "topic", "eventTime")

# With the position in the source, by which receivers of repeated messages can tell them.
POSITION_METADATA = ("key", "topic", "partition", "offset", "eventTime")

# ``to_json`` cuts timestamps to milliseconds unless it is given a format.
MICROSECOND_JSON = {
    "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
}


def payload_text(value: str | Column = "value") -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def metadata_columns(names: tuple[str, ...] = TABLE_METADATA) -> list[Column]:
    """Record columns of an envelope, the record time under its output name."""
    return [F.col("timestamp").alias("eventTime") if n == "eventTime" else F.col(n) for n in names]


def encode_rows(
    df: DataFrame,
    topic: str | Column | None = None,
    json_options: dict[str, str] | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Rows as messages: ``key`` text and ``value``, the JSON of the whole row (or of ``columns``).

    As ``to_json`` does, NULL fields are left out and a binary key becomes base64 inside the JSON.
    A ``topic`` column makes the Kafka sink send every row to the topic it names.
    """
    row = F.struct(*[F.col(f"`{name}`") for name in columns or df.columns])
    key = F.col("key").cast("string").alias("key")
    message = [key, F.to_json(row, json_options).alias("value")]
    if topic is not None:
        message.insert(0, (F.lit(topic) if isinstance(topic, str) else topic).alias("topic"))
    return df.select(*message)
