"""Receivers of messages that are sent at least once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: what tells a message apart from its repeats.
POSITION = ("topic", "partition", "offset")


def deduplicated(
    messages: DataFrame, delay: str, time: str = "eventTime", position: tuple[str, ...] = POSITION
) -> DataFrame:
    """Each source position once, on a stream as on a table.

    On a stream, repeats are recognised that come up to ``delay`` in event time behind their first
    copy.  Positions older than that are forgotten, which bounds the state: it holds the positions of
    one delay, spread over all tasks by position, whatever the length of the stream.  Records that
    are later than the delay themselves are dropped, as their first copy may be forgotten already;
    choose it longer than a sender may take to try again and than records may be out of order.
    """
    if not messages.isStreaming:
        return messages.dropDuplicates(list(position))
    kind = dict(messages.dtypes)[time]
    if kind != "timestamp":
        raise ValueError(f"{time} is {kind}, a watermark needs timestamp")
    return messages.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(position))


def published_positions(messages: DataFrame, time: str = "eventTime") -> DataFrame:
    """Received messages with the position and time that their JSON carries."""
    fields = F.from_json(
        "value", f"topic string, partition int, offset bigint, {time} timestamp"
    )
    return messages.select("*", fields.alias("_position")).select(
        F.col("_position.topic").alias("topic"),
        "_position.partition",
        "_position.offset",
        f"_position.{time}",
        "key",
        "value",
    )
