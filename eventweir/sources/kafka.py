"""Kafka topics as envelopes.  Needs the Kafka connector on Spark's class path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def topic_options(
    servers: str,
    topics: Sequence[str],
    starting: str = "earliest",
    ending: str | None = None,
    **extra: object,
) -> dict[str, str]:
    """Reader options for one or several topics; ``ending`` is for batch reads.

    Pass ``minPartitions`` or ``maxRecordsPerPartition`` to have a hot Kafka partition read by
    several tasks, ``maxOffsetsPerTrigger`` to bound a micro-batch.
    """
    if not topics:
        raise ValueError("name at least one topic")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
    }
    if ending is not None:
        options["endingOffsets"] = ending
    options.update({name: str(value) for name, value in extra.items()})
    return options


def read_topics(spark: SparkSession, servers: str, topics: Sequence[str], **extra) -> DataFrame:
    """All messages from earliest to latest, as a bounded DataFrame."""
    options = topic_options(servers, topics, ending="latest", **extra)
    return spark.read.format("kafka").options(**options).load()


def stream_topics(spark: SparkSession, servers: str, topics: Sequence[str], **extra) -> DataFrame:
    options = topic_options(servers, topics, **extra)
    return spark.readStream.format("kafka").options(**options).load()
