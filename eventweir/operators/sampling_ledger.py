"""Sampling that goes on where the last one ended, topic by topic and partition by partition."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweir.operators.schema_tracking import fold_schemas
from eventweir.versions import newest, update

LEDGER_SCHEMA = "topic string, partition int, end_offset long"


def end_offsets(envelope: DataFrame) -> DataFrame:
    """``(topic, partition, end_offset)``: the offset behind the last message of each partition."""
    return envelope.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end_offset"))


def load_ledger(spark: SparkSession, path: str) -> DataFrame:
    """What has been read so far; no rows before the first sample."""
    _, rows = newest(spark, path, LEDGER_SCHEMA)
    return spark.createDataFrame([], LEDGER_SCHEMA) if rows is None else rows


def starting_offsets(ledger: DataFrame, fresh: dict[str, int] | None = None) -> str:
    """The ledger as Kafka's ``startingOffsets``; it holds a row per partition of the topics.

    Kafka wants every partition named: ``fresh`` gives the number of partitions of topics, those not
    in the ledger are read from the earliest offset (-2).
    """
    offsets: dict[str, dict[str, int]] = {
        topic: {str(p): -2 for p in range(n)} for topic, n in (fresh or {}).items()
    }
    for row in ledger.collect():
        offsets.setdefault(row.topic, {})[str(row.partition)] = row.end_offset
    return json.dumps(offsets, sort_keys=True)


def unread(envelope: DataFrame, ledger: DataFrame) -> DataFrame:
    """The messages behind the ledger's offsets, for sources that cannot be told where to start.

    The ledger has one row per partition; it is as small as a topic list and goes to all tasks if
    Spark finds it so.
    """
    known = ledger.select("topic", "partition", "end_offset")
    return (
        envelope.join(known, ["topic", "partition"], "left")
        .where(F.col("end_offset").isNull() | (F.col("offset") >= F.col("end_offset")))
        .select(*envelope.columns)
    )


def _further(ledger: DataFrame | None, ends: DataFrame) -> DataFrame:
    """Both ledgers' furthest offsets."""
    both = ends if ledger is None else ledger.unionByName(ends)
    return both.groupBy("topic", "partition").agg(F.max("end_offset").alias("end_offset"))


def sample_increment(envelope: DataFrame, schemas: str, ledger: str) -> int:
    """Fold the messages that came since the last sample into the tracked schemas.

    Schemas are folded first, then the ledger moves on: a run that dies in between folds the same
    messages once more, which changes nothing.  Two runs at once both count.  Returns the version of
    the schemas.
    """
    spark = envelope.sparkSession
    new = unread(envelope, load_ledger(spark, ledger))
    ends = end_offsets(new)
    version = fold_schemas(new, schemas)
    if not ends.isEmpty():
        update(spark, ledger, LEDGER_SCHEMA, lambda rows: _further(rows, ends))
    return version
