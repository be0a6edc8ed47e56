"""Parquet folders as envelopes or tables, batch and streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventweir.functions.envelope import ENVELOPE_SCHEMA


def read_files(spark: SparkSession, path: str, schema: StructType = ENVELOPE_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def stream_files(
    spark: SparkSession,
    path: str,
    schema: StructType = ENVELOPE_SCHEMA,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Files under ``path`` (folder or glob) as a stream.

    ``max_files`` or ``max_bytes`` bound a micro-batch; an available-now run then takes several.
    """
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(path)


def topic_reader(table: DataFrame) -> Callable[[str], DataFrame]:
    """Read one topic of a table of envelopes.

    Meant for a table written partitioned by ``topic``: each topic then is read by itself, as a
    subscription to one Kafka topic would.
    """
    return lambda topic: table.where(F.col("topic") == topic)


def stream_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table as a stream."""
    return spark.readStream.table(name)
