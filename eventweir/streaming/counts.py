"""Counts of the records of a stream, per micro-batch and outcome, taken while they are written."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventweir.functions.labels import FAULTY, PARTIAL, UNDETERMINED, UNROUTED, VALID
from eventweir.streaming.sinks import finished_batches, replace_batch

OUTCOMES = (VALID, FAULTY, UNDETERMINED, PARTIAL, UNROUTED)
_ALL = "_all"
COUNTS_SCHEMA = "outcome string, records long"


def write_counted(
    batch: DataFrame,
    path: str,
    counts: str,
    app_id: str,
    batch_id: int,
    partition_by: Sequence[str] = (),
) -> None:
    """``replace_batch``, and what was written counted by outcome in the same pass.

    The counts own a folder like the batch's, so a replay replaces them: each batch counts once.
    Records with a label outside ``OUTCOMES`` would be in the total alone; such a batch is refused.
    """
    spark = batch.sparkSession
    seen = Observation(f"counts_{app_id}_{batch_id}")
    metrics = [F.count_if(F.col("outcome") == name).alias(name) for name in OUTCOMES]
    observed = batch.observe(seen, F.count("*").alias(_ALL), *metrics)
    replace_batch(observed, path, app_id, batch_id, partition_by)
    found = dict(seen.get)
    total = found.pop(_ALL)
    if total != sum(found.values()):
        raise ValueError(f"batch {batch_id} of {app_id} holds records without an outcome")
    rows = spark.createDataFrame(sorted(found.items()), COUNTS_SCHEMA).coalesce(1)
    replace_batch(rows, counts, app_id, batch_id)


def batch_counts(spark: SparkSession, counts: str) -> DataFrame:
    """``(app_id, batch_id, outcome, records)`` of all finished micro-batches."""
    full = f"{COUNTS_SCHEMA}, app_id string, batch_id long"
    folders = finished_batches(spark, counts)
    if folders:
        table = spark.read.schema(full).option("basePath", counts).parquet(*folders)
    else:
        table = spark.createDataFrame([], full)
    return table.select("app_id", "batch_id", "outcome", "records")
