"""Flows that follow the registry while they run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventweir.plans.config import PAYLOAD_BASED

START, STOP, KEEP = "start", "stop", "keep"

FLOW_SCHEMA = "pipeline_id string, flow string, topic string"


def flow_name(kind: Column, topic: Column) -> Column:
    """The name of a topic's flow: that of the table it fills."""
    prefix = F.when(kind == PAYLOAD_BASED, F.lit("bronze_")).otherwise(F.lit("silver_"))
    return F.concat(prefix, topic)


def requested_flows(registry: DataFrame) -> DataFrame:
    """``(pipeline_id, flow, topic)``: one flow for every topic that the registry allocates."""
    return registry.where(F.col("pipeline_id").isNotNull()).select(
        "pipeline_id",
        flow_name(F.col("kind"), F.col("topic_name")).alias("flow"),
        F.col("topic_name").alias("topic"),
    )


def active_flows(spark: SparkSession, pipeline_id: str) -> DataFrame:
    """The flows of this session, which runs one pipeline; other queries are passed over."""
    names = [q.name for q in spark.streams.active if q.name]
    rows = [
        (pipeline_id, name, name.split("_", 1)[1])
        for name in names
        if name.startswith(("bronze_", "silver_"))
    ]
    return spark.createDataFrame(rows, FLOW_SCHEMA)


def flow_changes(requested: DataFrame, active: DataFrame) -> DataFrame:
    """``(pipeline_id, flow, topic, action)``: start what is asked for and not active, stop the rest.

    A flow that is asked for and active is kept, so that a new topic touches no other.
    """
    asked = requested.withColumn("_asked", F.lit(True)).distinct()
    running = active.select("pipeline_id", "flow", F.col("topic").alias("_topic")).distinct()
    running = running.withColumn("_active", F.lit(True))
    action = (
        F.when(F.col("_active").isNull(), START).when(F.col("_asked").isNull(), STOP).otherwise(KEEP)
    )
    return asked.join(running, ["pipeline_id", "flow"], "full_outer").select(
        "pipeline_id", "flow", F.coalesce("topic", "_topic").alias("topic"), action.alias("action")
    )


def apply_changes(
    spark: SparkSession, changes: DataFrame, start: Callable[[str], StreamingQuery]
) -> dict[str, str]:
    """Stop and start the flows of this session's pipeline; by flow what came of it.

    ``start(topic)`` starts a topic's flow, looking up its configuration by then.  One that fails
    leaves the others as they are; its error is in the result and it is tried again next time.
    """
    running = {q.name: q for q in spark.streams.active if q.name}
    came = {}
    for row in changes.where(F.col("action") != KEEP).orderBy("action", "flow").collect():
        try:
            if row.action == START:
                start(row.topic)
            elif row.flow in running:
                running[row.flow].stop()
            came[row.flow] = row.action
        except Exception as e:  # noqa: BLE001 - whatever is wrong with one flow
            came[row.flow] = f"failed to {row.action}: {e}"
    return came


def follow_registry(
    spark: SparkSession,
    registry: DataFrame,
    pipeline_id: str,
    start: Callable[[str], StreamingQuery],
) -> dict[str, str]:
    """Bring the flows of this session to what the registry now gives to its pipeline."""
    own = requested_flows(registry.where(F.col("pipeline_id") == pipeline_id))
    return apply_changes(spark, flow_changes(own, active_flows(spark, pipeline_id)), start)
