"""Every table and outgoing topic that a registry gives rise to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventweir.operators.publishing import SINK_PREFIX
from eventweir.plans.config import PAYLOAD_BASED, TOPIC_BASED


def _target(use_case: str, *name: Column | str) -> Column:
    parts = [F.lit(p) if isinstance(p, str) else p for p in name]
    return F.struct(F.lit(use_case).alias("use_case"), F.concat(*parts).alias("object_name"))


def target_plan(registry: DataFrame, sinks_per_topic: bool = False) -> DataFrame:
    """``(topic_name, use_case, object_name)``: 1 row per single-type topic, 2 + 3 per event type
    for a mixed one, from one pass over the registry.

    Outgoing topics are named by event type alone, so two mixed topics with a common type share
    one; ``sinks_per_topic`` appends the topic to the name.
    """
    topic = F.col("topic_name")
    # The name patterns of the generated objects.
    single = F.array(_target("topic_table", "silver_", topic))
    bronze = F.array(
        _target("payload_bronze", "bronze_", topic),
        _target("quarantine_bronze", "bronze_feb_", topic),
    )

    def per_type(event_type: Column) -> Column:
        sink = (SINK_PREFIX, event_type) + (("_", topic) if sinks_per_topic else ())
        return F.array(
            _target("payload_table", "silver_", event_type, "_", topic),
            _target("quarantine_table", "silver_feb_", event_type, "_", topic),
            _target("outgoing_topic", *sink),
        )

    types = F.coalesce("event_types", F.array().cast("array<string>"))
    mixed = F.concat(bronze, F.flatten(F.transform(types, per_type)))
    unknown = F.raise_error(
        F.concat_ws(" ", F.lit("topic"), topic, F.lit("has no known kind:"), F.col("kind"))
    )
    targets = (
        F.when(F.col("kind") == TOPIC_BASED, single)
        .when(F.col("kind") == PAYLOAD_BASED, mixed)
        .otherwise(unknown.cast(registry.select(single).schema[0].dataType))
    )
    return registry.select("topic_name", F.explode(targets).alias("t")).select("topic_name", "t.*")


def target_collisions(plan: DataFrame) -> DataFrame:
    """``(object_kind, object_name, topics)``: names that more than one topic would create.

    Tables of all use cases share one name space, in which case makes no difference; outgoing topics
    have their own and tell case apart.
    """
    outgoing = F.col("use_case") == "outgoing_topic"
    named = plan.select(
        "topic_name",
        F.when(outgoing, "outgoing_topic").otherwise("table").alias("object_kind"),
        F.when(outgoing, F.col("object_name"))
        .otherwise(F.lower("object_name"))
        .alias("object_name"),
    )
    return (
        named.distinct()
        .groupBy("object_kind", "object_name")
        .agg(F.count("*").alias("topics"))
        .where(F.col("topics") > 1)
    )
