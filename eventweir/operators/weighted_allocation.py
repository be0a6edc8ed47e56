"""Allocation of topics that weigh differently, as sets: no loop over topics or pipelines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventweir.operators.numbering import number_rows, running_totals
from eventweir.plans.config import PAYLOAD_BASED


def objects_of_topic() -> Column:
    """How many tables a registry row gives rise to: its own and one per listed event type."""
    types = F.when(F.col("kind") == PAYLOAD_BASED, F.array_size("event_types"))
    return F.lit(1) + F.coalesce(types, F.lit(0))


def allocate_weighted(
    registry: DataFrame, capacity: int, weight: Column | None = None
) -> DataFrame:
    """Deal unallocated topics to pipelines with room for their weight, the rest to new groups.

    ``(topic_name, weight, pipeline_id, new_group)`` with exactly one of the last two set.  Weights are
    whole numbers, below one counts as one; by default a topic weighs its objects.  No pipeline gets
    beyond ``capacity``, nor does a new group, but for a topic that alone weighs more: it is a group of
    its own.

    Topics, heaviest first, and the room of pipelines, most first, are laid out on one line; a topic goes
    to the pipeline whose room holds it whole.  Those that lie across an end, at most one a pipeline,
    are dealt to new groups with the topics that are left: of weights up to a half, a quarter, ...
    of the capacity two, four, ... make a group, so all groups of a class but its last are over half full.

    A cell of the line as long as the capacity meets no more pipelines or topics than that, which
    bounds the pairs that the join compares.
    """
    if capacity < 1:
        raise ValueError("a pipeline must have room for at least one object")
    weighed = registry.select(
        "topic_name",
        "pipeline_id",
        F.greatest(weight if weight is not None else objects_of_topic(), F.lit(1))
        .cast("bigint")
        .alias("weight"),
    )
    topics = running_totals(
        weighed.where(F.col("pipeline_id").isNull()).select("topic_name", "weight"),
        [F.col("weight").desc(), F.col("topic_name")],
        "weight",
        "_start",
    )
    room = (
        weighed.where(F.col("pipeline_id").isNotNull())
        .groupBy("pipeline_id")
        .agg((F.lit(capacity) - F.sum("weight")).alias("_room"))
        .where(F.col("_room") > 0)
    )
    room = running_totals(room, [F.col("_room").desc(), F.col("pipeline_id")], "_room", "_from")
    cells = room.withColumn("_to", F.col("_from") + F.col("_room")).withColumn(
        "_cell", F.explode(F.sequence(_cell("_from", capacity), _cell(F.col("_to") - 1, capacity)))
    )
    holds = (F.col("_start") >= F.col("_from")) & (F.col("_start") + F.col("weight") <= F.col("_to"))
    on_line = topics.withColumn("_cell", _cell("_start", capacity))
    dealt = on_line.alias("t").join(
        cells.alias("c"), (F.col("t._cell") == F.col("c._cell")) & holds, "left"
    )
    dealt = dealt.select("topic_name", "weight", "pipeline_id")
    placed = dealt.where(F.col("pipeline_id").isNotNull())
    grouped = _new_groups(dealt.where(F.col("pipeline_id").isNull()), capacity)
    return placed.withColumn("new_group", F.lit(None).cast("bigint")).unionByName(grouped)


def _cell(at: str | Column, width: int) -> Column:
    return F.floor((F.col(at) if isinstance(at, str) else at) / F.lit(width))


def _new_groups(rest: DataFrame, capacity: int) -> DataFrame:
    """Topics in groups by classes of weight; a class takes a power of two of them to a group."""
    fitting = F.greatest(F.floor(F.lit(capacity) / F.col("weight")), F.lit(1))
    order = [F.col("_class"), F.col("weight").desc(), F.col("topic_name")]
    classed = rest.withColumn("_class", F.length(F.bin(fitting)) - 1)
    numbered, _ = number_rows(classed, order, "_number")
    # a row per class, 63 at most
    per_class = numbered.groupBy("_class").agg(
        F.min("_number").alias("_first"), F.count("*").alias("_topics")
    )
    groups = F.ceil(F.col("_topics") / F.pow(F.lit(2), F.col("_class")))
    classes = running_totals(
        per_class.select("_class", "_first", groups.alias("_groups")),
        [F.col("_class")],
        "_groups",
        "_before",
    )
    place = F.floor((F.col("_number") - F.col("_first")) / F.pow(F.lit(2), F.col("_class")))
    return numbered.join(F.broadcast(classes), "_class").select(
        "topic_name", "weight", "pipeline_id", (F.col("_before") + place + 1).alias("new_group")
    )
