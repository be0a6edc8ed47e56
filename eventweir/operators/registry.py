"""The registry ``(topic_name, pipeline_id, kind, event_types)`` and the allocation of its topics.

A NULL ``pipeline_id`` marks a topic that no pipeline serves yet.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventweir.operators.numbering import number_rows
from eventweir.plans.config import PAYLOAD_BASED, TOPIC_BASED
from eventweir.versions import committed, newest, save_version, update

REGISTRY_SCHEMA = (
    "topic_name string, pipeline_id string, kind string, event_types array<string>"
)


def new_registry(
    spark: SparkSession, single_type_topics: Iterable[str], mixed_topics: dict[str, Sequence[str]]
) -> DataFrame:
    """Unallocated rows: topics that hold one event type, and topics that hold several."""
    rows = [(topic, None, TOPIC_BASED, None) for topic in single_type_topics]
    rows += [(topic, None, PAYLOAD_BASED, list(types)) for topic, types in mixed_topics.items()]
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


def open_pipelines(registry: DataFrame, limit: int) -> DataFrame:
    """Pipelines with fewer than ``limit`` topics and their load."""
    return (
        registry.where(F.col("pipeline_id").isNotNull())
        .groupBy("pipeline_id")
        .agg(F.count("*").alias("load"))
        .where(F.col("load") < limit)
    )


def fullest_first(load: DataFrame) -> DataFrame:
    return load.orderBy(F.desc("load"), "pipeline_id")


def unallocated(registry: DataFrame) -> DataFrame:
    return registry.where(F.col("pipeline_id").isNull()).select(F.col("topic_name").alias("topic"))


def allocated(registry: DataFrame, distinct: bool = False) -> DataFrame:
    """The pipeline of every allocated topic; ``distinct`` lists each pipeline once."""
    ids = registry.where(F.col("pipeline_id").isNotNull()).select("pipeline_id")
    return ids.distinct() if distinct else ids


def topics_of(registry: DataFrame, pipeline_id: str) -> DataFrame:
    """The registry rows one pipeline serves, read at run time so that later additions count."""
    return registry.where(F.col("pipeline_id") == pipeline_id)


def allocate(registry: DataFrame, limit: int) -> DataFrame:
    """Deal unallocated topics to open pipelines, the rest to new groups of ``limit``.

    ``(topic_name, pipeline_id, new_group)`` with exactly one of the last two set.  Pipelines are
    dealt one topic per pass, the fullest first, until they hold ``limit``.  Free places numbered by
    (pass, load descending, pipeline) and topics numbered by name meet at equal numbers, so the
    dealing is one equi-join.  Only the passes needed are listed: there are never more places than
    topics and pipelines together, however far the pipelines are below the limit.
    """
    if limit < 1:
        raise ValueError("a pipeline must be allowed at least one topic")
    topics, n_topics = number_rows(
        unallocated(registry).select(F.col("topic").alias("topic_name")),
        [F.col("topic_name")],
        "_number",
    )
    free = open_pipelines(registry, limit).withColumn("_free", F.lit(limit) - F.col("load"))
    needed = F.least(F.col("_free"), _passes_needed(free, n_topics))
    places, n_places = number_rows(
        free.withColumn("_needed", needed)
        .where(F.col("_needed") > 0)
        .select(
            "pipeline_id", "load", F.explode(F.sequence(F.lit(1), F.col("_needed"))).alias("_pass")
        ),
        [F.col("_pass"), F.col("load").desc(), F.col("pipeline_id")],
        "_number",
    )
    group = F.floor((F.col("_number") - n_places - 1) / F.lit(limit)) + 1
    return topics.join(places.select("_number", "pipeline_id"), "_number", "left").select(
        "topic_name",
        "pipeline_id",
        F.when(F.col("pipeline_id").isNull(), group.cast("bigint")).alias("new_group"),
    )


def _passes_needed(free: DataFrame, n_topics: Column) -> Column:
    """How many passes deal ``n_topics``, from the pipelines per number of free places.

    Those with fewer free places than there are passes take all they can, the others one per pass.
    Splitting at any number of free places overstates what is dealt, except at the right one, so
    the largest of the answers is the right one.  There is one row per number of free places.
    """
    by_places = W.orderBy("_free")
    full = F.sum(F.col("_free") * F.col("_n")).over(
        by_places.rowsBetween(W.unboundedPreceding, -1)
    )
    dealing = F.sum("_n").over(by_places.rowsBetween(0, W.unboundedFollowing))
    passes = F.ceil((n_topics - F.coalesce(full, F.lit(0))) / dealing)
    per_places = free.groupBy("_free").agg(F.count("*").alias("_n"))
    return per_places.select(passes.alias("p")).agg(F.max("p").alias("p")).scalar()


def new_groups(allocation: DataFrame) -> DataFrame:
    """One row per pipeline to create: its topics, comma-joined.  At most ``limit`` names each."""
    return (
        allocation.where(F.col("new_group").isNotNull())
        .groupBy("new_group")
        .agg(
            F.array_join(F.sort_array(F.collect_list("topic_name")), ",").alias("topic_names"),
            F.count("*").alias("topics"),
        )
    )


def assignments(allocation: DataFrame, created: DataFrame | None = None) -> DataFrame:
    """``(topic_name, pipeline_id)`` of an allocation.

    ``created (new_group, pipeline_id)`` gives the ids of the pipelines made for the new groups;
    without it only topics dealt to existing pipelines are listed.
    """
    dealt = allocation.where(F.col("pipeline_id").isNotNull()).select("topic_name", "pipeline_id")
    if created is None:
        return dealt
    grouped = allocation.where(F.col("new_group").isNotNull()).select("topic_name", "new_group")
    return dealt.unionByName(grouped.join(created, "new_group").select("topic_name", "pipeline_id"))


def merge_assignments(registry: DataFrame, updates: DataFrame) -> DataFrame:
    """The registry with the pipelines of matched topics replaced.

    Topics that the registry lacks are ignored, nothing is deleted, and merging twice changes
    nothing more.  Repeated equal updates count once; contradicting ones fail the job.
    """
    agreed = updates.groupBy("topic_name").agg(
        F.min("pipeline_id").alias("_low"), F.max("pipeline_id").alias("_high")
    )
    contradiction = F.raise_error(
        F.concat(F.lit("two pipelines assigned to topic "), F.col("topic_name"))
    )
    once = agreed.select(
        "topic_name",
        F.when(F.col("_low") != F.col("_high"), contradiction)
        .otherwise(F.col("_low"))
        .alias("_new"),
        F.lit(True).alias("_matched"),
    )
    merged = registry.join(once, "topic_name", "left")
    return merged.select(
        *[
            F.when(F.col("_matched"), F.col("_new")).otherwise(F.col(c)).alias(c)
            if c == "pipeline_id"
            else F.col(c)
            for c in registry.columns
        ]
    )


def save_registry(registry: DataFrame, path: str, version: int) -> None:
    """Write one version of the registry, made from the one before.

    Refused where this or a newer version is committed, before or meanwhile: its writer has not seen
    it.
    """
    known = committed(registry.sparkSession, path)
    last = known[-1] if known else 0
    if last >= version or not save_version(registry, path, version):
        raise ValueError(f"{path} is at version {max(last, version)}, cannot save {version}")


def load_registry(spark: SparkSession, path: str) -> DataFrame:
    """The newest committed version; a write that did not finish is passed over."""
    version, rows = newest(spark, path, REGISTRY_SCHEMA)
    if rows is None:
        raise ValueError(f"no committed registry below {path}")
    return rows


def update_registry(
    spark: SparkSession, path: str, assign: Callable[[DataFrame], DataFrame]
) -> int:
    """One committed update of the saved registry; the version that holds it.

    ``assign`` makes ``(topic_name, pipeline_id)`` from the newest registry.  Where another writer
    commits first, it is asked again with that writer's version, so no update is lost and no topic
    is dealt twice.
    """

    def change(rows: DataFrame | None) -> DataFrame:
        if rows is None:
            raise ValueError(f"no committed registry below {path}")
        return merge_assignments(rows, assign(rows))

    return update(spark, path, REGISTRY_SCHEMA, change)
