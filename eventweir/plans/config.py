"""The topic configuration: kind, schema and event types per topic."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweir.functions.decoding import payload_schema

# The two kinds of topic.
TOPIC_BASED = "topic_based"
PAYLOAD_BASED = "payload_based"

CONFIG_SCHEMA = "topic string, kind string, schema_ddl string, event_types array<string>"


@dataclass(frozen=True)
class TopicConfig:
    topic: str
    kind: str
    schema_ddl: str
    event_types: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.kind not in (TOPIC_BASED, PAYLOAD_BASED):
            raise ValueError(f"unknown kind {self.kind} for topic {self.topic}")
        if self.kind == PAYLOAD_BASED and not self.event_types:
            raise ValueError(f"topic {self.topic} needs its event types")


def config_frame(spark: SparkSession, configs: Iterable[TopicConfig]) -> DataFrame:
    rows = [(c.topic, c.kind, c.schema_ddl, list(c.event_types) or None) for c in configs]
    return spark.createDataFrame(rows, CONFIG_SCHEMA)


def save_config(config: DataFrame, path: str) -> None:
    columns = ("topic", "kind", "schema_ddl", "event_types")
    config.select(*columns).write.mode("overwrite").parquet(path)


def load_config(spark: SparkSession, path: str, topics: Sequence[str]) -> list[TopicConfig]:
    """The configuration of the named topics."""
    stored = spark.read.schema(CONFIG_SCHEMA).parquet(path)
    return _to_driver(stored.where(F.col("topic").isin(list(topics))))


def pipeline_config(config: DataFrame, registry: DataFrame, pipeline_id: str) -> list[TopicConfig]:
    """The configuration of the topics that the registry gives to one pipeline.

    Looked up when the pipeline starts, so topics allocated to it since then are included.
    """
    served = registry.where(F.col("pipeline_id") == pipeline_id).select(
        F.col("topic_name").alias("topic")
    )
    return _to_driver(config.join(served, "topic", "left_semi"))


def topics_without_config(config: DataFrame, registry: DataFrame) -> DataFrame:
    """``(topic, pipeline_id)`` of allocated topics that have no configuration.

    ``pipeline_config`` cannot serve them: they had no message when schemas were sampled.
    """
    served = registry.where(F.col("pipeline_id").isNotNull()).select(
        F.col("topic_name").alias("topic"), "pipeline_id"
    )
    return served.join(config, "topic", "left_anti")


def _to_driver(config: DataFrame) -> list[TopicConfig]:
    """The few rows of one pipeline: a decoder's schema is part of the query plan."""
    return [
        TopicConfig(r.topic, r.kind, r.schema_ddl, tuple(r.event_types or ()))
        for r in config.orderBy("topic").collect()
    ]


def of_kind(configs: Iterable[TopicConfig], kind: str) -> list[TopicConfig]:
    return [c for c in configs if c.kind == kind]


# The keys of the mapping file, topic -> {type, schemahint, event_type}.
def from_mapping(mapping: Mapping[str, Mapping]) -> list[TopicConfig]:
    """The configuration from a parsed mapping file."""
    return [
        TopicConfig(topic, info["type"], info["schemahint"], tuple(info.get("event_type") or ()))
        for topic, info in mapping.items()
    ]


def to_mapping(configs: Iterable[TopicConfig]) -> dict[str, dict]:
    """The configuration as it goes into a mapping file; names that need it are quoted."""
    mapping = {}
    for config in configs:
        info = {"type": config.kind, "schemahint": payload_schema(config.schema_ddl).toDDL()}
        if config.event_types:
            info["event_type"] = list(config.event_types)
        mapping[config.topic] = info
    return mapping
