"""The four compositions: tables per topic, tables per event type, quarantine, outgoing topics.

All take and give DataFrames, so the same calls serve batch and streaming input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame

from eventweir.operators.projections import payload_bronze, topic_table
from eventweir.operators.publishing import publish_quarantine, publish_routes
from eventweir.operators.routing import label, quarantined, route, valid
from eventweir.plans.config import PAYLOAD_BASED, TOPIC_BASED, TopicConfig, of_kind


def split_by_topic(
    read_topic: Callable[[str], DataFrame], configs: Iterable[TopicConfig], **options
) -> dict[str, DataFrame]:
    """One decoded table per single-type topic, by table name.

    ``read_topic`` gives the envelopes of one topic, so each topic is read once and none is
    filtered out of another's data.
    """
    return {
        f"silver_{c.topic}": topic_table(read_topic(c.topic), c.schema_ddl, **options)
        for c in of_kind(configs, TOPIC_BASED)
    }


def labelled_bronze(envelope: DataFrame, config: TopicConfig, **options) -> DataFrame:
    """Bronze of one mixed topic, ready to be written partitioned by its labels."""
    if config.kind != PAYLOAD_BASED:
        raise ValueError(f"topic {config.topic} holds a single event type")
    return label(payload_bronze(envelope, config.schema_ddl, **options), config.event_types)


def split_by_payload(
    labelled: DataFrame, config: TopicConfig, **options
) -> dict[str, DataFrame]:
    """One table per event type of a mixed topic, by table name."""
    return {f"silver_{t}_{config.topic}": route(labelled, t, **options) for t in config.event_types}


def split_valid(labelled: DataFrame, config: TopicConfig, **options) -> dict[str, DataFrame]:
    """The valid rows of each event type of a mixed topic, by table name."""
    return {
        f"silver_feb_{t}_{config.topic}": valid(labelled, t, **options) for t in config.event_types
    }


def split_valid_faulty(
    labelled: DataFrame, policy: str = "quarantine_undetermined", json_options=None
) -> tuple[DataFrame, DataFrame]:
    """The valid rows as a table and the quarantined ones as messages."""
    return valid(labelled), publish_quarantine(quarantined(labelled, policy), json_options)


def publish(labelled: DataFrame, per_source_topic: bool = False, json_options=None) -> DataFrame:
    """All routed records as messages for the outgoing topic of their type."""
    return publish_routes(labelled, per_source_topic, json_options)
