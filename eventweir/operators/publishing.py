"""Records as outgoing messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventweir.functions.envelope import ROUTE_METADATA, encode_rows
from eventweir.functions.labels import UNROUTED
from eventweir.operators.projections import row_columns
from eventweir.operators.routing import route

# Topic names of outgoing messages.
QUARANTINE_TOPIC = "quarantine_events"
SINK_PREFIX = "kafka_sink_"


def publish_route(
    labelled: DataFrame,
    event_type: str,
    json_options: dict[str, str] | None = None,
    metadata: tuple[str, ...] = ROUTE_METADATA,
) -> DataFrame:
    """The messages of one event type, for the topic named after the type.

    Messages are sent at least once; with ``POSITION_METADATA`` receivers can drop repeated ones.
    """
    rows = route(labelled, event_type, metadata=metadata)
    return encode_rows(rows, SINK_PREFIX + event_type, json_options)


def publish_routes(
    labelled: DataFrame,
    per_source_topic: bool = False,
    json_options: dict[str, str] | None = None,
    metadata: tuple[str, ...] = ROUTE_METADATA,
    prefix: str = "",
) -> DataFrame:
    """The messages of all routes in one pass, each row naming its outgoing topic.

    ``per_source_topic`` appends the source topic to the name, which keeps two topics with a
    common event type apart.
    """
    routed = labelled.where(F.col("route") != UNROUTED)
    target = F.concat(F.lit(SINK_PREFIX), F.col("route"))
    if per_source_topic:
        target = F.concat(target, F.lit("_"), F.col("topic"))
    row = row_columns(routed, metadata, prefix)
    rows = routed.select(*row, target.alias("_target"))
    return encode_rows(rows, F.col("_target"), json_options, columns=rows.columns[:-1])


def publish_quarantine(
    quarantined: DataFrame, json_options: dict[str, str] | None = None
) -> DataFrame:
    """Quarantined records as messages for the quarantine topic."""
    return encode_rows(quarantined, QUARANTINE_TOPIC, json_options=json_options)


def publish_rejects(rejects: DataFrame, json_options: dict[str, str] | None = None) -> DataFrame:
    """Records that are in no valid table as messages for the quarantine topic, reason included."""
    return encode_rows(rejects, QUARANTINE_TOPIC, json_options=json_options)


def fan_out(
    events: DataFrame,
    combined_topic: str,
    type_field: str = "eventType",
    key: Column | None = None,
    json_options: dict[str, str] | None = None,
) -> DataFrame:
    """Every event as two messages: to the combined topic and to the topic named by its type.

    An event without a type goes to the combined topic only.  Messages have no key unless one is
    given.
    """
    targets = F.array_compact(F.array(F.lit(combined_topic), F.col(type_field)))
    # One text per event goes into the explode, not the event's columns: encoding above it would
    # run once for each message.
    encoded = events.select(
        targets.alias("_targets"),
        (key if key is not None else F.lit(None)).cast("string").alias("key"),
        F.to_json(F.struct("*"), json_options).alias("value"),
    )
    return encoded.select(F.explode("_targets").alias("topic"), "key", "value")
