"""Streams attached to sinks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from eventweir.functions.envelope import ROUTE_METADATA
from eventweir.operators.publishing import publish_quarantine, publish_rejects, publish_routes
from eventweir.operators.routing import LABELS, QUARANTINE_POLICIES, quarantined, rejects
from eventweir.operators.schema_tracking import fold_schemas
from eventweir.plans.config import PAYLOAD_BASED, TopicConfig, of_kind
from eventweir.plans.use_cases import labelled_bronze, split_by_topic
from eventweir.streaming.counts import write_counted
from eventweir.streaming.evolving import keep_schema
from eventweir.streaming.sinks import (
    BatchWriter,
    batch_path,
    batch_sink,
    catalog_sink,
    kafka_sink,
    replace_batch,
    table_sink,
)
from eventweir.workspace import read_written


def topic_flows(
    read_topic, configs: Iterable[TopicConfig], root: str | None, checkpoints: str, trigger=None
) -> list[StreamingQuery]:
    """One stream per single-type topic into its table ``root/silver_{topic}``.

    Without a ``root`` into the catalog table ``silver_{topic}``, which grows by the columns that a
    restart's configuration has more.
    """
    tables = split_by_topic(read_topic, configs)
    if root is None:
        return [
            catalog_sink(df, name, f"{checkpoints}/{name}", name=name, trigger=trigger)
            for name, df in tables.items()
        ]
    return [
        table_sink(df, f"{root}/{name}", f"{checkpoints}/{name}", name=name, trigger=trigger)
        for name, df in tables.items()
    ]


def bronze_flows(
    read_topic, configs: Iterable[TopicConfig], root: str | None, checkpoints: str, trigger=None
) -> list[StreamingQuery]:
    """One stream per mixed topic into ``root/bronze_{topic}``, partitioned by its labels.

    Without a ``root`` into the catalog table ``bronze_{topic}``, over which ``create_views`` makes
    the tables per event type.  Routes, valid rows and quarantine are read from that one table; the
    topic is consumed and decoded once.
    """
    started = []
    for config in of_kind(configs, PAYLOAD_BASED):
        name = f"bronze_{config.topic}"
        labelled = labelled_bronze(read_topic(config.topic), config)
        options = {"partition_by": LABELS, "name": name, "trigger": trigger}
        checkpoint = f"{checkpoints}/{name}"
        if root is None:
            comment = f"Events of topic {config.topic} by route and outcome"
            query = catalog_sink(labelled, name, checkpoint, comment=comment, **options)
        else:
            query = table_sink(labelled, f"{root}/{name}", checkpoint, **options)
        started.append(query)
    return started


MessagesOf = Callable[[DataFrame], DataFrame]


def payload_flow(
    labelled: DataFrame,
    path: str,
    checkpoint: str,
    app_id: str,
    outputs: Sequence[tuple[MessagesOf, BatchWriter]] = (),
    trigger=None,
    counts: str | None = None,
) -> StreamingQuery:
    """A labelled stream into one idempotent table, and messages made from it.

    Each micro-batch is decoded and written once, whatever the number of outputs.  Messages are
    read back from the few partitions of the written batch that hold them, so nothing is cached and
    losing executors between the writes repeats none of them.

    The schema is merged into the one kept beside the table before the stream starts: a restart may
    bring further payload fields, one that changes a field's type is refused.

    With a folder for ``counts`` the records of each micro-batch are counted by outcome while they
    are written, see ``batch_counts``.
    """
    keep_schema(labelled.sparkSession, path, labelled.schema)

    def process(batch: DataFrame, batch_id: int) -> None:
        if counts is None:
            replace_batch(batch, path, app_id, batch_id, LABELS)
        else:
            write_counted(batch, path, counts, app_id, batch_id, LABELS)
        for messages_of, send in outputs:
            send(messages_of(written_batch(batch, path, app_id, batch_id)), batch_id)

    return batch_sink(labelled, process, checkpoint, f"flow_{app_id}", trigger)


def quarantine_output(
    send: BatchWriter,
    policy: str = "quarantine_undetermined",
    json_options: dict[str, str] | None = None,
    metadata: tuple[str, ...] = ROUTE_METADATA,
) -> tuple[MessagesOf, BatchWriter]:
    """Quarantined records to ``send``; the valid ones are a partition of the table."""
    if policy not in QUARANTINE_POLICIES:
        raise ValueError(f"unknown policy {policy}")

    def messages(table: DataFrame) -> DataFrame:
        return publish_quarantine(quarantined(table, policy, metadata=metadata), json_options)

    return messages, send


def rejects_output(
    send: BatchWriter, json_options: dict[str, str] | None = None
) -> tuple[MessagesOf, BatchWriter]:
    """Everything that is in no valid table to ``send``, with its reason and original text."""
    return lambda table: publish_rejects(rejects(table), json_options), send


def publish_output(
    send: BatchWriter,
    per_source_topic: bool = False,
    json_options: dict[str, str] | None = None,
    metadata: tuple[str, ...] = ROUTE_METADATA,
) -> tuple[MessagesOf, BatchWriter]:
    """Records of all routes to ``send``, each for the outgoing topic of its type."""
    return lambda table: publish_routes(table, per_source_topic, json_options, metadata), send


def written_batch(batch: DataFrame, path: str, app_id: str, batch_id: int) -> DataFrame:
    return read_written(batch.sparkSession, batch_path(path, app_id, batch_id), batch.schema)


def tracking_flow(
    stream: DataFrame, path: str, checkpoint: str, name: str, trigger=None
) -> StreamingQuery:
    """Fold every micro-batch of envelopes into the schemas kept at ``path``.

    Folding a replayed batch changes nothing.  A schema that has grown is taken up by the flows that
    decode with it when they are started again.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        fold_schemas(batch, path)

    return batch_sink(stream, process, checkpoint, f"track_{name}", trigger)


def kafka_flow(labelled_table: DataFrame, topic: str, servers: str, checkpoint: str, **options):
    """Stream a bronze table's routed records to Kafka, each to the topic of its type.

    The query is named by the source ``topic``, so one session can run a flow for each.
    """
    trigger = options.pop("trigger", None)
    messages = publish_routes(labelled_table, **options)
    return kafka_sink(messages, servers, checkpoint, name=f"kafka_{topic}", trigger=trigger)
