"""The registered queries: name -> (spark, folder of the test tables) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixture as fx
from eventweir.functions.decoding import CORRUPT, decode_column, payload_schema
from eventweir.functions.envelope import MICROSECOND_JSON, POSITION_METADATA, payload_text
from eventweir.functions.rescue import rescued
from eventweir.functions.typetrees import overlay, path_hints
from eventweir.operators import (
    publishing,
    registry,
    routing,
    sampling_ledger,
    schema_drift,
    schema_sampling,
    schema_tracking,
)
from eventweir.operators.projections import DECODED, topic_table
from eventweir.operators.targets import target_collisions, target_plan
from eventweir.operators.weighted_allocation import allocate_weighted
from eventweir.plans.config import (
    PAYLOAD_BASED,
    TOPIC_BASED,
    TopicConfig,
    topics_without_config,
)
from eventweir.plans.flow_control import flow_changes, requested_flows
from eventweir.plans.use_cases import labelled_bronze, split_by_topic
from eventweir.sources.files import stream_files, stream_table, topic_reader
from eventweir.streaming import flows, sinks
from eventweir.streaming.counts import batch_counts
from eventweir.streaming.evolving import append_evolving, read_evolving
from eventweir.streaming.receiving import deduplicated
from eventweir.workspace import fresh_path, materialise, read_written, write_table

Query = Callable[[SparkSession, str], DataFrame]

_bronze: dict[tuple[str, str], DataFrame] = {}


def _envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.envelopes(fx.read_events(spark, sf_dir))


def write_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = labelled_bronze(_envelopes(spark, sf_dir), fx.CONFIG)
    folders = routing.label_folders(fx.EVENT_TYPES)
    return materialise(labelled, "bronze", routing.LABELS, folders=folders)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled bronze table, written once per application and read by all routes."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _bronze:
        _bronze[key] = write_bronze(spark, sf_dir)
    return _bronze[key]


def _key_text(df: DataFrame) -> DataFrame:
    return df.withColumn("key", F.col("key").cast("string"))


# --- decode and project


def decode_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _key_text(topic_table(_envelopes(spark, sf_dir), fx.PAYLOAD_DDL))


def _bronze_row(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("key").cast("string").alias("key"),
        "topic",
        "partition",
        "offset",
        "eventTime",
        "timestampType",
        "eventType",
        *[F.col(DECODED)[name].alias(f"payload_{name}") for name in fx.payload_columns()],
        *routing.LABELS,
    )


def bronze_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bronze_row(labelled_bronze(_envelopes(spark, sf_dir), fx.CONFIG))


def split_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables of all single-type topics, out of one table of mixed envelopes."""
    staged = materialise(_topic_envelopes(spark, sf_dir), "envelopes", ("topic",))
    configs = [TopicConfig(t, TOPIC_BASED, fx.PAYLOAD_DDL) for t in fx.EVENT_TYPES]
    tables = split_by_topic(topic_reader(staged), configs)
    return _key_text(reduce(DataFrame.unionByName, tables.values()))


# --- routes


def route(event_type: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return _key_text(routing.route(bronze(spark, sf_dir), event_type))


def route_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _key_text(routing.valid(bronze(spark, sf_dir)))


def route_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _key_text(routing.faulty(bronze(spark, sf_dir)))


def route_undetermined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _key_text(routing.undetermined(bronze(spark, sf_dir)))


def route_unrouted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = routing.unrouted(bronze(spark, sf_dir))
    return _key_text(rejected).select("key", "partition", "offset", "eventType", "reason", "raw")


def _numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled records whose code field is declared double."""
    envelopes = fx.numeric_envelopes(fx.read_events(spark, sf_dir))
    return labelled_bronze(envelopes, fx.NUMERIC_CONFIG)


def route_valid_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _key_text(routing.valid(_numeric(spark, sf_dir)))


def route_faulty_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _key_text(routing.faulty(_numeric(spark, sf_dir)))


def _flawed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled records with all that can be wrong with one."""
    return labelled_bronze(fx.flawed_envelopes(fx.read_events(spark, sf_dir)), fx.FLAWED_CONFIG)


def route_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = routing.partial(_flawed(spark, sf_dir)).withColumnRenamed(CORRUPT, "original")
    return _key_text(found)


def unrouted_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = routing.unrouted(_flawed(spark, sf_dir))
    return found.select("partition", "offset", "eventType", "reason", "raw")


def publish_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = routing.rejects(_flawed(spark, sf_dir)).drop("key", "eventTime")
    keyed = rejected.withColumn("key", F.col("offset").cast("string")).select(
        "key", "partition", "offset", "reason", "raw"
    )
    return publishing.publish_rejects(keyed)


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects of a stream, by way of the quarantine messages of one flow."""
    path = fresh_path(spark, "stream_rejects")
    stream = fx.flawed_envelopes(fx.stream_events(spark, sf_dir))
    labelled = labelled_bronze(stream, fx.FLAWED_CONFIG)
    output = flows.rejects_output(sinks.file_messages(f"{path}/messages", "stream_rejects"))
    flows.payload_flow(
        labelled, f"{path}/table", f"{path}/checkpoint", "stream_rejects", [output],
        sinks.AVAILABLE_NOW,
    ).awaitTermination()
    sent = sinks.read_messages(spark, f"{path}/messages")
    fields = F.from_json("value", "partition int, offset bigint, reason string, raw string")
    return sent.select("topic", fields.alias("v")).select("topic", "v.*")


def conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.conservation(bronze(spark, sf_dir))


# --- messages


def publish(event_type: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return publishing.publish_route(bronze(spark, sf_dir), event_type, MICROSECOND_JSON)


def publish_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publishing.publish_routes(
        bronze(spark, sf_dir), per_source_topic=True, json_options=MICROSECOND_JSON
    )


def publish_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = routing.quarantined(bronze(spark, sf_dir), "faulty_only")
    return publishing.publish_quarantine(rejected, MICROSECOND_JSON)


def publish_quarantine_undetermined(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = routing.quarantined(bronze(spark, sf_dir))
    return publishing.publish_quarantine(rejected, MICROSECOND_JSON)


def publish_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outgoing messages that carry their position in the source."""
    return publishing.publish_routes(
        bronze(spark, sf_dir), json_options=MICROSECOND_JSON, metadata=POSITION_METADATA
    )


def _decoded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.read_events(spark, sf_dir).select(
        *[c.alias(name) for name, c in fx.payload_columns().items()]
    )


def publish_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publishing.fan_out(_decoded_events(spark, sf_dir), fx.TOPIC)


# --- schemas


def _topic_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.topic_envelopes(fx.dealt_events(spark, sf_dir))


def _joined_types(df: DataFrame) -> DataFrame:
    return df.withColumn("event_types", F.array_join("event_types", ","))


def infer_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_sampling.infer_schemas(_topic_envelopes(spark, sf_dir))


def topic_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    registered = registry.new_registry(spark, fx.EVENT_TYPES, {fx.TOPIC: fx.EVENT_TYPES})
    config = schema_sampling.topic_config(infer_schema(spark, sf_dir), registered)
    return _joined_types(config)


def decode_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The combined topic decoded with the schema found in its own messages."""
    envelope = _envelopes(spark, sf_dir)
    (found,) = schema_sampling.infer_schemas(envelope).collect()
    return _key_text(topic_table(envelope, found.schema_ddl))


def field_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_drift.field_profile(_topic_envelopes(spark, sf_dir))


def _nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.nested_envelopes(fx.read_events(spark, sf_dir))


def infer_schema_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_sampling.infer_schemas(_nested(spark, sf_dir))


def field_profile_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_drift.field_profile(_nested(spark, sf_dir))


def drift_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = TopicConfig(fx.TOPIC, PAYLOAD_BASED, fx.NESTED_DDL, fx.EVENT_TYPES)
    registered = schema_drift.registered_fields(spark, [config])
    return schema_drift.schema_drift(field_profile_nested(spark, sf_dir), registered)


def payload_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_drift.payload_rejects(_nested(spark, sf_dir))


def schema_tracked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schema that three micro-batches were folded into, one after the other."""
    path = fresh_path(spark, "schema_tracked")
    stream = fx.nested_envelopes(fx.stream_events(spark, sf_dir))
    flows.tracking_flow(
        stream, f"{path}/schemas", f"{path}/checkpoint", "tracked", sinks.AVAILABLE_NOW
    ).awaitTermination()
    return schema_tracking.tracked_schemas(spark, f"{path}/schemas")


def sample_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schemas and offsets after two samples, the second of which goes on behind the first."""
    path = fresh_path(spark, "sample_increment")
    envelope = _nested(spark, sf_dir)
    early = envelope.where(F.col("offset") < envelope.agg(F.median("offset")).first()[0])
    for part in (early, envelope):
        sampling_ledger.sample_increment(part, f"{path}/schemas", f"{path}/ledger")
    schemas = schema_tracking.tracked_schemas(spark, f"{path}/schemas")
    return sampling_ledger.load_ledger(spark, f"{path}/ledger").join(schemas, "topic")


# A nested field and an element type that are hinted, by path, and one hinted as a whole.
HINTS = {"o.p.q": "string", "l[]": "variant", "id": "int", "o.more": "string"}


def decode_hinted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded by the schema that the messages have, some of its parts replaced by hints."""
    envelope = _nested(spark, sf_dir)
    (found,) = schema_sampling.infer_schemas(envelope).collect()
    schema = overlay(payload_schema(found.schema_ddl), path_hints(HINTS))
    decoded = envelope.select("offset", decode_column(payload_text(), schema).alias("d"))
    return decoded.select(
        "offset",
        "d.id",
        F.col("d.o.p.q").alias("q"),
        F.col("d.o.s").alias("s"),
        F.col("d.o.more").alias("more"),
        F.size("d.l").alias("l_size"),
        F.to_json(F.get("d.l", F.lit(0))).alias("l_first"),
        F.col("d.e").alias("e"),
        F.col("d.w").alias("w"),
    )


RESCUE_DDL = "id int, o struct<p:struct<q:double>>, l array<bigint>, w bigint"


def decode_rescued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some fields decoded, and all that the schema does not name or cannot hold in one column."""
    decoded = _nested(spark, sf_dir).select(
        "offset",
        decode_column(payload_text(), RESCUE_DDL).alias("d"),
        rescued(payload_text(), RESCUE_DDL).alias("rescued"),
    )
    return decoded.select(
        "offset",
        "d.id",
        F.col("d.o.p.q").alias("q"),
        F.array_join("d.l", ",").alias("l"),
        "d.w",
        "rescued",
    )


# An older configuration: ``value`` was whole, ``event_id`` a fraction, ``props`` not there yet,
# ``country`` still sent.
OLD_DDL = (
    "event_id double, eventType string, user_id bigint, value bigint, country string,"
    " error_code string"
)


def drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    configs = [TopicConfig(fx.TOPIC, PAYLOAD_BASED, OLD_DDL, fx.EVENT_TYPES)]
    configs += [TopicConfig(t, TOPIC_BASED, OLD_DDL) for t in fx.EVENT_TYPES]
    registered = schema_drift.registered_fields(spark, configs)
    return schema_drift.schema_drift(field_profile(spark, sf_dir), registered)


def schema_merge_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views and clicks written without ``props``, the other types with it but no ``value``."""
    events = fx.read_events(spark, sf_dir)
    early = F.col("event_type").isin("click", "view")
    path = fresh_path(spark, "evolving")
    schema = append_evolving(
        events.where(early).select("event_id", "event_type", "value"), path
    )
    schema = append_evolving(
        events.where(~F.coalesce(early, F.lit(False))).select("event_id", "event_type", "props"),
        path,
        schema,
    )
    return read_evolving(spark, path, schema)


# --- registry


def registry_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined_types(fx.registry(spark, sf_dir))


def registry_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.fullest_first(registry.open_pipelines(fx.registry(spark, sf_dir), fx.LIMIT))


def registry_unallocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.unallocated(fx.registry(spark, sf_dir))


def registry_allocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.allocated(fx.registry(spark, sf_dir))


def registry_pipelines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.allocated(fx.registry(spark, sf_dir), distinct=True)


def registry_allocate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.allocate(fx.registry(spark, sf_dir), fx.LIMIT)


def registry_allocate_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return allocate_weighted(fx.registry(spark, sf_dir), fx.LIMIT)


def registry_new_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.new_groups(registry_allocate(spark, sf_dir))


def registry_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry after dealing, the new groups' pipelines being named ``new`` and the number."""
    allocation = materialise(registry_allocate(spark, sf_dir), "allocation")
    created = (
        allocation.where(F.col("new_group").isNotNull())
        .select("new_group")
        .distinct()
        .withColumn("pipeline_id", F.concat(F.lit("new"), F.col("new_group").cast("string")))
    )
    updates = registry.assignments(allocation, created)
    return _joined_types(registry.merge_assignments(fx.registry(spark, sf_dir), updates))


def registry_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined_types(registry.topics_of(fx.registry(spark, sf_dir), "p007"))


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return target_plan(fx.registry(spark, sf_dir))


def targets_of_pipelines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The objects of the topics that pipelines already serve."""
    rows = fx.registry(spark, sf_dir)
    return target_plan(rows.where(F.col("pipeline_id").isNotNull()), sinks_per_topic=True)


def collisions_across_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clashes of a registry whose names differ by case only, or meet across kinds of tables."""
    return target_collisions(target_plan(fx.clashing_registry(spark, sf_dir)))


def without_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Allocated topics of the registry that no sampled schema is there for."""
    topics = fx.registry(spark, sf_dir)
    config = topics.where(F.substring("topic_name", -1, 1).cast("int") % 2 == 0).select(
        F.col("topic_name").alias("topic"), "kind", F.lit("a string").alias("schema_ddl"), "event_types"
    )
    return topics_without_config(config, topics)


def registry_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry after dealing, by way of two saved versions."""
    path = fresh_path(spark, "registry")
    registry.save_registry(fx.registry(spark, sf_dir), path, 1)
    registry.update_registry(spark, path, lambda rows: _dealt(rows))
    return _joined_types(registry.load_registry(spark, path))


def _dealt(rows: DataFrame) -> DataFrame:
    allocation = materialise(registry.allocate(rows, fx.LIMIT), "allocation")
    return registry.assignments(allocation)


def changes_of_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is to be done when pipelines run other topics than the registry gives them."""
    rows = fx.registry(spark, sf_dir)
    key = F.substring("topic_name", 2, 8).cast("long")
    running = rows.where(key % 5 == 0).withColumn(
        "pipeline_id", F.concat(F.lit("p"), F.lpad((key % 40).cast("string"), 3, "0"))
    )
    return flow_changes(requested_flows(rows), requested_flows(running))


def collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return target_collisions(target_plan(fx.registry(spark, sf_dir)))


# --- streams, run to the end of the available input


def _stream_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled_bronze(fx.envelopes(fx.stream_events(spark, sf_dir)), fx.CONFIG)


def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_path(spark, "stream_bronze")
    stream = fx.envelopes(fx.stream_events(spark, sf_dir))
    (query,) = flows.bronze_flows(
        lambda topic: stream, [fx.CONFIG], root, f"{root}/checkpoints", sinks.AVAILABLE_NOW
    )
    query.awaitTermination()
    schema = _stream_labelled(spark, sf_dir).schema
    return _bronze_row(read_written(spark, f"{root}/bronze_{fx.TOPIC}", schema))


def stream_topic_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_path(spark, "stream_topic")
    stream = fx.envelopes(fx.stream_events(spark, sf_dir))
    config = TopicConfig("events", TOPIC_BASED, fx.PAYLOAD_DDL)
    (query,) = flows.topic_flows(
        lambda topic: stream, [config], root, f"{root}/checkpoints", sinks.AVAILABLE_NOW
    )
    query.awaitTermination()
    return _key_text(
        read_written(
            spark, f"{root}/silver_events", topic_table(stream, fx.PAYLOAD_DDL).schema
        )
    )


def _run_payload_flow(
    spark: SparkSession, sf_dir: str, name: str, *outputs
) -> tuple[str, DataFrame]:
    """Run the flow to its end; the folder of its messages, and its table."""
    path = fresh_path(spark, name)
    labelled = _stream_labelled(spark, sf_dir)
    bound = [
        make(sinks.file_messages(f"{path}/messages/{i}", name)) for i, make in enumerate(outputs)
    ]
    flows.payload_flow(
        labelled, f"{path}/table", f"{path}/checkpoint", name, bound, sinks.AVAILABLE_NOW
    ).awaitTermination()
    return f"{path}/messages", sinks.read_batches(spark, f"{path}/table", labelled.schema)


_quarantine = partial(
    flows.quarantine_output, policy="faulty_only", json_options=MICROSECOND_JSON
)
_publish = partial(
    flows.publish_output, per_source_topic=True, json_options=MICROSECOND_JSON
)


def stream_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every routed record, from the table that one write per micro-batch filled."""
    _, table = _run_payload_flow(spark, sf_dir, "stream_routes")
    return _key_text(routing.route_table(table.where(F.col("route") != routing.UNROUTED)))


def stream_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze rows of a table whose first batches are packed while others have come since."""
    path = fresh_path(spark, "stream_compacted")
    labelled = _stream_labelled(spark, sf_dir)
    flows.payload_flow(
        labelled, f"{path}/table", f"{path}/checkpoint", "packed", trigger=sinks.AVAILABLE_NOW
    ).awaitTermination()
    for last in (0, 1):
        sinks.compact_batches(spark, f"{path}/table", "packed", last, partition_by=routing.LABELS)
    return _bronze_row(sinks.read_batches(spark, f"{path}/table"))


def stream_table_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routed records of a stream from the catalog table that another stream has filled."""
    topic = f"events_{uuid.uuid4().hex}"
    path = fresh_path(spark, "stream_table_routes")
    config = TopicConfig(topic, PAYLOAD_BASED, fx.PAYLOAD_DDL, fx.EVENT_TYPES)
    stream = fx.envelopes(fx.stream_events(spark, sf_dir))
    (query,) = flows.bronze_flows(
        lambda name: stream, [config], None, f"{path}/checkpoints", sinks.AVAILABLE_NOW
    )
    query.awaitTermination()
    bronze_rows = stream_table(spark, f"bronze_{topic}")
    routed = routing.route_table(bronze_rows.where(F.col("route") != routing.UNROUTED))
    sinks.table_sink(
        routed, f"{path}/routes", f"{path}/checkpoint", trigger=sinks.AVAILABLE_NOW
    ).awaitTermination()
    spark.sql(f"DROP TABLE bronze_{topic}")
    return _key_text(read_written(spark, f"{path}/routes", routed.schema))


def stream_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, table = _run_payload_flow(spark, sf_dir, "stream_valid", _quarantine)
    return _key_text(routing.valid(table))


def stream_schema_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table filled by two runs, the first of which did not know ``props`` yet."""
    path = fresh_path(spark, "stream_schema_merge")
    early = fx.PAYLOAD_DDL.replace(", props string", "")
    for app_id, ddl in (("early", early), ("late", fx.PAYLOAD_DDL)):
        config = TopicConfig(fx.TOPIC, PAYLOAD_BASED, ddl, fx.EVENT_TYPES)
        labelled = labelled_bronze(fx.envelopes(fx.stream_events(spark, sf_dir)), config)
        flows.payload_flow(
            labelled, f"{path}/table", f"{path}/{app_id}", app_id, trigger=sinks.AVAILABLE_NOW
        ).awaitTermination()
    return _key_text(routing.valid(sinks.read_batches(spark, f"{path}/table")))


def stream_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by outcome, counted while the micro-batches were written."""
    path = fresh_path(spark, "stream_conservation")
    flows.payload_flow(
        _stream_labelled(spark, sf_dir), f"{path}/table", f"{path}/checkpoint", "counted",
        trigger=sinks.AVAILABLE_NOW, counts=f"{path}/counts",
    ).awaitTermination()
    found = batch_counts(spark, f"{path}/counts").groupBy("outcome")
    return found.agg(F.sum("records").alias("records"), F.count_distinct("batch_id").alias("batches"))


def stream_catalog_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One catalog table filled by two runs of a flow, the first of which did not know ``props``.

    Half of the events come after the first run.
    """
    topic = f"events_{uuid.uuid4().hex}"
    path = fresh_path(spark, "stream_catalog_merge")
    events = fx.read_events(spark, sf_dir)
    early = fx.PAYLOAD_DDL.replace(", props string", "")
    for part, ddl in enumerate((early, fx.PAYLOAD_DDL)):
        come = events.where(F.abs(F.col("event_id")) % 2 == part)
        come.write.mode("append").parquet(f"{path}/events")
        stream = fx.envelopes(stream_files(spark, f"{path}/events", events.schema))
        (query,) = flows.topic_flows(
            lambda name, stream=stream: stream,
            [TopicConfig(topic, TOPIC_BASED, ddl)],
            None,
            f"{path}/checkpoints",
            sinks.AVAILABLE_NOW,
        )
        query.awaitTermination()
    rows = write_table(spark.table(f"silver_{topic}"), f"{path}/rows")
    spark.sql(f"DROP TABLE silver_{topic}")
    return _key_text(rows)


def stream_deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of a stream some of which come twice, each once."""
    path = fresh_path(spark, "stream_deduplicated")
    stream = fx.repeated_envelopes(spark, sf_dir)
    once = deduplicated(stream, "4000 days", time="timestamp")
    sinks.table_sink(
        once, f"{path}/table", f"{path}/checkpoint", trigger=sinks.AVAILABLE_NOW
    ).awaitTermination()
    found = read_written(spark, f"{path}/table", once.schema)
    return found.select(
        "topic", "partition", "offset", F.col("value").cast("string").alias("value")
    )


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages, _ = _run_payload_flow(spark, sf_dir, "stream_quarantine", _quarantine)
    return sinks.read_messages(spark, f"{messages}/0")


def stream_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages, _ = _run_payload_flow(spark, sf_dir, "stream_publish", _publish)
    return sinks.read_messages(spark, f"{messages}/0")


def stream_all_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantine and outgoing topics fed by one flow."""
    messages, _ = _run_payload_flow(spark, sf_dir, "stream_all_messages", _quarantine, _publish)
    return sinks.read_messages(spark, f"{messages}/0").unionByName(
        sinks.read_messages(spark, f"{messages}/1")
    )


QUERIES: dict[str, Query] = {
    "decode_flat": decode_flat,
    "split_topics": split_topics,
    "bronze_payload": bronze_payload,
    **{f"route_{t}": partial(route, t) for t in fx.EVENT_TYPES},
    "route_valid": route_valid,
    "route_faulty": route_faulty,
    "route_undetermined": route_undetermined,
    "route_unrouted": route_unrouted,
    "route_valid_numeric": route_valid_numeric,
    "route_faulty_numeric": route_faulty_numeric,
    "route_partial": route_partial,
    "unrouted_reasons": unrouted_reasons,
    "publish_rejects": publish_rejects,
    "conservation": conservation,
    **{f"publish_{t}": partial(publish, t) for t in fx.EVENT_TYPES},
    "publish_all": publish_all,
    "publish_positions": publish_positions,
    "publish_quarantine": publish_quarantine,
    "publish_quarantine_undetermined": publish_quarantine_undetermined,
    "publish_fanout": publish_fanout,
    "infer_schema": infer_schema,
    "topic_config": topic_config,
    "decode_inferred": decode_inferred,
    "field_profile": field_profile,
    "schema_drift": drift,
    "infer_schema_nested": infer_schema_nested,
    "field_profile_nested": field_profile_nested,
    "schema_drift_nested": drift_nested,
    "payload_rejects": payload_rejects,
    "schema_tracked": schema_tracked,
    "sample_increment": sample_increment,
    "decode_hinted": decode_hinted,
    "decode_rescued": decode_rescued,
    "schema_merge_read": schema_merge_read,
    "registry": registry_rows,
    "registry_load": registry_load,
    "registry_unallocated": registry_unallocated,
    "registry_allocated": registry_allocated,
    "registry_pipelines": registry_pipelines,
    "registry_topics": registry_topics,
    "registry_allocate": registry_allocate,
    "registry_allocate_weighted": registry_allocate_weighted,
    "registry_new_groups": registry_new_groups,
    "registry_merge": registry_merge,
    "target_plan": targets,
    "target_plan_allocated": targets_of_pipelines,
    "target_collisions": collisions,
    "target_collisions_across_kinds": collisions_across_kinds,
    "topics_without_config": without_config,
    "registry_saved": registry_saved,
    "flow_changes": changes_of_flows,
    "stream_bronze": stream_bronze,
    "stream_topic_table": stream_topic_table,
    "stream_routes": stream_routes,
    "stream_compacted": stream_compacted,
    "stream_table_routes": stream_table_routes,
    "stream_valid": stream_valid,
    "stream_schema_merge": stream_schema_merge,
    "stream_catalog_merge": stream_catalog_merge,
    "stream_conservation": stream_conservation,
    "stream_deduplicated": stream_deduplicated,
    "stream_quarantine": stream_quarantine,
    "stream_rejects": stream_rejects,
    "stream_publish": stream_publish,
    "stream_all_messages": stream_all_messages,
}
