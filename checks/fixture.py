"""Envelopes and a registry made from the test tables.

The remainders below give rows a property (broken text, unknown type, kinds of code); no row is
left out by them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweir.plans.config import PAYLOAD_BASED, TopicConfig
from eventweir.sources.files import stream_files
from eventweir.workspace import fresh_path, write_table

TOPIC = "all_events"
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
PAYLOAD_DDL = (
    "event_id bigint, eventType string, user_id bigint, value double, props string,"
    " error_code string"
)
CONFIG = TopicConfig(TOPIC, PAYLOAD_BASED, PAYLOAD_DDL, EVENT_TYPES)

LIMIT = 20
# Micro-batches that a run over everything available takes.
MICRO_BATCHES = 3
# Events to a file of a stream: a file of one row group is one task, however large it is.
FILE_EVENTS = 50_000
_staged: dict[tuple[str, str], str] = {}


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _dealt(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    """Where the events lie in as many files as their number calls for, and how many these are.

    A table of fewer files is dealt to as many first, written once per application, so that the
    tasks that decode it grow in number with the table.
    """
    events = read_events(spark, sf_dir)
    files = len(events.inputFiles())
    wanted = MICRO_BATCHES * max(1, -(-events.count() // (MICRO_BATCHES * FILE_EVENTS)))
    if files >= wanted:
        return f"{sf_dir}/events.parquet*", files  # the glob also fits a table of many part files
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _staged:
        _staged[key] = fresh_path(spark, "events")
        write_table(events.repartition(wanted), _staged[key])
    return _staged[key], wanted


def dealt_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events for work that costs far more than reading them."""
    path, _ = _dealt(spark, sf_dir)
    return spark.read.schema(read_events(spark, sf_dir).schema).parquet(path)


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a file stream of several micro-batches."""
    path, files = _dealt(spark, sf_dir)
    schema = read_events(spark, sf_dir).schema
    return stream_files(spark, path, schema, max_files=-(-files // MICRO_BATCHES))


def payload_columns() -> dict:
    event_id = F.col("event_id")
    event_type = F.when(event_id % 53 == 0, F.lit("mystery")).otherwise(F.col("event_type"))
    code = (
        F.when(event_id % 11 == 0, F.lit(None).cast("string"))
        .when(event_id % 7 == 0, F.lit("E1"))
        .when(event_id % 5 == 0, F.lit("1"))
        .otherwise(F.lit("0"))
    )
    return {
        "event_id": event_id,
        "eventType": event_type,
        "user_id": F.col("user_id"),
        "value": F.col("value"),
        "props": F.col("props"),
        "error_code": code,
    }


def envelopes(events: DataFrame, topic: Column | None = None) -> DataFrame:
    """One envelope per event; ``timestamp`` stays without zone so results do not depend on one."""
    payload = F.to_json(F.struct(*[c.alias(name) for name, c in payload_columns().items()]))
    broken = F.concat(F.lit("broken "), F.col("event_id").cast("string"))
    text = F.when(F.col("event_id") % 97 == 0, broken).otherwise(payload)
    return _enveloped(events, text, F.lit(TOPIC) if topic is None else topic)


# Codes that are numbers, some of them fractions.
NUMERIC_CONFIG = TopicConfig(
    TOPIC, PAYLOAD_BASED, PAYLOAD_DDL.replace("error_code string", "error_code double"), EVENT_TYPES
)


def numeric_envelopes(events: DataFrame) -> DataFrame:
    """Envelopes whose code is a number: none, 0.4, -0.9, 2 or 0."""
    event_id = F.col("event_id")
    code = (
        F.when(event_id % 11 == 0, F.lit(None).cast("double"))
        .when(event_id % 7 == 0, 0.4)
        .when(event_id % 5 == 0, -0.9)
        .when(event_id % 3 == 0, 2.0)
        .otherwise(0.0)
    )
    columns = payload_columns() | {"error_code": code}
    payload = F.to_json(F.struct(*[c.alias(name) for name, c in columns.items()]))
    return _enveloped(events, payload, F.lit(TOPIC))


FLAWED_CONFIG = TopicConfig(
    TOPIC, PAYLOAD_BASED, "eventType string, n bigint, error_code string", EVENT_TYPES
)


def flawed_envelopes(events: DataFrame) -> DataFrame:
    """Envelopes with every flaw by turns: lost fields under each code, no type, no JSON."""
    event_id = F.col("event_id")
    number = F.when(event_id % 2 == 0, F.lit('"oops"')).otherwise(event_id.cast("string"))
    code = F.when(event_id % 3 == 0, "0").when(event_id % 3 == 1, "7").otherwise("E1")
    typed = F.format_string(
        '{"eventType":"%s","n":%s,"error_code":"%s"}', "event_type", number, code
    )
    untyped = F.format_string('{"n":%s,"error_code":"0"}', number)
    unknown = F.format_string('{"eventType":"mystery","n":%s}', number)
    broken = F.format_string('{"eventType":"%s', "event_type")
    text = (
        F.when(event_id % 5 == 0, untyped)
        .when(event_id % 7 == 0, unknown)
        .when(event_id % 11 == 0, broken)
        .otherwise(typed)
    )
    return _enveloped(events, text, F.lit(TOPIC))


NESTED_DDL = (
    "id int, o struct<p:struct<q:double>,s:string>, l array<struct<x:bigint>>, e struct<a:bigint>,"
    " v array<double>, w bigint, gone string"
)


def nested_envelopes(events: DataFrame) -> DataFrame:
    """Envelopes with nested objects, arrays, empty ones, wrong types, and payloads to reject."""
    event_id = F.col("event_id")
    number = F.when(event_id % 2 == 0, event_id.cast("string")).otherwise(
        F.concat(event_id.cast("string"), F.lit(".5"))
    )
    listed = (
        F.when(event_id % 3 == 0, "[1,2]")
        .when(event_id % 3 == 1, '[{"x":1},{"x":"t"}]')
        .otherwise("[]")
    )
    wrong = F.when(event_id % 5 == 0, '"oops"').otherwise("5")
    whole = F.format_string(
        '{"id":%d,"o":{"p":{"q":%s},"s":"x"},"l":%s,"e":{},"v":[],"w":%s}',
        event_id, number, listed, wrong,
    )
    text = (
        F.when(event_id % 97 == 0, "broken")
        .when(event_id % 89 == 0, "[1]")
        .when(event_id % 83 == 0, '{"a":1,"a":2}')
        .otherwise(whole)
    )
    return _enveloped(events, text, F.lit(TOPIC))


def _enveloped(events: DataFrame, text: Column, topic: Column) -> DataFrame:
    return events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        topic.alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        text.cast("binary").alias("value"),
    )


def repeated_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The envelopes as a stream in which every third record comes again in a later batch."""
    key = (spark.sparkContext.applicationId, f"{sf_dir}/repeated")
    if key not in _staged:
        _staged[key] = fresh_path(spark, "repeated")
        rows = envelopes(read_events(spark, sf_dir)).withColumn(
            "timestamp", F.col("timestamp").cast("timestamp")
        )
        for part in (rows, rows.where(F.col("offset") % 3 == 0)):
            part.coalesce(MICRO_BATCHES).write.mode("append").parquet(_staged[key])
    schema = spark.read.parquet(_staged[key]).schema
    return stream_files(spark, _staged[key], schema, max_files=1)


def topic_envelopes(events: DataFrame) -> DataFrame:
    """All envelopes in the combined topic, well-formed ones in the topic of their type as well."""
    own_topic = F.when(F.col("event_id") % 97 != 0, payload_columns()["eventType"])
    topics = F.array_compact(F.array(F.lit(TOPIC), own_topic))
    return envelopes(events, topics).withColumn("topic", F.explode("topic"))


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")

    def padded(number, width: int):
        return F.lpad(number.cast("string"), width, "0")

    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.concat(F.lit("t"), padded(key, 8)).alias("topic_name"),
        F.when(key % 3 == 0, F.concat(F.lit("p"), padded(key % 40, 3))).alias("pipeline_id"),
        F.when(key % 10 == 0, F.lit("payload_based"))
        .otherwise(F.lit("topic_based"))
        .alias("kind"),
        F.when(key % 10 == 0, F.array(F.lit("click"), F.lit("view"))).alias("event_types"),
    )


def clashing_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry of mixed topics and single-type topics named as the tables of mixed ones are."""
    key = F.col("c_custkey")
    number = F.floor(key / 4).cast("string")
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.when(key % 4 == 0, F.concat(F.lit("all"), number))
        .when(key % 4 == 1, F.concat(F.lit("click_all"), number))
        .when(key % 4 == 2, F.concat(F.lit("Click_All"), number))
        .otherwise(F.concat(F.lit("feb_view_all"), number))
        .alias("topic_name"),
        F.lit(None).cast("string").alias("pipeline_id"),
        F.when(key % 4 == 0, F.lit("payload_based")).otherwise("topic_based").alias("kind"),
        F.when(key % 4 == 0, F.array(F.lit("click"), F.lit("view"), F.lit("click"))).alias(
            "event_types"
        ),
    )
