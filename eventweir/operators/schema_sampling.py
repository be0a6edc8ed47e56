"""A payload schema per topic from all of its messages, every topic in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventweir.functions.envelope import payload_text
from eventweir.functions.labels import JSON_SPACE
from eventweir.functions.typenames import declared_type

def payload_object(text: Column) -> Column:
    """The payload as a variant; NULL unless it is one well-formed JSON object.

    An object that names a key twice does not count as well-formed.
    """
    is_object = F.ltrim(text, F.lit(JSON_SPACE)).startswith("{")
    return F.when(is_object, F.try_parse_json(text))


def infer_schemas(envelope: DataFrame) -> DataFrame:
    """``(topic, schema_ddl)``: the schema that fits every well-formed message of the topic.

    Fields come sorted by name.  Always-null fields are text; objects with different fields are
    merged by name, one never seen with a field is text; whole numbers are bigint, and double where
    fractions occur too; other mixtures are text.  The aggregate is partial per task, so a topic
    that holds most of the messages costs no more than its share.  Topics without a well-formed
    object give no row.

    A task that meets more topics than ``spark.sql.objectHashAggregate.sortBased.fallbackThreshold``
    sorts its input first; raise that setting where one input split mixes hundreds of topics.
    """
    merged = (
        envelope.select("topic", payload_object(payload_text()).alias("payload"))
        .groupBy("topic")
        .agg(F.call_function("schema_of_variant_agg", F.col("payload")).alias("found"))
    )
    has_fields = F.col("found").startswith("OBJECT<") & (F.col("found") != "OBJECT<>")
    return merged.where(has_fields).select(
        "topic", declared_type(F.col("found")).alias("schema_ddl")
    )


def topic_config(schemas: DataFrame, registry: DataFrame) -> DataFrame:
    """The inferred schemas with the kind and event types their topics are registered under."""
    registered = registry.select(F.col("topic_name").alias("topic"), "kind", "event_types")
    return schemas.join(registered, "topic").select("topic", "kind", "schema_ddl", "event_types")
