"""What the messages hold against what is registered, per topic and field."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventweir.functions.decoding import payload_schema
from eventweir.functions.envelope import payload_text
from eventweir.functions.labels import JSON_SPACE
from eventweir.functions.typenames import declared_type
from eventweir.operators.schema_sampling import payload_object
from eventweir.plans.config import TopicConfig
from eventweir.workspace import materialise


ARRAY = "[]"
EMPTY_OBJECT, EMPTY_ARRAY = "struct<>", "array<>"

# Steps of the walk in one plan.
STEPS = 8

# A name in back-quotes, an array step, or a plain name.
_STEP = r"`[^`]*`|\[\]|[^.\[`]+"


def quoted(name: str) -> str:
    return f"`{name}`" if "." in name or "[" in name else name


def _quoted(name: Column) -> Column:
    needs = name.contains(".") | name.contains("[")
    return F.when(needs, F.concat(F.lit("`"), name, F.lit("`"))).otherwise(name)


def _outer_paths(field: Column) -> Column:
    """The paths that a field lies in: of ``a.b[].c`` these are ``a``, ``a.b`` and ``a.b[]``."""
    steps = F.regexp_extract_all(field, F.lit(_STEP), F.lit(0))
    count = F.size(steps) - 1
    paths = F.transform(
        F.sequence(F.lit(1), count),
        lambda n: F.replace(F.array_join(F.slice(steps, 1, n), "."), F.lit(".[]"), F.lit(ARRAY)),
    )
    return F.when(count > 0, paths).otherwise(F.array().cast("array<string>"))


def _text_brackets(content: Column) -> Column:
    """The nesting of a value, from its JSON text."""
    plain = F.regexp_replace(F.to_json(content), r"(?s)\\.", "")
    plain = F.regexp_replace(plain, '"[^"]*"', "")
    return F.translate(F.regexp_replace(plain, r"[^\[\]{}]+", ""), "[]{}", "<><>")


def _brackets(content: Column) -> Column:
    """The nesting of a value as < and >.

    Its type tells it, unless elements of an array are of several types, which hide what lies below
    them, or a name needs quotes, as it may then hold brackets.
    """
    kind = F.schema_of_variant(content)
    hidden = kind.contains("VARIANT") | kind.contains("`")
    return F.when(hidden, _text_brackets(content)).otherwise(F.regexp_replace(kind, "[^<>]+", ""))


#: Levels that are told by taking innermost brackets away.
SHALLOW = 4


def _depth(brackets: Column) -> Column:
    """How many brackets are open at most."""
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(seen: Column, bracket: Column) -> Column:
        now = seen["now"] + F.when(bracket == "<", 1).when(bracket == ">", -1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(seen["most"], now).alias("most"))

    depth, left = F.when(brackets == "", 0), brackets
    for level in range(1, SHALLOW + 1):
        left = F.replace(left, F.lit("<>"), F.lit(""))
        depth = depth.when(left == "", level)
    return depth.otherwise(F.aggregate(F.split(brackets, ""), start, step)["most"])


def field_profile(envelope: DataFrame) -> DataFrame:
    """``(topic, field, observed_type, records)`` over all well-formed messages, to full depth.

    A field is the path of a plain value, ``outer.inner``; the elements of an array are ``list[]``,
    each counted as a record.  Names with a dot or bracket are quoted.  Empty objects and arrays
    have types of their own, ``struct<>`` and ``array<>``.

    One pass finds how deep the messages nest, from their types, or from the text of those whose type
    hides it; a second one walks down in as many steps, values that are plain already wait.
    The walk is written every ``STEPS`` steps, so that deep messages make no larger plan.  Leaves are
    counted in a partial hash aggregate, so records of many shapes give no more groups than there are
    paths and types.
    """
    spark = envelope.sparkSession
    payloads = envelope.select("topic", payload_object(payload_text()).alias("content"))
    payloads = payloads.where(F.col("content").isNotNull())
    nestings = payloads.select(_brackets(F.col("content")).alias("b"))
    levels = nestings.agg(F.max(_depth(F.col("b")))).first()[0] or 0
    walked = payloads.lateralJoin(spark.tvf.variant_explode(F.col("content").outer())).select(
        "topic", F.col("value").alias("content"), _quoted(F.col("key")).alias("field")
    )
    for step in range(1, levels):
        if step % STEPS == 0:
            walked = materialise(walked, "walked")
        typed = walked.withColumn("kind", F.schema_of_variant("content"))
        is_list, is_object = F.col("kind").startswith("ARRAY"), F.col("kind").startswith("OBJECT")
        opened = typed.select(
            "*",
            is_list.alias("list"),
            F.when(is_list | is_object, F.col("content")).alias("inside"),
        )
        walked = opened.lateralJoin(
            spark.tvf.variant_explode_outer(F.col("inside").outer())
        ).select(
            "topic",
            F.when(F.col("pos").isNull(), F.col("content"))
            .otherwise(F.col("value"))
            .alias("content"),
            F.when(F.col("pos").isNull(), F.col("field"))
            .when(F.col("list"), F.concat("field", F.lit(ARRAY)))
            .otherwise(F.concat_ws(".", "field", _quoted(F.col("key"))))
            .alias("field"),
        )
    leaves = walked.select("topic", "field", F.schema_of_variant("content").alias("kind"))
    shown = F.when(F.col("kind").startswith("ARRAY"), F.lit("ARRAY")).otherwise(F.col("kind"))
    counted = leaves.groupBy("topic", "field", shown.alias("kind")).agg(F.count("*").alias("n"))
    observed = (
        F.when(F.col("kind") == "ARRAY", EMPTY_ARRAY)
        .when(F.col("kind") == "OBJECT<>", EMPTY_OBJECT)
        .otherwise(declared_type(F.col("kind"), null_as="void"))
    )
    return (
        counted.withColumn("observed_type", observed)
        .groupBy("topic", "field", "observed_type")
        .agg(F.sum("n").alias("records"))
    )


def payload_rejects(envelope: DataFrame) -> DataFrame:
    """``(topic, reject, records)``: what schemas are not inferred from, by topic and kind.

    ``no_value``, ``malformed``, ``not_object``, and ``repeated_key`` for objects that name a key
    twice (their decoding takes the last value).
    """
    text = payload_text()
    is_object = F.ltrim(text, F.lit(JSON_SPACE)).startswith("{")
    reject = (
        F.when(text.isNull(), "no_value")
        .when(F.get_json_object(text, "$").isNull(), "malformed")
        .when(~is_object, "not_object")
        .when(F.try_parse_json(text).isNull(), "repeated_key")
    )
    return (
        envelope.select("topic", reject.alias("reject"))
        .where(F.col("reject").isNotNull())
        .groupBy("topic", "reject")
        .agg(F.count("*").alias("records"))
    )


def _leaves(path: str, data_type: T.DataType):
    if isinstance(data_type, T.StructType) and data_type.fields:
        for field in data_type.fields:
            inner = f"{path}.{quoted(field.name)}" if path else quoted(field.name)
            yield from _leaves(inner, field.dataType)
    elif isinstance(data_type, T.ArrayType):
        yield from _leaves(path + ARRAY, data_type.elementType)
    else:
        yield path, data_type.simpleString()


def registered_fields(spark: SparkSession, configs: Iterable[TopicConfig]) -> DataFrame:
    """``(topic, field, registered_type)`` of every plain field, paths as in ``field_profile``."""
    rows = [
        (config.topic, path, kind)
        for config in configs
        for path, kind in _leaves("", payload_schema(config.schema_ddl))
    ]
    return spark.createDataFrame(rows, "topic string, field string, registered_type string")


_WHOLE = ("tinyint", "smallint", "int")


def _fit(seen: Column, wanted: Column) -> Column:
    """Whether values of a type decode to a registered plain type."""
    number = wanted.isin("float", "double") | wanted.startswith("decimal")
    times = wanted.startswith("timestamp") | (wanted == "date")
    return (
        F.when(seen == "void", "null_only")
        .when(seen == wanted, "match")
        .when(wanted == "string", "as_text")
        .when((seen == "bigint") & (wanted == "double"), "widening")
        .when((seen == "bigint") & (wanted.isin(*_WHOLE) | number), "narrowing")
        .when((seen == "double") & number, "narrowing")
        .when((seen == "string") & times, "narrowing")
        .otherwise("conflict")
    )


def schema_drift(profile: DataFrame, registered: DataFrame) -> DataFrame:
    """The profile next to the registered types, with a verdict per row.

    ``match``, ``null_only`` (fits any type), ``widening`` (fits by a lossless cast), ``narrowing``
    (fits where the value is in the type's range or form, else decodes to NULL), ``as_text``
    (registered as text, decodes to its JSON text), ``conflict`` (decodes to NULL), ``new_field``
    (not decoded), ``never_seen``.  Empty objects and arrays match any object and array.  What lies
    inside a field that is registered as plain is judged by that field, a plain value where an
    object or array is registered is a conflict.

    The profile, a row per topic, path and type, is written first: it is read several times, and its
    messages are to be walked once.
    """
    profile = materialise(profile, "profile")
    plain = registered.select("topic", "field", "registered_type")
    outer = registered.select("topic", F.explode(_outer_paths(F.col("field"))).alias("field"))
    inside = F.array_append(_outer_paths(F.col("field")), F.col("field"))
    lists = (
        registered.select("topic", F.explode(inside).alias("inner"))
        .where(F.col("inner").endswith(ARRAY))
        .select("topic", F.expr("left(inner, length(inner) - 2)").alias("field"))
    )
    containers = outer.union(lists).distinct().join(
        lists.distinct().withColumn("is_list", F.lit(True)), ["topic", "field"], "left"
    )
    kind = F.when(F.col("is_list"), "array").otherwise("struct")
    containers = containers.select("topic", "field", kind.alias("registered_as"))
    above = profile.select("topic", "field", F.explode(_outer_paths(F.col("field"))).alias("outer"))
    outer_plain = plain.withColumnsRenamed({"field": "outer", "registered_type": "outer_type"})
    above = (
        above.distinct()
        .join(outer_plain, ["topic", "outer"])
    )
    inside_seen = above.select("topic", F.col("outer").alias("field")).distinct()
    inside_seen = inside_seen.withColumn("inside_seen", F.lit(True))
    above = above.select("topic", "field", "outer_type")
    judged = (
        profile.join(plain, ["topic", "field"], "full_outer")
        .join(containers, ["topic", "field"], "left")
        .join(above, ["topic", "field"], "left")
        .join(inside_seen, ["topic", "field"], "left")
        .where(F.col("observed_type").isNotNull() | F.col("inside_seen").isNull())
    )
    seen, wanted, around = F.col("observed_type"), F.col("registered_type"), F.col("registered_as")
    empty = F.when(seen == EMPTY_OBJECT, "struct").when(seen == EMPTY_ARRAY, "array")
    verdict = (
        F.when(seen.isNull(), "never_seen")
        .when(wanted.isNotNull(), _fit(seen, wanted))
        .when(around.isNotNull() & (seen == "void"), "null_only")
        .when(around.isNotNull(), F.when(empty == around, "match").otherwise("conflict"))
        .when(F.col("outer_type") == "string", "as_text")
        .when(F.col("outer_type").isNotNull(), "conflict")
        .otherwise("new_field")
    )
    return judged.select(
        "topic",
        "field",
        F.coalesce(wanted, "outer_type", "registered_as").alias("registered_type"),
        "observed_type",
        F.coalesce("records", F.lit(0)).alias("records"),
        verdict.alias("verdict"),
    )
