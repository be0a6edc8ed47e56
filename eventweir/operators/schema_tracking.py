"""Schemas that are tracked between runs: every batch is folded into what is known.

What is kept per topic is the type tree of all messages so far, null and empty parts included, so
that folding batch by batch, in any order, repeated or not, gives what one pass over all messages
would.  Every change is a version, made by compare-and-set; old versions stay as the history.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventweir.functions.envelope import payload_text
from eventweir.functions.typenames import declared_type
from eventweir.functions.typetrees import declared, join
from eventweir.operators.schema_sampling import payload_object
from eventweir.versions import committed, newest, update, version_path
from eventweir.workspace import read_written

TRACKED_SCHEMA = "topic string, tree string"


def observed_trees(envelope: DataFrame) -> DataFrame:
    """``(topic, observed)``: the types of a topic's well-formed objects, void and empty kept apart.

    One partial aggregate over all topics, as in ``infer_schemas``; topics without a well-formed
    object give no row.
    """
    merged = (
        envelope.select("topic", payload_object(payload_text()).alias("payload"))
        .groupBy("topic")
        .agg(F.call_function("schema_of_variant_agg", F.col("payload")).alias("found"))
    )
    text = declared_type(F.col("found"), null_as="void", empty_as="struct<>")
    return merged.where(F.col("found").startswith("OBJECT<")).select("topic", text.alias("observed"))


def _trees(observed: DataFrame) -> dict[str, T.DataType]:
    """The few rows of one pipeline's topics: a decoder's schema is part of the query plan."""
    return {row.topic: T.DataType.fromDDL(row.observed) for row in observed.collect()}


def _known(rows: DataFrame | None) -> dict[str, T.DataType]:
    if rows is None:
        return {}
    return {row.topic: T.StructType.fromJson(json.loads(row.tree)) for row in rows.collect()}


def fold_schemas(envelope: DataFrame, path: str) -> int:
    """Fold a batch of messages into the schemas kept at ``path``; the version that holds it.

    A batch that brings nothing new makes no version.  Two writers at once both count: the later one
    joins its trees into what the earlier one has saved.
    """
    spark = envelope.sparkSession
    seen = _trees(observed_trees(envelope))

    def change(rows: DataFrame | None) -> DataFrame | None:
        known = _known(rows)
        joined = known | {t: join(known.get(t, T.StructType()), tree) for t, tree in seen.items()}
        if rows is not None and joined == known:
            return None
        kept = [(topic, tree.json()) for topic, tree in sorted(joined.items())]
        return spark.createDataFrame(kept, TRACKED_SCHEMA).coalesce(1)

    return update(spark, path, TRACKED_SCHEMA, change)


def tracked_schemas(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """``(topic, schema_ddl)`` as of a version, the newest by default."""
    if version is None:
        _, rows = newest(spark, path, TRACKED_SCHEMA)
    else:
        rows = read_written(spark, version_path(path, version), TRACKED_SCHEMA)
    found = [
        (topic, _ddl(declared(tree)))
        for topic, tree in _known(rows).items()
        if tree.fields
    ]
    return spark.createDataFrame(found, "topic string, schema_ddl string")


def _ddl(tree: T.DataType) -> str:
    """The declared type as ``infer_schemas`` writes it, names quoted where they need it."""
    if isinstance(tree, T.StructType):
        fields = (f"{_name(f.name)}:{_ddl(f.dataType)}" for f in tree)
        return f"struct<{','.join(fields)}>"
    if isinstance(tree, T.ArrayType):
        return f"array<{_ddl(tree.elementType)}>"
    return tree.simpleString()


def _name(name: str) -> str:
    plain = name.isascii() and name.replace("_", "a").isalnum() and not name[0].isdigit()
    return name if plain else "`" + name.replace("`", "``") + "`"


def schema_history(spark: SparkSession, path: str) -> DataFrame:
    """``(version, topic, schema_ddl)`` of all versions."""
    none = spark.createDataFrame([], "version int, topic string, schema_ddl string")
    parts = [
        tracked_schemas(spark, path, v).select(F.lit(v).alias("version"), "topic", "schema_ddl")
        for v in committed(spark, path)
    ]
    return reduce(DataFrame.unionByName, parts, none)
