"""Append with schema merge: tables whose later parts have more columns."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from eventweir.functions.decoding import check_field_names
from eventweir.versions import newest, update
from eventweir.workspace import matching_paths


SCHEMA_FOLDER = "_schema"
_KEPT = "value string"


def merge_types(known: T.DataType, new: T.DataType, path: str) -> T.DataType:
    """``known`` with the nested fields that only ``new`` has; refused if a type changes."""
    if isinstance(known, T.StructType) and isinstance(new, T.StructType):
        return merge_schemas(known, new, f"{path}.")
    if isinstance(known, T.ArrayType) and isinstance(new, T.ArrayType):
        element = merge_types(known.elementType, new.elementType, f"{path}[]")
        return T.ArrayType(element, known.containsNull or new.containsNull)
    if known != new:
        raise ValueError(
            f"column {path} is {known.simpleString()}, cannot append {new.simpleString()}"
        )
    return known


def merge_schemas(known: T.StructType, new: T.StructType, path: str = "") -> T.StructType:
    """``known`` with the columns and nested fields that only ``new`` has, appended by name.

    Names that differ only by case are the same column to Spark, so they are refused, as is a
    column that changes its type, also inside objects and arrays.
    """
    merged = []
    added = {f.name: f for f in new.fields}
    for field in known.fields:
        other = added.pop(field.name, None)
        if other is None:
            merged.append(field)
        else:
            kind = merge_types(field.dataType, other.dataType, path + field.name)
            merged.append(T.StructField(field.name, kind, True))
    merged += added.values()
    check_field_names(T.StructType(merged))
    return T.StructType(merged)


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema kept beside a table, if there is one."""
    _, kept = newest(spark, f"{path}/{SCHEMA_FOLDER}", _KEPT)
    if kept is not None:
        return _schema_of(kept)
    if not matching_paths(spark, f"{path}/{SCHEMA_FOLDER}/_SUCCESS"):
        return None
    # tables from before schemas had versions
    return _schema_of(spark.read.text(f"{path}/{SCHEMA_FOLDER}", wholetext=True))


def _schema_of(kept: DataFrame) -> T.StructType:
    return T.StructType.fromJson(json.loads(kept.first().value))


def keep_schema(spark: SparkSession, path: str, new: T.StructType) -> T.StructType:
    """Merge a schema into the one kept beside a table; refused if they do not go together.

    Every change is a version, so at no time is there none, and of two writers the later one merges
    its schema into the earlier one's.
    """

    def change(kept: DataFrame | None) -> DataFrame | None:
        known = stored_schema(spark, path) if kept is None else _schema_of(kept)
        merged = merge_schemas(known or new, new)
        if known == merged and kept is not None:
            return None
        return spark.createDataFrame([(merged.json(),)], _KEPT).coalesce(1)

    update(spark, f"{path}/{SCHEMA_FOLDER}", _KEPT, change)
    return stored_schema(spark, path)


def append_evolving(df: DataFrame, path: str, known: T.StructType | None = None) -> T.StructType:
    """Append ``df`` and return the table's schema with it.

    The schema is kept beside the table and compared before anything is written, so an append that
    does not fit leaves the table as it was.
    """
    new = merge_schemas(known, df.schema) if known else df.schema
    merged = keep_schema(df.sparkSession, path, new)
    df.write.mode("append").parquet(path)
    return merged


def read_evolving(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All parts by name, NULL where a part lacks a column.

    With the schema that is kept from the appends no footer is read; tables without one are read by
    merging the footers of all files.
    """
    schema = schema or stored_schema(spark, path)
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", True).parquet(path)


def add_missing_columns(spark: SparkSession, table: str, schema: T.StructType) -> list[str]:
    """Add the columns that a catalog table lacks; returns their names."""
    present = {f.name.lower() for f in spark.table(table).schema.fields}
    missing = [f for f in schema.fields if f.name.lower() not in present]
    if missing:
        columns = ", ".join(
            f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in missing
        )
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    return [f.name for f in missing]


def reconcile_table(spark: SparkSession, table: str, schema: T.StructType) -> list[str]:
    """Bring a catalog table up to a stream's schema before the stream starts; the columns added.

    A changed type is refused, also inside objects.  So is a further field inside an object: Spark
    adds only whole columns to tables of files.  A table that is not there yet is left to the sink.
    """
    if not spark.catalog.tableExists(table):
        return []
    known = spark.table(table).schema
    merged = merge_schemas(known, schema)
    grown = [f.name for f in known.fields if merged[f.name].dataType != _nullable(f.dataType)]
    if grown:
        raise ValueError(f"{table}: fields inside {', '.join(grown)} cannot be added to")
    return add_missing_columns(spark, table, schema)


def _nullable(kind: T.DataType) -> T.DataType:
    """A type as merging leaves it."""
    return merge_types(kind, kind, "")
