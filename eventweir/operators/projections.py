"""From envelope to typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from eventweir.functions.decoding import CORRUPT, check_field_names, decode_column, payload_schema
from eventweir.functions.envelope import (
    ROUTE_METADATA,
    TABLE_METADATA,
    metadata_columns,
    payload_text,
)

DECODED = "decodeValue"


def decode(envelope: DataFrame, schema: str | StructType, keep_raw: bool = False) -> DataFrame:
    """Record columns plus the payload as the struct ``decodeValue``.

    ``keep_raw`` keeps the payload text in ``raw`` so a table can be decoded again under another
    schema; without it only text that did not fit is kept, in the corrupt-record field.
    """
    columns = metadata_columns()
    columns.append(decode_column(payload_text(), schema).alias(DECODED))
    if keep_raw:
        columns.append(payload_text().alias("raw"))
    return envelope.select(*columns)


def payload_fields(decoded: DataFrame) -> StructType:
    return payload_schema(decoded.schema[DECODED].dataType)


def row_columns(
    decoded: DataFrame,
    metadata: tuple[str, ...] = TABLE_METADATA,
    prefix: str = "",
    with_corrupt: bool = False,
) -> list[Column]:
    """Record columns followed by one column per payload field.

    A payload field named like a record column is refused unless ``prefix`` tells them apart.
    """
    fields = payload_fields(decoded).fields
    renamed = StructType([StructField(prefix + f.name, f.dataType) for f in fields])
    check_field_names(renamed, metadata)
    columns = [F.col(name) for name in metadata]
    columns += [F.col(DECODED)[f.name].alias(prefix + f.name) for f in fields]
    if with_corrupt:
        columns.append(F.col(DECODED)[CORRUPT].alias(CORRUPT))
    return columns


def flatten(
    decoded: DataFrame, metadata: tuple[str, ...] = TABLE_METADATA, **options
) -> DataFrame:
    return decoded.select(*row_columns(decoded, metadata, **options))


def topic_table(envelope: DataFrame, schema: str | StructType, **options) -> DataFrame:
    """Topic-based projection: all record columns and the payload fields."""
    return flatten(decode(envelope, schema), **options)


def payload_bronze(
    envelope: DataFrame,
    schema: str | StructType,
    type_field: str = "eventType",
    keep_raw: bool = False,
) -> DataFrame:
    """Payload-based projection: record columns, the payload struct, and the lifted event type."""
    fields = payload_schema(schema)
    check_field_names(fields)
    if type_field not in fields.names:
        raise ValueError(f"the payload schema has no field {type_field}")
    return decode(envelope, fields, keep_raw).withColumn("eventType", F.col(DECODED)[type_field])


def route_table(
    routed: DataFrame, metadata: tuple[str, ...] = ROUTE_METADATA, **options
) -> DataFrame:
    """Projection of one event type's table: three record columns and the payload fields."""
    return flatten(routed, metadata, **options)


def redecode(
    bronze: DataFrame, schema: str | StructType, type_field: str = "eventType"
) -> DataFrame:
    """Bronze under another schema, from the payload text that ``keep_raw`` kept."""
    if "raw" not in bronze.columns:
        raise ValueError("only a table written with keep_raw can be decoded again")
    again = bronze.select(
        *TABLE_METADATA, decode_column(F.col("raw"), schema).alias(DECODED), "raw"
    )
    return again.withColumn("eventType", F.col(DECODED)[type_field])
