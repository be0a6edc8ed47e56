"""JSON payload decoding with a declared schema."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def payload_schema(ddl: str | T.StructType) -> T.StructType:
    """A payload schema from ``name type, ...`` or ``struct<name:type,...>`` text."""
    parsed = T.StructType.fromDDL(ddl) if isinstance(ddl, str) else ddl
    if not isinstance(parsed, T.StructType):
        raise ValueError(f"a payload schema must be a struct, got {parsed.simpleString()}")
    return T.StructType([f for f in parsed.fields if f.name != CORRUPT])


def decode_column(text: Column, schema: str | T.StructType) -> Column:
    """Parse JSON text to a struct that also holds the text of records that do not fit.

    The corrupt-record option is given by name on purpose: Catalyst prunes the fields of
    ``from_json`` only when it has no options, and a pruned schema would no longer see type errors
    in the fields it dropped.
    """
    full = payload_schema(schema).add(CORRUPT, T.StringType())
    return F.from_json(text, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def check_field_names(schema: T.StructType, reserved: tuple[str, ...] = ()) -> None:
    """Refuse names that a table cannot hold together: equal to another but for case."""
    _check_level(schema, tuple(reserved), "")


def _check_level(schema: T.StructType, reserved: tuple[str, ...], path: str) -> None:
    taken = {name.lower() for name in reserved}
    clashes = [f.name for f in schema.fields if f.name.lower() in taken]
    if clashes:
        raise ValueError(f"payload fields clash with record columns: {', '.join(clashes)}")
    seen = Counter(f.name.lower() for f in schema.fields)
    doubled = [path + f.name for f in schema.fields if seen[f.name.lower()] > 1]
    if doubled:
        raise ValueError(f"payload fields differ only by case: {', '.join(doubled)}")
    for field in schema.fields:
        inner = field.dataType
        while isinstance(inner, T.ArrayType):
            inner = inner.elementType
        if isinstance(inner, T.StructType):
            _check_level(inner, (), f"{path}{field.name}.")
