"""What a declared schema leaves of a payload: undeclared fields, and values that do not fit."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventweir.functions.decoding import payload_schema
from eventweir.functions.labels import JSON_SPACE

_FRACTIONS = (T.FloatType, T.DoubleType, T.DecimalType)


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _fits(value: Column, kind: T.DataType) -> Column:
    """Whether a value decodes to its declared type with nothing lost; null fits every type."""
    observed = F.schema_of_variant(value)
    null = observed == "VOID"
    if isinstance(kind, T.StringType):
        return F.lit(True)  # as its JSON text
    if isinstance(kind, T.StructType):
        return null | (observed.startswith("OBJECT") & _rest(value, kind).isNull())
    if isinstance(kind, T.ArrayType):
        inside = F.forall(
            F.try_variant_get(value, "$", "array<variant>"),
            lambda element: _fits(element, kind.elementType),
        )
        return null | (observed.startswith("ARRAY") & F.coalesce(inside, F.lit(False)))
    if isinstance(kind, T.MapType):
        inside = F.forall(
            F.map_values(F.try_variant_get(value, "$", "map<string,variant>")),
            lambda element: _fits(element, kind.valueType),
        )
        return null | (observed.startswith("OBJECT") & F.coalesce(inside, F.lit(False)))
    cast = F.try_variant_get(value, "$", kind.simpleString()).isNotNull()
    if isinstance(kind, T.BooleanType):
        return null | (observed == "BOOLEAN")
    if isinstance(kind, _FRACTIONS):
        number = observed.isin("BIGINT", "DOUBLE", "FLOAT") | observed.startswith("DECIMAL")
        return null | (number & cast)
    if isinstance(kind, T.IntegralType):
        return null | ((observed == "BIGINT") & cast)
    return null | ((observed == "STRING") & cast)


def _rest(value: Column, schema: T.StructType) -> Column:
    """An object without the declared fields that fit, as a variant; NULL if nothing is left."""

    def left(name: Column, inner: Column) -> Column:
        chosen = F.when(F.lit(False), inner)
        for field in schema.fields:
            kind = field.dataType
            if isinstance(kind, T.StructType):
                observed = F.schema_of_variant(inner)
                part = F.when(observed.startswith("OBJECT"), _rest(inner, kind))
                part = part.when(observed != "VOID", inner)
            else:
                part = F.when(~_fits(inner, kind), inner)
            chosen = chosen.when(name == field.name, part)
        return chosen.otherwise(inner)

    def kept(fields: Column) -> Column:
        rest = F.map_filter(F.transform_values(fields, left), lambda _, inner: inner.isNotNull())
        return _once(rest, lambda m: F.when(F.size(m) > 0, F.to_variant_object(m)))

    return kept(F.try_variant_get(value, "$", "map<string,variant>"))


def rescued(text: Column, schema: str | T.StructType) -> Column:
    """The JSON of what decoding by ``schema`` leaves behind, NULL if nothing.

    Undeclared fields at any depth, and the values of declared ones that do not decode: a word where
    a number is declared, a number out of range, an array one of whose elements does not fit (as a
    whole).  Laid over the decoded fields it gives the payload again, up to fields that are null.
    Payloads that are no well-formed object, or name a key twice, come back as their whole text.
    """
    fields = payload_schema(schema)
    is_object = F.ltrim(text, F.lit(JSON_SPACE)).startswith("{")
    parsed = F.when(is_object, F.try_parse_json(text))

    def of(payload: Column) -> Column:
        return F.when(payload.isNull(), text).otherwise(F.to_json(_rest(payload, fields)))

    return _once(parsed, of)
