"""Variant type text (``OBJECT<a: BIGINT>``) to Spark type text (``struct<a:bigint>``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How sampled JSON types are declared.  Always-null and mixed values become text,
# fractions become double, an object never seen with a field has nothing to declare.
_DECLARED_AS = (
    (r"OBJECT(?=<)", "struct"),
    (r"ARRAY(?=<)", "array"),
    (r"DECIMAL\(\d+,\s*\d+\)", "double"),
    (r"DOUBLE", "double"),
    (r"FLOAT", "double"),
    (r"BIGINT", "bigint"),
    (r"BOOLEAN", "boolean"),
    (r"STRING", "string"),
    (r"VARIANT", "string"),
)


def declared_type(
    variant_type: Column, null_as: str = "string", empty_as: str = "string"
) -> Column:
    """Rewrite a variant type, leaving quoted field names alone.

    ``null_as`` and ``empty_as`` name the types of what was always null and of empty objects.

    Splitting at back-quotes puts quoted names at the odd positions (a doubled quote inside a name
    gives an empty even one).  Outside quotes a name is always followed by a colon, a type never.
    """

    def rewrite(part: Column) -> Column:
        for found, declared in ((r"OBJECT<>", empty_as), *_DECLARED_AS, (r"VOID", null_as)):
            whole_word = rf"(?<![A-Za-z0-9_]){found}(?![A-Za-z0-9_:])"
            part = F.regexp_replace(part, whole_word, declared)
        return F.regexp_replace(part, r"([:,]) ", "$1")

    parts = F.transform(
        F.split(variant_type, "`"),
        lambda part, i: F.when(i % 2 == 0, rewrite(part)).otherwise(part),
    )
    return F.array_join(parts, "`")
