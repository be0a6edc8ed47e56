"""Tables of spans found in texts: one row per document, an array of finds each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def span_text(found: Column) -> Column:
    """``kind:start:end`` of each find, comma-joined."""
    return F.concat_ws(
        ",", F.transform(found, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"]))
    )


def summary(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """Per document the number of base finds by kind, their digest, and all spans as text."""
    base = F.filter("found", lambda f: f["base"])

    def number(kind: str) -> Column:
        return F.size(F.filter(base, lambda f: f["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind in kinds],
        F.sha2(span_text(base), 256).alias("base_sha256"),
        F.array_join(F.array_distinct(F.split(span_text(F.col("found")), ",")), ",").alias("spans"),
    )
