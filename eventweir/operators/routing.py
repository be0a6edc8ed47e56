"""Which table a record belongs to.

``label`` puts two short columns on bronze, ``route`` and ``outcome``.  Bronze is written once,
partitioned by them; every route, the valid and faulty tables and the rejects are then
partition-pruned reads of that one table: one decode and one write for all targets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from eventweir.functions.decoding import CORRUPT
from eventweir.functions.labels import (
    FAULTY,
    PARTIAL,
    UNDETERMINED,
    UNROUTED,
    VALID,
    outcome_label,
    route_label,
    unrouted_reason,
)
from eventweir.operators.projections import DECODED, payload_fields, route_table

LABELS = ("route", "outcome")


def label_folders(event_types: Sequence[str]) -> int:
    """How many folders a table partitioned by the labels has at most."""
    return 4 * len(event_types) + 1


def label(
    bronze: DataFrame, event_types: Sequence[str], code_field: str = "error_code"
) -> DataFrame:
    """Add ``route`` and ``outcome`` to a bronze DataFrame.

    Every record gets exactly one pair, so the targets add up to the input.  A payload without the
    code field leaves the outcome undetermined.  A record that has lost fields, as they did not fit
    their types, is ``partial`` unless its code says faulty.
    """
    fields = payload_fields(bronze)
    if code_field in fields.names:
        is_text = isinstance(fields[code_field].dataType, StringType)
        outcome = outcome_label(F.col(DECODED)[code_field], is_text)
    else:
        outcome = F.lit(UNDETERMINED)
    lost_fields = F.col(DECODED)[CORRUPT].isNotNull()
    outcome = F.when((outcome != FAULTY) & lost_fields, F.lit(PARTIAL)).otherwise(outcome)
    return bronze.withColumn("route", route_label(F.col("eventType"), event_types)).withColumn(
        "outcome", F.when(F.col("route") == UNROUTED, UNROUTED).otherwise(outcome)
    )


def route(labelled: DataFrame, event_type: str, **options) -> DataFrame:
    """The table of one event type."""
    return route_table(labelled.where(F.col("route") == event_type), **options)


def valid(labelled: DataFrame, event_type: str | None = None, **options) -> DataFrame:
    """Routed records with code 0, of all event types or of one."""
    return _with_outcome(labelled, VALID, event_type, **options)


def faulty(labelled: DataFrame, event_type: str | None = None, **options) -> DataFrame:
    return _with_outcome(labelled, FAULTY, event_type, **options)


def undetermined(labelled: DataFrame, event_type: str | None = None, **options) -> DataFrame:
    """Routed records whose code is missing or not a whole number."""
    return _with_outcome(labelled, UNDETERMINED, event_type, **options)


def partial(labelled: DataFrame, event_type: str | None = None) -> DataFrame:
    """Routed records some of whose fields did not fit their types, with the text they came as."""
    return _with_outcome(labelled, PARTIAL, event_type, with_corrupt=True)


def _with_outcome(
    labelled: DataFrame, outcome: str, event_type: str | None, **options
) -> DataFrame:
    chosen = F.col("outcome") == outcome
    if event_type is not None:
        chosen &= F.col("route") == event_type
    return route_table(labelled.where(chosen), **options)


def unrouted(labelled: DataFrame) -> DataFrame:
    """Records without a listed event type: position, reason, and the text where it was kept."""
    corrupt = F.col(DECODED)[CORRUPT]
    text = F.col("raw") if "raw" in labelled.columns else corrupt
    return labelled.where(F.col("route") == UNROUTED).select(
        "key",
        "topic",
        "partition",
        "offset",
        "eventTime",
        "eventType",
        unrouted_reason(F.col("eventType"), corrupt).alias("reason"),
        text.alias("raw"),
    )


def rejects(labelled: DataFrame) -> DataFrame:
    """All records that are in no valid table, each with its reason and original text.

    Faulty, undetermined and partial ones have their outcome as reason, unrouted ones why they have
    no route.  Where the text was not kept, a fully decoded payload is written out again.
    """
    corrupt = F.col(DECODED)[CORRUPT]
    payload = F.to_json(F.col(DECODED).dropFields(CORRUPT))
    text = F.coalesce(F.col("raw") if "raw" in labelled.columns else corrupt, payload)
    reason = F.when(
        F.col("route") == UNROUTED, unrouted_reason(F.col("eventType"), corrupt)
    ).otherwise(F.col("outcome"))
    return labelled.where(F.col("outcome") != VALID).select(
        "key",
        "topic",
        "partition",
        "offset",
        "eventTime",
        "eventType",
        reason.alias("reason"),
        text.alias("raw"),
    )


QUARANTINE_POLICIES = {
    "quarantine_undetermined": (FAULTY, UNDETERMINED, PARTIAL),
    "faulty_only": (FAULTY,),
}


def quarantined(
    labelled: DataFrame, policy: str = "quarantine_undetermined", **options
) -> DataFrame:
    """Records for the quarantine topic.

    ``faulty_only`` sends records with a non-zero code; the undetermined ones then stay in the
    table under their own outcome.
    """
    outcomes = QUARANTINE_POLICIES[policy]
    return route_table(labelled.where(F.col("outcome").isin(list(outcomes))), **options)


def conservation(labelled: DataFrame) -> DataFrame:
    """Per event type: records and distinct source positions, to compare with the source.

    Positions are counted exactly, as bits of words that stand for 64 offsets each.  Sources are
    read in offset order, so a task turns many records into one word by hash aggregation; the words
    are spread by offset, not by event type, so a type that holds most of the records is no hot
    task.  Whatever the types, there is never more than one word per record.
    """
    place = F.col("offset").bitwiseAND(63).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place)
    words = labelled.groupBy(
        "eventType", "topic", "partition", F.shiftright("offset", 6).alias("_word")
    ).agg(F.count("*").alias("_records"), F.bit_or(bit).alias("_seen"))
    return words.groupBy("eventType").agg(
        F.sum("_records").alias("records"),
        F.sum(F.bit_count("_seen").cast("long")).alias("positions"),
    )
