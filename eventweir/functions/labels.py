"""Labels that decide where a record goes: its route, its outcome, why it has no route."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

UNROUTED = "_unrouted"

VALID = "valid"
FAULTY = "faulty"
UNDETERMINED = "undetermined"
PARTIAL = "partial"

JSON_SPACE = " \t\r\n"

# Names that a partition folder cannot give back: it reads them as NULL.
RESERVED_TYPES = (UNROUTED, "", "__HIVE_DEFAULT_PARTITION__")


def route_label(event_type: Column, event_types: Sequence[str]) -> Column:
    """The event type if it is a listed one, else ``_unrouted``.

    Used as partition column instead of the raw type: a stream of garbage types cannot create more
    folders than there are listed types, and no record ends up without a folder.
    """
    refused = [repr(t) for t in event_types if t in RESERVED_TYPES]
    if refused:
        raise ValueError(f"not usable as an event type: {', '.join(refused)}")
    return F.when(event_type.isin(list(event_types)), event_type).otherwise(F.lit(UNROUTED))


# What ``try_cast`` reads as a whole number, bar overflow.
_WHOLE_NUMBER = r"^[\s\p{Cntrl}]*[-+]?[0-9]+[\s\p{Cntrl}]*$"


def outcome_label(code: Column, is_text: bool = True) -> Column:
    """``valid`` for code 0, ``faulty`` for any other number, else ``undetermined``.

    Codes that are numbers are compared as they are: 0.4 is faulty, not a number undetermined.  Text
    has to be a whole number.  Codes are text in practice.  A plain comparison with 0 would fail the job on the first
    non-numeric code under ANSI rules and lose the row without them.  Text is matched before it is
    cast because a failing ``try_cast`` throws and catches an exception per row.
    """
    if is_text:
        number = F.when(code.rlike(_WHOLE_NUMBER), code.try_cast("bigint"))
    else:
        number = F.nanvl(code.try_cast("double"), F.lit(None).cast("double"))
    return (
        F.when(number == 0, F.lit(VALID))
        .when(number.isNotNull(), F.lit(FAULTY))
        .otherwise(F.lit(UNDETERMINED))
    )


def unrouted_reason(event_type: Column, corrupt: Column) -> Column:
    """Why a record has no route.

    Any field that does not fit its type leaves text in ``corrupt``; only text that is no JSON
    object is malformed.  It is parsed again for the few unrouted records with such text.
    """
    is_json = F.ltrim(corrupt, F.lit(JSON_SPACE)).startswith("{")
    is_json &= F.get_json_object(corrupt, "$").isNotNull()
    return (
        F.when(event_type.isNotNull(), F.lit("unknown_type"))
        .when(corrupt.isNotNull() & ~is_json, F.lit("malformed"))
        .otherwise(F.lit("no_type"))
    )
