"""The tables per event type by name, for SQL users: views over one bronze table."""

from __future__ import annotations

from pyspark.sql import SparkSession

from eventweir.functions.envelope import ROUTE_METADATA
from eventweir.functions.labels import VALID
from eventweir.operators.projections import DECODED, payload_fields
from eventweir.plans.config import TopicConfig


def _identifier(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_views(
    spark: SparkSession, bronze_table: str, config: TopicConfig, prefix: str = ""
) -> list[str]:
    """Create ``silver_{type}_{topic}`` and, of valid rows, ``silver_feb_{type}_{topic}``.

    The views select by the partition columns of the bronze table, so a query on one of them reads
    only its partitions.  ``prefix`` keeps payload fields apart from record columns.  Views go to the current database; returns their names.
    """
    fields = payload_fields(spark.table(bronze_table)).names
    columns = [_identifier(name) for name in ROUTE_METADATA]
    columns += [f"{DECODED}.{_identifier(name)} AS {_identifier(prefix + name)}" for name in fields]
    created = []
    for event_type in config.event_types:
        chosen = f"route = {_literal(event_type)}"
        for name, condition in (
            (f"silver_{event_type}_{config.topic}", chosen),
            (f"silver_feb_{event_type}_{config.topic}", f"{chosen} AND outcome = '{VALID}'"),
        ):
            spark.sql(
                f"CREATE OR REPLACE VIEW {_identifier(name)} AS"
                f" SELECT {', '.join(columns)} FROM {bronze_table} WHERE {condition}"
            )
            created.append(name)
    return created
