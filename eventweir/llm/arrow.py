"""Helpers for functions that run over Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Bytes that ``[\x20\x09-\x0D]`` matches.
SPACE_BYTES = b" \t\n\v\f\r"
#: Texts a task holds as Python objects at a time.
SLICE_ROWS = 1024


def texts(column: pa.Array) -> list[str]:
    """The texts of a column; null counts as empty."""
    return [t or "" for t in column.to_pylist()]


def raw_texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a column of texts; null counts as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``SLICE_ROWS`` rows, so that a task holds few texts twice."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(start, SLICE_ROWS)


def with_columns(batch: pa.RecordBatch, keep: list[str], **added: pa.Array) -> pa.RecordBatch:
    """The named columns of a batch and the added ones, in this order."""
    columns = [batch.column(batch.schema.get_field_index(name)) for name in keep]
    return pa.RecordBatch.from_arrays([*columns, *added.values()], names=[*keep, *added])


def schema_of(df, names: list[str], added: str) -> StructType:
    """The schema of some columns of ``df`` followed by columns declared in DDL, all nullable."""
    own = [StructField(name, df.schema[name].dataType) for name in names]
    return StructType(own + StructType.fromDDL(added).fields)


def text_crc32(column: str) -> Column:
    """crc32 of a column's text form; null counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))
