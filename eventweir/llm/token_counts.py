"""Token counts by a two-tier lookup on the map side.

Tier one is a compact table of frequent pre-tokens and their token lengths, broadcast to all tasks.
It is made over all documents: each task keeps a bounded summary of its pre-tokens (rare ones are
dropped when it is full, as in lossy counting) and hands on its most frequent ones only.  Tier two
are the workers' own caches: what the table lacks is encoded once and kept.  No pre-token is ever
shuffled, only those summaries of at most ``per_task`` rows a task; the table has at most ``frequent``
entries.  Counts are exact whatever the table holds, since it saves work only.

Null texts count as empty: no bytes, no tokens.  An empty table gives an empty result; other columns
are passed over; repeated rows are counted each on their own.
"""

from __future__ import annotations

import heapq
import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventweir.llm.arrow import schema_of, slices, texts, with_columns
from eventweir.llm.pretokens import LONGEST_KEPT, Pieces, splitter

#: Entries of the broadcast table: some 1.5 MB.
FREQUENT = 65_536
#: Pre-tokens that a task hands on, and that its summary holds at most.
PER_TASK = 8_192
SUMMARY = 200_000


def _summary(path: str, per_task: int):
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, counts, floor = splitter(path), Counter(), 1
        for batch in slices(batches):
            for text in texts(batch.column(0)):
                counts.update(cut(text))
            while len(counts) > SUMMARY:
                counts = Counter({p: n - floor for p, n in counts.items() if n > floor})
        top = heapq.nsmallest(per_task, counts.items(), key=lambda x: (-x[1], x[0]))
        top = [(p, n) for p, n in top if len(p) <= LONGEST_KEPT]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())],
            names=["piece", "n"],
        )

    return summarise


def frequent_lengths(
    docs: DataFrame, path: str, text: str = "text", frequent: int = FREQUENT, per_task: int = PER_TASK
) -> dict[str, int]:
    """Token lengths of the most frequent pre-tokens, at most ``frequent`` of them."""
    summaries = docs.select(text).mapInArrow(_summary(path, per_task), "piece string, n long")
    top = summaries.groupBy("piece").agg(F.sum("n").alias("n"))
    rows = top.orderBy(F.desc("n"), "piece").limit(frequent).select("piece").collect()
    pieces = Pieces(path, len, most=frequent + 1)
    return {row.piece: pieces[row.piece] for row in rows}


#: The cache of this Python process, by the name its table was given.
_CACHES: dict[str, Pieces] = {}


def _counter(path: str, table, key: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = splitter(path)
        if key not in _CACHES:
            joined, lengths = table.value
            words = joined.split("\0") if lengths else []
            _CACHES.clear()
            _CACHES[key] = Pieces(path, len, fixed=dict(zip(words, lengths, strict=True)))
        length = _CACHES[key].__getitem__
        for batch in slices(batches):
            own = texts(batch.column(batch.schema.get_field_index("text")))
            keep = [c for c in batch.schema.names if c != "text"]
            yield with_columns(
                batch,
                keep,
                n_bytes=pa.array([len(t.encode()) for t in own], pa.int64()),
                n_tokens=pa.array([sum(map(length, cut(t))) for t in own], pa.int64()),
            )

    return count


def token_counts(
    docs: DataFrame,
    path: str,
    limit: int,
    doc_id: str = "doc_id",
    text: str = "text",
    frequent: int = FREQUENT,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether the tokens are more than ``limit``."""
    lengths = frequent_lengths(docs, path, text, frequent)
    compact = {p: n for p, n in lengths.items() if "\0" not in p}
    table = docs.sparkSession.sparkContext.broadcast(
        ("\0".join(compact), list(compact.values()))
    )
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = schema_of(rows, ["doc_id"], "n_bytes long, n_tokens long")
    counted = rows.mapInArrow(_counter(path, table, uuid.uuid4().hex), schema)
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
