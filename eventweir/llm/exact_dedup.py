"""Exact duplicates by content sort.

The order of documents is that of their normalised bytes, then most code points, then smallest id
(null ids last).  Sampled splitters cut it into ranges, one a task; an external sort in each of them
puts equal texts next to each other, the best document first, and neighbours are compared in full.

A splitter is the shortest head that tells a sampled text from the sampled text below it, so all
copies of a text stay on one side.  Only where both are equal is a splitter a whole text with code
points and id: such a text fills a range, and its copies are spread over several.  Every row is
compared with these splitters in full, and so the pieces of a spread group are known by the splitter
they equal, one row a piece and no more pieces than ranges.  Of texts of over ``HEAD_BYTES`` splitters
hold the head and the digest of the whole, which stands for the order of what follows the head when
ranges are chosen; in a range they too are sorted and compared by their whole bytes.  Splitters are
fixed before the rows are dealt, so a task that runs again deals them the same way.

Texts are equal when identical after deleting every character of ``[\\x20\\x09-\\x0D]``; null counts
as the empty text.  Of equal texts the row with the most code points stays, then the one with the
smallest id (null ids last), then any one of rows that repeat the same id and text.  Texts may be of
any length.  An empty table gives an empty result; further columns, whatever their names, are passed
over (``groups``) or kept (``distinct_rows``).
"""

from __future__ import annotations

import hashlib
import os
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from eventweir.llm.arrow import SLICE_ROWS, SPACE_BYTES, raw_texts, slices
from eventweir.operators.numbering import number_rows
from eventweir.workspace import materialise

#: Bytes of a normalised text that a splitter holds at most.
HEAD_BYTES = 16_384
#: Sampled rows to a range, about.
SAMPLE_ROWS = 20
_SPACES = SPACE_BYTES.decode()
_BEFORE_ALL = (b"", float("-inf"))


def _normal(text: str) -> F.Column:
    return F.translate(F.coalesce(F.col(text), F.lit("")), _SPACES, "").cast("binary")


def _key(head: bytes, rest: bytes, points: int, row_id) -> tuple:
    """The place of a row in the order that ranges are cut from."""
    return head, rest, -points, row_id is None, row_id


def _splitter(below: tuple, key: tuple) -> tuple:
    """What divides a sampled row from the one below it: a head as short as can be, or its whole key."""
    if below[0] == key[0]:
        return key
    same = len(os.path.commonprefix([below[0], key[0]]))
    return key[0][: same + 1], *_BEFORE_ALL


def splitters(docs: DataFrame, doc_id: str, text: str) -> list[tuple]:
    """Sorted splitters for ``spark.sql.shuffle.partitions`` ranges of about as many rows each."""
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.count()
    if rows == 0 or ranges < 2:
        return []
    normal = _normal(text)
    sample = docs.sample(min(1.0, ranges * SAMPLE_ROWS / rows), seed=1).select(
        F.substring(normal, 1, HEAD_BYTES).alias("head"),
        F.when(F.octet_length(normal) > HEAD_BYTES, F.unhex(F.sha2(normal, 256)))
        .otherwise(F.lit(b""))
        .alias("rest"),
        F.char_length(F.coalesce(F.col(text), F.lit(""))).alias("points"),
        F.col(doc_id).alias("id"),
    )
    order = [F.col("head"), F.col("rest"), F.desc("points"), F.asc_nulls_last("id")]
    placed, _ = number_rows(sample, order, "place")
    step = max(1, -(-placed.count() // ranges))
    near = placed.filter((F.col("place") % step).isin(0, step - 1)).collect()
    keys = {r.place: _key(bytes(r.head), bytes(r.rest), r.points, r.id) for r in near}
    cut = [p for p in sorted(keys) if p % step == 0 and p - 1 in keys]
    return [_splitter(keys[p - 1], keys[p]) for p in cut]


class _Ranges:
    """The range of a row, and the first splitter that its text equals, if one does."""

    def __init__(self, cuts: list[tuple]):
        self.cuts = cuts
        self.spread: dict[tuple, int] = {}
        for number, cut in enumerate(cuts):
            if len(cut) > 3:
                self.spread.setdefault(cut[:2], number)

    def place(self, raw: bytes, points: int, row_id) -> tuple[int, int | None]:
        rest = hashlib.sha256(raw).digest() if len(raw) > HEAD_BYTES else b""
        key = _key(raw[:HEAD_BYTES], rest, points, row_id)
        return bisect_right(self.cuts, key), self.spread.get(key[:2])


def _dealt(cuts, schema: pa.Schema):
    """Rows with their range and splitter; ``normal`` instead of the text where the schema asks it."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = _Ranges(cuts.value)
        for batch in slices(batches):
            normal = [raw.translate(None, SPACE_BYTES) for raw in raw_texts(batch.column("whole"))]
            points, ids = batch.column("points").to_pylist(), batch.column("id").to_pylist()
            placed = [ranges.place(*row) for row in zip(normal, points, ids, strict=True)]
            added = {
                "part": [part for part, _ in placed],
                "split": [split for _, split in placed],
                "normal": normal,
            }
            arrays = [
                pa.array(added[f.name], f.type) if f.name in added else batch.column(f.name)
                for f in schema
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return deal


def _sorted_by_content(docs: DataFrame, columns: list[str], doc_id: str, text: str) -> DataFrame:
    """part, split, points, id, normal and, of the columns, one struct ``row``, sorted in ranges."""
    cuts = splitters(docs, doc_id, text)
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("id"),
        F.char_length(whole).alias("points"),
        *([F.struct(*[F.col(c) for c in columns]).alias("row")] if columns else []),
        whole.alias("whole"),
    )
    added = StructType.fromDDL("part int, split int" + ("" if columns else ", normal binary"))
    schema = StructType([f for f in rows.schema if f.name != "whole"] + added.fields)
    shipped = docs.sparkSession.sparkContext.broadcast(cuts)
    dealt = rows.mapInArrow(_dealt(shipped, to_arrow_schema(schema)), schema)
    dealt = dealt.repartitionById(len(cuts) + 1, "part")
    if columns:
        dealt = dealt.withColumn("whole", F.col("row").getField(text))
        dealt = dealt.withColumn("normal", _normal("whole")).drop("whole")
    return dealt.sortWithinPartitions("normal", F.desc("points"), F.asc_nulls_last("id"))


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes], list[bool]]]:
    """Each batch with its texts and a mark on the rows whose text differs from the row above."""
    above = None
    for batch in slices(batches):
        normal, starts = batch.column("normal").to_pylist(), []
        for raw in normal:
            starts.append(raw != above)
            above = raw
        yield batch, normal, starts


def _runs(schema: pa.Schema):
    """Rows of each sorted range with the first id and the length of their run."""

    def run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        ids: list = []
        of_run: tuple = ()

        def ended() -> None:
            rows.extend((row_id, ids[0], len(ids), *of_run, i == 0) for i, row_id in enumerate(ids))

        def packed() -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        for batch, normal, starts in _marked(batches):
            others = (batch.column(c).to_pylist() for c in ("id", "part", "split"))
            for starts_run, raw, row_id, part, split in zip(starts, normal, *others, strict=True):
                if starts_run:
                    if ids:
                        ended()
                    ids, of_run = [], (hashlib.sha256(raw).hexdigest(), part, split)
                ids.append(row_id)
            if len(rows) >= SLICE_ROWS:
                yield packed()
                rows.clear()
        if ids:
            ended()
        if rows:
            yield packed()

    return run_rows


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its group's kept id and size, whether it stays, the text's digest."""
    ordered = _sorted_by_content(docs, [], doc_id, text)
    kind = docs.schema[doc_id].dataType
    schema = StructType().add("doc_id", kind).add("head_id", kind)
    for field in StructType.fromDDL("run long, text_sha256 string, part int, split int, first boolean"):
        schema = schema.add(field)
    runs = ordered.select("id", "normal", "part", "split").mapInArrow(
        _runs(to_arrow_schema(schema)), schema
    )
    runs = materialise(runs, "content-runs")
    pieces = (
        runs.filter("first and split is not null")
        .groupBy("split")
        .agg(
            F.min_by("head_id", "part").alias("whole_id"),
            F.min("part").alias("whole_part"),
            F.sum("run").alias("whole_size"),
        )
    )
    stays = F.col("first") & (F.col("whole_part").isNull() | (F.col("part") == F.col("whole_part")))
    return runs.join(F.broadcast(pieces), "split", "left").select(
        "doc_id",
        F.when(F.col("whole_part").isNull(), F.col("head_id"))
        .otherwise(F.col("whole_id"))
        .alias("keep_id"),
        F.coalesce("whole_size", "run").alias("group_size"),
        stays.alias("kept"),
        "text_sha256",
    )


def _first_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of each run."""
    for batch, _, starts in _marked(batches):
        firsts = batch.filter(pa.array(starts, pa.bool_()))
        if firsts.num_rows:
            yield firsts.select(["row", "part", "split"])


def distinct_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    ordered = _sorted_by_content(docs, docs.columns, doc_id, text)
    schema = StructType([ordered.schema[c] for c in ("row", "part", "split")])
    firsts = ordered.select("row", "normal", "part", "split").mapInArrow(_first_rows, schema)
    firsts = materialise(firsts, "first-rows")
    later = (
        firsts.filter("split is not null")
        .select("split", "part")
        .withColumn("earlier", F.min("part").over(Window.partitionBy("split")))
        .filter("part > earlier")
        .select("split", "part")
    )
    return firsts.join(F.broadcast(later), ["split", "part"], "left_anti").select("row.*")
