"""Benchmark decontamination by Wu-Manber search for many strings at once.

Texts are lower-cased (A-Z) and cut into words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``; joined by
single spaces, with one at either end, an item's windows of consecutive words become plain byte
strings.  Strings are searched by classes of similar length.  Per class, ``m`` is its shortest
length: a shift table over the blocks of the strings' first ``m`` bytes tells how far a search may
jump, a block that ends such a head opens a bucket of strings, and direct comparison confirms them.

The windows are made in tasks and written, and dealt by hash to as many blocks as they have
``block_bytes``, about that size each.  Blocks are broadcast one after the other and searched for in
all documents, so memory does not grow with the benchmark, nor with one item of it, only with the
longest window.  One block, the usual case, needs no shuffle of documents.

Null or wordless texts have no words: they are never hit and never hit others.  Items with a null
id contaminate like others and are listed as the empty text; repeated item ids are listed once.
An empty benchmark leaves every document clean, an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from eventweir.llm.arrow import SLICE_ROWS, raw_texts, slices
from eventweir.workspace import fresh_path, materialise, read_written, write_table

WINDOW = 13
#: A document is contaminated when at least one in so many of its words is hit.
SHARE = 20
#: Bytes of a block of the shift tables; strings shorter than two blocks use single bytes.
BLOCK = 8
#: Bytes of benchmark windows that are searched for at a time, about.
BLOCK_BYTES = 16 << 20

_FOUND = "n_words long, spans array<struct<a:long,b:long>>, items array<string>"
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def words(raw: bytes) -> list[bytes]:
    """The lower-cased words of a text's UTF-8 bytes."""
    return raw.translate(_WORD_BYTES).split()


def windows(item: list[bytes], size: int) -> Iterator[bytes]:
    """The windows of an item as byte strings, a space at either end."""
    for i in range(max(1, len(item) - size + 1) if item else 0):
        yield b" " + b" ".join(item[i : i + size]) + b" "


class Matcher:
    """Finds the starts of all given byte strings, each beginning with a space, in one text."""

    def __init__(self, strings: list[bytes]):
        self._classes = []
        by_size = defaultdict(list)
        for string in strings:
            by_size[len(string).bit_length()].append(string)
        for some in by_size.values():
            m = min(map(len, some))
            block = BLOCK if m >= 2 * BLOCK else 1
            shift: dict[bytes, int] = {}
            bucket = defaultdict(list)
            for string in some:
                for end in range(block, m + 1):
                    piece = string[end - block : end]
                    shift[piece] = min(shift.get(piece, m), m - end)
                bucket[string[m - block : m]].append(string)
            self._classes.append((m, block, shift, dict(bucket)))

    def find(self, text: bytes) -> Iterator[tuple[int, bytes]]:
        for m, block, shift, bucket in self._classes:
            far, end, size = m - block + 1, m, len(text)
            jump = shift.get
            while end <= size:
                piece = text[end - block : end]
                step = jump(piece, far)
                if step:
                    end += step
                    continue
                start = end - m
                for string in bucket[piece]:
                    if text.startswith(string, start):
                        yield start, string
                end += 1


def hits(text: bytes, matcher: Matcher) -> tuple[list[tuple[int, int]], set[bytes]]:
    """Merged intervals of words that windows cover, and the windows found."""
    starts, found = [], set()
    for start, string in matcher.find(text):
        starts.append((start, string.count(b" ") - 1))
        found.add(string)
    spans: list[list[int]] = []
    at = word = 0
    for start, length in sorted(starts):
        word += text.count(b" ", at, start)
        at = start
        if spans and word <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], word + length)
        else:
            spans.append([word, word + length])
    return [(a, b) for a, b in spans], found


#: The matcher of this Python process, by the name its broadcast was given.
_MATCHERS: dict[str, tuple] = {}


def _matcher(block, name: str) -> tuple[Matcher, dict[bytes, list[str]]]:
    if name not in _MATCHERS:
        owners: dict[bytes, list[str]] = defaultdict(list)
        for item, string in block.value:
            owners[string].append(item)
        _MATCHERS.clear()
        _MATCHERS[name] = Matcher(list(owners)), dict(owners)
    return _MATCHERS[name]


def _search(block, name: str, carried: StructType, schema: pa.Schema):
    """Words, hit intervals and items of each document, for one block of strings."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, owners = _matcher(block, name)
        for batch in slices(batches):
            columns: tuple[list, list, list] = ([], [], [])
            for raw in raw_texts(batch.column("text")):
                own = words(raw)
                spans, found = hits(b" " + b" ".join(own) + b" ", matcher) if own else ([], ())
                columns[0].append(len(own))
                columns[1].append([{"a": a, "b": b} for a, b in spans])
                columns[2].append(sorted({i for string in found for i in owners[string]}))
            arrays = [batch.column(c) for c in carried.names]
            for values, field in zip(columns, list(schema)[len(arrays) :], strict=True):
                arrays.append(pa.array(values, field.type))
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return search


def _window_rows(size: int, schema: pa.Schema):
    """A row per window of each item."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            items = batch.column("item").to_pylist()
            for item, raw in zip(items, raw_texts(batch.column("raw")), strict=True):
                strings = windows(words(raw), size)
                while some := list(islice(strings, SLICE_ROWS)):
                    arrays = [pa.array([item] * len(some)), pa.array(some, pa.binary())]
                    yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return rows


def _blocks(
    benchmark: DataFrame, item_id: str, text: str, size: int, block_bytes: int
) -> Iterator[list[tuple[str, bytes]]]:
    """Windows of the benchmark with their items, a block at a time; one empty block for none."""
    rows = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"),
        F.col(text).cast("binary").alias("raw"),
    ).filter("raw is not null")
    schema = StructType.fromDDL("item string, string binary")
    made = rows.mapInArrow(_window_rows(size, to_arrow_schema(schema)), schema)
    made = materialise(made.distinct(), "windows")
    total = made.agg(F.coalesce(F.sum(F.octet_length("string")), F.lit(0)).alias("n")).first().n
    count = max(1, -(-total // block_bytes))
    dealt = made.withColumn("block", F.pmod(F.xxhash64("string", "item"), F.lit(count)))
    for number in range(count):
        found = dealt.filter(F.col("block") == number).select("item", "string").collect()
        if found or count == 1:
            yield [(r.item, bytes(r.string)) for r in found]


def _merged(spans: F.Column) -> F.Column:
    """Number of words that sorted intervals cover together."""
    empty = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))

    def add(seen, span):
        from_word = F.greatest(seen["end"], span["a"])
        return F.struct(
            F.greatest(seen["end"], span["b"]).alias("end"),
            (seen["n"] + F.greatest(F.lit(0).cast("long"), span["b"] - from_word)).alias("n"),
        )

    return F.aggregate(F.array_sort(spans), empty, add)["n"]


def _searched(rows: DataFrame, names: list[str], block: list) -> DataFrame:
    """Some columns of the rows with n_words, spans and items for one block of strings."""
    own = StructType([rows.schema[c] for c in names])
    schema = StructType(own.fields + StructType.fromDDL(_FOUND).fields)
    shipped = rows.sparkSession.sparkContext.broadcast(block)
    search = _search(shipped, uuid.uuid4().hex, own, to_arrow_schema(schema))
    return rows.select(*names, "text").mapInArrow(search, schema)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
    share: int = SHARE,
    carry: bool = False,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    With ``carry`` also ``row``, the document with all its columns.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(doc_id).alias("doc_id"),
        *([F.struct(*[F.col(c) for c in docs.columns]).alias("row")] if carry else []),
        F.col(text).alias("text"),
    )
    names = [c for c in rows.columns if c not in ("text", "row_id")]
    blocks = _blocks(benchmark, item_id, item_text, size, block_bytes)
    block, further = next(blocks), next(blocks, None)
    if further is not None:
        rows = materialise(rows, "numbered")  # each block is searched for in the same rows
    result = _searched(rows, ["row_id", *names], block)
    if further is not None:
        path, number = fresh_path(spark, "hits"), 0
        while further is not None:
            part = _searched(rows, ["row_id"], further).filter("size(spans) > 0")
            written = write_table(part, f"{path}/block={number}")
            further, number = next(blocks, None), number + 1
        together = read_written(spark, path, written.schema).groupBy("row_id")
        added = together.agg(
            F.flatten(F.collect_list("spans")).alias("more_spans"),
            F.flatten(F.collect_list("items")).alias("more_items"),
        )
        result = result.join(added, "row_id", "left").withColumns(
            {
                c: F.concat(c, F.coalesce(f"more_{c}", F.slice(c, 1, 0)))
                for c in ("spans", "items")
            }
        )
    items = F.array_sort(F.array_distinct("items"))
    scored = result.withColumn("n_hit", _merged(F.col("spans"))).withColumn("items", items)
    bad = (F.col("n_hit") > 0) & (F.lit(share) * F.col("n_hit") >= F.col("n_words"))
    return scored.select(
        *names,
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        bad.alias("contaminated"),
    )


def clean_rows(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    judged = contamination(docs, benchmark, carry=True, **settings)
    return judged.filter("not contaminated").select("row.*")
