"""Ranked lexical search: for each query item, the documents that score highest, exactly.

Terms are the lower-cased (A-Z) words ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` of whole texts.  A
term weighs ``w = floor(1000 * ln((2N + 2) / (2 df + 1)))``; with ``m = 50 + (50 n N) div L`` a
document scores the sum, over the item's different terms, of
``w * ((10^9 tf) div (1000 tf + 20 m))``.  N counts the documents with a term, L all their terms, n a
document's, df the documents with a term, tf its occurrences in one.

Items are broadcast in blocks of bounded size, as the words of one block make a bounded vocabulary;
each block is searched for in all documents.  Tasks count the vocabulary's words in each document
into a sparse vector, which is written once; corpus statistics are sums over these.  A second pass
puts a ball tree over every block of some thousand vectors and searches it best-first for each item:
what a task has found so far bounds what is still looked at.  A task hands on no more than the best
few of each item.

Null texts, and texts without a word, have no terms: such documents count for nothing, such items
get no rows.  Equal scores go by ascending document id, null ids last; rows that repeat an id, or a
whole row, each count on their own, and an item repeated is answered each time.  An empty table of
documents or items gives an empty result.  Further columns are passed over.  Whole texts are used,
however long; one item and one document are held by a task at a time as a whole.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventweir.llm.arrow import raw_texts, slices
from eventweir.llm.ball_tree import BallTree
from eventweir.llm.blocks import Best, first_of_tasks, in_blocks
from eventweir.llm.decontamination import words
from eventweir.workspace import materialise

FIRST = 50
#: Bytes of item words that are searched for at a time, vectors and entries of a tree.
BLOCK_BYTES = 4 << 20
TREE_ROWS, TREE_ENTRIES = 4096, 1 << 20

_ITEMS = "row_key long, item_id long, terms array<binary>"
_VECTORS = "row_key long, doc_id long, n long, ids array<int>, counts array<int>"
_FOUND = "task int, item long, score long, doc_id long, row_key long"


def _term_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each item's different terms; items without any are left out."""
    for batch in slices(batches):
        sets = [sorted(set(words(raw))) for raw in raw_texts(batch.column("text"))]
        columns = [batch.column("row_key"), batch.column("item_id"), pa.array(sets, pa.list_(pa.binary()))]
        whole = pa.RecordBatch.from_arrays(columns, names=["row_key", "item_id", "terms"])
        yield whole.filter(pa.array([bool(s) for s in sets], pa.bool_()))


def _counted(shipped):
    """Each document's words, and how often those of the vocabulary occur in it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {term: i for i, term in enumerate(shipped.value)}
        for batch in slices(batches):
            totals, ids, counts, ends = [], [], [], [0]
            for raw in raw_texts(batch.column("text")):
                found = words(raw)
                totals.append(len(found))
                own = sorted(Counter(filter(None.__ne__, map(number.get, found))).items())
                ids += [i for i, _ in own]
                counts += [n for _, n in own]
                ends.append(len(ids))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row_key"),
                    batch.column("doc_id"),
                    pa.array(totals, pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(ids, pa.int32())),
                    pa.ListArray.from_arrays(ends, pa.array(counts, pa.int32())),
                ],
                names=["row_key", "doc_id", "n", "ids", "counts"],
            )

    return count


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Runs of vectors that a tree is put over, bounded by rows and by entries."""
    for batch in batches:
        ends = np.asarray(batch.column("ids").offsets).astype(np.int64)
        start = 0
        while start < batch.num_rows:
            most = np.searchsorted(ends, ends[start] + TREE_ENTRIES, "right") - 1
            stop = min(max(int(most), start + 1), start + TREE_ROWS, batch.num_rows)
            part = batch.slice(start, stop - start)
            yield {
                "starts": ends[start : stop + 1] - ends[start],
                "ids": np.asarray(part.column("ids").flatten()).astype(np.int64),
                "counts": np.asarray(part.column("counts").flatten()).astype(np.int64),
                "n": np.asarray(part.column("n")),
                "missing": np.asarray(part.column("doc_id").is_null()),
                "doc_id": np.asarray(part.column("doc_id").fill_null(0)),
                "row_key": np.asarray(part.column("row_key")),
            }
            start = stop


def _search(shipped, documents: int, terms: int, k: int):
    """What each task finds for the items of a block; ``documents`` and ``terms`` are N and L."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, items = shipped.value
        task, found = TaskContext.get().partitionId(), [Best(k) for _ in items]
        queries = [(cols, weights[cols]) for _, cols in items]
        dense = np.zeros(len(weights), np.int64)
        for part in _parts(batches):
            sizes = np.diff(part["starts"])
            m = np.repeat(50 + (50 * part["n"] * documents) // terms, sizes)
            tf = part["counts"]
            values = (1_000_000_000 * tf) // (1000 * tf + 20 * m)
            tree = BallTree(part["starts"], part["ids"], values, weights)
            bounds = tree.bounds(queries)
            for best, (cols, own), bound in zip(found, queries, bounds, strict=True):
                dense[cols] = own
                for rows, scores in tree.visit(bound, dense, lambda best=best: best.reach(1)):
                    into = scores >= best.reach(1)
                    if into.any():
                        rows = rows[into]
                        names = [part[name][rows] for name in ("missing", "doc_id", "row_key")]
                        best.add(scores[into], *names)
                dense[cols] = 0
        out = [
            (task, key, score, doc_id, row)
            for best, (key, _) in zip(found, items, strict=True)
            for score, doc_id, row in best
        ]
        if out:
            columns = zip(*out, strict=True)
            kinds = [pa.int32()] + [pa.int64()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
                names=["task", "item", "score", "doc_id", "row_key"],
            )

    return search


def term_weight(documents: int, holders: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holders + 1)))


def _found(rows: DataFrame, block: DataFrame, k: int) -> DataFrame:
    """The best documents of each task for one block of items."""
    context = rows.sparkSession.sparkContext
    items = [(row.row_key, [bytes(t) for t in row.terms]) for row in block.collect()]
    vocabulary = sorted({term for _, terms in items for term in terms})
    number = {term: i for i, term in enumerate(vocabulary)}
    counted = rows.mapInArrow(_counted(context.broadcast(vocabulary)), _VECTORS)
    vectors = materialise(counted, "term-vectors")
    documents, terms = vectors.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    holders = dict(
        vectors.select(F.explode("ids").alias("id")).groupBy("id").agg(F.count("*")).collect()
    )  # at most one row per word of the block
    weights = [term_weight(documents, holders.get(i, 0)) for i in range(len(vocabulary))]
    queries = [(key, np.array([number[t] for t in terms], np.int64)) for key, terms in items]
    shipped = context.broadcast((np.array(weights, np.int64), queries))
    search = _search(shipped, documents, terms or 1, k)
    holding = vectors.filter("size(ids) > 0").select("row_key", "doc_id", "n", "ids", "counts")
    return materialise(holding.mapInArrow(search, _FOUND), "finds")


def ranked(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    k: int = FIRST,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """item_id, rank, doc_id, score: each item's first ``k`` documents with a score above 0."""
    spark = docs.sparkSession

    def keyed(df: DataFrame, own_id: str, own_text: str, name: str) -> DataFrame:
        return df.select(
            F.monotonically_increasing_id().alias("row_key"),
            F.col(own_id).cast("long").alias(name),
            F.col(own_text).alias("text"),
        )

    rows = keyed(docs, doc_id, text, "doc_id")
    sets = keyed(items, item_id, item_text, "item_id").mapInArrow(_term_sets, _ITEMS)
    weight = F.aggregate(
        "terms", F.lit(64).cast("long"), lambda total, t: total + F.octet_length(t) + 48
    )
    queries, count = in_blocks(sets, weight, block_bytes)
    parts = [_found(rows, queries.filter(F.col("block") == n), k) for n in range(count)]
    finds = reduce(DataFrame.unionByName, parts, spark.createDataFrame([], _FOUND))
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), "row_key"]
    first = first_of_tasks(finds, ["item"], order, k, "task")
    names = queries.select(F.col("row_key").alias("item"), "item_id")
    return first.join(names, "item").select(
        "item_id", F.col("place").alias("rank"), "doc_id", "score"
    )
