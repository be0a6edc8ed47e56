"""Hard negatives for contrastive training, by Fagin's threshold algorithm.

Components become whole numbers, so that scores are exact inner products.  Every task cuts its rows
into blocks and sorts each block's components into one list per dimension.  For an anchor the lists
are read in parallel, from the top where its component is positive and from the bottom where it is
negative; each row met for the first time is fetched and scored in whole numbers.  The last
components read bound the score of all rows not met: once this threshold falls strictly below the
kth score that a window holds, none of them can enter it.

Two searches run over all rows.  The first finds each anchor's positives, in lists of the rows of its
own label.  The second finds, for each positive, the negatives in the window of scores that its score
spans; a window that is not full is done when the threshold falls below the window.  Anchors are
broadcast in blocks of bounded size, each searched for in all rows; a task carries what it has found
from block to block of rows, so later ones stop sooner, and hands on no more than the best few per
window.  Rows are never grouped by label, so a label or vector held by most of them costs no more
than its share.

Rows with a null label, a null vector, or a component that is null or not finite (also once scaled)
take no part.  Missing components of shorter vectors count as zero, an empty vector scores 0.  Null
ids come last among ties; rows that repeat an id, or a whole row, each count on their own, and rows
that still tie come in any order.  An empty table, or one without anchors, gives an empty result.
Further columns are passed over.  Scores have to fit 64-bit integers; larger ones raise an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventweir.llm.blocks import Best, first_of_tasks, in_blocks
from eventweir.workspace import materialise

SCALE = 256
POSITIVES = NEGATIVES = 5
#: A negative's score is at least and at most so many hundredths of the positive's.
LOW, HIGH = 80, 100
#: Bytes of anchors that are searched for at a time, rows of a block with lists of its own.
BLOCK_BYTES = 8 << 20
BLOCK_ROWS = 4096
#: Entries read from each list before the threshold is first looked at, and the factor from then on.
FIRST, FACTOR = 4, 4
#: Products below this are exact as doubles, a hundredfold too.
_EXACT = 1 << 46

_FOUND = "task int, anchor long, positive_score long, score long, vec_id long, row_key long"


def whole_vector(vector: Column, scale: int) -> Column:
    """The components times ``scale``, rounded down, as doubles."""

    def whole(x: Column) -> Column:
        scaled = x.cast("double") * scale
        return F.when(F.abs(scaled) < 2.0**53, F.floor(scaled).cast("double")).otherwise(scaled)

    return F.transform(vector, whole)


def _all_finite(vector: Column) -> Column:
    return F.forall(vector, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))


def _matrix(column: pa.Array, width: int = 0) -> np.ndarray:
    """Rows of numbers, padded with zeros to the longest row or ``width``."""
    flat, ends = np.asarray(column.flatten()), np.asarray(column.offsets)
    sizes = np.diff(ends)
    width = max(width, int(sizes.max(initial=0)))
    rows = np.zeros((len(sizes), width))
    rows[np.arange(width) < sizes[:, None]] = flat
    return rows


class Lists:
    """Rows of whole numbers with, per dimension, the rows sorted by value."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.rising = np.argsort(rows, axis=0, kind="stable").T.astype(np.int32)
        self.falling = np.ascontiguousarray(self.rising[:, ::-1])
        self.depths = [min(FIRST, len(rows))]
        while self.depths[-1] < len(rows):
            self.depths.append(min(self.depths[-1] * FACTOR, len(rows)))
        last = np.array(self.depths) - 1
        self._high = np.take_along_axis(rows, self.falling[:, last].T, axis=0)
        self._low = np.take_along_axis(rows, self.rising[:, last].T, axis=0)

    def thresholds(self, anchors: np.ndarray) -> np.ndarray:
        """By anchor and depth, the most that a row not met so far can score."""
        return np.maximum(anchors, 0) @ self._high.T + np.minimum(anchors, 0) @ self._low.T

    def read(self, anchor: np.ndarray) -> Iterator[np.ndarray]:
        """By depth, the rows met for the first time in the lists as the anchor's signs turn them."""
        used = np.flatnonzero(anchor)
        met = np.zeros(len(self.rows), bool)
        if not len(used):
            yield np.arange(len(self.rows))
            return
        lists = [self.falling[j] if anchor[j] > 0 else self.rising[j] for j in used]
        start = 0
        for depth in self.depths:
            now = np.zeros(len(self.rows), bool)
            for entries in lists:
                now[entries[start:depth]] = True
            now &= ~met
            met |= now
            start = depth
            yield np.flatnonzero(now)
            if met.all():
                return


def _exact(rows: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles where their products are exact, else as Python integers."""
    bound = np.abs(rows).max(initial=0) * np.abs(anchors).sum(axis=1).max(initial=0)
    if bound < _EXACT:
        return rows, anchors
    return tuple(np.array([[int(x) for x in row] for row in m], object) for m in (rows, anchors))


@dataclass
class Window:
    """Scores that may enter, and the best rows that have."""

    positive_score: int | None
    low: float
    high: float
    best: Best

    def open(self, threshold) -> bool:
        """Whether a row that scores up to ``threshold`` could still enter."""
        return threshold >= self.best.reach(self.low)


def threshold_search(
    lists: Lists, anchor: np.ndarray, bounds: np.ndarray, windows: list[Window], enters, names
) -> None:
    """Read the lists until no row not met can enter a window.

    ``enters`` marks the rows that may be listed for this anchor at all, ``names`` holds for each row
    whether its id is missing, its id and its key.
    """
    for new, bound in zip(lists.read(anchor), bounds, strict=False):
        if enters is not None:
            new = new[enters[new]]
        scores = lists.rows[new] @ anchor
        for window in windows:
            least = window.best.reach(window.low)
            into = np.flatnonzero((scores >= least) & (scores <= window.high))
            if len(into):
                window.best.add(scores[into], *(name[new[into]] for name in names))
        if not any(window.open(bound) for window in windows):
            return


@dataclass
class Anchors:
    """A block of anchors: keys, labels and vectors, the positive scores of each, labels as numbers."""

    keys: list[int]
    labels: list[str]
    vectors: np.ndarray
    positive_scores: list[list[int]] | None = None
    codes: np.ndarray | None = None


def _positives_in(lists_of: Callable, anchors: Anchors, block: dict, found: list) -> None:
    """Look for positives in one block of rows: lists by label."""
    for code in np.unique(block["code"][block["code"] >= 0]):
        own, rows = np.flatnonzero(anchors.codes == code), np.flatnonzero(block["code"] == code)
        lists, vectors = lists_of(rows, own)
        names = [block[n][rows] for n in ("missing", "id", "key")]
        bounds = lists.thresholds(vectors)
        for i, a in enumerate(own):
            others = names[2] != anchors.keys[a]
            threshold_search(lists, vectors[i], bounds[i], found[a], others, names)


def _negatives_in(lists_of: Callable, anchors: Anchors, block: dict, found: list) -> None:
    """Look for negatives in one block of rows: one set of lists."""
    rows, every = np.arange(len(block["code"])), np.arange(len(anchors.keys))
    lists, vectors = lists_of(rows, every)
    names = [block[n] for n in ("missing", "id", "key")]
    bounds = lists.thresholds(vectors)
    for a in every:
        if found[a]:
            others = block["code"] != anchors.codes[a]
            threshold_search(lists, vectors[a], bounds[a], found[a], others, names)


def _windows(anchors: Anchors, k: int, low: int, high: int) -> list[list[Window]]:
    """The empty windows of each anchor."""
    if anchors.positive_scores is None:
        every = float("inf")
        return [[Window(None, -every, every, Best(k))] for _ in anchors.keys]
    return [
        [
            Window(s, -(-low * s // 100), high * s // 100, Best(k))
            for s in scores
            if -(-low * s // 100) <= high * s // 100
        ]
        for scores in anchors.positive_scores
    ]


def _search(shipped, k: int, low: int, high: int):
    """What each task finds for the anchors of a block."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, task = shipped.value, TaskContext.get().partitionId()
        labels = pa.array(sorted(set(anchors.labels)), pa.string())
        anchors.codes = np.asarray(pc.index_in(pa.array(anchors.labels, pa.string()), labels))
        found = _windows(anchors, k, low, high)
        look = _positives_in if anchors.positive_scores is None else _negatives_in
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                ids = part.column("vec_id")
                block = {
                    "code": np.asarray(
                        pc.fill_null(pc.index_in(part.column("label"), labels), -1)
                    ),
                    "missing": np.asarray(ids.is_null()),
                    "id": np.asarray(ids.fill_null(0)),
                    "key": np.asarray(part.column("row_key")),
                }
                rows = _matrix(part.column("vector"), anchors.vectors.shape[1])
                wide = np.zeros((len(anchors.keys), rows.shape[1]))
                wide[:, : anchors.vectors.shape[1]] = anchors.vectors

                def lists_of(chosen, own, rows=rows, wide=wide):
                    some, vectors = _exact(rows[chosen], wide[own])
                    return Lists(some), vectors

                look(lists_of, anchors, block, found)
        out: list[tuple] = []
        for key, windows in zip(anchors.keys, found, strict=True):
            for window in windows:
                positive = window.positive_score
                out += [(task, key, positive, score, i, row) for score, i, row in window.best]
        if out:
            columns = zip(*out, strict=True)
            kinds = [pa.int32()] + [pa.int64()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
                names=["task", "anchor", "positive_score", "score", "vec_id", "row_key"],
            )

    return search


def _anchors_of(block: DataFrame, positives: DataFrame | None = None) -> Anchors:
    """A block of anchors on the driver; their weight was bounded when the block was made."""
    table = block.select("row_key", "label", "vector").sort("row_key").toArrow()
    keys = table.column("row_key").to_pylist()
    column = table.column("vector").combine_chunks()
    anchors = Anchors(keys, table.column("label").to_pylist(), _matrix(column))
    if positives is not None:
        own = block.select(F.col("row_key").alias("anchor")).join(positives, "anchor")
        scores: dict[int, set[int]] = {}
        for row in own.select("anchor", "score").collect():
            scores.setdefault(row.anchor, set()).add(row.score)
        anchors.positive_scores = [sorted(scores.get(key, ()), reverse=True) for key in keys]
    return anchors


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    vec_id: str = "vec_id",
    label: str | Column = "label",
    vector: str = "embedding",
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` marks the anchors.  An anchor's positives are the first ``positives`` other rows of
    its label; for each of them the first ``negatives`` rows of other labels are listed whose score
    is at least ``low`` and at most ``high`` hundredths of the positive's.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row_key"),
        F.col(vec_id).cast("long").alias("vec_id"),
        (F.col(label) if isinstance(label, str) else label).cast("string").alias("label"),
        whole_vector(F.col(vector), scale).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    ).filter(F.col("label").isNotNull() & F.col("vector").isNotNull() & _all_finite(F.col("vector")))
    rows = materialise(rows, "whole-vectors")
    searched = rows.select("row_key", "vec_id", "label", "vector")
    weight = F.size("vector") * 8 + F.octet_length("label") + 64
    anchors, count = in_blocks(rows.filter("is_anchor").drop("is_anchor"), weight, block_bytes)
    order = [F.desc("score"), F.asc_nulls_last("vec_id"), "row_key"]

    def found(number: int, k: int, some: DataFrame | None) -> DataFrame:
        shipped = spark.sparkContext.broadcast(
            _anchors_of(anchors.filter(F.col("block") == number), some)
        )
        return materialise(searched.mapInArrow(_search(shipped, k, low, high), _FOUND), "finds")

    empty = spark.createDataFrame([], _FOUND)
    parts = [found(n, positives, None) for n in range(count)]
    finds = reduce(DataFrame.unionByName, parts, empty).drop("positive_score")
    best = materialise(first_of_tasks(finds, ["anchor"], order, positives, "task"), "positives")
    parts = [found(n, negatives, best) for n in range(count)]
    finds = reduce(DataFrame.unionByName, parts, empty)
    others = first_of_tasks(finds, ["anchor", "positive_score"], order, negatives, "task")
    ids = anchors.select(F.col("row_key").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    pairs = best.select(
        "anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return (
        others.select(
            "anchor",
            "positive_score",
            F.col("place").alias("rank"),
            F.col("vec_id").alias("negative_id"),
            F.col("score").alias("negative_score"),
        )
        .join(pairs, ["anchor", "positive_score"])
        .join(ids, "anchor")
        .select(
            "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
        )
    )
