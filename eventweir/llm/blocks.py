"""A table of queries cut into blocks of bounded weight, and the best rows found for each query.

What a block holds can be broadcast: it weighs no more than the limit and one row, however many
queries there are.  Tasks that search their rows for a block keep the best few of each query and
hand on these; they are brought together in two steps, so that no task meets the finds of all others.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventweir.workspace import fresh_path, materialise, write_table

# Fixed value: ``monotonically_increasing_id`` keeps the row's place in the low 33 bits.
_PLACE_BITS = 33
#: Groups of tasks whose finds are brought together first.
GROUPS = 64


def in_blocks(queries: DataFrame, weight: Column, limit: int) -> tuple[DataFrame, int]:
    """The written queries with ``block``: 0, 1, ...; and the number of blocks.

    Running weights are summed inside the written partitions; only one sum per partition is
    broadcast.  An empty table has no block.
    """
    placed = queries.select(
        "*", weight.cast("long").alias("_w"), F.monotonically_increasing_id().alias("_at")
    )
    stored = materialise(placed, "queries")
    stored = stored.withColumn("_part", F.shiftrightunsigned("_at", _PLACE_BITS))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        stored.groupBy("_part")
        .agg(F.sum("_w").alias("_all"))
        .select("_part", F.coalesce(F.sum("_all").over(earlier), F.lit(0)).alias("_start"))
    )
    above = (
        Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum("_w").over(above), F.lit(0))
    blocks = (
        stored.withColumn("_before", before)
        .join(F.broadcast(starts), "_part")
        .select(
            *[F.col(f"`{c}`") for c in queries.columns],
            F.floor((F.col("_start") + F.col("_before")) / limit).cast("int").alias("block"),
        )
    )
    blocks = write_table(blocks, fresh_path(queries.sparkSession, "blocks"), ["block"])
    last = blocks.agg(F.max("block")).first()[0]
    return blocks, 0 if last is None else last + 1


def first_of_tasks(
    finds: DataFrame, query: Sequence[str], order: Sequence[Column], k: int, task: str
) -> DataFrame:
    """The first ``k`` finds of each query, with ``place``, out of what the tasks have found."""
    group = F.pmod(F.col(task), F.lit(GROUPS))
    near = Window.partitionBy(*query, group).orderBy(*order)
    some = finds.withColumn("place", F.row_number().over(near)).filter(F.col("place") <= k)
    whole = Window.partitionBy(*query).orderBy(*order)
    return some.withColumn("place", F.row_number().over(whole)).filter(F.col("place") <= k)


class Best:
    """The first ``k`` rows by descending score, ascending id (null last), ascending key."""

    __slots__ = ("k", "rows")

    def __init__(self, k: int):
        self.k = k
        self.rows: tuple[np.ndarray, ...] | None = None

    def full(self) -> bool:
        return self.rows is not None and len(self.rows[0]) == self.k

    def reach(self, otherwise):
        """The score of the last row, which others have to reach; ``otherwise`` while rows lack."""
        return self.rows[0][-1] if self.full() else otherwise

    def add(self, scores: np.ndarray, missing: np.ndarray, ids: np.ndarray, keys: np.ndarray):
        if not len(scores):
            return
        new = (scores, missing, ids, keys)
        if self.rows is not None:
            new = tuple(np.concatenate(pair) for pair in zip(self.rows, new, strict=True))
        order = np.lexsort((new[3], new[2], new[1], -new[0]))[: self.k]
        self.rows = tuple(column[order] for column in new)

    def __iter__(self) -> Iterator[tuple]:
        """Score, id and key of each row."""
        if self.rows is not None:
            for score, missing, row_id, key in zip(*self.rows, strict=True):
                yield int(score), None if missing else int(row_id), int(key)
