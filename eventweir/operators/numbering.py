"""Exact consecutive numbers and running totals over a sorted DataFrame without one task seeing all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventweir.workspace import materialise

# Fixed value: ``monotonically_increasing_id`` keeps the row's place in the low 33 bits.
_PLACE_BITS = 33


def number_rows(
    df: DataFrame, order_by: Sequence[Column], name: str
) -> tuple[DataFrame, Column]:
    """``df`` with ``name``: 1, 2, 3, ... in the given total order; and the number of rows.

    The sort is range-partitioned; each row remembers its partition and place there, and the rows
    are written so that both stay fixed.  What is then summed up in order is one count per sorted
    partition (no more than ``spark.sql.shuffle.partitions`` rows), which is also what bounds the
    broadcast side.
    """
    placed = df.orderBy(*order_by).withColumn("_at", F.monotonically_increasing_id())
    stored = materialise(placed, "numbered")
    part = F.shiftrightunsigned("_at", _PLACE_BITS).alias("_part")
    place = F.col("_at").bitwiseAND((1 << _PLACE_BITS) - 1)
    sizes = stored.groupBy(part).agg((F.max(place) + 1).alias("_size"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    numbered = (
        stored.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_start") + place + 1).alias(name))
    )
    return numbered, stored.agg(F.count("*").alias("n")).scalar()


def running_totals(
    df: DataFrame, order_by: Sequence[Column], amount: str, name: str
) -> DataFrame:
    """``df`` with ``name``: the sum of ``amount`` over all rows before, in the given total order.

    Like ``number_rows``: rows are summed up inside each sorted partition, and the partitions' sums
    are what is summed up in order and broadcast.
    """
    placed = df.orderBy(*order_by).withColumn("_at", F.monotonically_increasing_id())
    stored = materialise(placed, "totals")
    part = F.shiftrightunsigned("_at", _PLACE_BITS).alias("_part")
    sums = stored.groupBy(part).agg(F.sum(amount).alias("_sum"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start_of"))
    inside = W.partitionBy("_part").orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
    summed = stored.withColumn("_part", part).withColumn(
        "_inside", F.coalesce(F.sum(amount).over(inside), F.lit(0))
    )
    return summed.join(F.broadcast(starts), "_part").select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("_start_of") + F.col("_inside")).alias(name)
    )
