"""Connected components of a graph given by its edges, by alternating large and small stars.

Each round hooks every node's neighbours to the smallest node around it, first the larger
neighbours, then the smaller ones.  Rounds are joins and partial minima, so a node with very many
neighbours is a skewed join key, which adaptive execution splits, and never one group: it splits only
joins of two plain tables, so the minima are written before they are joined.  Every round is written to the shared folder and replaces the one before; nothing is held by the driver but two
numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventweir.workspace import fresh_path, remove, write_table


def _minima(edges: DataFrame) -> tuple[DataFrame, str]:
    """By ``node`` the smallest neighbour it is listed with, a written table, and where it lies."""
    path = fresh_path(edges.sparkSession, "minima")
    least = edges.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("least"))
    return write_table(least, path), path


def _large_stars(edges: DataFrame, minima: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is hooked to the smallest node around it."""
    least = minima.select("node", F.least("node", "least").alias("least"))
    hooked = edges.join(least, edges["low"] == least["node"]).select("high", "least")
    return hooked.filter(F.col("high") != F.col("least")).withColumnRenamed("least", "low")


def _small_stars(edges: DataFrame, least: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are hooked to the smallest of them."""
    hooked = edges.join(least, edges["high"] == least["node"]).select("low", "least")
    moved = hooked.filter("low != least").select(F.col("low").alias("high"), "least")
    own = least.select(F.col("node").alias("high"), "least")
    return moved.union(own).withColumnRenamed("least", "low").distinct()


def _round(edges: DataFrame) -> tuple[DataFrame, list[str]]:
    """The edges after both kinds of stars, and the tables they are still read from."""
    spark = edges.sparkSession
    both = edges.union(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
    around, first = _minima(both)
    path = fresh_path(spark, "large-stars")
    large = write_table(_large_stars(edges, around), path)
    below, second = _minima(large)
    return _small_stars(large, below), [first, path, second]


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected with, for nodes that are no root."""
    spark = edges.sparkSession
    start = edges.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("high"), F.least(a, b).alias("low")
    )
    path = fresh_path(spark, "stars")
    current = write_table(start.distinct(), path)
    before = None
    while True:
        state = current.agg(F.count("*"), F.bit_xor(F.xxhash64("high", "low"))).first()
        if state == before:
            break
        before, last_path = state, path
        path = fresh_path(spark, "stars")
        stars, used = _round(current)
        current = write_table(stars, path)
        for table in (last_path, *used):
            remove(spark, table)
    return current.select(F.col("high").alias("node"), F.col("low").alias("root"))
