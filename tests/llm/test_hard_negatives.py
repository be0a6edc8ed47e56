import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventweir.llm import blocks
from eventweir.llm.hard_negatives import Lists, hard_negatives

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, positives=5, negatives=5):
    """All scores of all pairs, sorted."""
    own = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        own.append((vec_id, [math.floor(256 * x) for x in vector], label))

    def score(a, b):
        return sum(x * y for x, y in zip(a, b, strict=False))

    out = []
    for i, (anchor_id, a, label) in enumerate(own):
        if anchor_id is None or anchor_id % 100:
            continue
        ranked = sorted(
            (-score(a, b), v is None, v or 0, k, other)
            for k, (v, b, other) in enumerate(own)
            if k != i
        )
        for s, no_id, pos, _, _ in [r for r in ranked if r[4] == label][:positives]:
            inside = [r for r in ranked if r[4] != label and -80 * s <= -100 * r[0] <= -100 * s]
            for rank, (n, missing, neg, _, _) in enumerate(inside[:negatives], 1):
                ids = None if no_id else pos, None if missing else neg
                out.append((anchor_id, ids[0], rank, ids[1], -s, -n))
    return sorted(out, key=repr)


def run(spark, rows, **settings):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = hard_negatives(df, F.col("vec_id") % 100 == 0, **settings)
    return sorted(map(tuple, found.collect()), key=repr)


def drawn(n, width, labels, seed):
    """Vectors in two clusters per label, some of them copies."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        if rows and draw.random() < 0.2:
            rows.append((i, draw.choice(rows)[1], draw.randrange(labels)))
        else:
            rows.append((i, [draw.gauss(0, 0.3) + 0.2 for _ in range(width)], draw.randrange(labels)))
    return rows


@pytest.mark.parametrize("width,labels", [(1, 2), (4, 3), (16, 2)])
def test_equals_all_pairs(spark, width, labels):
    rows = drawn(400, width, labels, width)
    assert run(spark, rows) == brute(rows)


def test_small_blocks_of_anchors_and_rows(spark, monkeypatch):
    rows = drawn(900, 6, 3, 9)
    assert run(spark, rows, block_bytes=200) == brute(rows)


def test_a_third_are_one_vector_and_one_label(spark):
    rows = drawn(300, 5, 3, 3)
    rows += [(1000 + i, [0.5] * 5, 1 if i % 3 else 2) for i in range(150)]
    assert run(spark, rows) == brute(rows)


def test_rows_that_take_no_part_and_odd_vectors(spark):
    rows = drawn(120, 3, 2, 4)
    rows += [(200, None, 1), (300, [0.1, None, 0.2], 1), (400, [NAN, 0.1, 0.1], 0)]
    rows += [(500, [INF, 0.1, 0.1], 0), (600, [0.1, 0.1, 0.1], None), (None, [0.3, 0.3, 0.3], 1)]
    rows += [(700, [], 1), (800, [0.2], 0), (900, [0.0, 0.0, 0.0], 0), (1100, [-0.3, 0.2, 0.1, 0.9], 1)]
    assert run(spark, rows) == brute(rows)


def test_rows_that_repeat(spark):
    """Copies of an anchor with its id are other rows; each copy is an anchor of its own."""
    rows = [(0, [1.0, 0.0], 1)] * 3 + [(7, [0.9, 0.1], 2), (8, [0.9, 0.1], 2), (9, [0.9, 0.0], 1)]
    found = run(spark, rows)
    assert found == brute(rows)
    assert {row[1] for row in found} == {0, 9}


def test_large_components_stay_exact(spark):
    rows = [(i, [2.0**20 + i, -(2.0**21) + 3 * i, 1.0], i % 2) for i in range(60)]
    rows += [(100 + i, [2.0**20 + i, -(2.0**21) + 3 * i, 2.0], i % 2) for i in range(60)]
    assert run(spark, rows) == brute(rows)


def test_empty_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [0.1], 1), (2, [0.2], 2)]) == []
    assert run(spark, [(0, [0.1], 1)]) == []


def test_lists_are_left_early():
    """With few dimensions and a clear best row the search reads a part of the lists."""
    rows = np.random.default_rng(5).integers(-100, 100, (4000, 2)).astype(float)
    rows[17] = (1000, -1000)
    lists, anchor = Lists(rows), np.array([3.0, -2.0])
    bounds = lists.thresholds(anchor[None])[0]
    met = set()
    for new, bound in zip(lists.read(anchor), bounds, strict=False):
        met |= set(new.tolist())
        rest = [r for r in range(len(rows)) if r not in met]
        assert max((rows[r] @ anchor for r in rest), default=-INF) <= bound
        if bound < rows[17] @ anchor:
            break
    assert 17 in met and len(met) < 100


def test_blocks_are_bounded(spark):
    rows = spark.range(1000).repartition(7)
    found, count = blocks.in_blocks(rows, F.col("id") % 10 + 1, 100)
    held = {r.block: (r.w, r.n) for r in found.groupBy("block").agg(
        F.sum(F.col("id") % 10 + 1).alias("w"), F.count("*").alias("n")).collect()}
    assert sorted(held) == list(range(count)) and sum(n for _, n in held.values()) == 1000
    assert max(w for w, _ in held.values()) <= 110
