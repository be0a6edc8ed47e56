"""Weighted allocation: capacities kept, every topic once, groups over half full."""
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from eventweir.operators import registry as reg
from eventweir.operators.numbering import running_totals
from eventweir.operators.weighted_allocation import allocate_weighted


def registry_of(spark, rows):
    """Rows of (topic, pipeline, number of event types or None)."""
    full = [
        (t, p, "topic_based" if n is None else "payload_based", None if n is None else ["e"] * n)
        for t, p, n in rows
    ]
    return spark.createDataFrame(full, reg.REGISTRY_SCHEMA)


def weight_of(types):
    return 1 + (types or 0)


def check(rows, capacity, found):
    weights = {t: weight_of(n) for t, _, n in rows}
    held, groups = defaultdict(int), defaultdict(list)
    for t, p, _ in rows:
        if p is not None:
            held[p] += weights[t]
    before = dict(held)
    assert sorted(r.topic_name for r in found) == sorted(t for t, p, _ in rows if p is None)
    for r in found:
        assert r.weight == weights[r.topic_name]
        assert (r.pipeline_id is None) != (r.new_group is None)
        if r.pipeline_id is not None:
            held[r.pipeline_id] += r.weight
        else:
            groups[r.new_group].append(r.weight)
    assert set(held) == set(before)
    assert all(n <= max(capacity, before[p]) for p, n in held.items())
    assert all(sum(own) <= capacity or len(own) == 1 for own in groups.values())
    assert sorted(groups) == list(range(1, len(groups) + 1))
    # at most one group a class of weights is half full or less
    assert sum(2 * sum(own) <= capacity for own in groups.values()) <= capacity.bit_length()
    # heavier topics take the room first; what is left is one a pipeline, and what found no room
    room = sum(max(0, capacity - n) for n in before.values())
    waiting = sum(weights[t] for t, p, _ in rows if p is None)
    if waiting <= room:
        assert sum(map(len, groups.values())) <= len(before)


@pytest.mark.parametrize("seed", range(4))
def test_random_registries(spark, seed):
    rng = random.Random(seed)
    capacity, pipelines = rng.randint(4, 30), [f"p{i}" for i in range(rng.randint(1, 9))]
    share = rng.choice([0.1, 0.5, 0.8])
    rows = [
        (f"t{i:03d}", rng.choice(pipelines) if rng.random() < share else None, rng.choice([None, 0, 1, 3, 9]))
        for i in range(rng.randint(1, 120))
    ]
    check(rows, capacity, allocate_weighted(registry_of(spark, rows), capacity).collect())


def test_a_small_deal_written_out(spark):
    """p has room for 4, q for 2: 3 goes to p, 2 lies across its end, 1 goes to q."""
    rows = [("a", "p", 5), ("b", "q", 7), ("x", None, 2), ("y", None, 1), ("z", None, None)]
    found = {r.topic_name: (r.pipeline_id, r.new_group) for r in allocate_weighted(registry_of(spark, rows), 10).collect()}
    assert found == {"x": ("p", None), "y": (None, 1), "z": ("q", None)}


def test_a_topic_beyond_the_capacity_is_a_group_of_its_own(spark):
    rows = [("a", None, 9), ("b", None, 0), ("c", None, None)]
    found = {r.topic_name: r.new_group for r in allocate_weighted(registry_of(spark, rows), 4).collect()}
    assert sorted(found) == ["a", "b", "c"] and found["b"] == found["c"] != found["a"]
    assert allocate_weighted(registry_of(spark, rows).limit(0), 4).collect() == []
    with pytest.raises(ValueError, match="at least one"):
        allocate_weighted(registry_of(spark, rows), 0)


def test_running_totals(spark):
    rng = random.Random(2)
    amounts = [rng.randint(-5, 50) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(amounts)), "i long, n long").repartition(7)
    found = {r.i: r.total for r in running_totals(df, [F.col("i")], "n", "total").collect()}
    assert found == {i: sum(amounts[:i]) for i in range(500)}
