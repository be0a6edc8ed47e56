import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from eventweir.llm.ball_tree import BallTree
from eventweir.llm.lexical_search import ranked

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, k=50):
    own = [(doc_id, i, terms_of(t)) for i, (doc_id, t) in enumerate(docs)]
    n_docs = sum(bool(t) for _, _, t in own)
    length = sum(len(t) for _, _, t in own)
    df = Counter(x for _, _, t in own for x in set(t))
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, i, t in own:
            tf = Counter(t)
            score = 0
            for term in set(terms_of(text)) & set(tf):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                m = 100 - 50 + (50 * len(t) * n_docs) // length
                score += w * ((10**9 * tf[term]) // (1000 * tf[term] + 20 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, i))
        for rank, (s, missing, doc_id, _) in enumerate(sorted(scored)[:k], 1):
            out.append((item_id, rank, None if missing else doc_id, -s))
    return sorted(out, key=repr)


def run(spark, docs, items, **settings):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, ranked(d, b, **settings).collect()), key=repr)


def drawn(n, seed, size=60):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(80)] + ["Ünder", "ñandú", "It's", "x-y", "Aé"]
    rates = [1 / (i + 1) for i in range(len(words))]
    return [
        (i, " ".join(draw.choices(words, rates, k=draw.randrange(1, size)))) for i in range(n)
    ]


def test_equals_all_pairs(spark):
    docs = drawn(500, 1)
    assert run(spark, docs, drawn(12, 2, 9), k=7) == brute(docs, drawn(12, 2, 9), 7)


def test_blocks_of_items_and_trees(spark, monkeypatch):
    docs, items = drawn(300, 3), drawn(9, 4, 9)
    assert run(spark, docs, items, k=5, block_bytes=150) == brute(docs, items, 5)


def test_ties_go_by_id(spark):
    docs = [(i, "same words here") for i in range(120)] + [(None, "same words here"), (500, "other")]
    found = run(spark, docs, [(1, "words")], k=10)
    assert [r[2] for r in sorted(found, key=lambda r: r[1])] == list(range(10))
    assert found == brute(docs, [(1, "words")], 10)


def test_odd_texts(spark):
    docs = drawn(60, 5)
    docs += [(900, None), (901, ""), (902, " .,\n "), (903, "long " * 60_000), (903, "w1 w1"), (903, "w1 w1")]
    docs += [(None, "w2 w3"), (905, "İSTANBUL É É"), (906, "a\x00b\x7fc")]
    items = [(1, None), (2, "..."), (3, "w1 W1 w2 é İstanbul"), (3, "w1"), (None, "long w3 b"), (4, "nowhere")]
    assert run(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")]) == []
    assert run(spark, [(1, "a")], []) == []
    assert run(spark, [(1, None)], [(1, "a")]) == []
    assert run(spark, [(1, "a")], [(1, "b")]) == []


@pytest.fixture(scope="module")
def sparse():
    """Rows in two far-apart groups of columns."""
    draw = np.random.default_rng(8)
    rows = []
    for i in range(1500):
        cols = np.sort(draw.choice(40, draw.integers(1, 9), replace=False)) + (i % 2) * 40
        rows.append((cols, draw.integers(1, 900_000, len(cols))))
    starts = np.r_[0, np.cumsum([len(c) for c, _ in rows])]
    cols, vals = (np.concatenate([r[k] for r in rows]) for k in (0, 1))
    return rows, BallTree(starts, cols, vals, draw.integers(0, 9000, 80)), starts, cols, vals


def dense_scores(rows, query):
    cols, weights = query
    table = np.zeros(80, np.int64)
    table[cols] = weights
    return np.array([(table[c] * v).sum() for c, v in rows]), table


def test_bounds_hold_for_every_node(sparse):
    rows, tree, *_ = sparse
    weights = np.rint(tree._weights**2).astype(np.int64)
    queries = [(np.array(c), weights[np.array(c)]) for c in ([0, 3, 5], [44], [1, 60, 70, 79])]
    bounds = tree.bounds(queries)
    for query, bound in zip(queries, bounds, strict=True):
        scores, _ = dense_scores(rows, query)
        for node, (low, high) in enumerate(zip(tree.low, tree.high, strict=True)):
            assert scores[tree.order[low:high]].max() <= bound[node]


def test_subtrees_are_passed_over(sparse):
    rows, tree, *_ = sparse
    weights = np.rint(tree._weights**2).astype(np.int64)
    query = (np.array([44, 50]), weights[[44, 50]])
    scores, table = dense_scores(rows, query)
    met, leaves = {}, 0
    for found, own in tree.visit(tree.bounds([query])[0], table, lambda: 1):
        leaves += 1
        met |= dict(zip(found.tolist(), own.tolist(), strict=True))
    assert all(scores[i] == s for i, s in met.items())
    assert all(scores[i] == 0 for i in range(len(rows)) if i not in met)
    assert leaves < sum(not c for c in tree.child)


def test_chunks_of_columns_change_nothing(sparse, monkeypatch):
    rows, tree, starts, cols, vals = sparse
    weights = np.rint(tree._weights**2)
    query = (np.array([2, 30, 77]), weights[[2, 30, 77]])
    monkeypatch.setattr("eventweir.llm.ball_tree.CHUNK", 13)
    other = BallTree(starts, cols, vals, weights)
    assert np.allclose(other.radius, tree.radius, rtol=1e-6)
    assert np.allclose(other.bounds([query]), tree.bounds([query]), rtol=1e-6)
