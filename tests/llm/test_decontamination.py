"""Contaminated words against a word-by-word model."""
import hashlib
import random
import re

import pytest

from eventweir.llm import decontamination
from eventweir.llm.decontamination import contamination

DOC, ITEM = "doc_id long, text string", "item_id long, text string"


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def by_hand(text, benchmark):
    """n_words, n_hit, n_items, items_sha256, contaminated."""
    words, hit, items = words_of(text), set(), set()
    for item, item_text in benchmark:
        own = words_of(item_text)
        size = min(13, len(own))
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else ()
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in windows:
                hit.update(range(i, i + size))
                items.add("" if item is None else str(item))
    digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
    bad = bool(hit) and 20 * len(hit) >= len(words)
    return len(words), len(hit), len(items), digest, bad


def found(spark, docs, items, **settings):
    result = contamination(
        spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM), **settings
    )
    return sorted(
        (r.doc_id if r.doc_id is not None else -1, (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated))
        for r in result.collect()
    )


def expected(docs, items):
    return sorted((i if i is not None else -1, by_hand(t, items)) for i, t in docs)


def corpus(rng):
    some = lambda n: " ".join(rng.choice(["Ab", "b", "c1", "dé", "E-e", "ff"]) for _ in range(n))
    items = [(i, some(rng.choice([1, 2, 5, 13, 14, 30]))) for i in range(12)]
    items += [(3, items[3][1]), (None, "Null id ITEM"), (50, None), (51, "... --"), (10, "x" * 70)]
    docs = []
    for i in range(80):
        parts = [some(rng.randrange(40))]
        if rng.random() < 0.7:
            parts += [rng.choice(items)[1] or "", some(rng.randrange(200))]
        docs.append((i, rng.choice([" ", "\n", "!?"]).join(parts)))
    docs += [(None, items[4][1]), (900, None), (901, ""), (902, "?!"), (7, docs[7][1])]
    docs += [(903, "x" * 70), (904, "x" * 71), (905, "null ID item"), (906, "w " * 50_000 + items[5][1])]
    return docs, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_equals_the_word_by_word_model(spark, block_bytes):
    docs, items = corpus(random.Random(3))
    assert found(spark, docs, items, block_bytes=block_bytes) == expected(docs, items)


def test_an_empty_benchmark_and_empty_documents(spark):
    docs = [(1, "some words here"), (2, None)]
    assert found(spark, docs, []) == expected(docs, [])
    assert found(spark, [], [(1, "a b")]) == []


def test_share_of_a_twentieth(spark):
    item = " ".join(f"q{i}" for i in range(13))
    docs = [(n, item + " z" * (n - 13)) for n in (13, 259, 260, 261)]
    judged = {i: own[-1] for i, own in found(spark, docs, [(1, item)])}
    assert judged == {13: True, 259: True, 260: True, 261: False}


def test_clean_rows_keep_all_columns(spark):
    docs = spark.createDataFrame(
        [(1, "a b c", "s"), (2, "other words", None)], DOC + ", n_words string"
    )
    items = spark.createDataFrame([(5, "b")], ITEM)
    kept = decontamination.clean_rows(docs, items)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(2, "other words", None)]


def test_many_strings_at_once():
    rng = random.Random(8)
    strings = [b" " + bytes(rng.choice(b"ab ") for _ in range(rng.randrange(1, 40))) for _ in range(300)]
    strings = sorted(set(strings))
    text = bytes(rng.choice(b"ab ") for _ in range(5000))
    direct = sorted((i, s) for s in strings for i in range(len(text)) if text.startswith(s, i))
    assert sorted(decontamination.Matcher(strings).find(text)) == direct
