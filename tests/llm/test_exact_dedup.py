"""Exact duplicates against a dictionary of normalised texts."""
import hashlib
import random

import pytest

from eventweir.llm import exact_dedup

SCHEMA = "doc_id long, text string"
SPACES = " \t\n\v\f\r"


def normal(text):
    return "".join(c for c in text or "" if c not in SPACES)


def by_hand(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(normal(text), []).append((-len(text or ""), i is None, i or 0))
    return {key: min(own) + (len(own),) for key, own in groups.items()}


def rows_of(rng):
    texts = ["", None, " \n", "a b", "a b", "a\tb ", "ab", "é", "é", "x" * 50_000]
    texts += ["same head of more than thirty-two bytes " + c for c in "abca"]
    rows = [(i, rng.choice(texts)) for i in range(400)]
    rows += [(500 + i, "hot " + " " * (i % 3)) for i in range(300)]
    return rows + [(None, "ab"), (None, "only null"), (7, rows[7][1]), (7, rows[7][1])]


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_groups_and_kept_rows(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = rows_of(random.Random(partitions))
        docs = spark.createDataFrame(rows, SCHEMA)
        found = exact_dedup.groups(docs).collect()
        kept = exact_dedup.distinct_rows(docs).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    expected = by_hand(rows)
    digests = {hashlib.sha256(k.encode()).hexdigest(): k for k in expected}
    assert len(found) == len(rows)
    for r in found:
        _, none, i, n = expected[digests[r.text_sha256]]
        assert (r.keep_id, r.group_size) == (None if none else i, n)
    assert sorted(digests[r.text_sha256] for r in found if r.kept) == sorted(expected)
    assert all(r.doc_id == r.keep_id for r in found if r.kept)
    assert sorted((normal(r.text), r.doc_id is None, r.doc_id or 0) for r in kept) == sorted(
        (k, none, i) for k, (_, none, i, _) in expected.items()
    )


def test_all_columns_stay_whatever_their_names(spark):
    schema = "doc_id string, text string, digest string, part int, row string, head string"
    rows = [("b", "t x", "d", 1, "r", None), ("a", "t  x", "e", 2, "s", "h"), ("c", "u", "f", 3, None, "")]
    docs = spark.createDataFrame(rows, schema)
    kept = exact_dedup.distinct_rows(docs)
    assert kept.schema == docs.schema
    assert sorted(map(tuple, kept.collect())) == [rows[1], rows[2]]


def test_an_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.groups(docs).collect() == []
    assert exact_dedup.distinct_rows(docs).collect() == []


def long_rows(rng):
    """Texts that share heads longer and shorter than a splitter's, with hot ones among them."""
    head, longer = "shared " * 200, "very long head " * 2_000
    rows = [(i, head + rng.choice(["x", "y", f"t{i}"]) + " " * (i % 4)) for i in range(150)]
    rows += [(200 + i, longer + rng.choice(["a", "b", "c"]) * (1 + i % 2)) for i in range(120)]
    return rows + [(400 + i, f"{rng.random()} own") for i in range(60)]


@pytest.mark.parametrize("seed", range(2))
def test_long_shared_heads_and_hot_texts(spark, seed):
    spark.conf.set("spark.sql.shuffle.partitions", 12)
    try:
        rows = long_rows(random.Random(seed))
        docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
        found = {r.doc_id: r for r in exact_dedup.groups(docs).collect()}
        kept = exact_dedup.distinct_rows(docs).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    expected = by_hand(rows)
    assert len(found) == len(rows)
    for i, text in rows:
        _, _, keep, size = expected[normal(text)]
        assert (found[i].keep_id, found[i].group_size, found[i].kept) == (keep, size, i == keep)
    assert sorted(r.doc_id for r in kept) == sorted(i for _, _, i, _ in expected.values())


def test_copies_of_one_text_are_spread(spark):
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    try:
        texts = [(i, "copy " * 50 if i % 2 else f"text {i}") for i in range(2_000)]
        docs = spark.createDataFrame(texts, SCHEMA)
        cuts = exact_dedup.splitters(docs, "doc_id", "text")
        ordered = exact_dedup._sorted_by_content(docs, [], "doc_id", "text")
        sizes = [r["count"] for r in ordered.groupBy("part").count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert len(sizes) == 8 and max(sizes) < 600
    assert sum(len(cut) > 3 for cut in cuts) >= 2  # whole keys where a text fills a range
    assert all(len(cut[0]) <= 8 for cut in cuts if len(cut) == 3)  # else a few bytes


def test_splitters_keep_the_order_of_keys():
    rng = random.Random(5)
    keys = sorted(
        exact_dedup._key(bytes(rng.choices(b"ab", k=rng.randint(0, 6))), b"", rng.randint(0, 2), i)
        for i in range(300)
    )
    cuts = [exact_dedup._splitter(a, b) for a, b in zip(keys, keys[1:], strict=False)][9::10]
    ranges = exact_dedup._Ranges(cuts)
    places = [ranges.place(key[0], -key[2], key[4]) for key in keys]
    assert [part for part, _ in places] == sorted(part for part, _ in places)
    for text in {key[0] for key in keys}:  # only texts that a splitter holds are spread
        own = {place for key, place in zip(keys, places, strict=True) if key[0] == text}
        assert len({split for _, split in own}) == 1
        assert len(own) == 1 or all(split is not None for _, split in own)
