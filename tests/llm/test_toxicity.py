"""Positive-unlabelled learning: the risk estimator, the features, accuracy on held-out rows."""
import random

import numpy as np
from pyspark.sql import functions as F

from eventweir.llm import grams, toxicity
from eventweir.llm.arrow import text_crc32

DOCS, LABELS = "doc_id long, text string", "doc_id long, toxic int"


def test_words_are_hashed_as_wholes():
    batch = grams.Batch([0, 1, 2], ["Hello wörld", "", "wörld, HELLO? xhello"])
    begin, bucket = batch.words()
    assert len(begin) == 5 and bucket[0] == bucket[3] and bucket[1] == bucket[2]
    assert bucket[4] not in bucket[:2]


def keyed(text):
    """Features of exactly the words and n-grams of a short text."""
    feature = np.full(toxicity._WIDTH, -1)
    own = toxicity.buckets_present([text])
    feature[own] = np.arange(len(own))
    key = np.zeros(len(own), np.uint64)
    for batch in grams.batches([text]):
        _, which, hashed = toxicity._places(batch, feature)
        key[which] = hashed
    return feature, key


def test_presence_is_that_of_a_set():
    feature, key = keyed("bad")
    matrix = toxicity.presence(["bad words", "good", "", "BAD!! bad,bad"], feature, key)
    hashed = grams.Batch([0], ["bad"]).words()[1][0]
    word = int(np.flatnonzero(key == hashed)[0])
    assert matrix[:, word].tolist() == [1, 0, 0, 1]
    assert set(np.unique(matrix)) <= {0, 1}


def test_other_words_of_a_bucket_are_no_features():
    feature, key = keyed("bad")
    feature[:] = 0  # every bucket leads to the feature of one word
    draw = random.Random(2)
    words = {"".join(draw.choices("abcdefgh", k=7)) for _ in range(5000)}
    hashed = grams.Batch([0], ["bad"]).words()[1][:1]
    assert toxicity.presence([" ".join(words)], feature, hashed).sum() == 0
    assert toxicity.presence([" ".join(words) + " bad"], feature, hashed).sum() == 1


def test_a_long_text_counts_once_in_each_bucket():
    long = "bad words and others " * 30_000
    assert len(long) > 2 * grams.PART
    short = set(toxicity.buckets_present(["bad words and others " * 3]).tolist())
    once, twice = (toxicity.buckets_present([long] * n) for n in (1, 2))
    assert len(once) == len(set(once.tolist())) and short <= set(once.tolist())
    assert len(once) < len(short) + 100  # words that a part's border cuts
    assert max(np.unique(twice, return_counts=True)[1]) == 2


def test_words_across_the_borders_of_windows_are_met():
    feature, key = keyed("unmistakable")
    for window in (toxicity.WINDOW, grams.PART):
        for at in range(window - 14, window + 3):
            text = "a" * (at - 1) + " unmistakable " + "b" * 50
            assert toxicity.presence([text], feature, key).any()
            found = [
                key[which] == hashed
                for batch in grams.batches([text], window, toxicity.OVERLAP)
                for _, which, hashed in [toxicity._places(batch, feature)]
            ]
            word = grams.Batch([0], ["unmistakable"]).words()[1][0]
            assert np.concatenate(found).any() and word in key


def test_clean_texts_stay_clean_however_long(spark):
    """On the table of 10,000: clean held-out documents joined, and with a toxic one among them."""
    root = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{root}/{t}.parquet") for t in ("documents", "labels"))
    rows = docs.select(F.col("doc_id").alias("id"), (text_crc32("doc_id") % 5 == 0).alias("held"), "text")
    known = labels.select(F.col("doc_id").alias("id"), "toxic")
    model = toxicity.train(rows, known, F.col("held"))
    held = rows.filter("held").join(known, "id").orderBy("id").collect()
    clean = [r.text for r in held if r.toxic == 0]
    toxic = [r.text for r in held if r.toxic == 1]
    found = toxicity.score_texts(model, clean + toxic)
    toxic = [t for t, score in zip(toxic, found[len(clean) :], strict=True) if score > 0.9]
    assert (found[: len(clean)] >= 0.5).mean() < 0.01 and len(toxic) > 50
    draw = random.Random(3)
    for size, times in ((30_000, 8), (400_000, 8), (2_000_000, 2)):
        for _ in range(times):
            parts, total = [], 0
            while total < size:
                parts.append(draw.choice(clean))
                total += len(parts[-1]) + 1
            plain = "\n".join(parts)
            parts.insert(draw.randrange(len(parts)), draw.choice(toxic))
            score, with_toxic = toxicity.score_texts(model, [plain, "\n".join(parts)])
            assert score < 0.5 and with_toxic > score
    throughout = "\n".join(toxic)
    assert len(throughout) > 30_000 and toxicity.score_texts(model, [throughout])[0] > 0.9


def test_a_classifier_finds_positives_hidden_among_unlabelled():
    """Two of ten features mark the positives; a fifth of the unlabelled rows are positive too."""
    rng = np.random.default_rng(0)

    def rows(n, positive):
        share = np.full(10, 0.2)
        share[:2] = 0.95 if positive else 0.05
        return (rng.random((n, 10)) < share).astype(np.float32)

    other = np.vstack([rows(800, True), rows(3200, False)])
    weights, constant = toxicity.fit(rows(400, True), other, 0.2, seed=1)
    yes = lambda x: (x @ weights + constant > 0).mean()
    assert yes(rows(2000, True)) > 0.85 and yes(rows(2000, False)) < 0.05


def corpus(spark, n=600):
    calm = ["tree", "river", "stone", "cloud", "bird", "road", "light", "house"]
    docs, labels, rng = [], [], random.Random(4)
    for i in range(n):
        toxic = i % 6 == 0
        words = [rng.choice(calm) for _ in range(40)] + ([f"vile{rng.choice('abc')}"] * 2 if toxic else [])
        docs.append((i, " ".join(words)))
        if i // 6 % 2 == 0:  # labelled ones are as often toxic as all
            labels.append((i, int(toxic)))
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)


def test_held_out_rows_and_their_labels_are_never_learned_from(spark):
    docs, labels = corpus(spark)
    held = text_crc32("doc_id") % 5 == 0
    found = toxicity.toxicity(docs, labels, held).orderBy("doc_id").collect()
    by_hand = [(r.doc_id, r.doc_id % 6 == 0) for r in found]
    right = [(r.predicted == 1) == toxic for r, (_, toxic) in zip(found, by_hand, strict=True) if r.held_out]
    assert len(right) > 60 and np.mean(right) > 0.95
    flipped = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.toxicity(docs, flipped, held).orderBy("doc_id").collect()
    assert [r.score for r in found] == [r.score for r in again]


def test_odd_rows(spark):
    docs, labels = corpus(spark)
    odd = [(None, "vilea"), (900, None), (901, ""), (0, "tree"), (902, "tree vilea vilea " * 40_000)]
    docs = docs.union(spark.createDataFrame(odd, DOCS)).withColumn("score", F.lit("x"))
    labels = labels.union(spark.createDataFrame([(0, None), (None, 1), (2, 0), (2, 0)], LABELS))
    found = toxicity.toxicity(docs, labels, F.lit(False)).collect()
    assert len(found) == 605 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    by_id = {r.doc_id: r.score for r in found}
    assert by_id[900] == by_id[901] < 0.5 < by_id[902]
    assert toxicity.toxicity(docs.limit(0), labels, F.lit(False)).collect() == []
    none = toxicity.toxicity(docs, labels.filter("toxic = 0"), F.lit(False)).collect()
    assert {r.score for r in none} == {0.0}


def test_held_out_accuracy(spark):
    from eventweir.llm.queries import QUERIES

    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = QUERIES["op1_nonnegative_pu"](spark, folder).join(labels, "doc_id").filter("held_out")
    rows = found.select("score", "toxic").collect()
    yes = np.array([r.score for r in rows if r.toxic == 1])
    no = np.array([r.score for r in rows if r.toxic == 0])
    area = (yes[:, None] > no[None, :]).mean() + 0.5 * (yes[:, None] == no[None, :]).mean()
    assert area > 0.95 and (no < 0.5).mean() > 0.98 and (yes >= 0.5).mean() > 0.7
