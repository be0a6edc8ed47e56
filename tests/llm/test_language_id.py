"""Naive Bayes against counts by hand, and its accuracy on held-out documents."""
import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from eventweir.llm import grams, language_id
from eventweir.llm.arrow import text_crc32

SCHEMA = "doc_id long, text string, lang string"


def test_counts_and_posterior_by_hand(spark, monkeypatch):
    rows = [(1, "Aa", "x"), (2, "ab", "y"), (3, "aa b", "x"), (4, None, "x"), (5, "zz", None)]
    model = language_id.train(spark.createDataFrame(rows, SCHEMA))
    assert model.languages == ("x", "y")
    assert np.allclose(np.exp(model.prior), [2 / 3, 1 / 3])

    def by_hand(texts):
        counts = [Counter() for _ in language_id.ORDERS]
        for batch in grams.batches(texts):
            for own, n in zip(counts, language_id.ORDERS, strict=True):
                own.update(batch.buckets(n, language_id.BITS).tolist())
        return counts

    learned = {"x": by_hand(["Aa", "aa b"]), "y": by_hand(["ab"])}
    logs = {}
    for lang, prior in (("x", 2 / 3), ("y", 1 / 3)):
        logs[lang] = math.log(prior)
        for own, seen in zip(learned[lang], by_hand(["aab"]), strict=True):
            total = sum(own.values()) + language_id.SMOOTHING * (1 << language_id.BITS)
            for bucket, n in seen.items():
                logs[lang] += n * math.log((own[bucket] + language_id.SMOOTHING) / total)
    odds = {k: math.exp(v - max(logs.values())) for k, v in logs.items()}
    found = language_id.score_texts(model, ["aab"])[0]
    assert np.allclose(found, [odds["x"] / sum(odds.values()), odds["y"] / sum(odds.values())], atol=1e-4)


def test_parts_of_long_texts_add_up(monkeypatch):
    text = "wörter und buchstaben " * 200
    whole = [b.buckets(1, 12) for b in grams.batches([text])]
    monkeypatch.setattr(grams, "PART", 100)
    parts = [b.buckets(1, 12) for b in grams.batches([text, "", "a"])]
    spaces = grams.Batch([0], [""]).buckets(1, 12)[0]
    count = lambda x: Counter(v for b in x for v in b.tolist() if v != spaces)
    assert count(parts) - count(whole) == Counter([grams.Batch([0], ["a"]).buckets(1, 12)[2]])
    numbers = np.concatenate([b.numbers for b in grams.batches([text, "", "a"])])
    assert numbers.tolist() == [0] * math.ceil(len(text) / 100) + [1, 2]


def test_odd_rows(spark):
    rows = [(1, "the cat", "en"), (2, "le chat", "fr"), (3, None, "en"), (4, "", "fr"), (5, "12 !", None)]
    rows += [(None, "the", None), (6, "the dog " * 50_000, None), (1, "the cat", "en")]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = language_id.identify(docs, F.col("doc_id") > 4).collect()
    by = {(r.doc_id, r.lang_pred) for r in found}
    assert len(found) == 8 and {(3, "und"), (4, "und"), (5, "und"), (6, "en"), (1, "en"), (2, "fr")} <= by
    assert all(0 <= r.score <= 1 for r in found)
    assert language_id.identify(docs.limit(0), F.lit(False)).collect() == []
    untaught = language_id.identify(docs, F.lit(True)).collect()
    assert {r.lang_pred for r in untaught} == {None, "und"}
    assert language_id.accepted_rows(docs, F.lit(True)).count() == 5


def test_held_out_accuracy_and_no_leak(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = text_crc32("doc_id") % 3 == 1
    changed = docs.withColumn("lang", F.when(held, F.lit("zz")).otherwise(F.col("lang")))
    found = language_id.identify(changed, held).join(docs, "doc_id").filter("held_out")
    right, n = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 250 and right > 0.97
