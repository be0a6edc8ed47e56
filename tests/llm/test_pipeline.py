"""The pipeline against a plain model of its stages, and its edge cases."""


import corpus_pipeline
from test_decontamination import by_hand as contaminated
from test_simhash import by_hand as fingerprint
from test_simhash import classes

SF = "/root/testdata/sf0.001"


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def stage_inputs(spark, docs, sf_dir):
    """Each stage's function, input and output."""
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        yield stage, docs, out
        docs = out


def normal(text):
    return "".join(c for c in text or "" if c not in " \t\n\v\f\r")


def test_stages_equal_a_plain_model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = {r.doc_id: r for r in docs.collect()}
    steps = list(stage_inputs(spark, docs, SF))
    for stage, given, out in steps[:-1]:
        assert out.columns == docs.columns
        before, after = ids(given), ids(out)
        texts = {i: rows[i].text for i in before}
        if stage is corpus_pipeline.known_language:
            assert after == [i for i in before if any(map(str.isalpha, texts[i] or ""))]
        elif stage is corpus_pipeline.exact_duplicates:
            best = {}
            for i in before:
                key = normal(texts[i])
                best[key] = min(best.get(key, (1, 0)), (-len(texts[i] or ""), i))
            assert after == sorted(i for _, i in best.values())
        elif stage is corpus_pipeline.near_duplicates:
            groups = classes({i: fingerprint(texts[i]) for i in before}, 4)
            assert after == sorted(set(groups.values()))
        else:
            assert after == [i for i in before if not contaminated(texts[i], benchmark)[-1]]
    assert len(ids(steps[3][2])) < len(rows)
    left = set(ids(steps[3][2]))
    packed = steps[4][2].collect()
    assert {r.doc_id for r in packed} == left
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == left


def test_every_stage_with_odd_rows(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [
        (None, text, None, "x", 1),
        (1, None, "en", "x", 2),
        (2, "", "en", None, None),
        (3, " \n", None, "y", 1),
        (4, text + " é", "en", "z", 7),
        (4, text + " é", "en", "z", 7),
        (5, "solo " * 40_000, "en", "z", 7),
    ]
    schema = "doc_id long, text string, lang string, digest string, print long"
    docs = spark.createDataFrame(rows, schema)
    for stage, _, out in stage_inputs(spark, docs, SF):
        if stage is corpus_pipeline.packed_sequences:
            assert sum(r.length for r in out.collect()) > 40_000
        else:
            assert out.columns == docs.columns and out.count() >= 2


def test_every_stage_with_an_empty_table(spark):
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).collect() == []


def test_nothing_but_unlettered_texts_goes_first(spark):
    rows = [(i, t) for i, t in enumerate([None, "", "123 +-", "A", "é", "1a", "日本"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' lang")
    kept = corpus_pipeline.known_language(spark, docs, SF)
    assert ids(kept) == [3, 4, 5, 6]
