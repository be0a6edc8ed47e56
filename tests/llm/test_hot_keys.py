"""Joins whose key may be hot are split by adaptive execution."""
import pytest
from pyspark.sql import functions as F

from eventweir.llm import components, simhash, warc

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.files.maxPartitionBytes": "8k",
    "spark.sql.files.openCostInBytes": "1k",
    "spark.sql.files.minPartitionNum": "16",
}


@pytest.fixture
def tight(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def splits(df):
    """How many joins of the plan that ran were split."""
    df.collect()
    return str(df._jdf.queryExecution().executedPlan()).count("skew=true")


def stored(spark, df, tmp_path, name):
    df.repartition(16).write.parquet(f"{tmp_path}/{name}")
    return spark.read.parquet(f"{tmp_path}/{name}")


def test_a_hub_of_stars(tight, tmp_path):
    rows = tight.range(1, 60_001).select(F.col("id").alias("high"), F.lit(0).cast("long").alias("low"))
    edges = stored(tight, rows, tmp_path, "edges")
    minima, _ = components._minima(edges.union(edges.select(F.col("low").alias("high"), F.col("high").alias("low"))))
    assert splits(components._large_stars(edges, minima)) == 1
    turned = stored(tight, rows.select((F.col("high") + 60_000).alias("low"), F.lit(200_000).cast("long").alias("high")), tmp_path, "t")
    minima, _ = components._minima(turned)
    assert splits(components._small_stars(turned.select("high", "low"), minima)) == 1


def test_copies_of_one_print(tight, monkeypatch, tmp_path):
    words = [f"w{i}" for i in range(400)]
    texts = tight.range(6000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 2 == 0, F.lit("one and the same text of some words"))
        .otherwise(F.concat_ws(" ", *[F.element_at(F.array(*map(F.lit, words)), (F.xxhash64("id", F.lit(k)) % 200 + 200).cast("int") + 1) for k in range(12)]))
        .alias("text"),
    )
    found = simhash.near_duplicates(stored(tight, texts, tmp_path, "texts"))
    assert splits(found) >= 1
    same = found.filter("doc_id % 2 = 0").select("component_id").distinct().collect()
    assert [r.component_id for r in same] == [0]


def test_copies_of_one_page(tight, monkeypatch, tmp_path):
    pages = tight.range(4000).select(
        F.col("id").alias("page_id"), F.lit("http://a/").alias("url"),
        F.when(F.col("id") % 2 == 0, F.lit("error " * 30)).otherwise(F.repeat(F.col("id").cast("string"), 40)).alias("html"),
    )
    plans = []
    monkeypatch.setattr(warc, "_write", lambda *_: lambda batches: iter(()))
    real = warc.materialise

    def seen(df, name, *args, **kwargs):
        if name == "warc-index":
            plans.append(splits(df))
        return real(df, name, *args, **kwargs)

    monkeypatch.setattr(warc, "materialise", seen)
    warc.write_archives(stored(tight, pages, tmp_path, "pages"))
    assert plans == [1]
