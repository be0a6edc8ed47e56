"""Packed batches: read once at every moment, few folders, replays change nothing."""
import glob
import os

import pytest
from pyspark.sql import functions as F

from eventweir.plans.config import PAYLOAD_BASED, TopicConfig
from eventweir.plans.use_cases import labelled_bronze
from eventweir.plans.views import create_views
from eventweir.sources.files import stream_files
from eventweir.streaming import flows, sinks

SCHEMA = "id long, route string"


def batch(spark, number):
    rows = [(10 * number + i, "ab"[i % 2]) for i in range(4)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "table")
    for app_id in ("x", "y"):
        for number in range(5):
            sinks.replace_batch(batch(spark, number), path, app_id, number, ("route",))
    return path


def ids(spark, path):
    schema = batch(spark, 0).schema
    return sorted(r.id for r in sinks.read_batches(spark, path, schema).collect())


def compact(spark, path, last, app_id="x"):
    schema = batch(spark, 0).schema
    sinks.compact_batches(spark, path, app_id, last, schema, ("route",))


def test_rows_are_read_once_at_every_step(spark, table):
    expected = ids(spark, table)
    assert len(expected) == 40
    for app_id, last in (("x", 1), ("x", 3), ("x", 3), ("x", 2), ("y", 4), ("x", 4)):
        compact(spark, table, last, app_id)
        assert ids(spark, table) == expected
    sinks.replace_batch(batch(spark, 5), table, "x", 5, ("route",))
    assert len(ids(spark, table)) == 44


def test_folders_stay_few(spark, table):
    compact(spark, table, 2)
    compact(spark, table, 4)
    assert glob.glob(f"{table}/app_id=x/batch_id=*") == []
    assert [os.path.basename(p) for p in glob.glob(f"{table}/_packed/app_id=x/*")] == ["last=4"]
    assert len(glob.glob(f"{table}/_packed/app_id=x/last=4/route=*/*.parquet")) <= 4


def test_a_replayed_packed_batch_adds_nothing(spark, table):
    expected = ids(spark, table)
    compact(spark, table, 3)
    sinks.replace_batch(batch(spark, 2), table, "x", 2, ("route",))
    assert ids(spark, table) == expected
    compact(spark, table, 4)
    assert ids(spark, table) == expected


def test_an_unfinished_rewrite_counts_for_nothing(spark, table):
    expected = ids(spark, table)
    half = batch(spark, 0).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    half.parquet(f"{table}/_packed/app_id=x/last=3")
    assert ids(spark, table) == expected
    compact(spark, table, 3)
    assert ids(spark, table) == expected


def test_two_topics_in_one_session_into_catalog_tables(spark, envelope_of, tmp_path):
    configs, sources = [], {}
    for topic in ("first", "second"):
        payloads = ['{"eventType":"a","offset":%d,"error_code":"0"}' % i for i in range(3)]
        folder = str(tmp_path / topic)
        envelope_of([(topic, p) for p in payloads]).write.parquet(folder)
        sources[topic] = folder
        ddl = "eventType string, offset bigint, error_code string"
        configs.append(TopicConfig(topic, PAYLOAD_BASED, ddl, ("a",)))
    read = lambda topic: stream_files(spark, sources[topic])
    tables = [f"bronze_{c.topic}" for c in configs]
    try:
        running = flows.bronze_flows(read, configs, None, str(tmp_path / "cp"), sinks.AVAILABLE_NOW)
        assert len({q.name for q in running}) == 2
        for query in running:
            query.awaitTermination()
        for config in configs:
            names = create_views(spark, f"bronze_{config.topic}", config, prefix="p_")
            rows = spark.table(names[0])
            assert rows.count() == 3 and {"p_offset", "topic"} <= set(rows.columns)
            assert rows.select("topic").distinct().first().topic == config.topic
            comment = spark.sql(f"DESCRIBE EXTENDED bronze_{config.topic}").where("col_name = 'Comment'")
            assert config.topic in comment.first().data_type
    finally:
        for view in ("silver_a_first", "silver_feb_a_first", "silver_a_second", "silver_feb_a_second"):
            spark.sql(f"DROP VIEW IF EXISTS {view}")
        for name in tables:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_prefix_reaches_every_composition(spark, envelope_of):
    from eventweir.functions.envelope import POSITION_METADATA
    from eventweir.operators import publishing, routing
    from eventweir.plans.use_cases import split_by_payload, split_by_topic, split_valid

    ddl = "eventType string, offset bigint, error_code string"
    config = TopicConfig("t", PAYLOAD_BASED, ddl, ("a",))
    envelope = envelope_of(['{"eventType":"a","offset":5,"error_code":"0"}'])
    labelled = labelled_bronze(envelope, config)
    with pytest.raises(ValueError, match="clash"):
        publishing.publish_routes(labelled, metadata=POSITION_METADATA)
    sent = publishing.publish_routes(labelled, metadata=POSITION_METADATA, prefix="p_").first()
    assert '"p_offset":5' in sent.value and '"offset":0' in sent.value
    single = TopicConfig("t", "topic_based", ddl)
    frames = [
        split_by_topic(lambda t: envelope, [single], prefix="p_")["silver_t"],
        split_by_payload(labelled, config, prefix="p_")["silver_a_t"],
        split_valid(labelled, config, prefix="p_")["silver_feb_a_t"],
        routing.valid(labelled, prefix="p_"),
    ]
    assert all(df.select(F.col("p_offset")).first()[0] == 5 for df in frames)
