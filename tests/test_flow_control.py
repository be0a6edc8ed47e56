"""Flows that follow the registry, counts, receivers, and tables that grow under a stream."""
import os
import shutil
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from eventweir.functions.envelope import ENVELOPE_SCHEMA
from eventweir.operators import registry as reg
from eventweir.plans import flow_control
from eventweir.plans.config import PAYLOAD_BASED, TOPIC_BASED, TopicConfig
from eventweir.plans.use_cases import labelled_bronze
from eventweir.sources.files import stream_files
from eventweir.streaming import flows, sinks
from eventweir.streaming.counts import batch_counts
from eventweir.streaming.receiving import deduplicated, published_positions


def registry(spark, *rows):
    return spark.createDataFrame([(*r, None) for r in rows], reg.REGISTRY_SCHEMA)


def test_changes(spark):
    asked = registry(
        spark, ("a", "p1", TOPIC_BASED), ("b", "p1", PAYLOAD_BASED), ("c", "p2", TOPIC_BASED), ("d", None, TOPIC_BASED)
    )
    active = spark.createDataFrame(
        [("p1", "silver_a", "a"), ("p1", "silver_c", "c"), ("p1", "silver_a", "a")], flow_control.FLOW_SCHEMA
    )
    found = flow_control.flow_changes(flow_control.requested_flows(asked), active)
    assert sorted(map(tuple, found.collect())) == [
        ("p1", "bronze_b", "b", "start"),
        ("p1", "silver_a", "a", "keep"),
        ("p1", "silver_c", "c", "stop"),
        ("p2", "silver_c", "c", "start"),
    ]


@pytest.fixture
def source(tmp_path, spark, envelope_of):
    """A folder of envelopes, and a function that adds some."""
    path = str(tmp_path / "source")

    def add(texts, first=0, times=1):
        rows = envelope_of(texts).withColumn("offset", F.col("offset") + first)
        for _ in range(times):
            rows.coalesce(1).write.mode("append").parquet(path)

    return path, add


def test_a_topic_allocated_later_is_served(spark, tmp_path, source):
    path, add = source
    add(['{"x":1}'])
    started = []

    def start(topic):
        if topic == "bad":
            raise ValueError("no configuration")
        started.append(topic)
        stream = stream_files(spark, path)
        (query,) = flows.topic_flows(
            lambda t: stream, [TopicConfig(topic, TOPIC_BASED, "x int")], f"{tmp_path}/out", f"{tmp_path}/ck",
            {"processingTime": "1 hour"},
        )
        return query

    rows = [("one", "p", TOPIC_BASED), ("bad", "p", TOPIC_BASED), ("other", "q", TOPIC_BASED)]
    try:
        came = flow_control.follow_registry(spark, registry(spark, *rows), "p", start)
        assert came == {"silver_one": "start", "silver_bad": "failed to start: no configuration"}
        first = next(q for q in spark.streams.active if q.name == "silver_one")
        later = [("one", "p", TOPIC_BASED), ("two", "p", TOPIC_BASED)]
        assert flow_control.follow_registry(spark, registry(spark, *later), "p", start) == {"silver_two": "start"}
        assert first.isActive and started == ["one", "two"]
        names = {r.flow for r in flow_control.active_flows(spark, "p").collect()}
        assert names == {"silver_one", "silver_two"}
        assert flow_control.follow_registry(spark, registry(spark, ("two", "p", TOPIC_BASED)), "p", start) == {"silver_one": "stop"}
        assert not first.isActive
        assert flow_control.follow_registry(spark, registry(spark, ("two", "p", TOPIC_BASED)), "p", start) == {}
    finally:
        for query in spark.streams.active:
            query.stop()


CONFIG = TopicConfig("t", PAYLOAD_BASED, "eventType string, error_code string, n int", ("click", "view"))
TEXTS = [
    '{"eventType":"click","error_code":"0"}', '{"eventType":"view","error_code":"1"}',
    '{"eventType":"view"}', '{"eventType":"other","error_code":"0"}', "broken",
    '{"eventType":"click","error_code":"0","n":"x"}', '{"eventType":"click","error_code":"0"}',
]
COUNTS = {"valid": 2, "faulty": 1, "undetermined": 1, "partial": 1, "_unrouted": 2}


def run_counted(spark, path, out, outputs=()):
    labelled = labelled_bronze(stream_files(spark, path, max_files=1), CONFIG)
    flows.payload_flow(
        labelled, f"{out}/table", f"{out}/ck", "app", outputs, sinks.AVAILABLE_NOW, counts=f"{out}/counts"
    ).awaitTermination()


def totals(spark, out):
    found = batch_counts(spark, f"{out}/counts").groupBy("outcome").agg(F.sum("records").alias("n"))
    return {r.outcome: r.n for r in found.collect()}


def test_counts_add_up_and_a_replayed_batch_counts_once(spark, tmp_path, source):
    path, add = source
    add(TEXTS)
    add(TEXTS, 100)

    def fails_once(batch, batch_id):
        if batch_id == 1 and not died:
            died.append(1)
            raise RuntimeError("executor lost")

    died = []
    output = (lambda table: table, fails_once)
    with pytest.raises(Exception, match="executor lost"):
        run_counted(spark, path, tmp_path, [output])
    run_counted(spark, path, tmp_path, [output])
    assert totals(spark, tmp_path) == {k: 2 * n for k, n in COUNTS.items()}
    table = sinks.read_batches(spark, f"{tmp_path}/table")
    assert {r.outcome: r["count"] for r in table.groupBy("outcome").count().collect()} == totals(spark, tmp_path)
    per_batch = batch_counts(spark, f"{tmp_path}/counts").groupBy("batch_id").agg(F.sum("records").alias("n"))
    assert {r.batch_id: r.n for r in per_batch.collect()} == {0: 7, 1: 7}


def test_batches_are_seen_whole_or_not_at_all(spark, tmp_path, source):
    path, add = source
    add(TEXTS)
    add(TEXTS, 100)
    run_counted(spark, path, tmp_path)
    os.remove(f"{tmp_path}/table/app_id=app/batch_id=1/_SUCCESS")
    assert sinks.read_batches(spark, f"{tmp_path}/table").count() == 7
    shutil.rmtree(f"{tmp_path}/table/app_id=app")
    assert sinks.read_batches(spark, f"{tmp_path}/table").count() == 0
    assert batch_counts(spark, f"{tmp_path}/none").count() == 0


def test_receivers_see_each_position_once(spark, tmp_path, source):
    path, add = source
    add(["a", "b", "c"], times=2)
    add(["c", "d"], first=2)
    once = deduplicated(stream_files(spark, path, max_files=1), "1 hour", time="timestamp")
    sinks.table_sink(once, f"{tmp_path}/o", f"{tmp_path}/ck", trigger=sinks.AVAILABLE_NOW).awaitTermination()
    found = spark.read.schema(ENVELOPE_SCHEMA).parquet(f"{tmp_path}/o")
    assert sorted((r.offset, bytes(r.value)) for r in found.collect()) == [(0, b"a"), (1, b"b"), (2, b"c"), (3, b"d")]
    batch = deduplicated(spark.read.schema(ENVELOPE_SCHEMA).parquet(path), "1 hour")
    assert batch.count() == 4


def test_old_positions_are_forgotten(spark, tmp_path):
    """The state holds the positions of one delay, not of the whole stream."""
    path = f"{tmp_path}/source"
    for hour in range(8):
        rows = [(b"k", b"v", "t", 0, hour * 10 + i, datetime(2024, 5, 1, hour, 0, i), 0) for i in range(10)]
        spark.createDataFrame(rows, ENVELOPE_SCHEMA).coalesce(1).write.mode("append").parquet(path)
        os.utime(max((f"{path}/{f}" for f in os.listdir(path) if f.endswith(".parquet")), key=os.path.getmtime), (hour, hour))
    once = deduplicated(stream_files(spark, path, max_files=1), "1 hour", time="timestamp")
    query = sinks.table_sink(once, f"{tmp_path}/o", f"{tmp_path}/ck", trigger=sinks.AVAILABLE_NOW)
    query.awaitTermination()
    held = [s.numRowsTotal for p in query.recentProgress for s in p.stateOperators]
    assert max(held) <= 40 < 80 and spark.read.parquet(f"{tmp_path}/o").count() == 80


def test_receivers_need_a_timestamp(spark, tmp_path, source):
    path, add = source
    add(["a"])
    stream = stream_files(spark, path).withColumn("timestamp", F.col("timestamp").cast("string"))
    with pytest.raises(ValueError, match="watermark"):
        deduplicated(stream, "1 hour", time="timestamp")


def test_positions_of_messages(spark):
    text = '{"key":"a","topic":"t","partition":3,"offset":7,"eventTime":"2024-05-01 00:00:00.000000","n":1}'
    row = published_positions(spark.createDataFrame([("k", text)], "key string, value string")).first()
    assert (row.topic, row.partition, row.offset, row.eventTime) == ("t", 3, 7, datetime(2024, 5, 1))


def run_catalog(spark, path, checkpoint, ddl):
    (query,) = flows.topic_flows(
        lambda t: stream_files(spark, path), [TopicConfig("grows", TOPIC_BASED, ddl)], None, checkpoint,
        sinks.AVAILABLE_NOW,
    )
    query.awaitTermination()


def test_a_catalog_table_grows_and_refuses(spark, tmp_path, source):
    path, add = source
    spark.sql("DROP TABLE IF EXISTS silver_grows")
    try:
        add(['{"x":1,"y":"a"}'])
        run_catalog(spark, path, f"{tmp_path}/ck", "x int")
        add(['{"x":2,"y":"b"}'], 10)
        run_catalog(spark, path, f"{tmp_path}/ck", "x int, y string")
        found = spark.table("silver_grows").orderBy("x").select("x", "y").collect()
        assert list(map(tuple, found)) == [(1, None), (2, "b")]
        with pytest.raises(ValueError, match="cannot append"):
            run_catalog(spark, path, f"{tmp_path}/ck", "x string, y string")
        with pytest.raises(ValueError, match="another checkpoint"):
            run_catalog(spark, path, f"{tmp_path}/fresh", "x int, y string")
        assert spark.table("silver_grows").count() == 2
    finally:
        spark.sql("DROP TABLE silver_grows")
