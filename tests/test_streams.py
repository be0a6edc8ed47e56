import json

import pytest
from pyspark.sql import functions as F

from checks import catalog
from checks import fixture as fx
from eventweir.functions.envelope import ENVELOPE_SCHEMA
from eventweir.operators import routing
from eventweir.plans.config import PAYLOAD_BASED, TOPIC_BASED, TopicConfig
from eventweir.plans.use_cases import (
    labelled_bronze,
    publish,
    split_by_payload,
    split_valid,
    split_valid_faulty,
)
from eventweir.plans.views import create_views
from eventweir.sources.files import read_files, stream_files, stream_table
from eventweir.streaming import flows, sinks
from eventweir.streaming.evolving import (
    add_missing_columns,
    append_evolving,
    merge_schemas,
    read_evolving,
)
from eventweir.workspace import read_written

SMALL = "/root/testdata/sf0.001"
NOW = sinks.AVAILABLE_NOW


def rows(df):
    return sorted((str(r) for r in df.collect()))


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    """Envelopes in six files, so that one file per trigger gives six micro-batches."""
    path = str(tmp_path_factory.mktemp("source") / "env")
    df = fx.envelopes(fx.read_events(spark, SMALL))
    df.repartition(6, "offset").write.parquet(path)
    return path, df.schema


@pytest.fixture
def labelled_stream(spark, source):
    path, schema = source
    return labelled_bronze(stream_files(spark, path, schema, max_files=1), fx.CONFIG)


@pytest.fixture
def labelled_batch(spark, source):
    path, schema = source
    return labelled_bronze(read_files(spark, path, schema), fx.CONFIG)


def test_bronze_stream_equals_batch(spark, source, labelled_batch, tmp_path):
    path, schema = source
    (query,) = flows.bronze_flows(
        lambda topic: stream_files(spark, path, schema, max_files=1),
        [fx.CONFIG, TopicConfig("single", TOPIC_BASED, "n int")],
        str(tmp_path), str(tmp_path / "cp"), NOW,
    )
    query.awaitTermination()
    assert query.name == "bronze_all_events" and query.lastProgress["batchId"] == 5
    table = read_written(spark, str(tmp_path / "bronze_all_events"), labelled_batch.schema)
    assert rows(table) == rows(labelled_batch)
    # restarted, it finds nothing new
    (query,) = flows.bronze_flows(
        lambda topic: stream_files(spark, path, schema, max_files=1),
        [fx.CONFIG], str(tmp_path), str(tmp_path / "cp"), NOW,
    )
    query.awaitTermination()
    assert table.count() == 1000


def test_topic_flows(spark, source, tmp_path):
    path, schema = source
    started = flows.topic_flows(
        lambda topic: stream_files(spark, path, schema),
        [fx.CONFIG, TopicConfig("events", TOPIC_BASED, fx.PAYLOAD_DDL)],
        str(tmp_path), str(tmp_path / "cp"), NOW,
    )
    assert [q.name for q in started] == ["silver_events"]
    started[0].awaitTermination()
    assert spark.read.parquet(str(tmp_path / "silver_events")).count() == 1000


def test_routes_survive_a_failed_batch(spark, labelled_stream, labelled_batch, tmp_path):
    """The third batch dies after its write; the replay must not add its rows again."""
    table, checkpoint = str(tmp_path / "table"), str(tmp_path / "cp")

    def dies_once(batch, batch_id):
        sinks.replace_batch(batch, table, "r", batch_id, routing.LABELS)
        if batch_id == 2:
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        sinks.batch_sink(labelled_stream, dies_once, checkpoint, "dies", NOW).awaitTermination()
    assert 0 < spark.read.parquet(table).count() < 1000
    flows.payload_flow(labelled_stream, table, checkpoint, "r", trigger=NOW).awaitTermination()
    written = sinks.read_batches(spark, table, labelled_batch.schema)
    assert rows(written) == rows(labelled_batch)


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_replay_under_another_routing_rule_leaves_nothing_behind(
    spark, labelled_batch, tmp_path, mode
):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    sinks.replace_batch(labelled_batch, path, "r", 0, routing.LABELS)
    other = labelled_batch.withColumn("route", F.lit("one"))
    sinks.replace_batch(other, path, "r", 0, routing.LABELS)
    spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    table = sinks.read_batches(spark, path, labelled_batch.schema)
    assert table.count() == 1000
    assert [r.route for r in table.select("route").distinct().collect()] == ["one"]


def test_new_app_id_keeps_older_batches(spark, labelled_batch, tmp_path):
    path = str(tmp_path / "t")
    for app_id in ("first", "second"):
        sinks.replace_batch(labelled_batch, path, app_id, 0, routing.LABELS)
    assert sinks.read_batches(spark, path, labelled_batch.schema).count() == 2000


@pytest.mark.parametrize("policy", ["quarantine_undetermined", "faulty_only"])
def test_quarantine_stream_equals_batch(spark, labelled_stream, labelled_batch, tmp_path, policy):
    table, messages = str(tmp_path / "table"), str(tmp_path / "messages")
    output = flows.quarantine_output(sinks.file_messages(messages, "q"), policy)
    flows.payload_flow(
        labelled_stream, table, str(tmp_path / "cp"), "q", [output], NOW
    ).awaitTermination()
    valid, expected = split_valid_faulty(labelled_batch, policy)
    stored = sinks.read_batches(spark, table, labelled_batch.schema)
    assert rows(routing.valid(stored)) == rows(valid)
    assert rows(sinks.read_messages(spark, messages)) == rows(expected)


def test_unknown_policy():
    with pytest.raises(ValueError, match="policy"):
        flows.quarantine_output(print, policy="drop")


def test_publish_stream_equals_batch(spark, labelled_stream, labelled_batch, tmp_path):
    messages = str(tmp_path / "messages")
    output = flows.publish_output(sinks.file_messages(messages, "p"))
    flows.payload_flow(
        labelled_stream, str(tmp_path / "table"), str(tmp_path / "cp"), "p", [output], NOW
    ).awaitTermination()
    assert rows(sinks.read_messages(spark, messages)) == rows(publish(labelled_batch))


def test_failed_message_output_is_repeated_but_the_table_is_not(
    spark, labelled_stream, labelled_batch, tmp_path
):
    """At least once: the batch whose sending failed is sent again, its rows are not added again."""
    table, checkpoint = str(tmp_path / "table"), str(tmp_path / "cp")
    sent, fail = [], [True]

    def send(messages, batch_id):
        sent.append((batch_id, messages.count()))
        if batch_id == 1 and fail.pop() is True:
            raise RuntimeError("broker away")

    def run():
        fail.append(len(sent) == 0)
        output = flows.publish_output(send)
        flows.payload_flow(
            labelled_stream, table, checkpoint, "p", [output], NOW
        ).awaitTermination()

    with pytest.raises(Exception, match="broker away"):
        run()
    run()
    assert [batch_id for batch_id, _ in sent] == [0, 1, 1, 2, 3, 4, 5]
    assert sent[1] == sent[2]
    assert rows(sinks.read_batches(spark, table, labelled_batch.schema)) == rows(labelled_batch)


def test_messages_streamed_from_the_bronze_table(spark, labelled_batch, tmp_path):
    """The outgoing topics can follow bronze as a stream of their own."""
    bronze = str(tmp_path / "bronze")
    labelled_batch.write.partitionBy(*routing.LABELS).parquet(bronze)
    stream = publish(stream_files(spark, bronze, labelled_batch.schema))
    sinks.table_sink(
        stream, str(tmp_path / "out"), str(tmp_path / "cp"), trigger=NOW
    ).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(publish(labelled_batch))


def test_batch_without_records(spark, labelled_batch, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_batch(labelled_batch.where("false"), path, "r", 0, routing.LABELS)
    written = flows.written_batch(labelled_batch, path, "r", 0)
    assert routing.quarantined(written).count() == 0


def test_catalog_sink_and_table_stream(spark, labelled_stream, tmp_path):
    sinks.catalog_sink(
        labelled_stream, "bronze_test", str(tmp_path / "cp"), partition_by=["route"],
        trigger=NOW, comment="it's raw",
    ).awaitTermination()
    try:
        assert spark.table("bronze_test").count() == 1000
        routed = stream_table(spark, "bronze_test").where("route = 'click'")
        sinks.table_sink(
            routed, str(tmp_path / "click"), str(tmp_path / "cp2"), trigger=NOW
        ).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "click")).count() == 200
    finally:
        spark.sql("DROP TABLE bronze_test")


def test_views_by_table_name(spark, labelled_stream, labelled_batch, tmp_path):
    sinks.catalog_sink(
        labelled_stream, "bronze_views", str(tmp_path / "cp"), routing.LABELS, trigger=NOW
    ).awaitTermination()
    try:
        names = create_views(spark, "bronze_views", fx.CONFIG)
        assert len(names) == 10
        views = {**split_by_payload(labelled_batch, fx.CONFIG),
                 **split_valid(labelled_batch, fx.CONFIG)}
        assert set(names) == set(views)
        for name in ("silver_click_all_events", "silver_feb_view_all_events"):
            view = spark.sql(f"SELECT * FROM {name}")
            assert view.columns == views[name].columns
            assert rows(view) == rows(views[name])
        plan = spark.table("silver_feb_view_all_events")._jdf.queryExecution().executedPlan()
        filters = plan.toString().split("PartitionFilters: [")[1].split("PushedFilters")[0]
        assert "= view" in filters and "= valid" in filters
        for name in names:
            spark.sql(f"DROP VIEW {name}")
    finally:
        spark.sql("DROP TABLE bronze_views")


def test_compaction_packs_files(spark, labelled_batch, tmp_path):
    path, packed = str(tmp_path / "t"), str(tmp_path / "packed")
    for batch_id in range(3):
        sinks.replace_batch(labelled_batch, path, "r", batch_id, routing.LABELS)
    table = sinks.read_batches(spark, path, labelled_batch.schema)
    sinks.compact(table, packed, routing.LABELS)
    again = read_written(spark, packed, labelled_batch.schema)
    assert rows(again) == rows(table)
    # five types in three outcomes, and the unrouted
    assert len(again.inputFiles()) == 16 < len(table.inputFiles())


def test_compaction_spreads_a_hot_route(spark, labelled_batch, tmp_path):
    packed = str(tmp_path / "packed")
    hot = labelled_batch.withColumn("route", F.lit("hot")).withColumn("outcome", F.lit("valid"))
    hot = hot.withColumn("key", F.repeat(F.sha2("key", 256), 50).cast("binary"))
    conf = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(conf, "64k")
    try:
        sinks.compact(hot, packed, routing.LABELS)
    finally:
        spark.conf.unset(conf)
    files = read_written(spark, packed, hot.schema).inputFiles()
    assert len(files) > 1 and all("route=hot/outcome=valid" in f for f in files)


def test_compaction_needs_adaptive_execution(spark, labelled_batch):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with pytest.raises(ValueError, match="adaptive"):
            sinks.compact(labelled_batch, "unused", routing.LABELS)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_production_envelopes_stream(spark, envelope_of, tmp_path):
    ddl = "eventType string, error_code string"
    config = TopicConfig("mixed", PAYLOAD_BASED, ddl, ("a",))
    texts = [json.dumps({"eventType": "a", "error_code": c}) for c in ("0", "1", "E")]
    envelope_of(texts, "mixed").write.parquet(str(tmp_path / "in"))
    stream = labelled_bronze(stream_files(spark, str(tmp_path / "in"), ENVELOPE_SCHEMA), config)
    flows.payload_flow(
        stream, str(tmp_path / "t"), str(tmp_path / "cp"), "r", trigger=NOW
    ).awaitTermination()
    table = sinks.read_batches(spark, str(tmp_path / "t"), stream.schema)
    assert sorted(r.outcome for r in table.collect()) == ["faulty", "undetermined", "valid"]


def test_restart_with_a_wider_payload_schema(spark, envelope_of, tmp_path):
    """Drift found, schema widened, stream restarted on the same checkpoint and table."""
    source, table = str(tmp_path / "in"), str(tmp_path / "table")

    def run(ddl):
        config = TopicConfig("mixed", PAYLOAD_BASED, ddl, ("a",))
        labelled = labelled_bronze(stream_files(spark, source, ENVELOPE_SCHEMA), config)
        flows.payload_flow(
            labelled, table, str(tmp_path / "cp"), "r", trigger=NOW
        ).awaitTermination()
        return routing.route(sinks.read_batches(spark, table, labelled.schema), "a")

    event = {"eventType": "a", "error_code": "0", "s": {"x": 1}}
    envelope_of([json.dumps(event)], "mixed").write.parquet(source)
    run("eventType string, error_code string, s struct<x:int>")
    wider = {**event, "s": {"x": 2, "y": "new"}, "n": 0.5}
    envelope_of([json.dumps(wider)], "mixed").write.mode("append").parquet(source)
    after = run("eventType string, error_code string, s struct<x:int,y:string>, n double")
    assert sorted((r.s.x, r.s.y, r.n) for r in after.collect()) == [
        (1, None, None),
        (2, "new", 0.5),
    ]


def test_append_with_more_columns(spark, tmp_path):
    path = str(tmp_path / "evolving")
    one = spark.createDataFrame([(1, ("x",))], "id int, s struct<a:string>")
    two = spark.createDataFrame([(2, ("y", 5), 0.5)], "id int, s struct<a:string,b:int>, v double")
    schema = append_evolving(two, path, append_evolving(one, path))
    assert schema.simpleString() == "struct<id:int,s:struct<a:string,b:int>,v:double>"
    known = read_evolving(spark, path, schema)
    assert [json.loads(v) for v in sorted(known.toJSON().collect())] == [
        {"id": 1, "s": {"a": "x"}},
        {"id": 2, "s": {"a": "y", "b": 5}, "v": 0.5},
    ]
    merged = read_evolving(spark, path)
    assert set(merged.columns) == {"id", "s", "v"} and merged.count() == 2
    with pytest.raises(ValueError, match="column v is double"):
        append_evolving(spark.createDataFrame([("q",)], "v string"), path, schema)
    assert known.count() == 2
    assert merge_schemas(schema, one.schema) == schema


def test_appends_that_would_ruin_the_table_are_refused(spark, tmp_path):
    path = str(tmp_path / "kept")
    append_evolving(spark.createDataFrame([(1, [(1,)])], "A int, l array<struct<x:int>>"), path)
    for ddl in ("a int", "A string", "l array<struct<x:string>>", "l array<struct<X:int>>"):
        with pytest.raises(ValueError):
            append_evolving(spark.createDataFrame([], ddl), path)
    wider = spark.createDataFrame([(2, [(2, "y")])], "A int, l array<struct<x:int,y:string>>")
    append_evolving(wider, path)
    rows = {r.A: r.l for r in read_evolving(spark, path).collect()}
    assert rows[1][0].y is None and rows[2][0].y == "y"


def test_a_flow_that_changes_a_type_is_refused_at_its_start(spark, envelope_of, tmp_path):
    envelope_of(['{"eventType":"a","n":1,"error_code":"0"}']).write.parquet(str(tmp_path / "in"))

    def run(app_id, ddl):
        stream = stream_files(spark, str(tmp_path / "in"))
        config = TopicConfig("t", PAYLOAD_BASED, ddl, ("a",))
        flows.payload_flow(
            labelled_bronze(stream, config), str(tmp_path / "table"), str(tmp_path / app_id), app_id,
            trigger=sinks.AVAILABLE_NOW,
        ).awaitTermination()

    run("one", "eventType string, n bigint, error_code string")
    for ddl in ("eventType string, n string, error_code string", "eventType string, N bigint"):
        with pytest.raises(ValueError):
            run("two", ddl)
    run("three", "eventType string, n bigint, error_code string, m string")
    table = sinks.read_batches(spark, str(tmp_path / "table"))
    assert [r.n for r in routing.valid(table).collect()] == [1, 1]
    assert "m" in routing.valid(table).columns


def test_catalog_table_gets_missing_columns(spark):
    spark.sql("CREATE TABLE grown (id INT) USING parquet")
    try:
        wanted = spark.createDataFrame([], "ID int, `odd ``name` string, v double").schema
        assert add_missing_columns(spark, "grown", wanted) == ["odd `name", "v"]
        assert add_missing_columns(spark, "grown", wanted) == []
        assert spark.table("grown").columns == ["id", "odd `name", "v"]
    finally:
        spark.sql("DROP TABLE grown")


@pytest.fixture(scope="module")
def one_file(spark, tmp_path_factory):
    """A folder whose table of 160,000 events is one file of one row group."""
    path = str(tmp_path_factory.mktemp("one_file"))
    number = F.col("id")
    events = spark.range(0, 160_000, 1, 1).select(
        number.alias("event_id"),
        F.timestamp_seconds(number).cast("timestamp_ntz").alias("ts"),
        (number % 100).alias("user_id"),
        F.element_at(F.array(*map(F.lit, fx.EVENT_TYPES)), (number % 5 + 1).cast("int")).alias(
            "event_type"
        ),
        (number / 4).alias("value"),
        F.lit("{}").alias("props"),
    )
    events.write.parquet(f"{path}/events.parquet")
    assert len(events.sparkSession.read.parquet(f"{path}/events.parquet").inputFiles()) == 1
    return path


def digest(df):
    """The rows of a large table, in any order, as their number and a sum of hashes."""
    hashed = F.xxhash64(*[F.col(c).cast("string") for c in df.columns]).cast("decimal(38,0)")
    return tuple(df.agg(F.count("*"), F.sum(hashed)).first())


def test_a_large_file_is_dealt_to_many_tasks(spark, one_file, tmp_path):
    seen = []

    def process(batch, batch_id):
        files = batch.groupBy(F.input_file_name()).count().collect()
        seen.append([r["count"] for r in files])

    stream = fx.stream_events(spark, one_file)
    sinks.batch_sink(stream, process, str(tmp_path / "cp"), trigger=NOW).awaitTermination()
    assert [len(counts) for counts in seen] == [2, 2, 2]
    assert max(map(max, seen)) <= fx.FILE_EVENTS and sum(map(sum, seen)) == 160_000
    sinks.table_sink(
        fx.stream_events(spark, one_file), str(tmp_path / "t"), str(tmp_path / "cp2"), trigger=NOW
    ).awaitTermination()
    source = fx.read_events(spark, one_file)
    table = read_written(spark, str(tmp_path / "t"), source.schema)
    assert digest(table) == digest(source)


def test_rejects_of_a_large_file_come_from_many_tasks(spark, one_file):
    sent = catalog.stream_rejects(spark, one_file)
    table = sent.inputFiles()[0].split("/messages/")[0] + "/table"
    written = spark.read.option("basePath", table).parquet(f"{table}/app_id=*")
    task = F.regexp_extract(F.input_file_name(), r"part-(\d+)", 1)
    tasks = written.select("batch_id", task.alias("task")).distinct().groupBy("batch_id").count()
    assert {r["batch_id"]: r["count"] for r in tasks.collect()} == {0: 2, 1: 2, 2: 2}
    envelope = fx.flawed_envelopes(fx.read_events(spark, one_file))
    wanted = routing.rejects(labelled_bronze(envelope, fx.FLAWED_CONFIG))
    columns = ["partition", "offset", "reason", "raw"]
    assert digest(sent.select(columns)) == digest(wanted.select(columns))
