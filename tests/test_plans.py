"""The physical plans that make the operators hold at scale."""

import re

import pytest

from checks import catalog
from checks import fixture as fx
from eventweir.operators import publishing, routing, schema_drift, schema_sampling
from eventweir.operators.projections import topic_table
from eventweir.operators.registry import allocate
from eventweir.operators.targets import target_plan
from eventweir.plans.config import TOPIC_BASED, TopicConfig
from eventweir.plans.use_cases import labelled_bronze, split_by_topic
from eventweir.sources.files import topic_reader
from eventweir.workspace import materialise, shared_dir

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plan_of(spark):
    def explain(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return explain


@pytest.fixture(scope="module")
def envelope(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "env")
    df = fx.envelopes(fx.read_events(spark, SMALL))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@pytest.fixture(scope="module")
def bronze(spark):
    return catalog.bronze(spark, SMALL)


def test_decoding_parses_once_without_shuffle_or_python(plan_of, envelope):
    for df in (topic_table(envelope, fx.PAYLOAD_DDL), labelled_bronze(envelope, fx.CONFIG)):
        plan = plan_of(df)
        assert plan.count("from_json(") == 1
        assert "Exchange" not in plan and "Python" not in plan
        assert not re.search(r"\bFilter ", plan)


@pytest.mark.parametrize(
    "select, filters",
    [
        (lambda b: routing.route(b, "click"), "(route#N = click)"),
        (routing.valid, "(outcome#N = valid)"),
        (routing.faulty, "(outcome#N = faulty)"),
        (routing.undetermined, "(outcome#N = undetermined)"),
        (routing.quarantined, "outcome#N IN (faulty,undetermined,partial)"),
        (routing.unrouted, "(route#N = _unrouted)"),
        (lambda b: publishing.publish_route(b, "view"), "(route#N = view)"),
        (publishing.publish_routes, "NOT (route#N = _unrouted)"),
    ],
)
def test_targets_read_only_their_partitions(plan_of, bronze, select, filters):
    plan = re.sub(r"#\d+L?", "#N", plan_of(select(bronze)))
    assert filters in re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan).group(1)
    assert "from_json" not in plan and "Exchange" not in plan


def test_one_field_of_a_route_reads_one_column(plan_of, bronze):
    plan = plan_of(routing.route(bronze, "click").select("user_id"))
    schema = re.search(r"ReadSchema: (\S+)", plan).group(1)
    assert schema == "struct<decodeValue:struct<user_id:bigint>>"


def test_a_staged_topic_is_read_by_itself(spark, plan_of, envelope):
    staged = materialise(envelope, "staged", ("topic",))
    config = TopicConfig(fx.TOPIC, TOPIC_BASED, fx.PAYLOAD_DDL)
    (table,) = split_by_topic(topic_reader(staged), [config]).values()
    plan = re.sub(r"#\d+L?", "#N", plan_of(table))
    assert f"(topic#N = {fx.TOPIC})" in plan.split("PartitionFilters")[1]
    assert plan.count("from_json(") == 1 and "Exchange" not in plan


def test_schema_aggregate_is_partial(plan_of, envelope):
    plan = plan_of(schema_sampling.infer_schemas(envelope))
    assert "partial_schema_of_variant_agg" in plan and "Python" not in plan


def test_profile_counts_before_the_shuffle(plan_of, envelope):
    plan = plan_of(schema_drift.field_profile(envelope))
    assert "partial_count" in plan and "SortAggregate" not in plan
    assert "Join" not in plan


def test_drift_walks_the_messages_once(spark, plan_of, envelope):
    config = TopicConfig(fx.TOPIC, TOPIC_BASED, fx.PAYLOAD_DDL)
    profile = schema_drift.field_profile(envelope)
    report = schema_drift.schema_drift(profile, schema_drift.registered_fields(spark, [config]))
    plan = plan_of(report)
    assert "variant_explode" in plan_of(profile)
    assert "variant_explode" not in plan and "parse_json" not in plan
    assert {r.verdict for r in report.collect()} == {"match"}


def test_allocation_has_no_cross_join(spark, plan_of):
    plan = plan_of(allocate(fx.registry(spark, SMALL), fx.LIMIT))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_target_plan_is_one_pass(spark, plan_of):
    plan = plan_of(target_plan(fx.registry(spark, SMALL)))
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


class _Session:
    """As much of a session as the shared folder is looked up in."""

    def __init__(self, master, **conf):
        self.conf, self.sparkContext = conf, type("Context", (), {"master": master})


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://host", "local-cluster[2,1,1024]"])
def test_a_driver_s_own_disk_is_no_shared_folder(master):
    warehouse = {"spark.sql.warehouse.dir": "file:/home/me/spark-warehouse"}
    with pytest.raises(ValueError, match="checkpoint.dir"):
        shared_dir(_Session(master, **warehouse))
    assert shared_dir(_Session("local[4]", **warehouse)) == "file:/home/me/spark-warehouse/_eventweir"
    assert shared_dir(_Session(master, **warehouse | {"spark.checkpoint.dir": "file:/shared/"})) == "file:/shared"
    assert shared_dir(_Session(master, **{"spark.sql.warehouse.dir": "hdfs://n/w"})) == "hdfs://n/w/_eventweir"
