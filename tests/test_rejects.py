"""Labels for every kind of flaw, and what becomes of the records that carry one."""
import json

import pytest
from pyspark.sql import functions as F

from eventweir.operators import publishing, routing
from eventweir.operators.registry import REGISTRY_SCHEMA, load_registry, save_registry
from eventweir.operators.targets import target_collisions, target_plan
from eventweir.plans.config import PAYLOAD_BASED, TopicConfig
from eventweir.plans.use_cases import labelled_bronze
from eventweir.workspace import materialise

DDL = "eventType string, n bigint, error_code string"
TYPES = ("a", "b", "12", "2024-01-01")


def labelled(envelope_of, payloads, ddl=DDL, types=TYPES, **options):
    config = TopicConfig("t", PAYLOAD_BASED, ddl, types)
    return labelled_bronze(envelope_of(payloads), config, **options)


def outcomes(df):
    return [r.outcome for r in df.orderBy("offset").collect()]


@pytest.mark.parametrize("kind", ["double", "float", "decimal(10,2)", "bigint", "int"])
def test_number_codes_are_compared_as_they_are(envelope_of, kind):
    codes = ["0", "0.0", "0.4", "-0.9", "1", "null"] if kind in ("double", "float") else ["0", "2", "null"]
    payloads = ['{"eventType":"a","error_code":%s}' % c for c in codes]
    found = outcomes(labelled(envelope_of, payloads, DDL.replace("error_code string", f"error_code {kind}")))
    expected = {"0": "valid", "0.0": "valid", "null": "undetermined"}
    assert found == [expected.get(c, "faulty") for c in codes]


@pytest.mark.parametrize("name", ["", "__HIVE_DEFAULT_PARTITION__", "_unrouted"])
def test_types_that_a_folder_cannot_give_back_are_refused(envelope_of, name):
    with pytest.raises(ValueError, match="not usable"):
        labelled(envelope_of, ["{}"], types=("a", name))


def test_every_listed_type_survives_the_write(envelope_of):
    types = (*TYPES, "x/y", "a b", "ä", "null", "a=b", "%41")
    payloads = [json.dumps({"eventType": t, "error_code": "0"}) for t in types]
    written = materialise(labelled(envelope_of, payloads, types=types), "types", routing.LABELS)
    for t in types:
        assert routing.route(written, t).count() == 1, t
    assert publishing.publish_routes(written).count() == len(types)


FLAWS = {
    '{"eventType":"a","n":1,"error_code":"0"}': "valid",
    '{"eventType":"a","n":"oops","error_code":"0"}': "partial",
    '{"eventType":"a","n":"oops"}': "partial",
    '{"eventType":"a","n":"oops","error_code":"1"}': "faulty",
    '{"eventType":"a","n":1,"error_code":"E"}': "undetermined",
    '{"n":"oops","error_code":"0"}': "no_type",
    '{"n":1}': "no_type",
    '{"eventType":"z"}': "unknown_type",
    '{"eventType":"z","n":"oops"}': "unknown_type",
    '{"eventType":"a"': "malformed",
    "[1]": "malformed",
    "5": "malformed",
}


@pytest.mark.parametrize("keep_raw", [True, False])
def test_rejects_hold_all_that_is_not_valid(envelope_of, keep_raw):
    table = labelled(envelope_of, list(FLAWS), keep_raw=keep_raw)
    rows = {r.offset: r for r in routing.rejects(table).collect()}
    reasons = list(FLAWS.values())
    assert {i: r.reason for i, r in rows.items()} == {i: f for i, f in enumerate(reasons) if f != "valid"}
    for i, text in enumerate(FLAWS):
        if i in rows and (keep_raw or "oops" in text or reasons[i] == "malformed"):
            assert rows[i].raw == text
        elif i in rows:
            assert json.loads(rows[i].raw).items() <= json.loads(text).items()
    valid = routing.valid(table).count()
    assert valid + len(rows) == table.count() == len(FLAWS)
    sent = publishing.publish_rejects(routing.rejects(table)).collect()
    assert sorted(json.loads(r.value)["reason"] for r in sent) == sorted(f for f in reasons if f != "valid")


def test_partial_rows_keep_their_text(envelope_of):
    table = labelled(envelope_of, list(FLAWS))
    (first, second) = routing.partial(table).orderBy("error_code").collect()
    assert (first.n, second.n) == (None, None) and "oops" in first._corrupt_record
    assert routing.quarantined(table).count() == 4
    assert routing.quarantined(table, "faulty_only").count() == 1


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_counts_need_no_sort(envelope_of):
    plan = physical(routing.conservation(labelled(envelope_of, ["{}"])))
    assert "HashAggregate" in plan and "Sort" not in plan


def test_an_event_is_encoded_once_for_all_its_messages(spark):
    events = spark.range(3).selectExpr("id", "cast(id as string) eventType")
    plan = physical(publishing.fan_out(events, "all"))
    assert plan.count("StructsToJson") == 1 and plan.index("Generate") < plan.index("StructsToJson")
    assert publishing.fan_out(events, "all").count() == 6


def plan_of(spark, rows):
    return target_plan(spark.createDataFrame(rows, REGISTRY_SCHEMA))


def test_collisions_across_kinds_and_case(spark):
    rows = [
        ("all", None, "payload_based", ["click", "click", "x"]),
        ("click_all", None, "topic_based", None),
        ("X_ALL", None, "topic_based", None),
        ("feb_x_all", None, "topic_based", None),
        ("more", None, "payload_based", ["X"]),
    ]
    found = {tuple(r) for r in target_collisions(plan_of(spark, rows)).collect()}
    assert found == {
        ("table", "silver_click_all", 2),
        ("table", "silver_x_all", 2),
        ("table", "silver_feb_x_all", 2),
    }


@pytest.mark.parametrize("kind", [None, "other"])
def test_unknown_kinds_raise(spark, kind):
    with pytest.raises(Exception, match="topic t has no known kind"):
        plan_of(spark, [("t", None, kind, None)]).collect()


def test_only_committed_versions_of_a_registry_are_read(spark, tmp_path):
    path = str(tmp_path)
    rows = spark.createDataFrame([("t", None, "topic_based", None)], REGISTRY_SCHEMA)
    with pytest.raises(ValueError, match="no committed"):
        load_registry(spark, path)
    save_registry(rows, path, 1)
    save_registry(rows.withColumn("pipeline_id", F.lit("p")), path, 2)
    unfinished = rows.withColumn("pipeline_id", F.lit("q"))
    unfinished.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        f"{path}/version=10"
    )
    assert load_registry(spark, path).first().pipeline_id == "p"
    for stale in (1, 2):
        with pytest.raises(ValueError, match="at version 2"):
            save_registry(rows, path, stale)
    save_registry(rows, path, 10)
    assert load_registry(spark, path).first().pipeline_id is None
