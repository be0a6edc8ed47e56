import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventweir.functions.envelope import MICROSECOND_JSON, POSITION_METADATA
from eventweir.functions.labels import UNROUTED, outcome_label, route_label
from eventweir.operators import publishing, routing
from eventweir.operators.projections import payload_bronze
from eventweir.plans.config import PAYLOAD_BASED, TOPIC_BASED, TopicConfig
from eventweir.plans.use_cases import (
    labelled_bronze,
    publish,
    split_by_payload,
    split_by_topic,
    split_valid,
    split_valid_faulty,
)
from eventweir.workspace import materialise

DDL = "eventType string, n bigint, error_code string"
CONFIG = TopicConfig("mixed", PAYLOAD_BASED, DDL, ("a", "b"))


def event(kind, n, code="0"):
    return json.dumps({"eventType": kind, "n": n, "error_code": code})


PAYLOADS = [
    event("a", 1),
    event("a", 2, "1"),
    event("b", 3, None),
    event("b", 4, "E1"),
    event("c", 5),
    event("", 6),
    '{"n":7}',
    "broken",
    None,
    "",
    "[]",
    event("b", 8, "-3"),
]


@pytest.fixture
def labelled(envelope_of):
    return labelled_bronze(envelope_of(PAYLOADS, "mixed"), CONFIG)


CODES = ["0", " 0 ", "1", "0.0", "0.4", "E1", "", None, "-0", "+7", "\t2\n", "1e0", "0x1", "٣",
         "99999999999999999999", "9223372036854775807", "- 1", "1 2", "true", "\x1f5\x7f"]


def outcomes_and_casts(spark, codes):
    df = spark.createDataFrame([(c,) for c in codes], "code string")
    rows = df.select(
        "code", outcome_label(F.col("code")).alias("o"), F.col("code").try_cast("bigint").alias("n")
    ).collect()
    return {r.code: (r.o, r.n) for r in rows}


def expected(number):
    return "undetermined" if number is None else "valid" if number == 0 else "faulty"


def test_outcomes_follow_the_cast(spark):
    got = outcomes_and_casts(spark, CODES)
    assert {c: o for c, (o, _) in got.items()} == {c: expected(n) for c, (_, n) in got.items()}
    assert [got[c][0] for c in ("0", " 0 ", "1", "0.0", "E1", "", None)] == [
        "valid", "valid", "faulty", "undetermined", "undetermined", "undetermined", "undetermined",
    ]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="0123456789+-. \t\n\r\x0b\x1c\x7fEe", max_size=6), min_size=200,
                max_size=400))
def test_matching_first_changes_no_outcome(spark, codes):
    for outcome, number in outcomes_and_casts(spark, codes).values():
        assert outcome == expected(number)


def test_numeric_codes(spark):
    df = spark.createDataFrame([(0,), (4,), (None,)], "code int")
    got = [r[0] for r in df.select(outcome_label(F.col("code"), is_text=False)).collect()]
    assert got == ["valid", "faulty", "undetermined"]


def test_every_record_goes_to_exactly_one_place(labelled):
    parts = [
        routing.valid(labelled).count(),
        routing.faulty(labelled).count(),
        routing.undetermined(labelled).count(),
        routing.unrouted(labelled).count(),
    ]
    assert parts == [1, 2, 2, 7]
    assert sum(parts) == len(PAYLOADS)


def test_conservation_counts_positions_once(spark):
    offsets = [0, 1, 32767, 32768, 32769, 65536, 10**12, 2**62]
    rows = [
        (kind, topic, partition, offset)
        for kind in ("a", "b", None)
        for topic in ("x", "y")
        for partition in (0, 1)
        for offset in offsets
    ]
    df = spark.createDataFrame(rows, "eventType string, topic string, partition int, offset bigint")
    for copies in (1, 3):
        many = df.crossJoin(spark.range(copies)).repartition(5)
        counted = routing.conservation(many).collect()
        assert {r.eventType: (r.records, r.positions) for r in counted} == {kind: (32 * copies, 32) for kind in ("a", "b", None)}


def test_reasons(labelled):
    rows = {r.offset: (r.reason, r.raw) for r in routing.unrouted(labelled).collect()}
    assert rows == {
        4: ("unknown_type", None),
        5: ("unknown_type", None),
        6: ("no_type", None),
        7: ("malformed", "broken"),
        8: ("no_type", None),
        9: ("no_type", None),
        10: ("malformed", "[]"),
    }


def test_rejects_come_with_their_text_where_it_is_kept(envelope_of):
    labelled = labelled_bronze(envelope_of(PAYLOADS, "mixed"), CONFIG, keep_raw=True)
    rows = {r.offset: r.raw for r in routing.unrouted(labelled).collect()}
    assert rows[4] == event("c", 5) and rows[7] == "broken" and rows[8] is None


def test_written_bronze_keeps_every_label(spark, labelled):
    """No folder per garbage type, and an empty type is not read back as NULL."""
    table = materialise(labelled, "test", routing.LABELS)
    assert {r.route for r in table.select("route").distinct().collect()} == {"a", "b", UNROUTED}
    same = ["offset", "eventType", "route", "outcome"]
    assert sorted(map(tuple, table.select(same).collect()), key=repr) == sorted(
        map(tuple, labelled.select(same).collect()), key=repr
    )


def test_types_that_look_like_numbers_dates_or_paths(spark, envelope_of):
    types = ("007", "7", "2024-01-01", "a/b", "x=y", "50 %", "ü", "A", "a")
    config = TopicConfig("mixed", PAYLOAD_BASED, DDL, types)
    labelled = labelled_bronze(envelope_of([event(t, i) for i, t in enumerate(types)]), config)
    table = materialise(labelled, "test", routing.LABELS)
    assert [routing.route(table, t).first().n for t in types] == list(range(len(types)))


def test_reserved_route_name(spark):
    with pytest.raises(ValueError, match=UNROUTED):
        route_label(F.col("eventType"), [UNROUTED])


def test_payload_without_code_field(envelope_of):
    bronze = payload_bronze(envelope_of(['{"eventType":"a"}']), "eventType string")
    assert routing.label(bronze, ["a"]).first().outcome == "undetermined"


def test_split_by_payload(labelled):
    tables = split_by_payload(labelled, CONFIG)
    assert {name: df.count() for name, df in tables.items()} == {
        "silver_a_mixed": 2,
        "silver_b_mixed": 3,
    }
    assert tables["silver_a_mixed"].columns == [
        "key", "topic", "eventTime", "eventType", "n", "error_code",
    ]


def test_split_valid(labelled):
    tables = split_valid(labelled, CONFIG)
    assert {name: df.count() for name, df in tables.items()} == {
        "silver_feb_a_mixed": 1,
        "silver_feb_b_mixed": 0,
    }
    assert routing.faulty(labelled, "b").first().n == 8


def test_split_by_topic(envelope_of):
    configs = [TopicConfig("x", TOPIC_BASED, "n bigint"), CONFIG]
    tables = split_by_topic(lambda topic: envelope_of([event("a", 5)], topic), configs)
    assert list(tables) == ["silver_x"]
    assert tables["silver_x"].first().n == 5


def test_labelled_bronze_refuses_single_type_topics(envelope_of):
    with pytest.raises(ValueError, match="single event type"):
        labelled_bronze(envelope_of([]), TopicConfig("x", TOPIC_BASED, DDL))


def test_quarantine_policies(labelled):
    valid, messages = split_valid_faulty(labelled)
    assert (valid.count(), messages.count()) == (1, 4)
    assert split_valid_faulty(labelled, "faulty_only")[1].count() == 2
    assert {r.topic for r in messages.collect()} == {"quarantine_events"}


def test_message_json(labelled):
    """NULL fields are left out, the key becomes base64, time is cut to milliseconds."""
    row = publishing.publish_route(labelled, "a").orderBy("value").first()
    assert (row.topic, row.key) == ("kafka_sink_a", "k0")
    assert json.loads(row.value) == {
        "key": "azA=",
        "topic": "mixed",
        "eventTime": "2024-05-01T12:00:00.000Z",
        "eventType": "a",
        "n": 1,
        "error_code": "0",
    }
    messages = publishing.publish_route(labelled, "b", MICROSECOND_JSON)
    null_code = json.loads(messages.where("key = 'k2'").first().value)
    assert "error_code" not in null_code
    assert null_code["eventTime"] == "2024-05-01 12:00:02.000000"


def test_publish_names_the_topic_per_row(labelled):
    assert {r.topic for r in publish(labelled).collect()} == {"kafka_sink_a", "kafka_sink_b"}
    named = publish(labelled, per_source_topic=True)
    assert {r.topic for r in named.collect()} == {"kafka_sink_a_mixed", "kafka_sink_b_mixed"}
    one_by_one = publishing.publish_route(labelled, "a").union(
        publishing.publish_route(labelled, "b")
    )
    assert sorted(map(tuple, publish(labelled).collect())) == sorted(
        map(tuple, one_by_one.collect())
    )


def test_messages_with_their_position(labelled):
    rows = routing.quarantined(labelled, metadata=POSITION_METADATA)
    messages = publishing.publish_quarantine(rows).collect()
    positions = [json.loads(m.value) for m in messages]
    assert sorted((p["topic"], p["partition"], p["offset"]) for p in positions) == [
        ("mixed", 0, 1), ("mixed", 0, 2), ("mixed", 0, 3), ("mixed", 0, 11),
    ]


def test_fan_out_without_type(spark):
    events = spark.createDataFrame([(1, "a"), (2, None)], "id int, eventType string")
    sent = publishing.fan_out(events, "all", key=F.col("id"))
    assert sorted((r.topic, r.key, r.value) for r in sent.collect()) == [
        ("a", "1", '{"id":1,"eventType":"a"}'),
        ("all", "1", '{"id":1,"eventType":"a"}'),
        ("all", "2", '{"id":2}'),
    ]
