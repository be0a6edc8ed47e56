import pytest
from pyspark.sql import functions as F

from eventweir.functions.decoding import CORRUPT, check_field_names, payload_schema
from eventweir.operators.projections import (
    DECODED,
    decode,
    flatten,
    payload_bronze,
    redecode,
    topic_table,
)

DDL = "a bigint, b string"


def decoded(envelope_of, text, ddl=DDL):
    return decode(envelope_of([text]), ddl).first()[DECODED]


@pytest.mark.parametrize("text", [None, ""])
def test_nothing_to_decode(envelope_of, text):
    assert decoded(envelope_of, text) is None


@pytest.mark.parametrize("text", ["not json", '{"a":1,"b":'])
def test_malformed_text_is_kept(envelope_of, text):
    row = decoded(envelope_of, text)
    assert (row.a, row.b, row[CORRUPT]) == (None, None, text)


@pytest.mark.parametrize("text", ["[]", '[{"a":1},{"a":2}]'])
def test_arrays_are_not_records(envelope_of, text):
    row = decoded(envelope_of, text)
    assert (row.a, row.b) == (None, None)


def test_wrong_type_loses_only_its_field(envelope_of):
    text = '{"a":"x","b":"kept"}'
    row = decoded(envelope_of, text)
    assert (row.a, row.b, row[CORRUPT]) == (None, "kept", text)


def test_object_in_a_text_field_is_its_json(envelope_of):
    assert decoded(envelope_of, '{"b":{"z":1}}').b == '{"z":1}'


def test_last_of_duplicate_keys_wins(envelope_of):
    assert decoded(envelope_of, '{"a":1,"a":2}').a == 2


def test_names_are_case_sensitive(envelope_of):
    row = decoded(envelope_of, '{"A":1,"b":"x"}')
    assert (row.a, row.b) == (None, "x")


def test_corrupt_text_survives_selecting_it_alone(envelope_of):
    """A pruned parser schema would not see the type error in ``a``."""
    text = '{"a":"x","b":"kept"}'
    only = decode(envelope_of([text]), DDL).select(F.col(DECODED)[CORRUPT].alias("c"))
    assert only.first().c == text


def test_schema_from_both_notations():
    assert payload_schema("a bigint, b struct<c:string>") == payload_schema(
        "struct<a:bigint,b:struct<c:string>>"
    )
    with pytest.raises(ValueError, match="must be a struct"):
        payload_schema(payload_schema("a array<int>")["a"].dataType)


def test_topic_table_columns(envelope_of):
    table = topic_table(envelope_of(['{"a":1,"b":"x"}']), DDL)
    assert table.columns == [
        "key", "topic", "partition", "offset", "eventTime", "timestampType", "a", "b",
    ]
    assert dict(table.dtypes)["eventTime"] == "timestamp"


def test_payload_bronze_columns(envelope_of):
    table = payload_bronze(envelope_of(["{}"]), "eventType string, a bigint", keep_raw=True)
    assert table.columns == [
        "key", "topic", "partition", "offset", "eventTime", "timestampType", DECODED, "raw",
        "eventType",
    ]


def test_payload_bronze_needs_the_type_field(envelope_of):
    with pytest.raises(ValueError, match="no field eventType"):
        payload_bronze(envelope_of(["{}"]), DDL)


@pytest.mark.parametrize("ddl", ["key string", "Topic string"])
def test_clash_with_record_columns(envelope_of, ddl):
    with pytest.raises(ValueError, match=ddl.split()[0]):
        topic_table(envelope_of(["{}"]), ddl)
    assert f"p_{ddl.split()[0]}" in topic_table(envelope_of(["{}"]), ddl, prefix="p_").columns


@pytest.mark.parametrize("ddl", ["id bigint, ID bigint", "s struct<x:int,X:int>",
                                 "s array<struct<x:int,X:int>>"])
def test_names_that_differ_only_by_case(ddl):
    with pytest.raises(ValueError, match="only by case"):
        check_field_names(payload_schema(ddl))


def test_field_names_with_dots_and_spaces(envelope_of):
    table = topic_table(envelope_of(['{"a.b":1,"c d":"x"}']), "`a.b` bigint, `c d` string")
    row = table.first()
    assert (row["a.b"], row["c d"]) == (1, "x")


def test_corrupt_column_on_request(envelope_of):
    rows = flatten(decode(envelope_of(["oops"]), DDL), with_corrupt=True).collect()
    assert rows[0][CORRUPT] == "oops"


def test_record_time_without_zone(spark, envelope_of):
    envelope = envelope_of(['{"a":1}'])
    plain = envelope.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    assert dict(topic_table(plain, DDL).dtypes)["eventTime"] == "timestamp_ntz"


def test_decoding_again_under_a_wider_schema(envelope_of):
    old, new = "eventType string, a string", "eventType string, a bigint, b double"
    envelope = envelope_of(['{"eventType":"x","a":1,"b":0.5}', "oops"])
    table = payload_bronze(envelope, old, keep_raw=True)
    expected = payload_bronze(envelope, new, keep_raw=True)
    again = redecode(table, new)
    assert again.columns == expected.columns
    assert again.collect() == expected.collect()
    with pytest.raises(ValueError, match="keep_raw"):
        redecode(payload_bronze(envelope, old), new)
