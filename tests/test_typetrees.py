import itertools
import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventweir.functions.typetrees import VOID, declared, join, join_all, overlay, path_hints
from eventweir.operators import sampling_ledger, schema_tracking
from eventweir.operators.schema_sampling import infer_schemas

LEAVES = [T.NullType(), T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType()]


def structs(inner):
    fields = st.dictionaries(st.sampled_from("abcd"), inner, max_size=3)
    return fields.map(
        lambda d: T.StructType([T.StructField(n, d[n]) for n in sorted(d)])
    )


TREES = st.recursive(
    st.sampled_from(LEAVES), lambda inner: inner.map(T.ArrayType) | structs(inner), max_leaves=8
)


@settings(max_examples=300, deadline=None)
@given(TREES, TREES, TREES)
def test_join_is_a_join(a, b, c):
    assert join(a, b) == join(b, a)
    assert join(join(a, b), c) == join(a, join(b, c))
    assert join(a, a) == a
    assert join(a, VOID) == a
    assert join(join(a, b), b) == join(a, b)


def test_join_by_example(spark):
    assert join_all([]) == VOID
    assert join(T.LongType(), T.DoubleType()) == T.DoubleType()
    assert join(T.BooleanType(), T.LongType()) == T.StringType()
    a, b = (T.StructType.fromDDL(d) for d in ("x long, y array<long>", "y array<double>, z string"))
    assert join(a, b) == T.StructType.fromDDL("x long, y array<double>, z string")
    assert join(a, T.LongType()) == T.StringType()
    assert declared(T.StructType()) == T.StringType()


def test_overlay_at_any_depth(spark):
    inferred = T.StructType.fromDDL("id long, o struct<p:struct<q:double,r:long>,s:string>, l array<struct<x:long>>")
    hints = T.StructType.fromDDL("o struct<p:struct<q:string>>, l array<struct<x:double,y:date>>, new int")
    assert overlay(inferred, hints) == T.StructType.fromDDL(
        "id long, o struct<p:struct<q:string,r:long>,s:string>, l array<struct<x:double,y:date>>, new int"
    )
    assert overlay(inferred, T.StructType.fromDDL("o string, id array<int>")) == T.StructType.fromDDL(
        "id array<int>, o string, l array<struct<x:long>>"
    )
    assert overlay(inferred, T.StructType()) == inferred


def test_hints_by_path(spark):
    hints = path_hints({"o.p.q": "string", "l[].x": "double", "m[][]": "int", "`a.b`.c": "date", "id": "int"})
    assert hints == T.StructType.fromDDL(
        "o struct<p:struct<q:string>>, l array<struct<x:double>>, m array<array<int>>, `a.b` struct<c:date>, id int"
    )
    for wrong in ({"a": "int", "a.b": "int"}, {"a.b": "int", "a[]": "int"}, {"[]": "int"}, {"": "int"}, {"a.b": "int", "a": "int"}):
        with pytest.raises(ValueError):
            path_hints(wrong)


def payloads(n, seed):
    draw = random.Random(seed)

    def value(depth):
        kind = draw.randrange(9 if depth else 6)
        if kind < 6:
            return [None, draw.randrange(9), draw.random(), "t", True, 10**25][kind]
        if kind == 6:
            return [value(depth - 1) for _ in range(draw.randrange(3))]
        return {k: value(depth - 1) for k in draw.sample("abc", draw.randrange(3))}

    return [json.dumps({k: value(2) for k in draw.sample("wxyz", draw.randrange(4))}) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_folding_in_any_order_equals_one_pass(spark, envelope_of, tmp_path, seed):
    texts = payloads(30, seed) + ["broken", "[1]", None]
    batches = [texts[i::3] for i in range(3)]
    whole = {r.topic: r.schema_ddl for r in infer_schemas(envelope_of(texts)).collect()}
    for n, order in enumerate(list(itertools.permutations(range(3)))[::2]):
        path = f"{tmp_path}/{n}"
        for i in (*order, order[0]):
            schema_tracking.fold_schemas(envelope_of(batches[i]), path)
        found = schema_tracking.tracked_schemas(spark, path).collect()
        assert {r.topic: r.schema_ddl for r in found} == whole


def test_versions_are_the_history(spark, envelope_of, tmp_path):
    path = str(tmp_path / "s")
    texts = [('a', '{"x":1}'), ('b', '{"y":{}}')]
    assert schema_tracking.fold_schemas(envelope_of(texts), path) == 1
    assert schema_tracking.fold_schemas(envelope_of(texts), path) == 1
    assert schema_tracking.fold_schemas(envelope_of([("a", '{"x":1.5,"odd name":null}')]), path) == 2
    assert schema_tracking.fold_schemas(envelope_of([("a", "broken"), ("c", "[]")]), path) == 2
    history = {(r.version, r.topic): r.schema_ddl for r in schema_tracking.schema_history(spark, path).collect()}
    assert history == {
        (1, "a"): "struct<x:bigint>",
        (1, "b"): "struct<y:string>",
        (2, "a"): "struct<`odd name`:string,x:double>",
        (2, "b"): "struct<y:string>",
    }


def test_two_folds_at_once_both_count(spark, envelope_of, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    other = [envelope_of([("a", '{"theirs":1}')])]
    save = schema_tracking.update

    def late(spark_, path_, schema, change):
        def changed(rows):
            result = change(rows)
            if other:
                schema_tracking.fold_schemas(other.pop(), path)
            return result

        return save(spark_, path_, schema, changed)

    monkeypatch.setattr(schema_tracking, "update", late)
    schema_tracking.fold_schemas(envelope_of([("a", '{"ours":"t"}')]), path)
    (found,) = schema_tracking.tracked_schemas(spark, path).collect()
    assert found.schema_ddl == "struct<ours:string,theirs:bigint>"


def test_samples_go_on_where_the_last_ended(spark, envelope_of, tmp_path):
    schemas, ledger = f"{tmp_path}/s", f"{tmp_path}/l"
    texts = ['{"x":1}', '{"x":2}', '{"x":0.5,"z":[1]}']
    whole = envelope_of(texts)
    sampling_ledger.sample_increment(whole.limit(0), schemas, ledger)
    assert sampling_ledger.load_ledger(spark, ledger).count() == 0
    sampling_ledger.sample_increment(whole.where("offset < 2"), schemas, ledger)
    rest = sampling_ledger.unread(whole, sampling_ledger.load_ledger(spark, ledger))
    assert [r.offset for r in rest.collect()] == [2]
    sampling_ledger.sample_increment(whole, schemas, ledger)
    assert sampling_ledger.unread(whole, sampling_ledger.load_ledger(spark, ledger)).count() == 0
    (found,) = schema_tracking.tracked_schemas(spark, schemas).collect()
    assert found.schema_ddl == "struct<x:double,z:array<bigint>>"
    offsets = sampling_ledger.starting_offsets(sampling_ledger.load_ledger(spark, ledger), {"t": 2, "u": 1})
    assert json.loads(offsets) == {"t": {"0": 3, "1": -2}, "u": {"0": -2}}


def test_a_ledger_never_goes_back(spark, tmp_path):
    def ends(offset):
        return spark.createDataFrame([("t", 0, offset)], sampling_ledger.LEDGER_SCHEMA)

    for offset in (7, 3):
        sampling_ledger.update(
            spark, str(tmp_path), sampling_ledger.LEDGER_SCHEMA,
            lambda rows, offset=offset: sampling_ledger._further(rows, ends(offset)),
        )
    assert sampling_ledger.load_ledger(spark, str(tmp_path)).first().end_offset == 7


def test_unread_keeps_partitions_that_are_new(spark, envelope_of):
    ledger = spark.createDataFrame([("t", 1, 5)], sampling_ledger.LEDGER_SCHEMA)
    assert sampling_ledger.unread(envelope_of(["{}", "{}"]), ledger).select(F.count("*")).first()[0] == 2
