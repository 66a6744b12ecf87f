"""Schema resolution: every rule, refused pairs, modes of compatibility, nested values."""

import json

import pytest

from eventide.functions import schemas as S


def record(*fields, name="R", **more):
    return S.parse({"type": "record", "name": name, "fields": list(fields), **more})


def f(name, kind, *default, **more):
    return {"name": name, "type": kind, **more, **({"default": default[0]} if default else {})}


PLACE = {"type": "record", "name": "Place", "fields": [f("x", "int"), f("y", "double", 0.5)]}
KIND = {"type": "enum", "name": "Kind", "symbols": ["a", "b"], "default": "b"}

WRITERS = {
    1: record(f("id", "int"), f("old", "string"), f("gone", "boolean")),
    2: record(f("id", "long"), f("name", "string"), f("old", "string"), f("size", "float"),
              f("kind", {"type": "enum", "name": "Kind", "symbols": ["a", "z"]}),
              f("at", {"type": "record", "name": "Spot", "fields": [f("x", "int")]}),
              f("more", {"type": "array", "items": ["null", "int"]}),
              f("tags", {"type": "map", "values": "int"})),
}
READER = record(
    f("id", "long"), f("name", "string", aliases=["old"]), f("size", ["null", "double"], None),
    f("kind", KIND, "a"),
    f("at", ["null", {**PLACE, "aliases": ["Spot"],
                      "fields": [f("x", "long"), f("y", "double", 0.5)]}], None),
    f("more", {"type": "array", "items": ["null", "long"]}, []),
    f("tags", {"type": "map", "values": "double"}, {"n": 1}),
    f("raw", "bytes", "ÿ"), f("note", ["string", "null"], "null"))

ONE = {"id": 5, "old": "é", "gone": True}
TWO = {"id": 6, "name": "new", "old": "unused", "size": 0.25, "kind": "z", "at": {"x": 3},
       "more": [1, None], "tags": {"p": 2}}


def read(spark, rows, writers=None, reader=READER):
    df = spark.createDataFrame([(v, b if b is None or isinstance(b, str) else json.dumps(b), k)
                                for k, (v, b) in enumerate(rows)], "v int, body string, k int")
    got = S.read_versions(df, "body", "v", writers or WRITERS, reader)
    assert got.columns == ["v", "k", "record"]
    return [r.record.asDict(recursive=True) if r.record else None
            for r in got.orderBy("k").collect()]


def test_each_version_in_the_readers_shape(spark):
    one, two, none = read(spark, [(1, ONE), (2, TWO), (1, None)])
    assert one == {"id": 5, "name": "é", "size": None, "kind": "a", "at": None, "more": [],
                   "tags": {"n": 1.0}, "raw": bytearray(b"\xff"), "note": "null"}
    assert two == {**one, "id": 6, "name": "new", "size": 0.25, "kind": "b",
                   "at": {"x": 3, "y": 0.5}, "more": [1, None], "tags": {"p": 2.0}}
    assert none is None
    assert read(spark, []) == []


@pytest.mark.parametrize("row, message", [
    ((3, ONE), "no schema for version 3"), ((None, ONE), "no schema for version null"),
    ((1, {"id": 5}), "record.name: no value"), ((1, "{nonsense"), "MALFORMED"),
    ((2, {**TWO, "tags": {"p": None}}), r"record.tags\[\]: no value")])
def test_records_that_do_not_fit_fail(spark, row, message):
    with pytest.raises(Exception, match=message):
        read(spark, [row])


@pytest.mark.parametrize("writer, reader, message", [
    ("long", "int", "long does not become int"), ("double", "float", "double does not become"),
    ("string", "int", "string does not become int"), (["null", "int"], "int", "null may be"),
    ({"type": "array", "items": "string"}, {"type": "array", "items": "long"}, r"f\[\]: string"),
    ({"type": "map", "values": "int"}, {"type": "array", "items": "int"}, "map does not become"),
    ({"type": "enum", "name": "K", "symbols": ["a", "b"]},
     {"type": "enum", "name": "K", "symbols": ["a"]}, "no symbol or default for b"),
    (PLACE, {**PLACE, "name": "Other"}, "Place is read as Other"),
    (PLACE, {**PLACE, "fields": [*PLACE["fields"], f("z", "int")]}, "f.z: not written")])
def test_pairs_refused_while_the_plan_is_built(spark, writer, reader, message):
    w, r = record(f("f", writer)), record(f("f", reader))
    assert len(S.problems(w, r)) == 1
    df = spark.createDataFrame([], "v int, body string")
    with pytest.raises(S.SchemaError, match=message):
        S.read_versions(df, "body", "v", {1: w}, r)


@pytest.mark.parametrize("wide, narrow", [("long", "int"), ("double", "long"), ("double", "int"),
                                          ("bytes", "string"), (["int", "null"], "int")])
def test_promotions(wide, narrow):
    assert not S.problems(record(f("f", narrow)), record(f("f", wide)))


def test_modes_of_compatibility():
    a, b = record(f("id", "int")), record(f("id", "int"), f("n", "int", 0))
    c = record(f("id", "int"), f("n", "int"))
    assert not S.compatibility([a], b, "FULL")
    assert not S.compatibility([a, b], c)                      # the last version only
    assert S.compatibility([a, b], c, "BACKWARD_TRANSITIVE") == [
        "reading version 1: record.n: not written, and without a default"]
    assert not S.compatibility([a, b], c, "FORWARD_TRANSITIVE")
    assert not S.compatibility([], c, "FULL") and not S.compatibility([c], a, "NONE")
    assert S.compatibility([c], a, "FORWARD") == [
        "read by version 1: record.n: not written, and without a default"]
    with pytest.raises(ValueError):
        S.compatibility([a], b, "SIDEWAYS")


@pytest.mark.parametrize("spec", [
    ["int", "string"], "nothing", {"name": "x"},
    {"type": "record", "name": "N", "fields": [f("next", ["null", "N"], None)]},
    {"type": "record", "name": "N", "fields": [f("a", "int"), f("a", "int")]},
    {"type": "record", "name": "N", "fields": [f("a", "int", "1")]},
    {"type": "record", "name": "N", "fields": [f("a", ["null", "int"], 3)]},
    {"type": "record", "name": "N", "fields": [f("a", PLACE, {"y": 1})]},
    {"type": "enum", "name": "K", "symbols": ["a"], "default": "b"}])
def test_schemas_that_are_none(spec):
    with pytest.raises(S.SchemaError):
        S.parse(spec)


def test_a_named_type_is_known_after_it_was_defined():
    both = S.parse(json.dumps({"type": "record", "name": "org.R", "fields": [
        f("a", PLACE), f("b", "Place")]}))
    assert both.fields[0].type == both.fields[1].type and both.name == "R"
    assert S.parse("int").kind == "int" and S.parse('"int"').kind == "int"
