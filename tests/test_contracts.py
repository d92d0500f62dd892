"""Required keys, schemas, invariants, drift reports, bounded walks, aggregates."""

import pytest
from pyspark.sql import functions as F

from lamella.operators import contracts as C
from lamella.operators import frequency as Q
from lamella.operators import resolve as R
from lamella.operators import upsert as U


def test_missing_keys(spark):
    df = spark.createDataFrame([(1, '{"a": null, "b": 1}', "[]"), (2, "{", None), (3, "{}", '{"c": {}}')], "id int, g string, h string")
    got = sorted(tuple(r) for r in C.missing_keys(df, {"g": ("a", "b"), "h": ("c",)}, id="id").collect())
    assert got == [(1, 2, "h", None), (2, 0, "g", None), (2, 2, "h", None), (3, 1, "g", "a"), (3, 2, "g", "b")]
    assert C.missing_keys(df.limit(0), {"g": ("a",)}, id="id").collect() == []


@pytest.mark.parametrize("schema, value, want", [
    ({"type": "integer"}, 1.0, []), ({"type": "integer"}, True, [("", "type")]), ({"const": 1}, True, [("", "const")]), ({"enum": [None, "a"]}, "b", [("", "enum")]),
    ({"type": ["string", "null"], "minLength": 1, "pattern": "^a"}, "", [("", "minLength"), ("", "pattern")]),
    ({"items": {"type": "number", "minimum": 0, "maximum": 5}, "minItems": 3, "maxItems": 3}, [1, -1, "x", 9], [("", "maxItems"), ("/1", "minimum"), ("/2", "type"), ("/3", "maximum")]),
    ({"properties": {"a/b": {"$ref": "#/$defs/x"}}, "required": ["z~"], "additionalProperties": False, "patternProperties": {"^p": True}, "$defs": {"x": {"type": "null"}}}, {"a/b": 1, "p1": 2, "q": 3}, [("/z~0", "required"), ("/a~1b", "type"), ("/q", "additionalProperties")]),
    ({"oneOf": [{"type": "number"}, {"const": 1}]}, 1, [("", "oneOf")]), ({"anyOf": [{"type": "null"}]}, 1, [("", "anyOf")]), ({"not": {"required": ["a"]}}, {"a": 1}, [("", "not")]),
    ({"allOf": [{"minProperties": 2}, {"additionalProperties": {"type": "string"}}]}, {"a": 1}, [("", "minProperties"), ("/a", "type")]), (True, 1, []), ({"items": False}, [1], [("/0", "false")]),
])
def test_schema_keywords(schema, value, want):
    assert C.Schema(schema).failures(value) == want


def test_schema_failures_of_odd_texts(spark):
    df = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "{", 0), (4, "1", 0), (5, "[" * 50 + "]" * 50, 0)], "id long, t string, path int")
    got = sorted(tuple(r) for r in C.schema_failures(df, {"type": "number"}, id="id", text="t").collect())
    assert got == [(2, "", "unreadable"), (3, "", "unreadable"), (5, "", "type")]


def test_invariants_and_allowed_findings(spark):
    docs = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "id int, v string")
    registry = {"no_x": C.where(F.col("v") == "x", "/v", "is x"), "set": C.where(F.col("v").isNull(), "/v", "is null")}
    assert {tuple(r) for r in C.run_invariants(docs, registry).collect()} == {(1, "no_x", "/v", "is x"), (2, "set", "/v", "is null")}
    allowed = spark.createDataFrame([("set", "/v"), ("no_x", "/other")], "invariant string, path string")
    assert [r.id for r in C.run_invariants(docs, registry, allowed=allowed).collect()] == [1]


def test_drift_report(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id string")
    got = {tuple(r) for r in C.drift_report({"new": ids("a", "a", "b")}, ids("a", "b"), ids("a", "old")).collect()}
    assert got == {("a", "new", 2), ("b", "missing_baseline", 1)}


def test_bounded_walks(spark):
    n = spark.createDataFrame([(f"k{i:02d}", f"k{i - 1:02d}" if i else None) for i in range(20)] + [("x", "gone"), ("s", "s"), ("p", "Base"), ("Base", None), ("c1", "c2"), ("c2", "c1")], "node string, parent string")
    top = {r.node: r.top for r in R.walk_up(n, 8, stop="Base").collect()}
    assert top["k19"] == "k11" and top["k05"] == "k00" and top["x"] == "x" and top["s"] == "s" and top["p"] == "p" and top["c1"] == "c1"


def test_aggregate_writer(spark):
    old, new = spark.createDataFrame([("b", 1), ("a", 2)], "id string, v int"), spark.createDataFrame([("c", 3)], "id string, v int")
    scope = spark.createDataFrame([("a",)], "id string")
    rows, envelope = U.aggregate(old, new, scope, old_stamp=["t2", "exchange:z"], new_stamp=["t1"], tiers=["t1", "t2"], stats={"count": F.sum("v"), "most": F.max("v")})
    assert [r.id for r in rows.collect()] == ["b", "c"] and tuple(envelope.select("count", "most", "tier_scope").first()) == (4, 3, "t1,t2,exchange:z")
    assert [r.id for r in U.aggregate(old, new, None, readable=False)[0].collect()] == ["c"]
    with pytest.raises(ValueError):
        U.aggregate(old, new, scope, readable=False)


def test_trait_anomalies(spark):
    rows = [(i, "g", "a", "x") for i in range(9)] + [(9, "g", "b", None), (10, None, "z", "q")]
    got = {r.id: r.traits for r in Q.trait_anomalies(spark.createDataFrame(rows, "id int, g string, s string, t string"), by=["g"], traits=["s", "t"], id="id").collect()}
    assert got == {9: "s,t"}
