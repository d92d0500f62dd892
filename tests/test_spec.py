import pytest
from pyspark.sql import functions as F

from lamella.operators import diff as D
from lamella.operators import patch as P
from lamella.operators import resolve as R
from lamella.operators import scope as S
from lamella.operators import upsert as U


def ids(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "id string")


def test_scopes(spark):
    assert S.parse_ids([" a,b ", "b,,c", ""]) == ["a", "b", "c"]
    universe = ids(spark, "binance", "kraken", "gate")
    assert S.resolve(universe) is None and S.resolve(universe, everything=True) is None
    with pytest.raises(ValueError):
        S.resolve(universe, everything=True, ids=["gate"])
    with pytest.raises(S.UnknownIds, match="binance"):
        S.resolve(universe, ids=["binanse"])
    members = spark.createDataFrame([("gate", "tier1"), ("gone", "tier1"), ("kraken", "tier2")], "id string, tier string")
    assert sorted(r.id for r in S.resolve(universe, ids=["kraken"], tiers=["tier1"], tier_members=members).collect()) == ["gate", "kraken"]
    tiers = {r.id: r.tier for r in S.tier_of(universe, members.unionByName(spark.createDataFrame([("gate", "tier2")], "id string, tier string")), ["tier1", "tier2"]).collect()}
    assert tiers == {"gate": "tier2", "kraken": "tier2", "binance": "unclassified"}
    stamp = spark.range(1).select(S.merge_scope_values(F.array(F.lit("tier2")), F.array(F.lit("exchange:b"), F.lit("tier1")), ["tier1", "tier2"]), S.merge_scope_values(F.array(F.lit("all")), F.lit(None).cast("array<string>"), ["tier1"])).first()
    assert stamp[0] == ["tier1", "tier2", "exchange:b"] and stamp[1] == ["all"]


def test_referral(spark):
    df = spark.createDataFrame([('"http://x"',), ('{"url":"u"}',), ('{"url":"u","discount":0.2}',), ("3",), (None,), ("{",)], "v string")
    assert [tuple(r[0]) if r[0] else None for r in df.select(S.referral(F.col("v"))).collect()] == [("http://x", 0.0), ("u", 0.0), ("u", 0.2), None, None, None]


def test_scoped_upsert(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "id string, v long")
    one, two = spark.createDataFrame([("a", 2)], "id string, v long"), spark.createDataFrame([("b", 3)], "id string, v long")
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(U.scoped_upsert(old, one, ids(spark, "a", "b"))) == [("a", 2), ("c", 1)]
    assert rows(U.scoped_upsert(old, one, None)) == [("a", 2)]
    both = U.scoped_upsert(old, one.unionByName(two), ids(spark, "a", "b"))
    assert rows(U.scoped_upsert(U.scoped_upsert(old, one, ids(spark, "a")), two, ids(spark, "b"))) == rows(both)
    files = spark.createDataFrame([("a", "a", True), ("b", "x", True), ("c", None, False), ("z", "z", True)], "id string, body_id string, readable boolean")
    got = {r.id: r.status for r in U.manifest_status(ids(spark, "a", "b", "c", "d"), files).collect()}
    assert got == {"a": "ok", "b": "id_mismatch", "c": "corrupt", "d": "missing", "z": "orphan"}


def nodes(spark):
    return spark.createDataFrame([("root", None), ("a", "root"), ("b", "a"), ("x", "y"), ("y", "x"), ("lone", "gone")], "node string, parent string")


def test_resolution(spark):
    chain = R.closure(nodes(spark))
    assert {(r.node, r.ancestor, r.distance) for r in chain.where("distance > 0").collect()} == {("a", "root", 1), ("b", "a", 1), ("b", "root", 2)}
    values = spark.createDataFrame([("root", "R"), ("a", None)], "node string, value string")
    got = {r.node: (r.value, r.origin) for r in R.nearest_value(nodes(spark), values, F.lit("D")).collect()}
    assert got["b"] == (None, "a") and got["a"] == (None, "self") and got["root"] == ("R", "self") and got["lone"] == ("D", "default") and got["x"] == ("D", "default")
    hop = {r.node: r.value for r in R.parent_fallback(nodes(spark), values).collect()}
    assert hop["a"] == "R" and hop["b"] is None
    members = spark.createDataFrame([("root", "m"), ("root", "k"), ("a", "m"), ("a", "n")], "node string, name string")
    status = {(r.node, r.name): r.status for r in R.override_classes(chain, members).collect()}
    assert status == {("root", "m"): "new", ("root", "k"): "new", ("a", "m"): "overridden", ("a", "n"): "new", ("a", "k"): "inherited", ("b", "m"): "inherited", ("b", "k"): "inherited", ("b", "n"): "inherited"}
    tiers = R.expand_tiers(nodes(spark), spark.createDataFrame([("t", "root"), ("u", "b")], "tier string, id string"))
    assert {(r.tier, r.id) for r in tiers.collect()} == {("t", "root"), ("t", "a"), ("t", "b"), ("u", "b")}
    buckets = {r.node: r.bucket for r in R.priority_bucket(nodes(spark), [("first", "a"), ("second", "root")]).collect()}
    assert buckets["b"] == "first" and buckets["root"] == "second" and buckets["lone"] == "non_retryable"


def test_reachability(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), (None, "a")], "src string, dst string")
    got = {(r.node, r.hops) for r in R.reachable(edges, ids(spark, "a")).collect()}
    assert got == {("a", 0), ("b", 1), ("c", 2), ("d", 3)}
    assert {r.node for r in R.reachable(edges, ids(spark, "a"), depth=1).collect()} == {"a", "b"}


def test_pointers():
    assert P.pointer_keys("/") == [""] and P.pointer_keys("/a~1b/~01") == ["a/b", "~1"]
    with pytest.raises(ValueError):
        P.pointer_keys("a")
    doc = {"a": [{"b": 1}], "": 2}
    assert P.pointer_get(doc, "/a/0/b") == 1 and P.pointer_get(doc, "/") == 2 and P.pointer_get(doc, "/a/9") is None and P.pointer_get([1], "/0") is None and P.pointer_get(doc, "x") is doc
    assert P.nesting_depth({"a": [[]]}) == 3 and P.nesting_depth(1) == 0 and P.nesting_depth([]) == 1 and P.nesting_depth([0] * 10 + [[1]]) == 1
    assert P.strip_keys({"a": {"generated_at": 1, "b": [{"extracted_at": 1}]}}) == {"a": {"b": [{}]}}
    assert P.strip_undefined({"a": "__undefined", "b": ["__undefined", None]}) == {"b": [None]} and P.substitute({"u": ["x{h}"]}, "h", "y") == {"u": ["xy"]}


def test_patches(spark):
    docs = spark.createDataFrame([("a", '{"x":{"y":1}}'), ("b", "{"), ("c", '{"k":[1]}')], "id string, document string")
    entries = spark.createDataFrame([("a", 1, "/x/y", "2"), ("a", 2, "/x/z/w", '"q"'), ("a", 3, "/x/y/0", "1"), ("b", 1, "/x", "1"), ("c", 1, "/k/0", "null")], "id string, ord int, path string, value string")
    got = {r.id: (r.document, r.applied, r.failed) for r in P.patch_documents(docs, entries).collect()}
    assert got == {"a": ('{"x":{"y":2,"z":{"w":"q"}}}', 2, 1), "b": ("{", 0, 1), "c": ('{"k":[null]}', 1, 0)}
    d = spark.createDataFrame([("abc", "abd"), ("a", "a"), ("a", None), ("a", "ab")], "l string, r string").select(P.first_difference("l", "r").alias("d")).collect()
    assert [r.d.position for r in d] == [2, None, None, 1]
    stamped = spark.range(1).select(P.stamp_provenance(F.create_map(F.lit("/a"), F.lit("raw")), F.array(F.lit("/a"), F.lit("/b")))).first()[0]
    assert stamped == {"/a": "override", "/b": "override"}


def test_parity(spark):
    rows = lambda *r: D.node_rows(spark.createDataFrame(list(r), "id string, t string"), id=["id"], text="t")
    new = rows(("same", '{"a":1,"generated_at":5}'), ("drift", '{"a":{"b":1,"c":[1,2]},"d":1}'), ("extra", "{}"), ("kind", '{"a":{"b":1}}'))
    old = rows(("same", '{"a":1,"generated_at":6}'), ("drift", '{"a":{"b":2,"c":[1]},"d":1}'), ("missing", "{}"), ("kind", '{"a":3}'))
    got = {r.id: (r.status, r.n_paths) for r in D.parity(new, old, id=["id"]).collect()}
    assert got == {"same": ("match", 0), "drift": ("drift", 2), "extra": ("extra", 0), "missing": ("missing", 0), "kind": ("drift", 1)}
    topmost = D.new_paths(rows(("x", '{"a":{"n":{"m":1}},"l":[{"q":1}]}')).select("id", "path"), rows(("x", '{"a":{},"l":[]}')).select("id", "path"))
    assert [r.path for r in topmost.collect()] == ["/a/n"]
