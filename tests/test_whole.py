"""Registered queries do the whole job: small tables with what a cut would lose."""

import datetime as dt

import __spark_entry__ as entry
from lamella.operators.families import round_trip


def write(spark, path, **tables):
    """Each table (rows, schema) as a Parquet folder; returns the folder of all."""
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def run(spark, name, d):
    return entry.queries()[name](spark, d)


MARKETS = (
    "row_no long, ccxt_version string, exchange string, symbol string, id string, base string, quote string, settle string, market_type string, active boolean, "
    "contract boolean, linear string, inverse string, precisions map<string,string>, limits map<string,struct<min:double,max:double>>, loaded_at timestamp_ntz"
)


def market(n, version="4.7.8", exchange="x", symbol="A/B", base="A", quote="B", kind="spot", precisions=None, limits=None):
    return (n, version, exchange, symbol, "i", base, quote, None, kind, True, False, None, None, precisions, limits, dt.datetime(2025, 1, 1))


def test_profile_keeps_ranges_of_maps(spark, tmp_path):
    rows = [
        market(1, precisions={"price": "10", "amount": "x"}, limits={"cost": (1.0, None)}),
        market(2, precisions={"price": "9", "amount": None}, limits={"cost": (-2.0, None)}),
        market(3),
    ]
    d = write(spark, tmp_path, load_markets=(rows, MARKETS))
    full = {r.column_name: (r.n_rows, r.n_null, r.n_distinct, r.least, r.least_number, r.greatest_number) for r in run(spark, "p3_profile", d).collect()}
    assert full["precisions"] == (3, 1, 2, None, None, None) and full["limits"] == (3, 1, 2, None, None, None) and full["base"] == (3, 0, 1, "A", None, None)
    assert full["precisions.price"] == (2, 0, None, None, 9.0, 10.0) and full["precisions.amount"] == (2, 2, None, None, None, None)
    assert full["limits.cost.min"] == (2, 0, None, None, -2.0, 1.0)
    got = {r.feature: (r.n, r.n_other, r.least, r.greatest) for r in run(spark, "p3_ranges", d).collect()}
    assert got == {
        "precisions.price": (2, 0, 9.0, 10.0), "precisions.amount": (0, 2, None, None),
        "limits.cost.min": (2, 0, -2.0, 1.0), "limits.cost.max": (0, 2, None, None),
    }


CLASSES = "node_key string, parent_key string, id string, class_type string, source_file string, extends_raw string, methods array<string>, method_count int, extracted_at timestamp_ntz"


def test_calls_to_earlier_names_and_cycles(spark, tmp_path):
    classes = [["e", "d"], ["d", "c"], ["c", "b"], ["b", "a"], ["a", "e"], ["a"], None, ["a", None, "b"]]
    rows = [(f"rest:{i}", None, str(i), "rest", "f", None, m, 0, dt.datetime(2025, 1, 1)) for i, m in enumerate(classes)]
    d = write(spark, tmp_path, class_hierarchy=(rows, CLASSES))
    ring = "edcba"
    want = {(ring[i], ring[(i + k) % 5], k) for i in range(5) for k in range(5)}
    assert {(r.start, r.node, r.hops) for r in run(spark, "call_fixpoint", d).collect()} == want
    assert {(r.start, r.node, r.hops) for r in run(spark, "call_reach", d).collect()} == {w for w in want if w[2] <= 3}


FIXTURES = "fixture_no long, exchange string, ccxt_version string, cases array<struct<name:string>>, skipped array<struct<name:string,reason:string>>"
RELEASES = ([(v, dt.datetime(2025, m, 1)) for v, m in (("4.7.9", 1), ("4.7.10", 2), ("4.8.10", 3), ("4.9.0", 4))], "ccxt_version string, released_at timestamp_ntz")


def test_fixtures_against_the_latest_before(spark, tmp_path):
    rows = [
        (1, "x", "4.7.9", [("a",)], []), (2, "x", "4.7.10", [("b",)], []), (3, "x", "4.9.0", [("old",)], []), (4, "x", "4.9.0", [("b",)], []),
        (5, "y", "4.8.10", [("a",)], []), (6, "z", "9.9.9", [], []), (7, None, "4.9.0", [], []), (8, "w", "4.9.0", None, None),
    ]
    d = write(spark, tmp_path, signing_fixture=(rows, FIXTURES), ccxt_release=RELEASES)
    got = {(r.exchange, r.ccxt_version): (r.prev_version, r.status, r.n_paths) for r in run(spark, "fixture_parity", d).collect()}
    assert got == {
        ("x", "4.7.9"): (None, "extra", 0), ("x", "4.7.10"): ("4.7.9", "drift", 1), ("x", "4.8.10"): ("4.7.10", "missing", 0), ("x", "4.9.0"): ("4.7.10", "match", 0),
        ("y", "4.8.10"): (None, "extra", 0), ("y", "4.9.0"): ("4.8.10", "missing", 0), ("w", "4.9.0"): (None, "extra", 0),
    }


def test_orphans_are_those_of_the_tables(spark, tmp_path):
    d = write(
        spark, tmp_path, lineitem=([(11,), (22,), (22,), (3,)], "l_orderkey long"), orders=([(11, 13), (22, 13), (4, 99)], "o_orderkey long, o_custkey long"),
        customer=([(13,)], "c_custkey long"),
    )
    assert {(r.rule, r.n) for r in run(spark, "order_invariants", d).collect()} == {("line_has_order", 1), ("order_has_customer", 1)}


OUTPUTS = "record_no long, exchange string, ccxt_version string, endpoints string, auth string, websocket string"


def test_outputs_as_delivered(spark, tmp_path):
    rows = [
        (1, "x", "v", "{}", "1", None), (3, "x", "v", "{}", "1", None), (7, "x", "v", "{}", "1 ", None), (8, "x", "w", "{}", "1", None),
        (10, None, "v", "{}", None, "3"), (14, None, "v", "{}", None, "4"), (20, "y", None, '{"b": 1, "a": [1.50, null]}', "{", ""),
    ]
    d = write(spark, tmp_path, exchange_output=(rows, OUTPUTS))
    got = {r.record_no: r.status for r in run(spark, "determinism", d).collect()}
    assert got == {1: "equal", 3: "diverged", 7: "missing_second", 8: "missing_second", 10: "diverged", 14: "missing_second", 20: "missing_second"}
    assert run(spark, "round_trip", d).collect() == []


def test_planted_faults_of_a_round_trip(spark):
    source = spark.createDataFrame([(7, "{}", "1"), (10, "{}", None), (11, '{"a":1,"b":2}', "1")], "record_no long, endpoints string, auth string")
    output = spark.createDataFrame([(7, "{}", None), (11, '{"b": 2, "a": 1}', "1")], source.schema)
    assert {(r.record_no, r.section) for r in round_trip(output, source, id="record_no", sections=["endpoints", "auth"]).collect()} == {(7, "auth"), (10, "endpoints")}


def test_descendants_of_both_tables(spark, tmp_path):
    classes = [(n, p, n, "rest", "f", None, None, 0, dt.datetime(2025, 1, 1)) for n, p in (("a", None), ("b", "a"), ("c", "b"), ("s", "s"))]
    trees = [(7, {"E": [], "F": ["E"], "G": ["F", "E"]})]
    d = write(spark, tmp_path, class_hierarchy=(classes, CLASSES), error_class_hierarchy=(trees, "tree_no long, ancestors map<string,array<string>>"))
    got = {(r.tree_no, r.ancestor, r.descendant, r.distance) for r in run(spark, "p5_pairs", d).collect()}
    assert got == {(0, "a", "b", 1), (0, "a", "c", 2), (0, "b", "c", 1), (7, "E", "F", 1), (7, "E", "G", 2), (7, "F", "G", 1)}


def test_changes_between_all_loads(spark, tmp_path):
    loads = [("x", v, "succeeded", dt.datetime(2025, 5, 1)) for v in ("4.7.9", "4.7.10", "4.9.0")] + [("x", "4.8.10", "failed", dt.datetime(2025, 5, 1)), ("y", "4.9.0", "succeeded", None)]
    symbols = {"4.7.9": ["A", "B"], "4.7.10": ["A", "C", None], "4.8.10": ["Q"], "4.9.0": ["A", "B"]}
    rows = [market(i, version=v, symbol=s) for v, many in symbols.items() for i, s in enumerate(many)] + [market(9, version="4.9.0", exchange="y")]
    d = write(
        spark, tmp_path, load_markets=(rows, MARKETS), ccxt_release=RELEASES,
        load_manifest=(loads, "exchange string, ccxt_version string, status string, finished_at timestamp_ntz"),
    )
    got = {(r.exchange, r.ccxt_version): (r.left_n, r.right_n, r.removed, r.added) for r in run(spark, "market_spot_check", d).collect()}
    assert got == {("x", "4.7.10"): (2, 3, 1, 2), ("x", "4.9.0"): (3, 2, 2, 1)}
    flipped = {(r.ccxt_version, r.symbol, r.path) for r in run(spark, "drift_flipped", d).collect()}
    assert flipped == {(v, s, p) for v in ("4.7.10", "4.9.0") for s in "BC" for p in ("/quote", "/market_type")}
    assert {(r.ccxt_version, r.symbol, r.source) for r in run(spark, "drift_stale", d).collect()} == {(v, s, p) for v, s in (("4.7.10", "C"), ("4.9.0", "B")) for p in ("/base", "/market_type")}
    assert {(r.ccxt_version, r.symbol) for r in run(spark, "drift_new", d).where("path = '/base'").collect()} == {("4.7.10", "C"), ("4.9.0", "B")}
