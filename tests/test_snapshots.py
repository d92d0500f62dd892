import datetime as dt

from pyspark.sql import functions as F

from lamella.operators import snapshots as S

T = lambda d: dt.datetime(2025, 1, d)
MARKET = "row_no long, ccxt_version string, exchange string, symbol string, base string, precisions map<string,string>, limits map<string,struct<min:double,max:double>>, loaded_at timestamp, seq long, h1 string"


def loads(spark, rows):
    attempts = spark.createDataFrame(rows, "ccxt_version string, exchange string, status string, finished_at timestamp")
    order = spark.createDataFrame([("v1", T(1)), ("v2", T(2)), ("v10", T(3)), ("v11", T(4))], "ccxt_version string, released_at timestamp")
    return S.counting_snapshots(attempts, order)


def events(spark, rows, snapshots):
    df = spark.createDataFrame(rows, MARKET)
    compared = [F.col("base"), S.canonical_number_map(F.col("precisions")), S.canonical_map(F.col("limits"))]
    got = S.change_events(S.validity_intervals(df, snapshots, compared=compared)).collect()
    return sorted((r.ccxt_version, r.exchange, r.symbol, r.change_kind) for r in got)


def row(n, v, s, base="A", p=None, lim=None, at=1, ex="x"):
    # Columns named like the operator's own must do no harm.
    return (n, v, ex, s, base, p, lim, T(at), 99, "clash")


def test_last_attempt_counts_and_versions_follow_releases(spark):
    got = loads(spark, [
        ("v1", "x", "succeeded", T(1)), ("v1", "x", "failed", T(2)), ("v2", "x", "failed", T(1)), ("v2", "x", "succeeded", T(2)),
        ("v10", "x", "succeeded", T(3)), ("v10", "x", "succeeded", T(3)), ("v99", "x", "succeeded", T(3)), (None, "x", "succeeded", T(3)), ("v1", None, "succeeded", T(3)),
    ]).collect()
    assert sorted((r.exchange, r.ccxt_version, r.seq, r.prev_version, r.next_version) for r in got) == [("x", "v10", 2, "v2", None), ("x", "v2", 1, None, "v10")]


def test_added_removed_changed_and_returned(spark):
    ok = loads(spark, [(v, "x", "succeeded", T(1)) for v in ("v1", "v2", "v10", "v11")])
    lim = lambda a, b: {"cost": {"min": a, "max": b}}
    got = events(spark, [
        row(1, "v1", " a "), row(2, "v2", "a"), row(3, "v10", "a", base="B"), row(4, "v11", "a", base="B"),
        row(5, "v1", "gone"), row(6, "v10", "gone"),
        row(7, "v2", "new"), row(8, "v10", "new"), row(9, "v11", "new"),
        row(10, "v1", "same", p={"x": "1e-3", "y": None}), row(11, "v2", "same", p={"x": "0.0010"}), row(12, "v10", "same", p={"x": "0.001 "}), row(13, "v11", "same", p={"x": "0.001"}),
        row(14, "v1", "nul", lim=lim(None, 1.0)), row(15, "v2", "nul", lim=lim(1.0, None)), row(16, "v10", "nul", lim=lim(1.0, None)), row(17, "v11", "nul", lim=None),
        row(18, "v1", None), row(19, "v1", "  "), row(20, "v1", "__undefined"),
        row(21, "v1", "late", base="X", at=1), row(22, "v1", "late", base="Y", at=2), row(23, "v2", "late", base="Y"), row(24, "v10", "late", base="Y"), row(25, "v11", "late", base="Y"),
        row(26, "v77", "a"), row(27, "v1", "b", ex="other"), row(28, "v1", "b", ex=None),
    ], ok)
    assert got == sorted([
        ("v10", "x", "a", "changed"), ("v2", "x", "gone", "removed"), ("v10", "x", "gone", "added"), ("v11", "x", "gone", "removed"),
        ("v2", "x", "new", "added"), ("v2", "x", "nul", "changed"), ("v11", "x", "nul", "changed"),
    ])


def test_a_load_without_rows_removes_all_and_null_differs_from_empty(spark):
    ok = loads(spark, [(v, "x", "succeeded", T(1)) for v in ("v1", "v2", "v10")])
    got = events(spark, [row(1, "v1", "a", p=None), row(2, "v10", "a", p={}), row(3, "v1", "b", p={}), row(4, "v1", "b", p={})], ok)
    assert got == [("v10", "x", "a", "added"), ("v2", "x", "a", "removed"), ("v2", "x", "b", "removed")]


def test_repeated_rows_of_one_key_and_empty_tables(spark):
    ok = loads(spark, [("v1", "x", "succeeded", T(1)), ("v2", "x", "succeeded", T(1))])
    assert events(spark, [row(1, v, "hot") for v in ("v1", "v2") for _ in range(500)], ok) == []
    assert events(spark, [], ok) == []
    assert events(spark, [row(1, "v1", "a")], loads(spark, [])) == []
