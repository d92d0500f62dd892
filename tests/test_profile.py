import datetime as dt
import math
import random
from fractions import Fraction

from pyspark.sql import functions as F

from lamella.operators import profile as P
from lamella.operators import snapshots as S
from lamella.plans.quality_queries import market_rules

T = lambda d: dt.datetime(2025, 1, d)


def test_violations(spark):
    rows = [
        (1, "ABC", "spot", {"a": "1", "b": "1.50e-3", "c": None}, {"x": {"min": 0.0, "max": 0.0}}),
        (2, "abc", "SPOT", {"a": "0.000"}, {"x": {"min": 2.0, "max": 1.0}}),
        (3, "", "", {"a": ""}, {"x": {"min": -1.0, "max": None}}),
        (4, None, None, None, None),
        (5, "ABCDEFGHIJKLM", "__undefined", {"a": "1e-400"}, {"x": {"min": None, "max": None}}),
        (6, "A\n", "swap\n", {"a": "1\n"}, {"x": None}),
        (7, "A1", "option", {"a": "0e5"}, {"x": {"min": None, "max": -0.5}}),
        (8, "A1", "option", {"a": "１"}, {}),
    ]
    df = spark.createDataFrame(rows, "row_no long, base string, market_type string, precisions map<string,string>, limits map<string,struct<min:double,max:double>>")
    got = {(r.row_no, r.column_name) for r in P.cell_violations(df, market_rules(), keep=["row_no"]).collect()}
    assert got == {
        (2, "base"), (2, "market_type"), (2, "precisions"), (2, "limits"), (3, "base"), (3, "market_type"), (3, "precisions"), (3, "limits"),
        (5, "base"), (6, "base"), (6, "market_type"), (6, "precisions"), (7, "precisions"), (7, "limits"), (8, "precisions"),
    }


def snapshots(spark):
    attempts = spark.createDataFrame([(v, "x", "succeeded", T(1)) for v in ("v1", "v2", "v3")], "ccxt_version string, exchange string, status string, finished_at timestamp")
    order = spark.createDataFrame([("v1", T(1)), ("v2", T(2)), ("v3", T(3))], "ccxt_version string, released_at timestamp")
    return S.counting_snapshots(attempts, order)


def shifts(spark, rows, least=10, threshold=(203, 1000)):
    df = spark.createDataFrame(rows, "ccxt_version string, exchange string, a string, kind string, n long")
    got = P.share_shifts(df, snapshots(spark), columns=["a", "kind"], by_value=["kind"], threshold=threshold, least_rows=least).collect()
    return sorted((r.column_name, r.ccxt_version) for r in got)


def test_share_shifts(spark):
    rows = [("v1", "x", None if i < 2 else "q", "k1", 0) for i in range(10)] + [("v2", "x", None if i < 4 else "q", "k1" if i < 5 else f"junk{i}", 0) for i in range(10)]
    assert shifts(spark, rows) == [("kind", "v2")]  # nulls moved by exactly 0.2
    assert shifts(spark, rows, threshold=(2, 10)) == [("kind", "v2")]  # equal is not more
    assert shifts(spark, rows, threshold=(19, 100)) == [("a", "v2"), ("kind", "v2")]
    assert shifts(spark, rows, least=11) == []
    assert shifts(spark, []) == []
    gone = [("v1", "x", "q", None, 0)] * 10 + [("v2", "x", "q", "k", 0)] * 10 + [("v3", "x", "q", "k", 0)] * 10 + [("v3", None, None, None, None)]
    assert shifts(spark, gone) == [("kind", "v2")]


def test_profile_counts(spark):
    rows = [("l", "b", 2, {"k": "1", "j": None}), ("l", "a", 10, {"j": None, "k": "1"}), ("l", None, None, None), ("l", "a", 2, {}), (None, "z", 1, None)]
    df = spark.createDataFrame(rows, "load string, s string, n long, m map<string,string>")
    got = {(r.load, r.column_name): tuple(r)[2:] for r in P.column_profile(df, {"s": F.col("s") == "b"}, load=["load"]).collect()}
    assert got["l", "s"] == (4, 1, 2, "a", "b", 1)
    assert got["l", "n"] == (4, 1, 2, "2", "10", 0)
    assert got["l", "m"][:3] == (4, 2 - 1, 2)
    assert got[None, "n"] == (1, 0, 1, "1", "1", 0)
    assert P.column_profile(df.limit(0), {}, load=["load"]).count() == 0


def test_power_sums_are_exact_and_mergeable(spark):
    rnd = random.Random(2)
    xs = [rnd.choice([1, -1]) * rnd.random() * 10 ** rnd.randrange(-12, 12) for _ in range(500)] + [0.0, -0.0, 1e300, 5e-324, 2.0**60, 1e16, 1.0, -1e16]
    df = spark.createDataFrame([("g", x) for x in xs] + [("g", None), ("g", float("nan")), ("g", float("inf"))], "f string, x double")
    sums = P.power_sums(df, by=["f"], value="x").collect()
    s1 = sum(Fraction(int(r.m)) * Fraction(2) ** (r.k - 53) for r in sums)
    s2 = sum((Fraction(int(r.hh)) * 2**54 + Fraction(int(r.hl)) * 2**28 + int(r.ll)) * Fraction(2) ** (2 * (r.k - 53)) for r in sums)
    assert s1 == sum(map(Fraction, xs)) and s2 == sum(Fraction(x) ** 2 for x in xs)
    assert sum(r.n for r in sums) == len(xs)
    plain = spark.createDataFrame([("g", x) for x in (1.0, 2.0, 4.0)], "f string, x double")
    m = P.moments(P.power_sums(plain, by=["f"], value="x"), by=["f"]).first()
    assert math.isclose(m["mean"], 7 / 3) and math.isclose(m["variance"], 14 / 9) and m["n"] == 3
