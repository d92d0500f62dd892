from pyspark.sql import functions as F

from lamella.functions import strings as X
from lamella.operators import frequency as Q
from lamella.operators import rules as V


def test_tiers_at_their_bounds(spark):
    rows = [(10, 10), (9, 10), (10, 11), (5, 10), (6, 10), (5, 100), (4, 100), (0, 0), (1, 1)]
    df = spark.createDataFrame(rows, "c long, t long").select("c", "t", Q.tier(F.col("c"), F.col("t")).alias("tier"))
    assert [r.tier for r in df.collect()] == ["universal", "frequent", "common", "uncommon", "frequent", "uncommon", "rare", "rare", "universal"]


def test_key_frequency(spark):
    rows = [(i, "all", "s") for i in range(4)] + [(0, "half", "s"), (1, "half", None), (2, None, "s")]
    got = {r.key: (r["count"], r.pct, r.kinds) for r in Q.key_frequency(spark.createDataFrame(rows, "e long, k string, t string"), entity="e", key="k", kind="t").collect()}
    assert got == {"all": (4, 100.0, "s:4"), "half": (2, 50.0, "null:1,s:1")}
    assert Q.key_frequency(spark.createDataFrame([], "e long, k string, t string"), entity="e", key="k", kind="t").count() == 0


def test_distribution(spark):
    df = spark.createDataFrame([(x,) for x in (3, 4, 5, 6, 8, None)], "n long")
    assert tuple(Q.size_distribution(df, size="n").first()) == (5, 3, 8, 4, 5, 6, 5.2)
    assert tuple(Q.size_distribution(df.limit(0), size="n").first()) == (0, 0, 0, 0, 0, 0, 0.0)


def test_families_sets_and_patterns(spark):
    names = spark.createDataFrame([("e", "fetchTicker"), ("e", "fetchTicker"), ("f", "sign"), ("f", "signed"), ("f", None)], "e string, name string")
    got = {r.family: (r.occurrences, r.names, r.members) for r in Q.family_stats(names, name="name", known=("fetch", "sign")).collect()}
    assert got == {"fetch": (2, 1, "fetchTicker"), "sign": (1, 1, "sign"), "other": (1, 1, "signed")}
    spread = {(r.name, r.set) for r in Q.spread_sets(names, name="name", entity="e").collect()}
    assert ("sign", "unique") in spread and ("sign", "rare") in spread and not [s for s in spread if s[1] == "universal"]
    sides = {r.name: r.side for r in Q.cross_sets(names.where("e = 'e'"), names, name="name").collect()}
    assert sides == {"fetchTicker": "shared", "sign": "right_only", "signed": "right_only"}
    flags = spark.createDataFrame([(1, "b", True), (1, "a", True), (2, "a", False), (3, "a", None)], "id long, f string, v boolean")
    assert {(r.pattern, r.entities) for r in Q.flag_patterns(flags, entity="id", flag="f", on="v").collect()} == {("a,b", 1), ("", 2)}


def test_dominance(spark):
    rows = [("g", "x")] * 8 + [("g", None)] * 2 + [("h", "x")] * 7 + [("h", None)] * 3 + [("n", None)]
    df = spark.createDataFrame(rows, "g string, v string")
    best = Q.dominant_value(df, by=["g"], value="v")
    assert {r.g: r.dominant for r in best.collect()} == {"g": "x", "h": None, "n": None}
    assert Q.anomalies(df, best, by=["g"], value="v").count() == 2


def test_id_structures(spark):
    rows = [("BTCUSD", "BTC", "USD"), ("BTC-USD", "BTC", "USD"), ("BTC_USD-PERP", "BTC", "USD"), ("USD_BTC", "BTC", "USD"), ("BTC", "BTC", "USD"), ("@12", "X", "Y"), ("", "X", "Y"), ("A", "", "Y"), ("A", "A", ""), (None, "A", "B"), ("zz", "A", "B")]
    df = spark.createDataFrame(rows, "i string, b string, q string")
    got = [r[0] for r in df.select(X.id_structure(F.col("i"), F.col("b"), F.col("q"))).collect()]
    assert got == ["basequote", "base-quote", "base_quote+suffix", "quote_base", "base_only", "numeric", "opaque", "opaque", "basequote", "opaque", "opaque"]
    case = spark.createDataFrame([("AB1",), ("ab",), ("aB",), ("12",), (None,)], "t string").select(X.letter_case(F.col("t"))).collect()
    assert [r[0] for r in case] == ["upper", "lower", "mixed", None, None]


def test_jaro():
    assert round(X.jaro("martha", "marhta"), 6) == 0.944444 and X.jaro("", "a") == 0 and X.jaro("", "") == 1 and round(X.jaro("dixon", "dicksonx"), 6) == 0.766667


def test_findings_and_coverage(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1)], "id long, v long")
    rules = [V.Rule("negative", "error", F.col("v") < 0), V.Rule("small", "warning", F.col("v") < 10)]
    got = V.row_findings(df, rules, keep=["id"], skip=V.Rule("none", "warning", F.col("v").isNull()))
    assert {(r.rule, r.id) for r in got.collect()} == {("small", 1), ("none", 2), ("negative", 3), ("small", 3)}
    assert {(r.rule, r.n) for r in V.rollup(got, ["negative", "small", "none", "never"]).collect()} == {("negative", 1), ("small", 2), ("none", 1), ("never", 0)}
    rows = spark.createDataFrame([("a", True, True), ("b", False, True), ("c", False, False)], "id string, p boolean, on boolean")
    scores = V.coverage(rows, {"x": (F.col("p"), F.col("on"), F.lit("gone"))}, id="id")
    assert {(r.id, r.pct, r.gaps) for r in scores.collect()} == {("a", 100.0, ""), ("b", 0.0, "x: gone"), ("c", 0.0, "")}
    assert tuple(V.coverage_summary(scores).first()) == (3, 1, 2, 0, 33.3)
