import random

import pytest
from pyspark.sql import functions as F

import lamella.operators.hierarchy as H
from lamella.plans.runtime import durable

SCHEMA = "tree_no long, node_key string, parent_key string, at int, part int, kind int"


def run(spark, edges):
    df = spark.createDataFrame([(*e, 1, 1) for e in edges], SCHEMA)
    return {(r.tree_no, r.node_key): (r.root_key, r.depth, r.full_path) for r in H.hierarchy(df).collect()}


def brute(edges):
    par = {(t, k): p for t, k, p, _ in edges}
    out = {}
    for t, k in par:
        path, x, ring = [k], k, None
        while (p := par[t, x]) is not None and (t, p) in par and ring is None:
            if p in path:
                ring = path[path.index(p) :]
            path.append(p)
            x = p
        out[t, k] = (min(ring), -1, "") if ring else (path[-1], len(path) - 1, "/".join(reversed(path)))
    return out


def test_roots_duplicates_and_cycles(spark):
    got = run(spark, [
        (0, "a", None, 1), (0, "b", " a\t", 1), (0, "b", "c", 0), (0, "c", "b", None), (0, "c", "b", None), (0, "d", "nobody", 1), (0, "e", "__undefined", 1),
        (0, "f", "  ", 1), (0, "self", "self", 1), (0, "below", "self", 1), (0, "r2", "r1", 1), (0, "r1", "r2", 1), (0, "r0", "r2", 1), (1, "b", "a", 1), (0, None, "a", 1),
        (0, "x" * 5000, "a", 1),
    ])
    assert got == {
        (0, "a"): ("a", 0, "a"), (0, "b"): ("a", 1, "a/b"), (0, "c"): ("a", 2, "a/b/c"), (0, "d"): ("d", 0, "d"), (0, "e"): ("e", 0, "e"), (0, "f"): ("f", 0, "f"),
        (0, "self"): ("self", -1, ""), (0, "below"): ("self", -1, ""), (0, "r1"): ("r1", -1, ""), (0, "r2"): ("r1", -1, ""), (0, "r0"): ("r1", -1, ""),
        (1, "b"): ("b", 0, "b"), (0, "x" * 5000): ("a", 1, "a/" + "x" * 5000),
    }
    assert run(spark, []) == {}


@pytest.mark.parametrize("size, poor", [(10_000, 0.7), (40, 0.7), (40, -1.0), (25, 0.0)])
def test_contraction_by_ranges_and_by_coins(spark, monkeypatch, size, poor):
    monkeypatch.setattr(H, "RECORDS_PER_TASK", size)
    monkeypatch.setattr(H, "POOR", poor)
    rnd = random.Random(size)
    edges = []
    for i in range(250):
        m, t = rnd.random(), rnd.choice([0, 0, 0, 3])
        p = f"k{i - 1:03d}" if m < 0.55 else f"k{rnd.randrange(250):03d}" if m < 0.9 else None
        edges.append((t, f"k{i:03d}", p, 1))
    edges += [(5, f"c{i:03d}", f"c{(i + 1) % 60:03d}", 1) for i in range(60)] + [(5, f"d{i:03d}", f"d{i - 1:03d}" if i else "c007", 1) for i in range(40)]
    edges += [(6, f"e{i:03d}", f"e{i - 1:03d}" if i else None, 1) for i in range(120)]
    assert run(spark, edges) == brute(edges)


def test_descendants(spark):
    df = spark.createDataFrame([(0, "a", None, 1), (0, "b/x", "a", 1), (0, "c", "b/x", 1), (0, "s", "s", 1)], "tree_no long, node_key string, parent_key string, at int")
    got = sorted((r.ancestor, r.descendant, r.distance) for r in H.descendants(df).collect())
    assert got == [("a", "b/x", 1), ("a", "c", 2), ("b/x", "c", 1)]


def test_values_taken_down_one_long_chain(spark):
    import lamella.operators.resolve as R

    n = 100_000
    nodes = spark.range(n).select(F.format_string("k%06d", "id").alias("node"), F.when(F.col("id") > 0, F.format_string("k%06d", F.col("id") - 1)).alias("parent"))
    values = spark.createDataFrame([("k000010", 1), ("k050000", None)], "node string, value int")
    got = {r.origin: (r.n, r.d, r.v) for r in R.nearest_value(nodes, values, F.lit(-1)).groupBy("origin").agg(F.count("*").alias("n"), F.max("distance").alias("d"), F.max("value").alias("v")).collect()}
    assert got == {"default": (10, None, -1), "self": (2, 0, 1), "k000010": (49_989, 49_989, 1), "k050000": (49_999, 49_999, None)}
    assert R.roots(nodes).agg(F.max("depth"), F.countDistinct("root")).first() == (n - 1, 1)


@pytest.mark.parametrize("size", [60])
def test_values_taken_down_against_brute_force(spark, monkeypatch, size):
    import lamella.operators.resolve as R

    monkeypatch.setattr(H, "RECORDS_PER_TASK", size)
    rnd = random.Random(size)
    parent = {f"n{i:03d}": f"n{rnd.randrange(200):03d}" if rnd.random() < 0.8 else None for i in range(200)}
    held = {k: rnd.randrange(9) for k in sorted(parent) if rnd.random() < 0.2}
    want = {}
    for k in parent:
        path, at = [], k
        while at is not None and at not in path:
            path.append(at)
            at = parent[at]
        path = path[:1] if at is not None else path
        hit = next(((i, a) for i, a in enumerate(path) if a in held), None)
        want[k] = (held[hit[1]], "self" if hit[0] == 0 else hit[1], hit[0]) if hit else (-1, "default", None)
    nodes = spark.createDataFrame(sorted(parent.items()), "node string, parent string")
    values = spark.createDataFrame(sorted(held.items()), "node string, value int")
    assert {r.node: (r.value, r.origin, r.distance) for r in R.nearest_value(nodes, values, F.lit(-1)).collect()} == want


@pytest.mark.parametrize("size, poor", [(60, 0.7), (60, -1.0)])
def test_descendant_counts(spark, monkeypatch, size, poor):
    monkeypatch.setattr(H, "RECORDS_PER_TASK", size)
    monkeypatch.setattr(H, "POOR", poor)
    rnd = random.Random(size)
    edges = [(rnd.choice([0, 0, 4]), f"k{i:03d}", f"k{rnd.randrange(max(1, i)):03d}" if rnd.random() < 0.9 else None, 1) for i in range(200)]
    edges += [(5, f"c{i}", f"c{(i + 1) % 6}", 1) for i in range(6)] + [(5, "below", "c0", 1), (6, "one", None, 1)] + [(7, f"e{i:03d}", f"e{i - 1:03d}" if i else None, 1) for i in range(90)]
    df = spark.createDataFrame([(*e, 1) for e in edges], "tree_no long, node_key string, parent_key string, at int, part int")
    got = {(r.tree_no, r.node_key): (r.descendants, r.children, r.height) for r in H.descendant_counts(df).collect()}
    want = {}
    for r in H.descendants(df).collect():
        n, c, h = want.get((r.tree_no, r.ancestor), (0, 0, 0))
        want[r.tree_no, r.ancestor] = (n + 1, c + (r.distance == 1), max(h, r.distance))
    assert got == want and H.descendant_counts(df.limit(0)).collect() == []


def test_every_level_leaves_fewer_records(spark, monkeypatch):
    """Keys unrelated to the tree, far more records than a task takes: coins of one level must not be those of the last."""
    monkeypatch.setattr(H, "RECORDS_PER_TASK", 12)
    sizes, solve = [], H.solve

    def counted(records, fold, n, **kw):
        sizes.append(n)
        assert len(sizes) < 30, sizes
        return solve(records, fold, n, **kw)

    monkeypatch.setattr(H, "solve", counted)
    rng = random.Random(5)
    keys = [f"{rng.getrandbits(40):010x}" for _ in range(120)]
    edges = [(0, k, keys[rng.randrange(i)] if i > 4 else None, 1) for i, k in enumerate(keys)] + [(0, "s", "s", 1), (0, "t", "s", 1), (0, "0t", "t", 1)]
    assert run(spark, edges) == brute(edges)
    assert sizes[-1] <= 12


def test_written_results_have_no_growing_estimate(spark):
    """The estimate of a join is the product of its sides; kept from copy to copy its digits would double with each."""
    df = spark.range(3).select("id", F.lit(1).alias("v"))
    for _ in range(4):
        df = durable(df.join(df.select("id", F.col("v").alias("w")), "id", "left").select("id", F.col("v").alias("v")))
    assert df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length() <= 64
    assert sorted(map(tuple, df.collect())) == [(0, 1), (1, 1), (2, 1)]


def test_only_the_result_stays_written(spark):
    """Copies made on the way to the families' roots, and the shuffle files that led to them, are gone."""
    import glob

    from lamella.plans.family_queries import rooted
    from lamella.plans.runtime import ensure_checkpoint_dir
    from tests.compare import DATA

    ensure_checkpoint_dir(spark)
    written = lambda: set(glob.glob(f"{spark.sparkContext._jsc.getCheckpointDir().get().removeprefix('file:')}/rdd-*"))
    before = written()
    kept = rooted(spark, DATA)
    assert len(written() - before) == 1 and kept.count() > 0


@pytest.fixture
def odd_forest(spark):
    """Random parents with cycles, names that repeat and fill more than one block of bits, a node that is in no tree."""
    rnd = random.Random(3)
    parent = {f"n{i:03d}": f"n{rnd.randrange(150):03d}" if rnd.random() < 0.8 else None for i in range(150)}
    nodes = spark.createDataFrame(sorted(parent.items()), "node string, parent string")
    names = [(k, f"m{rnd.randrange(130):03d}") for k in sorted(parent) for _ in range(rnd.randrange(5))] + [("n000", "m000"), ("n000", "m000"), ("apart", "m001")]
    return nodes, spark.createDataFrame(names, "node string, name string")


def test_override_counts_make_no_pairs(spark, monkeypatch, odd_forest):
    import lamella.operators.resolve as R

    nodes, members = odd_forest
    want = R.override_classes(R.closure(nodes), members.distinct()).groupBy("node", "status").agg(F.count("*")).collect()
    monkeypatch.setattr(H, "RECORDS_PER_TASK", 60)
    got = R.override_counts(nodes, members)
    assert sorted(got.collect()) == sorted(want) and R.override_counts(nodes, members.limit(0)).collect() == []


def test_scope_with_ancestors_makes_no_pairs(spark, monkeypatch, odd_forest):
    import lamella.operators.resolve as R

    nodes, _ = odd_forest
    scope = spark.createDataFrame([(f"n{i:03d}",) for i in range(0, 150, 11)] + [("apart",), ("n000",)], "id string")
    want = R.close_scope(R.closure(nodes), scope).collect()
    monkeypatch.setattr(H, "RECORDS_PER_TASK", 60)
    got = R.scope_with_ancestors(nodes, scope).collect()
    assert sorted(got) == sorted(want) and any(r.added for r in got)


def test_nearest_values_leave_two_copies(spark):
    """Only the values and what goes down the paths stay written; those of the contraction are gone."""
    import glob

    import lamella.operators.resolve as R
    from lamella.plans.runtime import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    written = lambda: set(glob.glob(f"{spark.sparkContext._jsc.getCheckpointDir().get().removeprefix('file:')}/rdd-*"))
    nodes = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b")], "node string, parent string")
    before = written()
    found = R.nearest_value(nodes, spark.createDataFrame([("a", 5)], "node string, value int"))
    assert len(written() - before) == 2
    assert {(r.node, r.value, r.origin) for r in found.collect()} == {("a", 5, "self"), ("b", 5, "a"), ("c", 5, "a")}


def test_tiers_leave_three_copies(spark):
    """Edges, tiers and the tops of walks stay written."""
    import glob

    from lamella.plans.runtime import ensure_checkpoint_dir
    from lamella.plans.spec_queries import tier_expansion
    from tests.compare import DATA

    ensure_checkpoint_dir(spark)
    written = lambda: set(glob.glob(f"{spark.sparkContext._jsc.getCheckpointDir().get().removeprefix('file:')}/rdd-*"))
    before = written()
    tier_expansion(spark, DATA)
    assert len(written() - before) == 3


def test_family_shared_takes_the_methods_apart_once(spark):
    from lamella.plans.family_queries import family_shared
    from tests.compare import DATA

    assert family_shared(spark, DATA)._jdf.queryExecution().optimizedPlan().toString().count("Generate explode") == 1
