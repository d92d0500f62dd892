import datetime as dt
import random

import lamella.operators.references as R

T = lambda d: dt.datetime(2025, 1, d)


def run(spark, refs, listed):
    r = spark.createDataFrame(refs, "no long, key string, at timestamp, name string, rng int, salt int")
    p = spark.createDataFrame(listed, "k string, t timestamp")
    return R.orphan_references(r, p, ref_id="no", key="key", at="at", label="name", listed_key="k", listed_at="t")


def ref(no, key, day, name="d"):
    return (no, key, T(day) if day else None, name, 7, 7)


def pairs(df):
    return sorted((r.ref_id, r.reason) for r in df.collect())


def test_reasons(spark):
    listed = [("A", T(2)), ("b", T(2)), ("B ", T(4)), ("c", T(6)), (None, T(8)), ("", T(8)), ("z", None)]
    got = run(spark, [
        ref(1, " a ", 2), ref(2, "A", 5), ref(3, "b", 4), ref(4, "C", 4), ref(5, "nobody", 5), ref(6, None, 5), ref(7, " \t ", 5),
        ref(8, "a", 1), ref(9, "a", None), ref(10, "b", 9), ref(11, "z", 5), ref(5, "nobody", 5), ref(5, "nobody", 5), ref(12, "x" * 100_000, 5),
    ], listed)
    assert pairs(got) == [(2, "deleted"), (4, "late"), (5, "missing"), (8, "late"), (9, "late"), (10, "deleted"), (11, "missing"), (12, "missing")]


def test_empty_tables(spark):
    assert pairs(run(spark, [], [("a", T(1))])) == []
    assert pairs(run(spark, [ref(1, "a", 2)], [])) == [(1, "missing")]


def brute(refs, listed):
    norm = lambda k: (k or "").strip().lower() or None
    times = sorted({t for _, t in listed})
    has = {(norm(k), t) for k, t in listed}
    out = set()
    for no, key, at, *_ in refs:
        k = norm(key)
        force = max((t for t in times if t <= at), default=None)
        if k is None or (k, force) in has:
            continue
        mine = [t for x, t in has if x == k]
        earlier, later = any(force and t < force for t in mine), any(force is None or t > force for t in mine)
        out.add((no, "deleted" if earlier else "late" if later else "missing"))
    return sorted(out)


def test_many_ranges_and_salts(spark, monkeypatch):
    rnd = random.Random(4)
    listed = [(f"k{rnd.randrange(60)}", T(1 + rnd.randrange(9))) for _ in range(250)]
    refs = [ref(i, "K1 " if rnd.random() < 0.4 else f"k{rnd.randrange(80)}", 1 + rnd.randrange(12)) for i in range(600)]
    want = brute(refs, listed)
    monkeypatch.setattr(R, "PARENTS_PER_RANGE", 20)
    monkeypatch.setattr(R, "ROWS_PER_TASK", 50)
    assert pairs(run(spark, refs, listed)) == want
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        assert pairs(run(spark, refs, listed)) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_keys_of_one_hash(spark):
    import numpy as np
    import pyarrow as pa

    schema = pa.schema([("h", pa.int64()), ("key", pa.string()), ("at_us", pa.int64())])
    store = R._Store([pa.RecordBatch.from_pydict({"h": [5, 5, 5, 9], "key": ["a", "b", "b", "c"], "at_us": [1, 1, 2, 1]}, schema)])
    found = store.find(np.array([5, 5, 5, 9, 1]), pa.array(["a", "b", "x", "c", "a"]))
    assert found.tolist() == [0, 1, -1, 2, -1]
    assert store.listed(np.array([1, 1, 0]), np.array([2, 3, 1])).tolist() == [True, False, True]
