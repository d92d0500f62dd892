import random
from collections import Counter

import pytest

import lamella.llm.packing as P


def check(histogram, capacity):
    plan = P.plan(histogram, capacity)
    total = Counter()
    for config, k in plan:
        assert k > 0 and sum(s * a for s, a in config) <= capacity
        for s, a in config:
            total[s] += a * k
    assert total == Counter({s: n for s, n in histogram.items() if n})
    return sum(k for _, k in plan)


def test_plans_hold_every_item():
    rnd = random.Random(3)
    for _ in range(20):
        h = {rnd.randrange(1, 65): rnd.randrange(0, 400) for _ in range(rnd.randrange(1, 30))}
        n = check(h, 64)
        least = -(-sum(s * k for s, k in h.items()) // 64)
        fit = sum(k for _, k in P.best_fit({s: k for s, k in h.items() if k}, 64))
        assert least <= n <= fit
    assert P.plan({}, 64) == [] and check({64: 7}, 64) == 7 and check({1: 1}, 64) == 1
    with pytest.raises(ValueError):
        P.plan({65: 1}, 64)


def test_knapsack_is_optimal():
    import itertools

    import numpy as np

    rnd = random.Random(5)
    for _ in range(30):
        sizes = rnd.sample(range(1, 12), 4)
        values = [rnd.random() for _ in sizes]
        most = [rnd.randrange(1, 4) for _ in sizes]
        got = P.best_configuration(np.array(sizes), np.array(values), np.array(most), 20)
        best = max(sum(v * a for v, a in zip(values, c)) for c in itertools.product(*(range(m + 1) for m in most)) if sum(s * a for s, a in zip(sizes, c)) <= 20)
        assert abs(sum(values[sizes.index(s)] * a for s, a in got.items()) - best) < 1e-9
        assert all(a <= most[sizes.index(s)] for s, a in got.items())


def pack(spark, rows, capacity=20):
    df = spark.createDataFrame(rows, "doc_id long, n_tokens long, piece long, rank long")
    return P.pack(df, capacity=capacity)


def test_containers(spark, monkeypatch):
    monkeypatch.setattr(P, "ITEMS_PER_BUCKET", 10)
    rnd = random.Random(8)
    rows = [(i, 5 if rnd.random() < 0.4 else rnd.randrange(0, 70), 9, 9) for i in range(300)] + [(7, 5, 9, 9)] * 3 + [(None, 3, 9, 9), (1000, None, 9, 9), (1001, 20, 9, 9), (1002, 40, 9, 9)]
    got = pack(spark, rows).collect()
    fill = Counter()
    for r in got:
        fill[r.container_id] += r.n_tokens
    assert max(fill.values()) <= 20 and sorted(fill) == list(range(len(fill)))
    whole = Counter()
    for r in got:
        whole[r.doc_id] += r.n_tokens
        assert r.start_token == 20 * r.piece
    want = Counter()
    for d, n, *_ in rows:
        want[d] += n or 0
    assert whole == want
    assert sum(1 for r in got if r.doc_id == 1001) == 1 and sum(1 for r in got if r.doc_id == 1002) == 2
    report = P.packing_report(pack(spark, rows), capacity=20).first()
    assert report["fullest"] <= 20 and report["tokens"] == sum(want.values()) and report["containers"] >= report["least_containers"]


def test_nothing_to_pack(spark):
    assert pack(spark, []).collect() == []
    assert [r.container_id for r in pack(spark, [(1, 0, 1, 1), (2, None, 1, 1)]).collect()] == [0, 0]
    assert P.packing_report(pack(spark, [])).first()["containers"] == 0
