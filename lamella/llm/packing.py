"""Filling fixed-capacity containers: a configuration linear program over the length histogram.

The corpus enters only as a histogram of item sizes, which the capacity bounds. Over it
a packing plan is made on the driver: a covering program over configurations (multisets
of sizes that fit), solved by multiplicative weights with a knapsack dynamic program as
pricing, rounded down, repeated on what is left, and ended by best fit. The plan, of a
size that the capacity bounds as well, says for the r-th item of each size in which
container it lies; items find their r and their container in parallel.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamella.plans.runtime import broadcast_if_small, durable

CAPACITY = 2048
#: Rounds of multiplicative weights of the first program and of those on residues.
ROUNDS, LATER_ROUNDS = 64, 24
#: How far the logarithm of a size's weight falls while its need is covered once.
DECAY = 8.0
#: Items of one (size, bucket) group that a task numbers.
ITEMS_PER_BUCKET = 200_000

Plan = list[tuple[tuple[tuple[int, int], ...], int]]


def best_configuration(sizes: np.ndarray, values: np.ndarray, most: np.ndarray, capacity: int) -> Counter:
    """Multiset of sizes of greatest value that fits: bounded knapsack, copies taken in powers of two."""
    best = np.zeros(capacity + 1)
    steps: list[tuple[int, int, np.ndarray]] = []
    for s, v, u in zip(sizes.tolist(), values.tolist(), np.minimum(most, capacity // sizes).tolist()):
        k = 1
        while u > 0:
            k = min(k, u)
            u -= k
            w = s * k
            with_it = best[:-w] + v * k
            take = np.zeros(capacity + 1, bool)
            take[w:] = with_it > best[w:] + 1e-15
            best[w:] = np.where(take[w:], with_it, best[w:])
            steps.append((s, k, take))
            k *= 2
    room, chosen = capacity, Counter()
    for s, k, take in reversed(steps):
        if take[room]:
            chosen[s] += k
            room -= s * k
    return chosen


def weigh(need: dict[int, int], capacity: int, rounds: int) -> list[tuple[Counter, float]]:
    """Fractional solution of the covering program by multiplicative weights: (configuration, containers).

    Each round prices a size by itself times its weight, takes the best configuration
    for a share of 1/``rounds`` of the containers that the sizes fill, and lowers the
    weights of what it covers. A configuration holds no more copies than a few rounds
    need, so that rare sizes are not covered many times over.
    """
    sizes = np.array(sorted(need, reverse=True))
    count = np.array([need[s] for s in sizes.tolist()], float)
    share = float((sizes * count).sum()) / capacity / rounds
    most = np.minimum(np.maximum(1, np.ceil(3 * count / share)), count).astype(np.int64)
    log_weight = np.zeros(len(sizes))
    found: Counter = Counter()
    for _ in range(rounds):
        chosen = best_configuration(sizes, sizes / capacity * np.exp(log_weight - log_weight.max()), most, capacity)
        found[tuple(sorted(chosen.items()))] += 1
        copies = np.array([chosen.get(s, 0) for s in sizes.tolist()], float)
        log_weight -= DECAY * np.minimum(copies * share / count, 1.0)
    return [(Counter(dict(c)), k * share) for c, k in found.items()]


def best_fit(need: dict[int, int], capacity: int) -> Plan:
    """Largest sizes first, into the fullest containers that still take them; like containers are handled together."""
    rooms: dict[int, Counter] = {capacity: Counter()}
    for s in sorted(need, reverse=True):
        n = need[s]
        for room in sorted(r for r in rooms if r >= s):
            fit = room // s
            for config, k in list(rooms[room].items()):
                full, rest = divmod(n, fit)
                for bins, copies in ((min(k, full), fit), (1 if full < k and rest else 0, rest)):
                    if bins:
                        n -= bins * copies
                        rooms[room][config] -= bins
                        rooms.setdefault(room - copies * s, Counter())[(*config, (s, copies))] += bins
                rooms[room] = +rooms[room]
                if not n:
                    break
            if not n:
                break
        if n:
            fit = capacity // s
            full, rest = divmod(n, fit)
            for bins, copies in ((full, fit), (1, rest)):
                if bins and copies:
                    rooms.setdefault(capacity - copies * s, Counter())[((s, copies),)] += bins
    return [(tuple(sorted(c)), k) for r in rooms.values() for c, k in r.items() if c and k > 0]


def _by_program(histogram: dict[int, int], capacity: int) -> Counter:
    left, out, rounds = dict(histogram), Counter(), ROUNDS
    while left:
        taken = 0
        for chosen, x in sorted(weigh(left, capacity, rounds), key=lambda c: -c[1]):
            k = min([int(x + 0.5), *(left.get(s, 0) // a for s, a in chosen.items())])
            if k > 0:
                taken += k
                out[tuple(sorted(chosen.items()))] += k
                for s, a in chosen.items():
                    left[s] -= k * a
        left = {s: n for s, n in left.items() if n > 0}
        rounds = max(8, min(LATER_ROUNDS, int(sum(s * n for s, n in left.items()) / capacity / 2)))
        if not taken:
            break
    for config, k in best_fit(left, capacity):
        out[config] += k
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Configurations and how many containers have each; every item of the histogram lies in one of them.

    Sizes are 1 to ``capacity``; an empty histogram gives no containers. Rounding can
    cost the program more than best fit wastes where few sizes fit each other, so best
    fit over the whole histogram is tried as well and the plan with fewer containers
    holds, that of the program if both are alike.
    """
    if any(not 0 < s <= capacity for s in histogram):
        raise ValueError(f"sizes must be 1 to {capacity}")
    need = {s: n for s, n in histogram.items() if n > 0}
    full = need.pop(capacity, 0)
    first, second = _by_program(need, capacity), Counter(dict(best_fit(need, capacity)))
    out = min(first, second, key=lambda p: sum(p.values()))
    out[((capacity, 1),)] += full
    return sorted((+out).items())


class Layout:
    """Where the r-th item of a size lies, as sorted arrays over (size, rank)."""

    def __init__(self, packing: Plan):
        ranks: Counter = Counter()
        rows, base = [], 0
        for config, k in packing:
            for s, a in config:
                rows.append(((s << 44) + ranks[s], base, a))
                ranks[s] += a * k
            base += k
        rows.sort()
        self.containers = base
        self.start = np.array([r[0] for r in rows], np.int64)
        self.base = np.array([r[1] for r in rows], np.int64)
        self.each = np.array([r[2] for r in rows], np.int64)

    def container(self, size: np.ndarray, rank: np.ndarray) -> np.ndarray:
        place = (size << 44) + rank
        if not len(self.start):
            return np.zeros(len(size), np.int64)
        i = np.maximum(np.searchsorted(self.start, place, "right") - 1, 0)
        lies = self.base[i] + (place - self.start[i]) // self.each[i]
        return np.where(size > 0, lies, rank % self.containers)


_OUT = pa.schema([(c, pa.int64()) for c in ("doc_id", "piece", "start_token", "n_tokens", "container_id")])


def pieces(sizes: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Items (doc_id, piece, start_token, n_tokens): only a text above the capacity is split, into full pieces and a rest."""
    last = F.greatest(F.lit(0), F.ceil(F.col("n_tokens") / capacity) - 1)
    split = sizes.select("doc_id", F.col("n_tokens").alias("n"), F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("piece"))
    start = F.col("piece") * capacity
    return split.select("doc_id", "piece", start.alias("start_token"), F.least(F.col("n") - start, F.lit(capacity)).cast("long").alias("n_tokens"))


def pack(sizes: DataFrame, *, capacity: int = CAPACITY) -> DataFrame:
    """Container of every item: (doc_id, piece, start_token, n_tokens, container_id).

    ``sizes`` has doc_id and n_tokens (null counts as 0). No container holds more
    than ``capacity`` tokens; ids run from 0 without gaps. Texts without tokens are
    one item of size 0 each and are spread evenly over the containers; if there are
    no others, all lie in container 0. Repeated rows are items of their own.

    Items are numbered within their size by buckets of their hash and the counts of
    the buckets before, so that a size that most items have is numbered by many tasks.
    """
    items = durable(pieces(sizes.select("doc_id", F.coalesce(F.col("n_tokens").cast("long"), F.lit(0)).alias("n_tokens")), capacity))
    n = items.count()
    buckets = max(8, math.ceil(n / ITEMS_PER_BUCKET))
    placed = items.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))
    counts = durable(placed.groupBy("n_tokens", "bucket").agg(F.count("*").alias("in_bucket")))
    histogram = {int(r[0]): int(r[1]) for r in counts.groupBy("n_tokens").agg(F.sum("in_bucket")).collect()}  # capacity + 1 rows at most
    histogram.pop(0, None)
    layout = Layout(plan(histogram, capacity))
    before = F.sum("in_bucket").over(Window.partitionBy("n_tokens").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = broadcast_if_small(durable(counts.select("n_tokens", "bucket", F.coalesce(before, F.lit(0)).alias("before"))))
    own = F.row_number().over(Window.partitionBy("n_tokens", "bucket").orderBy("doc_id", "piece")) - 1
    ranked = placed.withColumn("own", own).join(offsets, ["n_tokens", "bucket"])
    ready = ranked.select("doc_id", "piece", "start_token", "n_tokens", (F.col("own") + F.col("before")).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = layout.container(b["n_tokens"].to_numpy(), b["rank"].to_numpy())
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["piece"], b["start_token"], b["n_tokens"], pa.array(at, pa.int64())], schema=_OUT)

    return ready.mapInArrow(run, "doc_id long, piece long, start_token long, n_tokens long, container_id long")


def packing_report(packed: DataFrame, *, capacity: int = CAPACITY) -> DataFrame:
    """One row: items, tokens, containers, the least number that could hold the tokens, the fullest, and the share of space used."""
    each = packed.groupBy("container_id").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("k"))
    return each.agg(
        F.coalesce(F.sum("k"), F.lit(0)).alias("items"),
        F.coalesce(F.sum("t"), F.lit(0)).alias("tokens"),
        F.count("*").alias("containers"),
        F.coalesce(F.ceil(F.sum("t") / capacity), F.lit(0)).alias("least_containers"),
        F.coalesce(F.max("t"), F.lit(0)).alias("fullest"),
        F.round(F.sum("t") / (F.count("*") * capacity), 6).alias("filled"),
    )
