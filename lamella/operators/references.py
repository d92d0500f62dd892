"""References to records that do not exist: range store, binary search, misses by reason."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamella.plans.runtime import broadcast_if_small, durable

#: Reference rows that one range task probes; a fuller range is split by salt.
ROWS_PER_TASK = 1_000_000
#: Parent rows of one range; its sorted arrays are held in memory while it is probed.
PARENTS_PER_RANGE = 250_000

MISSES = "ref_id long, label string, at_us long, reason string"
_OUT = pa.schema([("ref_id", pa.int64()), ("label", pa.string()), ("at_us", pa.int64()), ("reason", pa.string())])
_NEVER = np.iinfo(np.int64).min


def normal_key(column: Column) -> Column:
    """Key without surrounding Unicode whitespace and in lower case; null if nothing is left."""
    bare = F.lower(F.regexp_replace(column, r"(?U)^[\s\p{Z}]+|[\s\p{Z}]+$", ""))
    return F.when(bare != "", bare)


def _range_of(hashed: Column, n: int) -> Column:
    """Range of a 64-bit hash: ``n`` ranges of equal width over all its values."""
    unit = F.shiftrightunsigned(hashed, 11).cast("double") / F.lit(float(2**53))
    return F.least(F.floor(unit * n), F.lit(n - 1)).cast("int")


_PLACED = "part int, is_ref int, ref_id long, label string, at_us long, key string, force_us long"
_PLACED_SCHEMA = pa.schema([("part", pa.int32()), ("is_ref", pa.int32()), ("ref_id", pa.int64()), ("label", pa.string()), ("at_us", pa.int64()), ("key", pa.string()), ("force_us", pa.int64())])


def _fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range in order of time: references with the last list before them in the range, and one row with the range's last list."""
    from pyspark import TaskContext

    part, last = TaskContext.get().partitionId(), _NEVER
    for b in batches:
        at, is_ref = b["at_us"].fill_null(_NEVER).to_numpy(), b["is_ref"].to_numpy()
        if not len(at):
            continue
        seen = np.maximum.accumulate(np.maximum(np.where(is_ref == 0, at, _NEVER), last))
        last = int(seen[-1])
        own = is_ref == 1
        if own.any():
            r = b.filter(pa.array(own))
            force = pa.array(seen[own], pa.int64(), mask=seen[own] == _NEVER)
            cols = [pa.array(np.full(r.num_rows, part, np.int32)), r["is_ref"].cast(pa.int32()), r["ref_id"], r["label"], r["at_us"], r["key"], force]
            yield pa.RecordBatch.from_arrays(cols, schema=_PLACED_SCHEMA)
    if last != _NEVER:
        yield pa.RecordBatch.from_pylist([{"part": part, "is_ref": 0, "at_us": last}], schema=_PLACED_SCHEMA)


def _in_force(refs: DataFrame, times: DataFrame) -> DataFrame:
    """``refs`` (ref_id, label, at_us, key) with ``force_us``, the latest of ``times`` (at_us) not after them, or null.

    References and lists are sorted by time together, in ranges that also spread references of one time
    by their hash, so a time that most of them share is many ranges. What a range lacks is the last list of those
    before it, one row for each range.
    """
    width = int(refs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marks = times.select(F.lit(None).cast("long").alias("ref_id"), F.lit(None).cast("string").alias("label"), "at_us", F.lit(None).cast("string").alias("key"), F.lit(0).alias("is_ref"), F.lit(0).cast("long").alias("salt"))
    both = refs.select("ref_id", "label", "at_us", "key", F.lit(1).alias("is_ref"), F.xxhash64("ref_id").alias("salt")).unionByName(marks)
    order = ["at_us", "is_ref", "salt"]
    laid = durable(both.repartitionByRange(width, *order).sortWithinPartitions(*order).mapInArrow(_fill, _PLACED))
    w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = laid.groupBy("part").agg(F.max(F.when(F.col("is_ref") == 0, F.col("at_us"))).alias("m"))
    carry = parts.select("part", F.max("m").over(w).alias("before"))
    found = laid.where("is_ref = 1").join(broadcast_if_small(carry), "part", "left")
    return found.select("ref_id", "label", "at_us", "key", F.coalesce("force_us", "before").alias("force_us"))


def _spans(*columns: np.ndarray) -> list[tuple[int, int]]:
    """Runs of rows in which all columns stay the same."""
    n = len(columns[0])
    if not n:
        return []
    change = np.zeros(n, bool)
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    cuts = [0, *np.flatnonzero(change).tolist(), n]
    return list(zip(cuts, cuts[1:]))


class _Store:
    """Parents of one range: distinct keys in hash order, and the listing times of each as one sorted array."""

    def __init__(self, batches: list[pa.RecordBatch]):
        t = pa.Table.from_batches(batches).combine_chunks()
        h, at = t["h"].to_numpy(), t["at_us"].to_numpy()
        keys = t["key"].combine_chunks() if isinstance(t["key"], pa.ChunkedArray) else t["key"]
        new = np.ones(len(h), bool)
        if len(h) > 1:
            same = pc.equal(keys.slice(1), keys.slice(0, len(h) - 1)).to_numpy(zero_copy_only=False)
            new[1:] = ~same
        self.first = np.flatnonzero(new)
        self.last = np.append(self.first[1:], len(h)) - 1
        self.hash, self.keys, self.at = h[self.first], keys.take(pa.array(self.first)), at
        self.of = np.cumsum(new) - 1

    def find(self, h: np.ndarray, keys: pa.Array) -> np.ndarray:
        """Index of each key among the store's keys, -1 if it is none of them."""
        if not len(self.hash):
            return np.full(len(h), -1)
        lo = np.searchsorted(self.hash, h, "left")
        many = np.searchsorted(self.hash, h, "right") - lo
        at = np.where(many > 0, lo, 0)
        same = pc.equal(self.keys.take(pa.array(at)), keys).to_numpy(zero_copy_only=False) & (many > 0)
        found = np.where(same, at, -1)
        for i in np.flatnonzero((many > 1) & ~same):  # several keys with this hash
            for j in range(lo[i] + 1, lo[i] + many[i]):
                if self.keys[j].as_py() == keys[i].as_py():
                    found[i] = j
        return found

    def listed(self, key: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Whether the list of time ``at`` has the key: a binary search inside each key's own sorted times."""
        lo, hi = self.first[key].copy(), self.last[key] + 1
        end = hi.copy()
        while (open_ := lo < hi).any():
            mid = (lo + hi) // 2
            less = open_ & (self.at[np.minimum(mid, len(self.at) - 1)] < at)
            lo, hi = np.where(less, mid + 1, lo), np.where(open_ & ~less, mid, hi)
        return (lo < end) & (self.at[np.minimum(lo, len(self.at) - 1)] == at)


def _probe(store: _Store, b: pa.RecordBatch, force: np.ndarray) -> pa.RecordBatch:
    found = store.find(b["h"].to_numpy(), b["key"])
    known = found >= 0
    reason = np.full(len(found), "missing", dtype=object)
    key, f = found[known], force[known]
    if len(key):
        earlier = store.at[store.first[key]] < f
        reason[known] = np.where(earlier, "deleted", np.where(store.at[store.last[key]] > f, "late", "missing"))
        reason[np.flatnonzero(known)[store.listed(key, f)]] = None
    out = pa.RecordBatch.from_arrays([b["ref_id"], b["label"], b["at_us"], pa.array(reason, pa.string())], schema=_OUT)
    return out.filter(pc.is_valid(out["reason"]))


def _prober() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, parents, store, previous = None, [], None, None
        for batch in batches:
            rng, salt, kind = (batch[c].to_numpy() for c in ("rng", "salt", "kind"))
            for a, z in _spans(rng, salt, kind):
                b, group = batch.slice(a, z - a), (rng[a], salt[a])
                if group != here:
                    here, parents, store, previous = group, [], None, None
                if kind[a] == 0:
                    parents.append(b)
                    continue
                if store is None:
                    store, parents = _Store(parents or [b.slice(0, 0)]), []
                ids, at = b["ref_id"].to_numpy(), b["at_us"].fill_null(_NEVER).to_numpy()
                force = b["force_us"].fill_null(_NEVER).to_numpy()
                once = np.ones(len(ids), bool)
                if len(ids) > 1:
                    once[1:] = (ids[1:] != ids[:-1]) | (at[1:] != at[:-1]) | (b["h"].to_numpy()[1:] != b["h"].to_numpy()[:-1])
                once[0] = previous != (ids[0], at[0], b["h"][0].as_py())
                previous = (ids[-1], at[-1], b["h"][-1].as_py())
                if once.any():
                    yield _probe(store, b.filter(pa.array(once)), force[once])

    return run


def orphan_references(
    refs: DataFrame,
    listed: DataFrame,
    *,
    ref_id: str,
    key: str,
    at: str,
    label: str,
    listed_key: str,
    listed_at: str,
) -> DataFrame:
    """References whose key the list in force does not have, as (ref_id, label, at_us, reason).

    ``listed`` has a row per list (told by its time ``listed_at``) and key. In
    force is the latest list not after the reference. An absent key is ``deleted``
    if an earlier list has it, else ``late`` if a later one has it, else
    ``missing``. Keys compare without case and surrounding whitespace; a null or
    blank key refers to nothing. A reference before every list, or with a null
    time, has no list in force, so it is ``late`` or ``missing``. Null list times
    are no list. Exactly repeated references give one row; with no list at all
    every reference is ``missing``.

    Keys are hashed to 64 bits and laid out in ranges of equal width of the hash,
    which stay balanced without sampling. A range's parents form sorted arrays;
    its references stream past them in Arrow batches and are looked up by binary
    search, then compared exactly. Ranges that a hot key fills are split by salt,
    with their bounded parent arrays repeated, so no group is ever gathered.
    """
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    parents = durable(
        listed.select(normal_key(F.col(listed_key)).alias("key"), us(listed_at).alias("at_us"))
        .where("key is not null and at_us is not null")
        .groupBy("key", "at_us")
        .agg(F.lit(1).alias("one"))
        .select("key", "at_us")
    )
    lists = listed.select(us(listed_at).alias("at_us")).where("at_us is not null").distinct()
    slim = refs.select(
        F.col(ref_id).cast("long").alias("ref_id"), F.col(label).cast("string").alias("label"), us(at).alias("at_us"),
        normal_key(F.col(key)).alias("key"),
    ).where("key is not null")
    slim = _in_force(slim, lists)
    n = max(1, math.ceil(parents.count() / PARENTS_PER_RANGE))
    h = F.xxhash64("key")
    slim = slim.withColumn("h", h).withColumn("rng", _range_of(F.col("h"), n))
    spread = durable(slim.groupBy("rng").agg(F.ceil(F.count("*") / ROWS_PER_TASK).cast("int").alias("salts")))
    tasks = int(spread.agg(F.sum("salts")).first()[0] or 1)
    few = broadcast_if_small(spread)
    salted = slim.join(few, "rng").withColumn("salt", F.pmod(F.xxhash64("ref_id"), F.col("salts")).cast("int"))
    store = (
        parents.withColumn("h", h).withColumn("rng", _range_of(F.col("h"), n))
        .join(few, "rng")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    )
    layout = ["rng", "salt", "kind", "h", "key", "at_us", "force_us", "ref_id", "label"]
    both = salted.withColumn("kind", F.lit(1)).select(layout).unionByName(
        store.select(
            "rng", "salt", F.lit(0).alias("kind"), "h", "key", "at_us", F.lit(None).cast("long").alias("force_us"),
            F.lit(None).cast("long").alias("ref_id"), F.lit(None).cast("string").alias("label"),
        )
    )
    width = int(refs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = both.repartition(max(1, min(tasks * 2, width * 4)), "rng", "salt").sortWithinPartitions("rng", "salt", "kind", "h", "key", "at_us", "ref_id")
    return laid.mapInArrow(_prober(), MISSES)


def orphan_report(misses: DataFrame, refs: DataFrame, *, key: str, at: str, label: str) -> DataFrame:
    """Misses per label, month and reason, beside the month's references that name a key (repeated rows included)."""
    month = F.date_format(F.col(at), "yyyy-MM")
    total = refs.where(normal_key(F.col(key)).isNotNull()).groupBy(F.col(label).alias("label"), month.alias("period")).agg(F.count("*").alias("refs"))
    period = F.date_format(F.timestamp_micros("at_us"), "yyyy-MM")
    lost = misses.groupBy("label", period.alias("period")).agg(
        *[F.count(F.when(F.col("reason") == r, 1)).alias(r) for r in ("deleted", "late", "missing")]
    )
    t, m = total.alias("t"), lost.alias("m")
    return t.join(m, F.col("t.label").eqNullSafe(F.col("m.label")) & F.col("t.period").eqNullSafe(F.col("m.period")), "left").select(
        F.col("t.label").alias(label), "t.period", "refs", *[F.coalesce(F.col(f"m.{r}"), F.lit(0)).alias(r) for r in ("deleted", "late", "missing")]
    )
