"""Structural differences: leaves of JSON texts, parity of two sets of documents, drift against a baseline."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.operators.nested import escape
from lamella.operators.patch import VOLATILE


def walk(value: object, path: str = "", drop: frozenset[str] = frozenset(VOLATILE)) -> Iterator[tuple[str, str, str]]:
    """Nodes (path, kind, scalar as JSON) of a value, without the dropped keys; containers come before their children."""
    todo = [(path, value)]
    while todo:
        p, v = todo.pop()
        if isinstance(v, dict):
            yield p, "object", ""
            todo += [(f"{p}/{escape(k)}", x) for k, x in reversed(v.items()) if k not in drop]
        elif isinstance(v, list):
            yield p, "array", str(len(v))
            todo += [(f"{p}/{i}", x) for i, x in reversed(list(enumerate(v)))]
        else:
            yield p, "scalar", json.dumps(v, ensure_ascii=False)


def node_rows(documents: DataFrame, *, id: Sequence[str], text: str) -> DataFrame:
    """Every node of each JSON text: (*id, path, kind, scalar). An array's scalar is its length; unreadable texts have none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out: list[tuple] = []
            for *key, t in b.itertuples(index=False, name=None):
                try:
                    value = json.loads(t)
                except (TypeError, ValueError):
                    continue
                out += [(*key, *n) for n in walk(value)]
                if len(out) > 50_000:
                    yield pd.DataFrame(out, columns=columns)
                    out = []
            yield pd.DataFrame(out, columns=columns)

    keyed = documents.select(*id, F.col(text).alias("__text")).where("__text is not null")
    columns = [*id, "path", "kind", "scalar"]
    types = ", ".join(f"`{c}` {t}" for c, t in keyed.drop("__text").dtypes)
    return keyed.mapInPandas(run, f"{types}, path string, kind string, scalar string")


def parity(new: DataFrame, old: DataFrame, *, id: Sequence[str]) -> DataFrame:
    """Documents in two sets, by their node rows: (*id, status, n_paths); missing, extra, match or drift.

    ``n_paths`` counts the topmost nodes that differ: a list of another length, or a
    node of another kind, is one path and hides what is below it.
    """
    keys = list(id)
    a = new.select(*keys, "path", F.struct("kind", "scalar").alias("a"))
    b = old.select(*keys, "path", F.struct("kind", "scalar").alias("b"))
    both = a.join(b, [*keys, "path"], "full")
    ids = new.select(*keys).distinct().withColumn("n", F.lit(1)).join(old.select(*keys).distinct().withColumn("o", F.lit(1)), keys, "full")
    differs = both.where(~F.col("a").eqNullSafe(F.col("b"))).select(*keys, "path")
    # A path is hidden if a proper beginning of it differs as well.
    segments = F.split("path", "/")
    above = differs.select(*keys, "path", F.explode(F.sequence(F.lit(0), F.size(segments) - 2)).alias("k")).where("k >= 0 and path <> ''")
    above = above.select(*keys, "path", F.array_join(F.slice(segments, F.lit(1), F.col("k") + 1), "/").alias("head"))
    hidden = above.join(differs.withColumnRenamed("path", "head"), [*keys, "head"], "left_semi").select(*keys, "path").distinct()
    count = differs.join(hidden, [*keys, "path"], "left_anti").groupBy(*keys).agg(F.count("*").alias("n_paths"))
    status = F.when(F.col("n").isNull(), "missing").when(F.col("o").isNull(), "extra").when(F.coalesce("n_paths", F.lit(0)) > 0, "drift").otherwise("match")
    return ids.join(count, keys, "left").select(*keys, status.alias("status"), F.when(status == "drift", F.col("n_paths")).otherwise(0).cast("long").alias("n_paths"))


def key_differences(left: Column, right: Column) -> Column:
    """Sorted keys of two maps whose values differ; an absent key equals a null value."""
    keys = F.array_union(F.coalesce(F.map_keys(left), F.array().cast("array<string>")), F.coalesce(F.map_keys(right), F.array().cast("array<string>")))
    return F.array_sort(F.filter(keys, lambda k: ~F.element_at(left, k).eqNullSafe(F.element_at(right, k))))


def spot_check(left: DataFrame, right: DataFrame, *, group: str, key: str) -> DataFrame:
    """Per group: keys of both sides, and those that only one has. One aggregate over both sides."""
    both = left.select(group, key, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(right.select(group, key, F.lit(0).alias("l"), F.lit(1).alias("r")))
    seen = both.groupBy(group, key).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return seen.groupBy(group).agg(
        F.sum("l").cast("long").alias("left_n"), F.sum("r").cast("long").alias("right_n"),
        F.count(F.when(F.col("r") == 0, 1)).alias("removed"), F.count(F.when(F.col("l") == 0, 1)).alias("added"),
    )


def flipped_derived(current: DataFrame, baseline: DataFrame, provenance: DataFrame) -> DataFrame:
    """Derived values that changed: (id, path, before, after) of (id, path, value) rows and (path, tag) provenance."""
    derived = provenance.where("tag = 'derived'").select("path")
    a = current.select("id", "path", F.col("value").alias("after"))
    b = baseline.select("id", "path", F.col("value").alias("before"))
    return a.join(b, ["id", "path"], "full").join(derived, "path", "left_semi").where(~F.col("before").eqNullSafe(F.col("after"))).select("id", "path", "before", "after")


def stale_overrides(entries: DataFrame, current: DataFrame, baseline: DataFrame, sources: DataFrame) -> DataFrame:
    """Override entries (id, path) whose value, or one of whose raw sources (path, source), changed: (id, path, source)."""
    looked = entries.select("id", "path", F.col("path").alias("source")).unionByName(entries.join(sources, "path").select("id", "path", "source")).distinct()
    a = current.select("id", F.col("path").alias("source"), F.col("value").alias("after"))
    b = baseline.select("id", F.col("path").alias("source"), F.col("value").alias("before"))
    return looked.join(a, ["id", "source"], "left").join(b, ["id", "source"], "left").where(~F.col("before").eqNullSafe(F.col("after"))).select("id", "path", "source")


def new_paths(current: DataFrame, baseline: DataFrame) -> DataFrame:
    """Topmost object keys that the baseline lacks: (id, path) of node rows; what is inside lists is left aside."""
    inside = F.col("path").rlike("/[0-9]+(/|$)")
    added = current.where(~inside).join(baseline.select("id", "path"), ["id", "path"], "left_anti").select("id", "path")
    parent = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    return added.withColumn("above", parent).join(added.select("id", F.col("path").alias("above")), ["id", "above"], "left_anti").select("id", "path")


def determinism(first: DataFrame, second: DataFrame, *, id: str, text: str) -> DataFrame:
    """Outputs of two runs by content hash: (id, status); equal, diverged, or missing in one."""
    a = first.select(id, F.sha2(F.col(text), 256).alias("a"), F.lit(1).alias("l"))
    b = second.select(id, F.sha2(F.col(text), 256).alias("b"), F.lit(1).alias("r"))
    status = F.when(F.col("l").isNull(), "missing_first").when(F.col("r").isNull(), "missing_second").when(F.col("a").eqNullSafe(F.col("b")), "equal").otherwise("diverged")
    return a.join(b, id, "full").select(id, status.alias("status"))


def override_audit(entries: DataFrame, derived: DataFrame) -> DataFrame:
    """Audit of list overrides (id, path, value array) against derived lists (id, path, value): (id, path, status).

    Equal sets are a ``warning`` (redundant); an override inside the derived set is
    ``verified``; anything else a ``mismatch``; nothing derived is ``unverified``.
    """
    j = entries.select("id", "path", F.array_sort(F.array_distinct("value")).alias("o")).join(
        derived.select("id", "path", F.array_sort(F.array_distinct("value")).alias("d")), ["id", "path"], "left"
    )
    status = (
        F.when(F.col("d").isNull(), "unverified").when(F.col("o") == F.col("d"), "warning")
        .when(F.size(F.array_except("o", "d")) == 0, "verified").otherwise("mismatch")
    )
    return j.select("id", "path", status.alias("status"))
