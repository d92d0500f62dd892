"""Scoped replacement of rows, envelopes and their statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.operators.scope import merge_scope_values


def scoped_upsert(existing: DataFrame, new: DataFrame, scope: DataFrame | None, *, id: str = "id") -> DataFrame:
    """Existing rows outside the scope and all new rows.

    Every existing row whose id is in scope goes, also if no new row has that id;
    without a scope all existing rows go. New rows are taken as they are.
    """
    if scope is None:
        return new
    return existing.join(scope.select(F.col("id").alias(id)).distinct(), id, "left_anti").unionByName(new)


def envelope(rows: DataFrame, *, stats: Sequence[Column] = ()) -> DataFrame:
    """One row about a dataset: count, and the given aggregates (a callback of statistics is a list of them)."""
    return rows.agg(F.count("*").alias("count"), *stats)


def reaggregate(entries: DataFrame, scope: DataFrame, envelopes: DataFrame, *, group: str, id: str = "id", count: str = "entry_count") -> DataFrame:
    """Envelopes after a prune: (group, old count, new count, changed) with entries outside the scope left out."""
    kept = entries.join(scope.select(F.col("id").alias(id)).distinct(), id, "left_semi").groupBy(group).agg(F.count("*").alias("new_count"))
    old = envelopes.groupBy(group).agg(F.max(count).cast("long").alias("old_count"))
    both = old.join(kept, group, "left").withColumn("new_count", F.coalesce("new_count", F.lit(0)))
    return both.select(group, "old_count", "new_count", (~F.col("old_count").eqNullSafe(F.col("new_count"))).alias("changed"))


def manifest_status(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Status of each id of a manifest or file: ok, missing, corrupt, id_mismatch or orphan.

    ``manifest`` has id; ``files`` has id (from the name), body_id, and readable.
    """
    m = manifest.select("id").distinct().withColumn("listed", F.lit(True))
    f = files.select("id", "body_id", "readable", F.lit(True).alias("there"))
    status = (
        F.when(F.col("listed").isNull(), "orphan").when(F.col("there").isNull(), "missing").when(~F.col("readable"), "corrupt")
        .when(~F.col("body_id").eqNullSafe(F.col("id")), "id_mismatch").otherwise("ok")
    )
    return m.join(f, "id", "full").select("id", status.alias("status"))


def keep_first(rows: DataFrame, *, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first by ``order``. By an aggregate, so repeated keys are reduced before they move."""
    rest = [c for c in rows.columns if c not in key]
    best = rows.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r"))
    return best.select(*key, *[F.col(f"r.{c}").alias(c) for c in rest])


def pivot_kinds(rows: DataFrame, *, id: str, kind: str, value: str, order: Sequence[str], kinds: Sequence[str]) -> DataFrame:
    """One column per kind for each id: the first value by ``order`` (nulls first); kinds are a fixed list, so no pass is needed to find them."""
    first = lambda k: F.min_by(F.when(F.col(kind) == k, F.col(value)), F.when(F.col(kind) == k, F.struct(*order)))
    return rows.groupBy(id).agg(*[first(k).alias(k) for k in kinds])


def aggregate(existing: DataFrame, new: DataFrame, scope: DataFrame | None, *, id: str = "id", old_stamp: Sequence[str] = (), new_stamp: Sequence[str] = (), tiers: Sequence[str] = (), stats: Mapping[str, Column] | None = None, readable: bool = True) -> tuple[DataFrame, DataFrame]:
    """A dataset after a scoped upsert: its rows, to be read in order of ``id``, and its envelope of one row.

    The envelope has the count, the union of the scope stamps (``all`` absorbs, tiers come first) and the given
    statistics, which hold over the count where names clash. An existing dataset that cannot be read
    (``readable`` false) is an error for a scoped write and is replaced by a full one.
    """
    if scope is not None and not readable:
        raise ValueError("the existing dataset cannot be read; write it in full")
    rows = scoped_upsert(existing, new, scope, id=id)
    text = lambda values: F.array(*[F.lit(v) for v in values]).cast("array<string>")
    stamp = merge_scope_values(text(old_stamp if scope is not None else ()), text(new_stamp), list(tiers))
    measures = {"count": F.count("*")} | dict(stats or {})
    return rows.orderBy(id), rows.agg(*[c.alias(n) for n, c in measures.items()]).withColumn("tier_scope", F.array_join(stamp, ","))
