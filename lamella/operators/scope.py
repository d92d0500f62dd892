"""Scopes: which entities an operation is about, and filters by sets of ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamella.functions.strings import jaro_similarity
from lamella.plans.runtime import broadcast_if_small


class UnknownIds(ValueError):
    """Explicitly named ids that the universe lacks."""


def parse_ids(values: Sequence[str]) -> list[str]:
    """Ids from repeatable, comma-separated options: trimmed, without empties and repeats, in order."""
    return list(dict.fromkeys(x.strip() for v in values for x in v.split(",") if x.strip()))


def split_ids(df: DataFrame, column: str) -> DataFrame:
    """The same for a column of options: distinct ids."""
    part = df.select(F.explode(F.split(column, ",")).alias("x")).select(F.trim("x").alias("id"))
    return part.where("id <> ''").distinct()


def resolve(
    universe: DataFrame, *, everything: bool = False, ids: Sequence[str] = (), tiers: Sequence[str] = (), tier_members: DataFrame | None = None
) -> DataFrame | None:
    """Ids in scope, or None for all.

    ``everything`` with a narrowing is an error; no narrowing means all. Tier
    members are cut to the universe; explicit ids outside it raise UnknownIds
    with the closest known ids.
    """
    if everything and (ids or tiers):
        raise ValueError("everything cannot be combined with ids or tiers")
    if everything or not (ids or tiers):
        return None
    spark = universe.sparkSession
    asked = spark.createDataFrame([(i,) for i in ids], "id string")
    unknown = [r["id"] for r in asked.join(universe.select("id"), "id", "left_anti").collect()]  # the caller's own ids
    if unknown:
        near = {r["asked"]: [] for r in spark.createDataFrame([(u,) for u in unknown], "asked string").collect()}
        for r in closest(spark.createDataFrame([(u,) for u in unknown], "asked string"), universe, asked="asked", known="id").orderBy("asked", "rank").collect():
            near[r["asked"]].append(r["id"])
        raise UnknownIds("; ".join(f"{u} (near: {', '.join(n) or 'none'})" for u, n in sorted(near.items())))
    out = asked
    if tiers and tier_members is not None:
        chosen = tier_members.where(F.col("tier").isin(*tiers)).select("id")
        out = out.unionByName(chosen.join(universe.select("id"), "id", "left_semi"))
    return out.distinct()


def closest(queries: DataFrame, universe: DataFrame, *, asked: str, known: str, least: float = 0.7, k: int = 3) -> DataFrame:
    """Up to ``k`` known ids for each asked one, by Jaro similarity of at least ``least``, then by id.

    ``queries`` are the few names a user gave: a stated query set against all rows,
    compared where the universe lies. Best ones are kept per name.
    """
    pairs = universe.select(F.col(known).alias("id")).distinct().crossJoin(F.broadcast(queries.select(asked).distinct()))
    scored = pairs.withColumn("score", jaro_similarity(asked, "id")).where(F.col("score") >= least)
    # The window's limit is also applied before the shuffle, so each task sends k rows of a name at most.
    place = F.row_number().over(Window.partitionBy(asked).orderBy(F.desc("score"), "id"))
    return scored.withColumn("rank", place).where(F.col("rank") <= k).select(asked, "id", F.round("score", 6).alias("score"), "rank")


def filter_ids(df: DataFrame, scope: DataFrame | None, *, id: str = "id") -> DataFrame:
    """Rows whose id is in scope; all of them without a scope."""
    return df if scope is None else df.join(broadcast_if_small(scope.select(F.col("id").alias(id)).distinct()), id, "left_semi")


def without_ids(df: DataFrame, excluded: DataFrame, *, id: str = "id") -> DataFrame:
    """Rows whose id is not excluded; a null id stays."""
    return df.join(excluded.select(F.col("id").alias(id)).distinct(), id, "left_anti")


def missing_files(scope: DataFrame, files: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Ids in scope without a file, less the aliases."""
    out = scope.select("id").join(files.select("id"), "id", "left_anti")
    return out if aliases is None else out.join(aliases.select("id"), "id", "left_anti")


def tier_of(ids: DataFrame, members: DataFrame, order: Sequence[str]) -> DataFrame:
    """Tier of each id; of several the one that comes last in ``order`` holds, without any ``unclassified``."""
    place = F.array_position(F.array(*[F.lit(t) for t in order]), F.col("tier"))
    last = members.groupBy("id").agg(F.max_by("tier", place).alias("tier"))
    return ids.select("id").join(last, "id", "left").select("id", F.coalesce("tier", F.lit("unclassified")).alias("tier"))


def merge_scope_values(a: Column, b: Column, canonical: Sequence[str]) -> Column:
    """Union of two scope stamps (arrays); ``all`` absorbs, tiers in canonical order come first, then the rest by name."""
    place = lambda x: F.array_position(F.array(*[F.lit(c) for c in canonical]), x)
    both = F.array_union(F.coalesce(a, F.array().cast("array<string>")), F.coalesce(b, F.array().cast("array<string>")))
    ranked = F.array_sort(F.transform(both, lambda x: F.struct(F.when(place(x) == 0, 999).otherwise(place(x)).alias("k"), x.alias("x"))))
    return F.when(F.array_contains(both, "all"), F.array(F.lit("all"))).otherwise(F.transform(ranked, lambda s: s["x"]))


def restrict_vocabulary(entries: DataFrame, allowed: DataFrame, disabled: DataFrame, *, id: str = "id", key: str = "key") -> DataFrame:
    """Entries (id, key, ...) whose key is canonical and not switched off for that id."""
    kept = entries.join(broadcast_if_small(allowed.select(key).distinct()), key, "left_semi")
    return kept.join(disabled.select(id, key), [id, key], "left_anti")


def referral(value: Column) -> Column:
    """Referral of any JSON shape as (url, discount): a text is a url with discount 0, an object keeps its url, all else is null."""
    v = F.try_parse_json(value)
    kind = F.schema_of_variant(v)
    text = F.struct(F.try_variant_get(v, "$", "string").alias("url"), F.lit(0.0).alias("discount"))
    url, cut = F.try_variant_get(v, "$.url", "string"), F.try_variant_get(v, "$.discount", "double")
    return F.when(kind == "STRING", text).when(kind.startswith("OBJECT"), F.struct(url.alias("url"), F.coalesce(cut, F.lit(0.0)).alias("discount")))
