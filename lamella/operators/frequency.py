"""Frequencies, tiers, distributions and dominant values over (entity, name) rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """100 * part / whole, rounded half up; 0 where the whole is 0."""
    return F.when(whole > 0, F.round(part * 100.0 / whole, digits)).otherwise(0.0)


def key_frequency(rows: DataFrame, *, entity: str, key: str, kind: str, total: DataFrame | None = None) -> DataFrame:
    """Per key: entities that have it, share of all entities, histogram of value kinds as ``kind:n`` text.

    Null keys are left out. ``total`` gives the entities (one row each) that count
    as all, by default those with a key or without. Two aggregates on the key; the
    total is counted first, by a job of its own.
    """
    n = (total if total is not None else rows.select(entity).distinct()).count()
    each = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key"), F.col(kind).alias("kind")).agg(F.count("*").alias("n"))
    part = F.concat_ws(":", F.coalesce(F.col("kind").cast("string"), F.lit("null")), F.col("n").cast("string"))
    keys = each.groupBy("key").agg(F.sum("n").alias("count"), F.array_join(F.array_sort(F.collect_list(part)), ",").alias("kinds"))
    return keys.withColumn("total", F.lit(n).cast("long")).select("key", "count", percent(F.col("count"), F.col("total")).alias("pct"), "kinds", "total")


def tier(count: Column, total: Column) -> Column:
    """universal (all), common (> 90 %), frequent (> 50 %), uncommon (5 or more), rare; rare without entities."""
    return (
        F.when(total == 0, "rare").when(count == total, "universal").when(count > 0.9 * total, "common")
        .when(count > 0.5 * total, "frequent").when(count >= 5, "uncommon").otherwise("rare")
    )


def tier_members(frequencies: DataFrame) -> DataFrame:
    """Keys of each tier: how many, and their names in order."""
    named = frequencies.withColumn("tier", tier(F.col("count"), F.col("total")))
    return named.groupBy("tier").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("key")), ",").alias("keys"))


def name_family(name: Column, known: Sequence[str]) -> Column:
    """Lower-case beginning of a camel-case name if it is a known one (a bare known word too), else ``other``."""
    head = F.regexp_extract(name, "^([a-z]+)[A-Z]", 1)
    return F.when(head.isin(*known), head).when(name.isin(*known), name).otherwise("other")


def occurrence_counts(rows: DataFrame, *, name: str, entity: str) -> DataFrame:
    """Occurrences of each name (repeats within an entity count) and entities that have it."""
    return rows.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("name")).agg(
        F.count("*").alias("occurrences"), F.countDistinct(entity).alias("entities")
    )


def family_stats(rows: DataFrame, *, name: str, known: Sequence[str]) -> DataFrame:
    """Per family: occurrences, their share of all, distinct names, and the names by falling count, then name."""
    each = rows.where(F.col(name).isNotNull()).groupBy(name_family(F.col(name), known).alias("family"), F.col(name).alias("name")).agg(F.count("*").alias("n"))
    order = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), F.col("name"))))
    total = F.lit(rows.where(F.col(name).isNotNull()).count())
    return each.groupBy("family").agg(
        F.sum("n").alias("occurrences"), percent(F.sum("n"), total).alias("pct"), F.count("*").alias("names"), F.array_join(F.transform(order, lambda x: x["name"]), ",").alias("members")
    )


def spread_sets(rows: DataFrame, *, name: str, entity: str) -> DataFrame:
    """Names that all entities, just one, or fewer than five have (rare includes unique): (name, set)."""
    pairs = rows.where(F.col(name).isNotNull()).select(F.col(entity).alias("e"), F.col(name).alias("name")).distinct()
    total = rows.select(entity).distinct().count()
    n = pairs.groupBy("name").agg(F.count("*").alias("n")).withColumn("total", F.lit(total).cast("long"))
    marks = F.array_compact(F.array(
        F.when(F.col("n") == F.col("total"), F.lit("universal")), F.when(F.col("n") == 1, F.lit("unique")), F.when(F.col("n") < 5, F.lit("rare"))
    ))
    return n.select("name", "n", F.explode(marks).alias("set"))


def size_distribution(sizes: DataFrame, *, size: str, by: Sequence[str] = ()) -> DataFrame:
    """min, max, mean (1 digit) and nearest-rank p25, median, p75; zeros for an empty input without ``by``."""
    rank = lambda p: F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY `{size}`)")
    whole = lambda c: F.coalesce(c.cast("long"), F.lit(0).cast("long"))
    out = sizes.where(F.col(size).isNotNull()).groupBy(*by).agg(
        F.count("*").alias("n"), whole(F.min(size)).alias("min"), whole(F.max(size)).alias("max"), whole(rank(0.25)).alias("p25"),
        whole(rank(0.5)).alias("median"), whole(rank(0.75)).alias("p75"), F.coalesce(F.round(F.avg(size), 1), F.lit(0.0)).alias("mean"),
    )
    return out


def cross_sets(left: DataFrame, right: DataFrame, *, name: str) -> DataFrame:
    """Each distinct name with where it occurs: shared, left_only or right_only. One shuffle of names."""
    both = left.select(name, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(right.select(name, F.lit(0).alias("l"), F.lit(1).alias("r")))
    seen = both.where(F.col(name).isNotNull()).groupBy(name).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return seen.select(name, F.when(F.col("l") + F.col("r") == 2, "shared").when(F.col("l") == 1, "left_only").otherwise("right_only").alias("side"))


def flag_patterns(flags: DataFrame, *, entity: str, flag: str, on: str) -> DataFrame:
    """Entities grouped by the sorted set of flags that are on; without any the pattern is empty."""
    sets = flags.groupBy(entity).agg(F.array_join(F.array_sort(F.collect_set(F.when(F.col(on), F.col(flag)))), ",").alias("pattern"))
    return sets.groupBy("pattern").agg(F.count("*").alias("entities"))


def dominant_value(rows: DataFrame, *, by: Sequence[str], value: str, threshold: float = 0.8) -> DataFrame:
    """Most frequent non-null value per group, if its share of all rows (nulls too) reaches the threshold, else null.

    Ties take the least value. Values are counted before groups are formed, so a
    group's rows never meet in one task.
    """
    each = rows.groupBy(*by, F.col(value).alias("v")).agg(F.count("*").alias("n"))
    best = each.groupBy(*by).agg(
        F.sum("n").alias("total"), F.min(F.when(F.col("v").isNotNull(), F.struct((-F.col("n")).alias("k"), F.col("v")))).alias("b")
    )
    share = -F.col("b.k") / F.col("total")
    return best.select(*by, "total", F.when(share >= threshold, F.col("b.v")).alias("dominant"), F.round(F.coalesce(share, F.lit(0.0)), 4).alias("share"))


def anomalies(rows: DataFrame, dominants: DataFrame, *, by: Sequence[str], value: str) -> DataFrame:
    """Rows whose value differs (null counts as different) from their group's dominant one, where there is one."""
    d = dominants.where(F.col("dominant").isNotNull()).select(*by, "dominant")
    return rows.join(d, list(by)).where(~F.col(value).eqNullSafe(F.col("dominant")))


def top_rows(rows: DataFrame, *, by: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group by ``order``, numbered; ``k`` is the report's length."""
    w = Window.partitionBy(*by).orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def trait_anomalies(rows: DataFrame, *, by: Sequence[str], traits: Sequence[str], id: str, threshold: float = 0.8) -> DataFrame:
    """Rows that differ from their group in traits that dominate it: (id, *by, traits as sorted text).

    A trait without a dominant value in the group tells nothing; a null trait differs from a dominant one.
    Dominants are a row per group and trait.
    """
    long = rows.select(id, *by, F.explode(F.array(*[F.struct(F.lit(t).alias("trait"), F.col(t).cast("string").alias("value")) for t in traits])).alias("t")).select(id, *by, "t.*")
    best = dominant_value(long, by=[*by, "trait"], value="value", threshold=threshold)
    odd = anomalies(long, best, by=[*by, "trait"], value="value")
    return odd.groupBy(id, *by).agg(F.array_join(F.array_sort(F.collect_set("trait")), ",").alias("traits"))
