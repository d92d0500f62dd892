"""What changed between full snapshots, by gaps and islands over key and row hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamella.functions.strings import as_number
from lamella.plans.runtime import broadcast_if_small, durable


def counting_snapshots(
    attempts: DataFrame,
    order: DataFrame,
    *,
    scope: str = "exchange",
    version: str = "ccxt_version",
    status: str = "status",
    finished: str = "finished_at",
    success: str = "succeeded",
    released: str = "released_at",
) -> DataFrame:
    """Snapshots that count, numbered 1, 2, ... per scope in release order.

    Of several attempts at one (scope, version) the one with the latest
    ``finished`` decides; of equally late ones the greater status. A null
    ``finished`` is earliest. Attempts without scope or version, and versions
    that ``order`` does not list, do not count. Columns out: scope, version,
    ``seq``, ``prev_version``, ``next_version`` (null at the ends).
    """
    last = (
        attempts.where(F.col(scope).isNotNull() & F.col(version).isNotNull())
        .groupBy(scope, version)
        .agg(F.max(F.struct(F.col(finished).alias("at"), F.col(status).alias("status"))).alias("last"))
        .where(F.col("last.status") == success)
    )
    when = order.groupBy(version).agg(F.min(released).alias("__released"))
    w = Window.partitionBy(scope).orderBy("__released", version)
    return last.join(when, version).select(
        scope,
        version,
        F.row_number().over(w).alias("seq"),
        F.lag(version).over(w).alias("prev_version"),
        F.lead(version).over(w).alias("next_version"),
    )


def canonical_number_map(column: Column) -> Column:
    """A map<string,string> as sorted entries; null values are absent, numbers of equal value alike.

    Texts that read as a number (surrounding spaces aside) compare as doubles,
    all others as given. A null map stays null and differs from an empty one.
    """
    entry = lambda e: F.struct(
        e["key"].alias("k"),
        as_number(e["value"]).alias("n"),
        F.when(as_number(e["value"]).isNull(), e["value"]).alias("t"),
    )
    kept = F.filter(F.map_entries(column), lambda e: e["value"].isNotNull())
    return F.array_sort(F.transform(kept, entry))


def canonical_map(column: Column) -> Column:
    """A map as entries sorted by key; a null map stays null."""
    return F.array_sort(F.map_entries(column))


def row_hash(columns: Sequence[Column]) -> list[Column]:
    """Two independent 64-bit hashes of the values; null, absent and empty all differ."""
    text = F.to_json(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(columns)]), {"ignoreNullFields": "false"})
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("second"), text).alias("h2")]


def validity_intervals(
    rows: DataFrame,
    snapshots: DataFrame,
    *,
    compared: Sequence[Column],
    scope: str = "exchange",
    version: str = "ccxt_version",
    key: str = "symbol",
    latest: Sequence[str] = ("loaded_at", "row_no"),
    no_key: Sequence[str] = ("", "__undefined"),
) -> DataFrame:
    """Intervals of consecutive snapshots in which a key kept the same content.

    Keys are trimmed of spaces; rows with a null key or one of ``no_key`` are
    left out. In a snapshot the row that is greatest by ``latest`` holds (nulls
    lowest, further ties by content hash), so repeated rows do no harm. Columns
    out: scope, key, ``from_seq``, ``to_seq``, ``from_version`` and
    ``gone_version``, the snapshot after ``to_seq`` (null after the last one).

    The shuffle carries keys and hashes only. A key's rows are reduced before
    it, so its windows hold at most one row per snapshot however often it was
    delivered.
    """
    slim = (
        rows.select(scope, version, F.trim(F.col(key)).alias(key), *[F.col(c).alias(f"__o{i}") for i, c in enumerate(latest)], *row_hash(compared))
        .where(F.col(key).isNotNull() & ~F.col(key).isin(*no_key))
    )
    small = broadcast_if_small(durable(snapshots.select(scope, version, "seq", "next_version")))
    held = (
        slim.join(small, [scope, version])
        .groupBy(scope, key, "seq")
        .agg(F.max(F.struct(*[f"__o{i}" for i in range(len(latest))], "h1", "h2", version, "next_version")).alias("r"))
        .select(scope, key, "seq", "r.h1", "r.h2", F.col(f"r.{version}").alias("v"), F.col("r.next_version").alias("nv"))
    )
    w = Window.partitionBy(scope, key).orderBy("seq")
    starts = (
        (F.lag("seq").over(w) == F.col("seq") - 1) & (F.lag("h1").over(w) == F.col("h1")) & (F.lag("h2").over(w) == F.col("h2"))
    )
    islands = held.withColumn("__new", F.when(starts, 0).otherwise(1)).withColumn("__island", F.sum("__new").over(w))
    return islands.groupBy(scope, key, "__island").agg(
        F.min("seq").alias("from_seq"),
        F.max("seq").alias("to_seq"),
        F.min_by("v", "seq").alias("from_version"),
        F.max_by("nv", "seq").alias("gone_version"),
    ).drop("__island")


def change_events(intervals: DataFrame, *, scope: str = "exchange", key: str = "symbol") -> DataFrame:
    """Events from validity intervals: (version, scope, key, change_kind).

    An interval that starts where the one before ended is ``changed``, another
    start after the scope's first snapshot is ``added``, an end that nothing
    adjoins and that a snapshot follows is ``removed`` in that snapshot.
    """
    w = Window.partitionBy(scope, key).orderBy("from_seq")
    adjoins = F.coalesce(F.lag("to_seq").over(w) == F.col("from_seq") - 1, F.lit(False))
    followed = F.coalesce(F.lead("from_seq").over(w) == F.col("to_seq") + 1, F.lit(False))
    start = F.when(
        F.col("from_seq") > 1,
        F.struct(F.col("from_version").alias("v"), F.when(F.col("__adjoins"), "changed").otherwise("added").alias("k")),
    )
    end = F.when(
        ~F.col("__followed") & F.col("gone_version").isNotNull(),
        F.struct(F.col("gone_version").alias("v"), F.lit("removed").alias("k")),
    )
    return (
        intervals.withColumns({"__adjoins": adjoins, "__followed": followed})
        .select(scope, key, F.explode(F.array_compact(F.array(start, end))).alias("e"))
        .select(F.col("e.v").alias("ccxt_version"), scope, key, F.col("e.k").alias("change_kind"))
    )
