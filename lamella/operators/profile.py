"""Column-level data quality profile per load: nulls, distincts, ranges, violations, shifts between loads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamella.plans.runtime import broadcast_if_small, durable


def value_text(column: str, kind: T.DataType) -> Column:
    """Value of any type as one comparable text; a map's entries are sorted by key."""
    c = F.col(column)
    if isinstance(kind, T.MapType):
        return F.to_json(F.array_sort(F.map_entries(c)), {"ignoreNullFields": "false"})
    if isinstance(kind, (T.ArrayType, T.StructType, T.VariantType)):
        return F.to_json(c, {"ignoreNullFields": "false"})
    return c.cast("string")


def cell_violations(rows: DataFrame, rules: Mapping[str, Column], *, keep: Sequence[str]) -> DataFrame:
    """One row per cell that is not null and breaks its column's rule: (column_name, *keep).

    A rule is a boolean expression, true for a violation; null counts as none.
    A narrow scan and an explode, no shuffle.
    """
    broken = F.array_compact(F.array(*[F.when(F.col(c).isNotNull() & rule, F.lit(c)) for c, rule in rules.items()]))
    return rows.select(F.explode(broken).alias("column_name"), *keep)


def share_counts(
    rows: DataFrame, *, load: Sequence[str], columns: Sequence[str], by_value: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Counts per load: (load, n) and the long form (load, column_name, value, n).

    Of every column the nulls are counted (``value`` null), of those in
    ``by_value`` each value too. One pass over the rows, combined before the
    shuffle, so a hot load or value is a few rows when it moves.
    """
    nulls = [F.count(F.when(F.col(c).isNull(), 1)).alias(f"__n{i}") for i, c in enumerate(columns)]
    part = durable(rows.groupBy(*load, *[F.col(c).alias(f"__v{i}") for i, c in enumerate(by_value)]).agg(F.count("*").alias("__all"), *nulls))
    total = part.groupBy(*load).agg(F.sum("__all").alias("n"))
    null_part = part.groupBy(*load).agg(*[F.sum(f"__n{i}").alias(f"__n{i}") for i in range(len(columns))])
    stacked = null_part.select(
        *load, F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"__n{i}").alias("n")) for i, c in enumerate(columns)])).alias("s")
    ).select(*load, F.col("s.c").alias("column_name"), F.lit(None).cast("string").alias("value"), F.col("s.n").alias("n"))
    valued = [
        part.where(F.col(f"__v{i}").isNotNull())
        .groupBy(*load, F.col(f"__v{i}").cast("string").alias("value"))
        .agg(F.sum("__all").alias("n"))
        .select(*load, F.lit(c).alias("column_name"), "value", "n")
        for i, c in enumerate(by_value)
    ]
    return total, reduce(DataFrame.unionByName, valued, stacked)


def share_shifts(
    rows: DataFrame,
    snapshots: DataFrame,
    *,
    columns: Sequence[str],
    by_value: Sequence[str],
    threshold: tuple[int, int],
    least_rows: int,
    scope: str = "exchange",
    version: str = "ccxt_version",
) -> DataFrame:
    """Columns whose share of nulls (or of any one value) moved against the snapshot before: (column_name, version, scope).

    ``threshold`` is a fraction (numerator, denominator); shares compare in whole
    numbers, so equality is exact. Both snapshots need ``least_rows`` rows. A
    value that one of the two lacks has the share 0 there. A count is paired with
    the snapshot after it by moving it there, not by a self-join.
    """
    total, counts = share_counts(rows, load=[scope, version], columns=columns, by_value=by_value)
    small = broadcast_if_small(durable(snapshots.select(scope, version, "seq", "prev_version", "next_version")))
    sizes = durable(total.join(small, [scope, version]).select(scope, "seq", version, "n"))
    before = sizes.select(scope, (F.col("seq") + 1).alias("seq"), F.col("n").alias("n0"))
    pairs = sizes.withColumnRenamed("n", "n1").join(before, [scope, "seq"]).where((F.col("n1") >= least_rows) & (F.col("n0") >= least_rows))
    placed = counts.join(small, [scope, version]).select(scope, "seq", "column_name", "value", "n")
    moved = placed.select(
        scope, "column_name", "value",
        F.explode(
            F.array(
                F.struct(F.col("seq"), F.col("n").alias("c1"), F.lit(0).cast("long").alias("c0")),
                F.struct((F.col("seq") + 1).alias("seq"), F.lit(0).cast("long").alias("c1"), F.col("n").alias("c0")),
            )
        ).alias("s"),
    ).select(scope, "column_name", "value", "s.*")
    both = moved.groupBy(scope, "column_name", "value", "seq").agg(F.sum("c1").alias("c1"), F.sum("c0").alias("c0"))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    gap = F.abs(wide("c1") * wide("n0") - wide("c0") * wide("n1"))
    up, down = threshold
    return (
        both.join(pairs, [scope, "seq"])
        .where(gap.cast("double") > 0)
        .where(gap * F.lit(down).cast("decimal(9,0)").cast("decimal(5,0)") > wide("n0") * wide("n1") * F.lit(up).cast("decimal(5,0)"))
        .select("column_name", version, scope)
        .distinct()
    )


def column_profile(rows: DataFrame, rules: Mapping[str, Column], *, load: Sequence[str]) -> DataFrame:
    """Per load and column: rows, nulls, distinct values, least and greatest value (as text), violations.

    Counts and ranges merge, so they come from one pass that combines before it
    moves: a load of any size is a row for each task. Only distinct counts need the
    values; of each value a 64-bit hash moves, with one of its load and column, once
    for each task that has it (two of a load's values are taken for one with a chance of
    about n**2 / 2**65). Least and greatest are in the order of the column's type for
    numbers, times and booleans, in byte order for texts, and null for maps, lists and
    structs. The load's own columns are not profiled.
    """
    kinds = {f.name: f.dataType for f in rows.schema.fields if f.name not in load}
    names = list(kinds)
    nested = (T.MapType, T.ArrayType, T.StructType, T.VariantType)
    group = lambda i: F.xxhash64(F.lit(names[i]), *load)

    measures = [F.count("*").alias("__n")]
    for i, (c, k) in enumerate(kinds.items()):
        measures.append(F.count(c).alias(f"__k{i}"))
        measures.append(F.count(F.when(F.col(c).isNotNull() & rules[c], 1)).alias(f"__b{i}") if c in rules else F.lit(0).cast("long").alias(f"__b{i}"))
        if not isinstance(k, nested):
            measures += [F.min(c).alias(f"__lo{i}"), F.max(c).alias(f"__hi{i}")]
    wide = rows.groupBy(*load).agg(*measures)
    text = lambda p, i, k: F.lit(None).cast("string") if isinstance(k, nested) else F.col(f"__{p}{i}").cast("string")
    long = wide.select(*load, F.explode(F.array(*[
        F.struct(
            F.lit(c).alias("column_name"), F.col("__n").alias("n_rows"), (F.col("__n") - F.col(f"__k{i}")).alias("n_null"),
            text("lo", i, k).alias("least"), text("hi", i, k).alias("greatest"), F.col(f"__b{i}").alias("n_violations"), group(i).alias("__g"),
        )
        for i, (c, k) in enumerate(kinds.items())
    ])).alias("s")).select(*load, "s.*")

    hashes = F.array(*[F.when(F.col(c).isNotNull(), F.struct(group(i).alias("__g"), F.xxhash64(value_text(c, k)).alias("h"))) for i, (c, k) in enumerate(kinds.items())])
    values = rows.select(F.explode(hashes).alias("v")).where("v is not null").select("v.*").distinct()
    counts = values.groupBy("__g").agg(F.count("*").alias("n_distinct"))
    return long.join(counts, "__g", "left").select(
        *load, "column_name", "n_rows", "n_null", F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"), "least", "greatest", "n_violations"
    )


def power_sums(values: DataFrame, *, by: Sequence[str], value: str) -> DataFrame:
    """Exact, mergeable sums of x and x squared: whole mantissas summed per binary exponent.

    A finite double is m * 2**(k-53) with a whole m below 2**55; m is split into
    28 and 27 bits, so that sums of the parts' products stay exact in decimals.
    Partial results of any split of the rows add up to the same state. Columns
    out: ``by``, ``k``, ``n``, ``m`` and the parts ``hh``, ``hl``, ``ll`` of the
    sum of squares. Nulls, NaN and infinities are left out.
    """
    x = F.col("__x")
    finite = values.select(*by, F.col(value).cast("double").alias("__x")).where(x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    k = F.when(x == 0, 0).otherwise(F.floor(F.log2(F.abs(x)))).cast("int")
    up = F.lit(53) - F.col("k")
    half = F.floor(up / 2)
    scaled = finite.withColumn("k", k).withColumn("m", (x * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), up - half)).cast("long"))
    h, low = F.shiftright("m", 27), F.col("m").bitwiseAND(F.lit(2**27 - 1))
    split = scaled.select(*by, "k", h.alias("h"), low.alias("l"))
    products = split.select(*by, "k", "h", "l", (F.col("h") * F.col("h")).alias("hh"), (F.col("h") * F.col("l")).alias("hl"), (F.col("l") * F.col("l")).alias("ll"))
    # Sums of whole parts of at most 29 bits: exact in 64 bits for 2**34 rows of a group, an error beyond.
    parts = [F.sum("h").alias("sh"), F.sum("l").alias("sl")]
    for c in ("hh", "hl", "ll"):
        parts += [F.sum(F.shiftright(c, 28)).alias(f"{c}1"), F.sum(F.col(c).bitwiseAND(F.lit(2**28 - 1))).alias(f"{c}0")]
    whole = lambda c: F.col(c).cast("decimal(20,0)").cast("decimal(38,0)")
    joined = lambda high, lower, bits: (whole(high) * F.lit(2**bits).cast("decimal(10,0)") + whole(lower)).cast("decimal(38,0)")
    return products.groupBy(*by, "k").agg(F.count("*").alias("n"), *parts).select(
        *by, "k", "n", joined("sh", "sl", 27).alias("m"), *[joined(f"{c}1", f"{c}0", 28).alias(c) for c in ("hh", "hl", "ll")]
    )


def moments(sums: DataFrame, *, by: Sequence[str]) -> DataFrame:
    """``n``, mean and population variance from exact power sums; one rounding, in a fixed order of exponents."""
    part = F.struct(
        F.col("k"),
        (F.col("m").cast("double") * F.pow(F.lit(2.0), F.col("k") - 53)).alias("s1"),
        (
            (F.col("hh").cast("double") * float(2**54) + F.col("hl").cast("double") * float(2**28) + F.col("ll").cast("double"))
            * F.pow(F.lit(2.0), (F.col("k") - 53) * 2)
        ).alias("s2"),
    )
    total = lambda f: F.aggregate(F.array_sort("__p"), F.lit(0.0), lambda a, p: a + p[f])
    folded = sums.groupBy(*by).agg(F.sum("n").alias("n"), F.collect_list(part).alias("__p"))
    return folded.select(*by, "n", (total("s1") / F.col("n")).alias("mean"), total("s2").alias("__s2")).select(
        *by, "n", "mean", F.greatest(F.lit(0.0), F.col("__s2") / F.col("n") - F.col("mean") * F.col("mean")).alias("variance")
    )


def standardised_shifts(stats: DataFrame, snapshots: DataFrame, *, feature: str = "feature", scope: str = "exchange", version: str = "ccxt_version") -> DataFrame:
    """Difference of means against the snapshot before, in pooled standard deviations.

    Null where the snapshot before lacks the feature; 0 for equal means, and null
    for different ones, where both variances are 0.
    """
    small = broadcast_if_small(durable(snapshots.select(scope, version, "seq")))
    now = durable(stats.join(small, [scope, version]))  # a row per snapshot and feature, read twice
    then = now.select(scope, feature, (F.col("seq") + 1).alias("seq"), F.col("mean").alias("mean0"), F.col("variance").alias("variance0"))
    pooled = F.sqrt((F.col("variance") + F.col("variance0")) / 2)
    gap = F.col("mean") - F.col("mean0")
    shift = F.when(gap == 0, 0.0).when(pooled > 0, gap / pooled)
    return now.join(then, [scope, feature, "seq"], "left").select(scope, version, feature, "n", "mean", "variance", shift.alias("shift"))
