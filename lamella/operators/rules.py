"""Rule-based validation: rules as expressions, findings as rows, rollups, coverage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNDEFINED = "__undefined"


@dataclass(frozen=True)
class Rule:
    """A check of one row: ``broken`` is true for a finding, of kind ``error`` or ``warning``."""

    name: str
    level: str
    broken: Column


def row_findings(rows: DataFrame, rules: Sequence[Rule], *, keep: Sequence[str], skip: Rule | None = None) -> DataFrame:
    """(rule, level, *keep) for every rule a row breaks; where ``skip`` is broken only that one counts.

    All rules run in one pass over the rows, without a shuffle.
    """
    found = F.array_compact(F.array(*[F.when(r.broken, F.struct(F.lit(r.name).alias("rule"), F.lit(r.level).alias("level"))) for r in rules]))
    if skip is not None:
        found = F.when(skip.broken, F.array(F.struct(F.lit(skip.name).alias("rule"), F.lit(skip.level).alias("level")))).otherwise(found)
    return rows.select(F.explode(found).alias("f"), *keep).select("f.rule", "f.level", *keep)


def unset(column: Column) -> Column:
    """Null or the sentinel for undefined."""
    return column.isNull() | (column == UNDEFINED)


def market_rules() -> tuple[list[Rule], Rule]:
    """Structure and consistency of a market row; a market without symbol has that one warning."""
    c = F.col
    flag = lambda x: c(x).isin("true", "false", UNDEFINED)
    is_ = lambda x, v: F.coalesce(x == v, F.lit(False))
    rules = [Rule(f"required_{f}", "error", unset(c(f))) for f in ("id", "base", "quote")]
    rules += [Rule("soft_type", "warning", unset(c("market_type")))]
    rules += [Rule(f"boolean_{f}", "error", c(f).isNotNull() & ~flag(f)) for f in ("linear", "inverse")]
    rules += [Rule(f"map_{f}", "error", c(f).isNull()) for f in ("precisions", "limits")]
    rules += [
        Rule("contract_and_spot", "error", is_(c("contract"), True) & is_(c("market_type"), "spot")),
        Rule("type_without_contract", "error", is_(c("contract"), False) & c("market_type").isin("swap", "future", "option")),
        Rule("linear_without_contract", "error", is_(c("contract"), False) & is_(c("linear"), "true")),
        Rule("inverse_without_contract", "error", is_(c("contract"), False) & is_(c("inverse"), "true")),
    ]
    return rules, Rule("missing_symbol", "warning", F.coalesce(F.trim(c("symbol")), F.lit("")) == "")


def rollup(findings: DataFrame, rule_names: Sequence[str]) -> DataFrame:
    """Findings per rule, zero for rules without any."""
    every = findings.sparkSession.createDataFrame([(r,) for r in rule_names], "rule string")
    counts = findings.groupBy("rule").agg(F.count("*").alias("n"))
    return F.broadcast(every).join(counts, "rule", "left").select("rule", F.coalesce("n", F.lit(0)).alias("n"))


def subset_violations(child: DataFrame, parent: DataFrame, *, on: Sequence[str]) -> DataFrame:
    """Rows of ``child`` whose key ``parent`` lacks (null keys too): an invariant of inclusion."""
    return child.join(parent.select(*on).distinct(), list(on), "left_anti")


def undefined_density(rows: DataFrame, *, entity: str, fields: Sequence[str]) -> DataFrame:
    """Share of fields that are ``__undefined`` per entity, in percent with 1 digit."""
    hits = sum((F.when(F.col(f) == UNDEFINED, 1).otherwise(0) for f in fields), F.lit(0))
    agg = rows.groupBy(entity).agg((F.count("*") * len(fields)).alias("fields"), F.sum(hits).alias("undefined"))
    return agg.select(entity, "fields", "undefined", F.round(F.col("undefined") * 100.0 / F.col("fields"), 1).alias("pct"))


def coverage(presence: DataFrame, layers: Mapping[str, tuple[Column, Column, Column]], *, id: str) -> DataFrame:
    """Score of each entity over its applicable layers: (id, score, max, pct, gaps).

    A layer is (present, applicable, reason of a gap), three expressions of a row.
    Gaps read ``layer: reason`` and are sorted; without applicable layers pct is 0.
    """
    score = sum((F.when(a & p, 1).otherwise(0) for p, a, _ in layers.values()), F.lit(0)).cast("long")
    most = sum((F.when(a, 1).otherwise(0) for _, a, _ in layers.values()), F.lit(0)).cast("long")
    gaps = F.array_compact(F.array(*[F.when(a & ~p, F.concat(F.lit(f"{n}: "), r)) for n, (p, a, r) in layers.items()]))
    out = presence.select(id, score.alias("score"), most.alias("max"), F.array_join(F.array_sort(gaps), "; ").alias("gaps"))
    return out.select(id, "score", "max", F.when(F.col("max") > 0, F.round(F.col("score") * 100.0 / F.col("max"), 1)).otherwise(0.0).alias("pct"), "gaps")


def coverage_summary(scores: DataFrame) -> DataFrame:
    """Entities with full, partial and no coverage, and the mean of their (rounded) shares."""
    return scores.agg(
        F.count("*").alias("entities"), F.count(F.when(F.col("pct") == 100.0, 1)).alias("full"), F.count(F.when(F.col("pct") == 0.0, 1)).alias("none"),
        F.count(F.when((F.col("pct") > 0) & (F.col("pct") < 100), 1)).alias("partial"), F.coalesce(F.round(F.avg("pct"), 1), F.lit(0.0)).alias("mean_pct"),
    )


def layer_counts(presence: DataFrame, layers: Mapping[str, tuple[Column, Column, Column]]) -> DataFrame:
    """Per layer: entities that have it, those it applies to, and gaps: (layer, present, applicable, gaps)."""
    cells = F.explode(F.array(*[F.struct(F.lit(n).alias("layer"), p.alias("p"), a.alias("a")) for n, (p, a, _) in layers.items()]))
    return presence.select(cells.alias("c")).groupBy(F.col("c.layer").alias("layer")).agg(
        F.count(F.when(F.col("c.p"), 1)).alias("present"), F.count(F.when(F.col("c.a"), 1)).alias("applicable"), F.count(F.when(F.col("c.a") & ~F.col("c.p"), 1)).alias("gaps")
    )


def undefined_mean(density: DataFrame) -> DataFrame:
    """Mean of the entities' (rounded) shares, each entity alike."""
    return density.agg(F.count("*").alias("entities"), F.coalesce(F.round(F.avg("pct"), 1), F.lit(0.0)).alias("mean_pct"))
