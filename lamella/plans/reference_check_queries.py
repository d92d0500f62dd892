"""Problem 4: discoveries that refer to exchanges no list has."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.operators import references as R
from lamella.plans.runtime import read_table


def listed_exchanges(spark: SparkSession, d: str) -> DataFrame:
    """One row per entry of an extraction; an extraction without entries keeps a row with a null id."""
    return read_table(spark, d, "exchanges").select("extracted_at", F.explode_outer("exchanges").alias("e")).select("extracted_at", F.col("e.id").alias("listed_id"))


def _misses(spark: SparkSession, d: str) -> DataFrame:
    return R.orphan_references(
        read_table(spark, d, "discoveries"), listed_exchanges(spark, d), ref_id="discovery_no", key="id", at="extracted_at",
        label="dataset", listed_key="listed_id", listed_at="extracted_at",
    )


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _misses(spark, d).select(F.col("ref_id").alias("discovery_no"), "reason")


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    return R.orphan_report(_misses(spark, d), read_table(spark, d, "discoveries"), key="id", at="extracted_at", label="dataset")


KEY_SQL = "nullif(lower(regexp_replace({0}, '^\\s+|\\s+$', '', 'g')), '')"
MISSES_SQL = f"""
WITH lists AS (SELECT DISTINCT extracted_at AS t FROM exchanges WHERE extracted_at IS NOT NULL),
listed AS (SELECT DISTINCT {KEY_SQL.format('e.id')} AS k, extracted_at AS t FROM (SELECT extracted_at, unnest(exchanges) AS e FROM exchanges)),
refs AS (SELECT DISTINCT discovery_no, dataset, extracted_at, {KEY_SQL.format('id')} AS k FROM discoveries),
placed AS (SELECT r.*, l.t AS f FROM refs r ASOF LEFT JOIN lists l ON r.extracted_at >= l.t WHERE k IS NOT NULL),
judged AS (
  SELECT p.*, EXISTS (SELECT 1 FROM listed x WHERE x.k = p.k AND x.t = p.f) AS ok, s.lo, s.hi
  FROM placed p LEFT JOIN (SELECT k, min(t) AS lo, max(t) AS hi FROM listed GROUP BY 1) s ON s.k = p.k)
SELECT discovery_no, dataset, extracted_at,
       CASE WHEN lo < f THEN 'deleted' WHEN hi > f OR (f IS NULL AND hi IS NOT NULL) THEN 'late' ELSE 'missing' END AS reason
FROM judged WHERE NOT ok"""

QUERIES = {"p4_found": p4_found, "p4_report": p4_report}
SQL = {
    "p4_found": f"SELECT discovery_no, reason FROM ({MISSES_SQL})",
    "p4_report": f"""
WITH m AS ({MISSES_SQL}),
t AS (SELECT dataset, strftime(extracted_at, '%Y-%m') AS period, count(*) AS refs FROM discoveries WHERE {KEY_SQL.format('id')} IS NOT NULL GROUP BY ALL)
SELECT t.dataset, t.period, refs, count(*) FILTER (reason = 'deleted') AS deleted, count(*) FILTER (reason = 'late') AS late,
       count(*) FILTER (reason = 'missing') AS missing
FROM t LEFT JOIN m ON m.dataset IS NOT DISTINCT FROM t.dataset AND strftime(m.extracted_at, '%Y-%m') IS NOT DISTINCT FROM t.period GROUP BY ALL""",
}
