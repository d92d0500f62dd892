"""Problem 1: changes between the consecutive loads of an exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.operators import snapshots as S
from lamella.plans.runtime import read_table

MARKET_FIELDS = ("id", "base", "quote", "settle", "market_type", "active")


def market_intervals(spark: SparkSession, d: str) -> DataFrame:
    loads = S.counting_snapshots(read_table(spark, d, "load_manifest"), read_table(spark, d, "ccxt_release"))
    compared = [F.col(c) for c in MARKET_FIELDS] + [S.canonical_number_map(F.col("precisions")), S.canonical_map(F.col("limits"))]
    return S.validity_intervals(read_table(spark, d, "load_markets"), loads, compared=compared)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return S.change_events(market_intervals(spark, d))


def p1_intervals(spark: SparkSession, d: str) -> DataFrame:
    return market_intervals(spark, d)


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    """Events per load and kind."""
    return p1_found(spark, d).groupBy("exchange", "ccxt_version", "change_kind").agg(F.count("*").alias("n"))


LOADS_SQL = """
last_try AS (
  SELECT exchange, ccxt_version, max_by(status, (finished_at, status)) AS status
  FROM load_manifest WHERE exchange IS NOT NULL AND ccxt_version IS NOT NULL GROUP BY ALL),
loads AS (
  SELECT exchange, ccxt_version, row_number() OVER w AS seq, lag(ccxt_version) OVER w AS prev_version,
         lead(ccxt_version) OVER w AS next_version
  FROM last_try JOIN (SELECT ccxt_version, min(released_at) AS released_at FROM ccxt_release GROUP BY 1) USING (ccxt_version)
  WHERE status = 'succeeded'
  WINDOW w AS (PARTITION BY exchange ORDER BY released_at, ccxt_version))"""

NUMBER_SQL = r"""CASE WHEN regexp_full_match({0}, '\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*') THEN TRY_CAST(trim({0}) AS DOUBLE) END"""
HELD_SQL = LOADS_SQL + f""",
held AS (
  SELECT m.exchange, trim(symbol, ' ') AS symbol, seq, m.ccxt_version, next_version,
         arg_max(struct_pack(a := id, b := base, c := quote, d := settle, e := market_type, f := active,
           g := CASE WHEN precisions IS NOT NULL THEN list_sort([
             struct_pack(k := e.key, n := {NUMBER_SQL.format('e.value')}, t := CASE WHEN {NUMBER_SQL.format('e.value')} IS NULL THEN e.value END)
             FOR e IN map_entries(precisions) IF e.value IS NOT NULL])::VARCHAR END,
           h := list_sort(map_entries(limits))::VARCHAR)::VARCHAR, (loaded_at, row_no)) AS content
  FROM load_markets m JOIN loads l ON m.exchange = l.exchange AND m.ccxt_version = l.ccxt_version
  WHERE symbol IS NOT NULL AND trim(symbol, ' ') NOT IN ('', '__undefined')
  GROUP BY ALL)"""

FOUND_SQL = f"""
WITH {HELD_SQL},
pairs AS (
  SELECT l.ccxt_version, l.exchange, coalesce(n.symbol, o.symbol) AS symbol, n.content AS new, o.content AS old,
         n.symbol IS NOT NULL AS has_new, o.symbol IS NOT NULL AS has_old
  FROM (SELECT * FROM held) n FULL JOIN (SELECT *, seq + 1 AS next_seq FROM held) o
    ON n.exchange = o.exchange AND n.symbol = o.symbol AND n.seq = o.next_seq
  JOIN loads l ON l.exchange = coalesce(n.exchange, o.exchange) AND l.seq = coalesce(n.seq, o.next_seq)
  WHERE l.seq > 1)
SELECT ccxt_version, exchange, symbol,
       CASE WHEN NOT has_old THEN 'added' WHEN NOT has_new THEN 'removed' ELSE 'changed' END AS change_kind
FROM pairs WHERE NOT has_old OR NOT has_new OR new <> old"""

INTERVALS_SQL = f"""
WITH {HELD_SQL},
marked AS (
  SELECT *, CASE WHEN lag(seq) OVER w = seq - 1 AND lag(content) OVER w = content THEN 0 ELSE 1 END AS fresh
  FROM held WINDOW w AS (PARTITION BY exchange, symbol ORDER BY seq)),
islands AS (SELECT *, sum(fresh) OVER (PARTITION BY exchange, symbol ORDER BY seq) AS island FROM marked)
SELECT exchange, symbol, CAST(min(seq) AS INTEGER) AS from_seq, CAST(max(seq) AS INTEGER) AS to_seq,
       arg_min(ccxt_version, seq) AS from_version, arg_max_null(next_version, seq) AS gone_version
FROM islands GROUP BY exchange, symbol, island"""

QUERIES = {"p1_found": p1_found, "p1_intervals": p1_intervals, "p1_report": p1_report}
SQL = {
    "p1_found": FOUND_SQL,
    "p1_intervals": INTERVALS_SQL,
    "p1_report": f"SELECT exchange, ccxt_version, change_kind, count(*) AS n FROM ({FOUND_SQL}) GROUP BY ALL",
}
