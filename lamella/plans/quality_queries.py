"""Problem 3: quality profile of load_markets per exchange and load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.functions.strings import as_number
from lamella.operators import profile as P
from lamella.operators import snapshots as S
from lamella.plans.change_queries import LOADS_SQL, NUMBER_SQL
from lamella.plans.runtime import read_table

LOAD = ("exchange", "ccxt_version")
# Fixed values.
MARKET_TYPES = ("spot", "swap", "future", "option", "__undefined")
NUMBER = r"\A[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?\z"
ABOVE_ZERO = r"\A[0-9.]*[1-9]"
BASE = r"\A[A-Z0-9]{1,12}\z"
SHIFT = (203, 1000)
LEAST_ROWS = 30


def market_rules() -> dict:
    bad_step = lambda v: v.isNotNull() & ~(v.rlike(NUMBER) & v.rlike(ABOVE_ZERO))
    bad_range = lambda r: F.coalesce(r["min"] < 0, F.lit(False)) | F.coalesce(r["max"] < 0, F.lit(False)) | F.coalesce(r["min"] > r["max"], F.lit(False))
    return {
        "base": ~F.col("base").rlike(BASE),
        "market_type": ~F.col("market_type").isin(*MARKET_TYPES),
        "precisions": F.exists(F.map_values("precisions"), bad_step),
        "limits": F.exists(F.map_values("limits"), bad_range),
    }


def _loads(spark: SparkSession, d: str) -> DataFrame:
    return S.counting_snapshots(read_table(spark, d, "load_manifest"), read_table(spark, d, "ccxt_release"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    markets = read_table(spark, d, "load_markets")
    cells = P.cell_violations(markets, market_rules(), keep=["ccxt_version", "exchange", "row_no"])
    shifts = P.share_shifts(
        markets, _loads(spark, d), columns=markets.columns, by_value=["market_type"], threshold=SHIFT, least_rows=LEAST_ROWS
    )
    return cells.unionByName(shifts.withColumn("row_no", F.lit(0).cast("long")))


def p3_profile(spark: SparkSession, d: str) -> DataFrame:
    """A row per load and column, and one per load and key of the map columns with the range of its numbers.

    Of a key (``precisions.<key>``, ``limits.<key>.min``, ``.max``) ``n_rows`` counts entries and
    ``n_null`` those that hold no finite number; it has no distinct count and no violations of its own.
    """
    whole = P.column_profile(read_table(spark, d, "load_markets"), market_rules(), load=LOAD)
    none = lambda kind: F.lit(None).cast(kind)
    keys = p3_ranges(spark, d).select(
        *LOAD, F.col("feature").alias("column_name"), (F.col("n") + F.col("n_other")).alias("n_rows"), F.col("n_other").alias("n_null"),
        none("long").alias("n_distinct"), none("string").alias("least"), none("string").alias("greatest"), none("long").alias("n_violations"),
        F.col("least").alias("least_number"), F.col("greatest").alias("greatest_number"),
    )
    return whole.withColumns({"least_number": none("double"), "greatest_number": none("double")}).unionByName(keys)


def market_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Numbers of the map columns, one row each: (exchange, ccxt_version, feature, x)."""
    pair = lambda f, x: F.struct(f.alias("feature"), x.alias("x"))
    steps = F.transform(F.map_entries("precisions"), lambda e: pair(F.concat(F.lit("precisions."), e["key"]), as_number(e["value"])))
    lows = F.transform(F.map_entries("limits"), lambda e: pair(F.concat(F.lit("limits."), e["key"], F.lit(".min")), e["value"]["min"]))
    highs = F.transform(F.map_entries("limits"), lambda e: pair(F.concat(F.lit("limits."), e["key"], F.lit(".max")), e["value"]["max"]))
    none = F.array().cast("array<struct<feature:string,x:double>>")
    every = F.concat(*[F.coalesce(a, none) for a in (steps, lows, highs)])
    return read_table(spark, d, "load_markets").select(*LOAD, F.explode(every).alias("s")).select(*LOAD, "s.feature", "s.x")


def p3_shifts(spark: SparkSession, d: str) -> DataFrame:
    by = [*LOAD, "feature"]
    stats = P.moments(P.power_sums(market_numbers(spark, d), by=by, value="x"), by=by)
    full = P.standardised_shifts(stats, _loads(spark, d))
    return full.select("exchange", "ccxt_version", "feature", "n", F.round("mean", 3).alias("mean"), F.round("shift", 3).alias("shift"))


BAD_SQL = f"""
  (base IS NOT NULL AND NOT regexp_full_match(base, '[A-Z0-9]{{1,12}}')) AS base_bad,
  (market_type IS NOT NULL AND market_type NOT IN {MARKET_TYPES}) AS type_bad,
  (precisions IS NOT NULL AND len(list_filter(map_values(precisions), lambda v: v IS NOT NULL AND NOT (
     regexp_full_match(v, '[0-9]+([.][0-9]+)?([eE][+-]?[0-9]+)?') AND regexp_matches(v, '^[0-9.]*[1-9]')))) > 0) AS precisions_bad,
  (limits IS NOT NULL AND len(list_filter(map_values(limits), lambda r: coalesce(r.min < 0, false) OR coalesce(r.max < 0, false)
     OR coalesce(r.min > r.max, false))) > 0) AS limits_bad"""
COLUMNS = (
    "row_no", "ccxt_version", "exchange", "symbol", "id", "base", "quote", "settle", "market_type", "active", "contract",
    "linear", "inverse", "precisions", "limits", "loaded_at",
)
MAP_TEXT = "CASE WHEN {0} IS NOT NULL THEN list_sort(map_entries({0}))::VARCHAR END"
VALUES = {c: f"{c}::VARCHAR" for c in COLUMNS} | {c: MAP_TEXT.format(c) for c in ("precisions", "limits")}
BAD_OF = {"base": "base_bad", "market_type": "type_bad", "precisions": "precisions_bad", "limits": "limits_bad"}

FOUND_SQL = f"""
WITH {LOADS_SQL},
marked AS (SELECT row_no, ccxt_version, exchange, {BAD_SQL} FROM load_markets),
cells AS ({" UNION ALL ".join(f"SELECT '{c}' AS column_name, ccxt_version, exchange, row_no FROM marked WHERE {b}" for c, b in BAD_OF.items())}),
delivered AS (SELECT m.*, l.seq FROM load_markets m JOIN loads l ON m.exchange = l.exchange AND m.ccxt_version = l.ccxt_version),
sizes AS (SELECT exchange, seq, count(*) AS n FROM delivered GROUP BY ALL),
counts AS (
  {" UNION ALL ".join(f"SELECT exchange, seq, '{c}' AS column_name, NULL::VARCHAR AS value, count(*) FILTER ({c} IS NULL) AS n FROM delivered GROUP BY 1, 2" for c in COLUMNS)}
  UNION ALL SELECT exchange, seq, 'market_type', market_type, count(*) FROM delivered WHERE market_type IS NOT NULL GROUP BY ALL),
pairs AS (SELECT a.exchange, a.seq, a.n AS n1, b.n AS n0 FROM sizes a JOIN sizes b ON a.exchange = b.exchange AND a.seq = b.seq + 1 WHERE a.n >= {LEAST_ROWS} AND b.n >= {LEAST_ROWS}),
asked AS (SELECT exchange, seq, column_name, value FROM counts UNION SELECT exchange, seq + 1, column_name, value FROM counts),
moved AS (
  SELECT DISTINCT q.column_name, q.exchange, q.seq
  FROM asked q JOIN pairs p USING (exchange, seq)
  LEFT JOIN counts a ON a.exchange = q.exchange AND a.seq = q.seq AND a.column_name = q.column_name AND a.value IS NOT DISTINCT FROM q.value
  LEFT JOIN counts b ON b.exchange = q.exchange AND b.seq = q.seq - 1 AND b.column_name = q.column_name AND b.value IS NOT DISTINCT FROM q.value
  WHERE abs(coalesce(a.n, 0)::HUGEINT * n0 - coalesce(b.n, 0)::HUGEINT * n1) * {SHIFT[1]} > {SHIFT[0]} * n0::HUGEINT * n1)
SELECT * FROM cells UNION ALL
SELECT m.column_name, l.ccxt_version, m.exchange, 0::BIGINT FROM moved m JOIN loads l USING (exchange, seq)"""

SHIFTS_SQL = f"""
WITH {LOADS_SQL},
numbers AS (
  SELECT exchange, ccxt_version, unnest(list_concat(list_concat(
    [struct_pack(f := 'precisions.' || e.key, x := {NUMBER_SQL.format('e.value')}) FOR e IN coalesce(map_entries(precisions), [])],
    [struct_pack(f := 'limits.' || e.key || '.min', x := e.value.min) FOR e IN coalesce(map_entries(limits), [])]),
    [struct_pack(f := 'limits.' || e.key || '.max', x := e.value.max) FOR e IN coalesce(map_entries(limits), [])])) AS s
  FROM load_markets),
stats AS (
  SELECT exchange, ccxt_version, s.f AS feature, count(*) AS n, favg(s.x) AS mean, var_pop(s.x) AS variance
  FROM numbers WHERE isfinite(s.x) GROUP BY ALL),
placed AS (SELECT t.*, l.seq FROM stats t JOIN loads l USING (exchange, ccxt_version))
SELECT a.exchange, a.ccxt_version, a.feature, a.n, round(a.mean, 3) AS mean,
       round(CASE WHEN abs(a.mean - b.mean) <= 1e-14 * abs(a.mean) THEN 0 WHEN a.variance + b.variance > 0 THEN (a.mean - b.mean) / sqrt((a.variance + b.variance) / 2) END, 3) AS shift
FROM placed a LEFT JOIN placed b ON a.exchange = b.exchange AND a.feature = b.feature AND a.seq = b.seq + 1"""

def p3_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Range of the numbers below each key of the map columns, per load.

    ``n`` counts finite numbers, ``n_other`` entries that are null, no number or
    not finite; a feature with none of the first has a null range.
    """
    x = F.col("x")
    ok = x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return market_numbers(spark, d).groupBy(*LOAD, "feature").agg(
        F.count(F.when(ok, 1)).alias("n"), F.count(F.when(~ok, 1)).alias("n_other"),
        F.min(F.when(ok, x)).alias("least"), F.max(F.when(ok, x)).alias("greatest"),
    )


RANGES_SQL = f"""
WITH numbers AS (
  SELECT exchange, ccxt_version, unnest(list_concat(list_concat(
    [struct_pack(f := 'precisions.' || e.key, x := {NUMBER_SQL.format('e.value')}) FOR e IN coalesce(map_entries(precisions), [])],
    [struct_pack(f := 'limits.' || e.key || '.min', x := e.value.min) FOR e IN coalesce(map_entries(limits), [])]),
    [struct_pack(f := 'limits.' || e.key || '.max', x := e.value.max) FOR e IN coalesce(map_entries(limits), [])])) AS s
  FROM load_markets)
SELECT exchange, ccxt_version, s.f AS feature, count(*) FILTER (isfinite(s.x)) AS n, count(*) FILTER (NOT coalesce(isfinite(s.x), false)) AS n_other,
       min(s.x) FILTER (isfinite(s.x)) AS least, max(s.x) FILTER (isfinite(s.x)) AS greatest
FROM numbers GROUP BY ALL"""

_TEXT = [c for c in COLUMNS if c not in ("precisions", "limits")]
PROFILE_SQL = f"""
WITH marked AS (SELECT *, {BAD_SQL} FROM load_markets)
{" UNION ALL ".join(
    f"SELECT exchange, ccxt_version, '{c}' AS column_name, count(*) AS n_rows, count(*) FILTER ({c} IS NULL) AS n_null, "
    f"count(DISTINCT {VALUES[c]}) AS n_distinct, {f'min({c})::VARCHAR' if c in _TEXT else 'NULL'} AS least, "
    f"{f'max({c})::VARCHAR' if c in _TEXT else 'NULL'} AS greatest, "
    f"{f'count(*) FILTER ({BAD_OF[c]})' if c in BAD_OF else '0'} AS n_violations, NULL::DOUBLE AS least_number, NULL::DOUBLE AS greatest_number FROM marked GROUP BY exchange, ccxt_version"
    for c in COLUMNS if c not in LOAD)}
UNION ALL SELECT exchange, ccxt_version, feature, n + n_other, n_other, NULL, NULL, NULL, NULL, least, greatest FROM ({RANGES_SQL})"""

QUERIES = {"p3_found": p3_found, "p3_profile": p3_profile, "p3_shifts": p3_shifts, "p3_ranges": p3_ranges}
SQL = {"p3_found": FOUND_SQL, "p3_profile": PROFILE_SQL, "p3_shifts": SHIFTS_SQL, "p3_ranges": RANGES_SQL}
