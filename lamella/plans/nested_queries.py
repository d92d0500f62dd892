"""Problem 2: child tables of exchange_output and signing_fixture."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.operators.nested import Level, flatten_nested
from lamella.plans.runtime import read_table

LAYOUT = {
    "endpoints": (
        Level("endpoint", ("descriptors",), "map", (Level("param", ("signature", "params"), "list"), Level("error", ("errors",), "list"))),
    ),
    "auth": (Level("recipe", ("sign_recipe",), "map", (Level("step", ("steps",), "list"),)),),
    "websocket": (
        Level(None, ("subscribe", "channels"), "map", (Level("channel", (), "list"),)),
        Level("dispatch", ("dispatch", "entries"), "list"),
    ),
    "": (Level("case", ("cases",), "list", (Level("header", ("output", "headers"), "map", keep_null=True),)),),
}


def nested_groups(spark: SparkSession, d: str) -> DataFrame:
    """Groups of both tables as JSON texts; the typed cases are serialised and take the same way."""
    names = ("endpoints", "auth", "websocket")
    texts = F.explode(F.array(*[F.struct(F.lit(g).alias("group_name"), F.col(g).alias("group_text")) for g in names]))
    out = read_table(spark, d, "exchange_output").select(F.lit("exchange_output").alias("source_table"), "record_no", texts.alias("g")).select("source_table", "record_no", "g.*")
    cases = F.to_json(F.struct("cases"), {"ignoreNullFields": "false"})
    fixed = read_table(spark, d, "signing_fixture").select(
        F.lit("signing_fixture").alias("source_table"), F.col("fixture_no").alias("record_no"), F.lit("").alias("group_name"), cases.alias("group_text")
    )
    return out.unionByName(fixed)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return flatten_nested(nested_groups(spark, d), LAYOUT)


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    """Records and their parents per entity."""
    return p2_found(spark, d).groupBy("source_table", "entity").agg(
        F.count("*").alias("records"), F.countDistinct("record_no", "parent_path").alias("parents")
    )


# The same rows by the JSON functions of SQL; there a text inside a text is opened three times at most.
FOUND_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT record_no, unnest(['endpoints', 'auth', 'websocket']) AS g, unnest([endpoints, auth, websocket]) AS t FROM exchange_output),
opened AS (
  SELECT record_no, g, t::JSON AS j, 0 AS k FROM texts WHERE t IS NOT NULL AND json_valid(t)
  UNION ALL
  SELECT record_no, g, CASE WHEN json_type(j) = 'ARRAY' THEN j->0 ELSE (j->>'$')::JSON END, k + 1 FROM opened
  WHERE k < 6 AND ((json_type(j) = 'ARRAY' AND json_array_length(j) = 1) OR (json_type(j) = 'VARCHAR' AND json_valid(j->>'$')))),
groups AS (SELECT record_no, g, j FROM opened WHERE json_type(j) = 'OBJECT'),
maps AS (
  SELECT record_no, 'endpoint' AS entity, '/endpoints/descriptors' AS base, j->'descriptors' AS m FROM groups WHERE g = 'endpoints'
  UNION ALL SELECT record_no, 'recipe', '/auth/sign_recipe', j->'sign_recipe' FROM groups WHERE g = 'auth'
  UNION ALL SELECT record_no, 'method', '/websocket/subscribe/channels', j->'subscribe'->'channels' FROM groups WHERE g = 'websocket'),
named AS (
  SELECT record_no, entity, base || '/' || replace(replace(e.key, '~', '~0'), '/', '~1') AS path, e.value AS v
  FROM maps, json_each(maps.m) e WHERE json_type(m) = 'OBJECT' AND json_type(e.value) <> 'NULL' AND e.value::VARCHAR <> '"__undefined"'
  UNION ALL
  SELECT record_no, entity, base || '/' || replace(replace(e.value->>'name', '~', '~0'), '/', '~1'), e.value
  FROM maps, json_each(maps.m) e WHERE json_type(m) = 'ARRAY' AND json_type(e.value) <> 'NULL'),
lists AS (
  SELECT record_no, 'param' AS entity, path AS parent, path || '/signature/params' AS base, v->'signature'->'params' AS l FROM named WHERE entity = 'endpoint'
  UNION ALL SELECT record_no, 'error', path, path || '/errors', v->'errors' FROM named WHERE entity = 'endpoint'
  UNION ALL SELECT record_no, 'step', path, path || '/steps', v->'steps' FROM named WHERE entity = 'recipe'
  UNION ALL SELECT record_no, 'channel', path, path, v FROM named WHERE entity = 'method'
  UNION ALL SELECT record_no, 'dispatch', '', '/websocket/dispatch/entries', j->'dispatch'->'entries' FROM groups WHERE g = 'websocket'),
elements AS (
  SELECT record_no, entity, lists.parent, base || '/' || e.key AS path FROM lists, json_each(lists.l) e WHERE json_type(l) = 'ARRAY' AND json_type(e.value) <> 'NULL'
  UNION ALL SELECT record_no, entity, parent, base || '/0' FROM lists WHERE json_type(l) NOT IN ('ARRAY', 'NULL') AND l::VARCHAR <> '"__undefined"'),
cases AS (SELECT fixture_no AS record_no, unnest(cases) AS c, generate_subscripts(cases, 1) - 1 AS i FROM signing_fixture)
SELECT 'exchange_output' AS source_table, record_no, entity, '' AS parent_path, path AS record_path FROM named WHERE entity <> 'method'
UNION ALL SELECT 'exchange_output', record_no, entity, parent, path FROM elements
UNION ALL SELECT 'signing_fixture', record_no, 'case', '', '/cases/' || i FROM cases WHERE c IS NOT NULL
UNION ALL SELECT 'signing_fixture', record_no, 'header', '/cases/' || i, '/cases/' || i || '/output/headers/' || replace(replace(k, '~', '~0'), '/', '~1')
FROM (SELECT record_no, i, unnest(map_keys(c.output.headers)) AS k FROM cases WHERE c IS NOT NULL)"""

QUERIES = {"p2_found": p2_found, "p2_report": p2_report}
SQL = {
    "p2_found": FOUND_SQL,
    "p2_report": f"SELECT source_table, entity, count(*) AS records, count(DISTINCT (record_no, parent_path)) AS parents FROM ({FOUND_SQL}) GROUP BY ALL",
}
