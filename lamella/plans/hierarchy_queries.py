"""Problem 5: hierarchies of classes and of error classes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.operators import hierarchy as H
from lamella.plans.runtime import read_table


def class_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Nodes of both tables as (tree_no, node_key, parent_key, at)."""
    classes = read_table(spark, d, "class_hierarchy").select(F.lit(0).cast("long").alias("tree_no"), "node_key", "parent_key", F.col("extracted_at").alias("at"))
    errors = read_table(spark, d, "error_class_hierarchy").select("tree_no", F.explode("ancestors").alias("node_key", "chain"))
    first = errors.select("tree_no", "node_key", F.get("chain", 0).alias("parent_key"), F.lit(None).cast("timestamp_ntz").alias("at"))
    return classes.unionByName(first)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return H.hierarchy(class_nodes(spark, d))


def p5_descendants(spark: SparkSession, d: str) -> DataFrame:
    """Descendants of each node that has any: how many, and how far down."""
    return H.descendant_counts(class_nodes(spark, d))


def p5_pairs(spark: SparkSession, d: str) -> DataFrame:
    """All descendants of each node of both tables: (tree_no, ancestor, descendant, distance)."""
    return H.descendants(class_nodes(spark, d))


def p5_cycles(spark: SparkSession, d: str) -> DataFrame:
    """Per cycle its smallest key and the nodes that are on it or run into it."""
    return p5_found(spark, d).where("depth = -1").groupBy("tree_no", "root_key").agg(F.count("*").alias("nodes"))


NODES_SQL = r"""
raw AS (
  SELECT 0::BIGINT AS tree_no, node_key, parent_key, extracted_at AS ts FROM class_hierarchy
  UNION ALL
  SELECT tree_no, e.key, e.value[1], NULL FROM (SELECT tree_no, unnest(map_entries(ancestors)) AS e FROM error_class_hierarchy)),
last AS (
  SELECT tree_no, node_key, arg_max(struct_pack(p := regexp_replace(parent_key, '^\s+|\s+$', '', 'g')),
         (coalesce(ts, TIMESTAMP '1900-01-01'), coalesce(regexp_replace(parent_key, '^\s+|\s+$', '', 'g'), ''))).p AS parent
  FROM raw WHERE node_key IS NOT NULL GROUP BY ALL),
nodes AS (
  SELECT l.tree_no, l.node_key, k.node_key AS parent
  FROM last l LEFT JOIN last k ON k.tree_no = l.tree_no AND k.node_key = l.parent AND l.parent NOT IN ('', '__undefined')),
down AS (
  SELECT tree_no, node_key, node_key AS root_key, 0::BIGINT AS depth, node_key AS full_path FROM nodes WHERE parent IS NULL
  UNION ALL
  SELECT n.tree_no, n.node_key, root_key, depth + 1, full_path || '/' || n.node_key
  FROM down JOIN nodes n ON n.tree_no = down.tree_no AND n.parent = down.node_key)"""
FOUND_SQL = f"""
WITH RECURSIVE {NODES_SQL},
lost AS (SELECT * FROM nodes n ANTI JOIN down USING (tree_no, node_key)),
up AS (
  SELECT tree_no, node_key, parent AS here, [node_key] AS seen, false AS closed FROM lost
  UNION ALL
  SELECT u.tree_no, u.node_key, l.parent, list_append(seen, here), list_contains(seen, here)
  FROM up u JOIN lost l ON l.tree_no = u.tree_no AND l.node_key = u.here WHERE NOT closed)
SELECT * FROM down
UNION ALL
SELECT tree_no, node_key, list_min(seen[list_position(seen, seen[-1]):]), -1, '' FROM up WHERE closed"""

QUERIES = {"p5_found": p5_found, "p5_descendants": p5_descendants, "p5_pairs": p5_pairs, "p5_cycles": p5_cycles}
SQL = {
    "p5_found": FOUND_SQL,
    "p5_descendants": f"""
WITH RECURSIVE {NODES_SQL},
pairs AS (
  SELECT tree_no, parent AS node_key, node_key AS d, 1 AS distance FROM nodes SEMI JOIN down USING (tree_no, node_key) WHERE parent IS NOT NULL
  UNION ALL
  SELECT p.tree_no, n.parent, p.d, distance + 1 FROM pairs p JOIN nodes n ON n.tree_no = p.tree_no AND n.node_key = p.node_key WHERE n.parent IS NOT NULL)
SELECT tree_no, node_key, count(*) AS descendants, count(*) FILTER (distance = 1) AS children, max(distance)::BIGINT AS height FROM pairs GROUP BY ALL""",
    "p5_pairs": f"""
WITH RECURSIVE {NODES_SQL},
pairs AS (
  SELECT tree_no, parent AS ancestor, node_key AS descendant, 1::BIGINT AS distance FROM nodes SEMI JOIN down USING (tree_no, node_key) WHERE parent IS NOT NULL
  UNION ALL
  SELECT p.tree_no, n.parent, descendant, distance + 1 FROM pairs p JOIN nodes n ON n.tree_no = p.tree_no AND n.node_key = p.ancestor WHERE n.parent IS NOT NULL)
SELECT * FROM pairs""",
    "p5_cycles": f"SELECT tree_no, root_key, count(*) AS nodes FROM ({FOUND_SQL}) WHERE depth = -1 GROUP BY ALL",
}
