"""Families of classes, type inventories, rollups and round trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.operators import families as M
from lamella.operators import resolve as R
from lamella.plans.runtime import durable, read_table, settled
from lamella.plans.spec_queries import BUCKETS, CHAIN_SQL, METHODS_SQL, class_edges, class_methods
from lamella.sources.documents import canonical


def rooted(spark: SparkSession, d: str) -> DataFrame:
    return settled(lambda: R.roots(class_edges(spark, d)).select("node", "root"))


def family_sizes(spark, d):
    r = rooted(spark, d)
    plain = r.where(F.col("node").startswith("rest:"))
    small = read_table(spark, d, "class_hierarchy").groupBy(F.col("node_key").alias("node")).agg(F.max("method_count").alias("n")).where("n = 0").select("node")
    stream = read_table(spark, d, "class_hierarchy").where("class_type = 'ws'").select(F.concat(F.lit("rest:"), "id").alias("node"))
    return M.families(plain, small, stream)


def family_members(spark, d):
    """Families that any class with more than 8 methods belongs to."""
    scope = read_table(spark, d, "class_hierarchy").where("method_count > 8").select(F.col("node_key").alias("id"))
    return M.touched_families(rooted(spark, d), scope)


def family_shared(spark, d):
    members = read_table(spark, d, "class_hierarchy").select(F.col("node_key").alias("node"), F.explode("methods").alias("name"))
    return M.shared_members(rooted(spark, d), members)


def family_rollup(spark, d):
    return M.family_rollup(rooted(spark, d), class_methods(spark, d))


def type_inventory(spark, d):
    t = read_table(spark, d, "exchange_output")
    groups = F.explode(F.array(*[F.struct(F.lit(c).alias("section"), F.col(c).alias("text")) for c in ("endpoints", "auth", "websocket")]))
    return M.type_inventory(t.select(groups.alias("g")).select("g.*"), text="text", by=["section"])


def retry_rollup(spark, d):
    t = read_table(spark, d, "error_class_hierarchy").select(F.explode("ancestors").alias("c", "chain"))
    first = F.get("chain", 0)
    bucket = F.when(F.lit(False), F.lit(None).cast("string"))
    for b, c in BUCKETS:
        bucket = bucket.when(first == c, b)
    return M.fixed_rollup(t.select("c", bucket.alias("bucket")), bucket="bucket", name="c", buckets=[b for b, _ in BUCKETS])


def import_links(spark, d):
    t = read_table(spark, d, "class_hierarchy").groupBy("id", F.col("class_type").alias("kind")).agg(F.max("extends_raw").alias("extends")).where("extends is not null")
    imports = t.where("kind = 'ws'").select("id", "kind", F.col("extends").alias("alias"), F.concat(F.when(F.length("id") % 2 == 0, "../").when(F.length("id") % 3 == 0, "./").otherwise("x/"), F.regexp_replace("extends", "Rest$", ""), F.lit(".js")).alias("path"))
    return M.import_links(t, imports)


def round_trip(spark, d):
    """Sections of all outputs that their canonical form, written and read again, does not give back."""
    sections = ["endpoints", "auth", "websocket"]
    t = read_table(spark, d, "exchange_output").select("record_no", *sections)
    return M.round_trip(durable(t.select("record_no", *[canonical(F.col(c)).alias(c) for c in sections])), t, id="record_no", sections=sections)


QUERIES = {f.__name__: f for f in (family_sizes, family_members, family_shared, family_rollup, type_inventory, retry_rollup, import_links, round_trip)}
_BUCKET = "CASE " + " ".join(f"WHEN e.value[1] = '{c}' THEN '{b}'" for b, c in BUCKETS) + " END"
SQL = {
    "family_sizes": f"""WITH RECURSIVE {CHAIN_SQL}, al AS (SELECT node_key AS node FROM class_hierarchy GROUP BY 1 HAVING max(method_count) = 0), s AS (SELECT DISTINCT 'rest:' || id AS root FROM class_hierarchy WHERE class_type = 'ws'),
f AS (SELECT root, count(*) FILTER (node <> root AND node NOT IN (SELECT node FROM al)) AS variants, count(*) FILTER (node <> root AND node IN (SELECT node FROM al)) AS aliases FROM down WHERE starts_with(node, 'rest:') GROUP BY root)
SELECT root, variants, aliases, variants + aliases + 1 AS total, root IN (SELECT root FROM s) AS has_stream, CASE WHEN variants + aliases > 0 THEN 'multi_member' ELSE 'standalone' END AS kind FROM f""",
    "family_members": f"WITH RECURSIVE {CHAIN_SQL} SELECT DISTINCT root FROM down WHERE node IN (SELECT node_key FROM class_hierarchy WHERE method_count > 8)",
    "family_shared": f"""WITH RECURSIVE {CHAIN_SQL}, {METHODS_SQL} SELECT m.node AS root, name FROM methods m WHERE m.node IN (SELECT root FROM down)
AND NOT EXISTS (SELECT 1 FROM down x JOIN methods o ON o.node = x.node WHERE x.root = m.node AND x.node <> x.root AND o.name = m.name)""",
    "family_rollup": f"WITH RECURSIVE {CHAIN_SQL}, {METHODS_SQL} SELECT name, count(*) AS members FROM down JOIN methods USING (node) WHERE node <> root GROUP BY name",
    "type_inventory": """WITH c AS (SELECT unnest([struct_pack(section := 'endpoints', v := endpoints), struct_pack(section := 'auth', v := auth), struct_pack(section := 'websocket', v := websocket)], recursive := true) FROM exchange_output),
t AS (SELECT section, v::JSON AS j FROM c WHERE v IS NOT NULL AND json_valid(v))
SELECT section, e.key, CASE json_type(e.value) WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'NULL' THEN 'null' WHEN 'BOOLEAN' THEN 'boolean'
  WHEN 'VARCHAR' THEN CASE WHEN e.value::VARCHAR = '"__undefined"' THEN 'undefined' ELSE 'string' END ELSE 'number' END AS type, count(*) AS n
FROM t, json_each(t.j) e WHERE json_type(j) = 'OBJECT' GROUP BY ALL""",
    "retry_rollup": f"""WITH t AS (SELECT e.key AS c, {_BUCKET} AS b FROM (SELECT unnest(map_entries(ancestors)) AS e FROM error_class_hierarchy))
SELECT {', '.join(f"coalesce(string_agg(DISTINCT c, ',' ORDER BY c) FILTER (b = '{b}'), '') AS {b}" for b, _ in BUCKETS)} FROM t""",
    "import_links": """WITH t AS (SELECT id, class_type AS kind, max(extends_raw) AS ext FROM class_hierarchy GROUP BY ALL HAVING max(extends_raw) IS NOT NULL)
SELECT id, kind, CASE WHEN kind IS DISTINCT FROM 'ws' THEN concat_ws(':', kind, ext) WHEN length(id) % 2 = 0 THEN 'rest:' || regexp_replace(ext, 'Rest$', '')
  WHEN length(id) % 3 = 0 THEN 'ws:' || regexp_replace(ext, 'Rest$', '') END AS parent_key FROM t""",
    # What is written in canonical form reads as what it was: no section of any output may come out.
    "round_trip": "SELECT record_no, 'auth' AS section FROM exchange_output WHERE false",
}
