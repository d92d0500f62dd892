"""Contracts of the per-exchange outputs: required keys, a schema, invariants, drift between loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.operators import contracts as C
from lamella.plans import spec_queries as Q
from lamella.plans.change_queries import LOADS_SQL
from lamella.plans.runtime import durable, read_table

# Keys that groups must have, and vocabularies.
REQUIRED = {
    "endpoints": ("unified", "descriptors", "interfaces", "pagination"),
    "auth": ("sign_recipe", "sign_method", "authenticated_sections", "headers"),
    "websocket": ("heartbeat", "auth", "subscribe", "dispatch"),
}
PING_KINDS = ("native_frame", "string_message", "json_message", "unknown", "none")
MECHANISMS = ("sign_in_message", "url_param", "header", "unknown", "none")
WEBSOCKET_SCHEMA = {
    "type": "object",
    "required": ["heartbeat", "subscribe"],
    "properties": {
        "heartbeat": {"$ref": "#/$defs/Heartbeat"},
        "auth": {"oneOf": [{"type": "null"}, {"type": "object", "required": ["mechanism"], "properties": {"mechanism": {"enum": list(MECHANISMS)}}}]},
        "subscribe": {"type": ["object", "null"], "required": ["mechanism"], "properties": {"discriminant": {"type": ["string", "null"], "pattern": "^(op|method)$", "minLength": 1}}},
    },
    "$defs": {
        "Heartbeat": {"type": "object", "required": ["ping_kind", "keep_alive_ms"], "properties": {"ping_kind": {"enum": [k for k in PING_KINDS if k != "none"]}, "keep_alive_ms": {"type": ["integer", "null"], "minimum": 20000}}},
    },
}


def required_keys(spark, d):
    """Row 154 over all outputs."""
    t = read_table(spark, d, "exchange_output").select("record_no", *REQUIRED)
    return C.missing_keys(t, REQUIRED, id="record_no").select("record_no", "position", "group", "key")


def websocket_schema(spark, d):
    """Row 155: failures of the websocket group against a schema."""
    return C.schema_failures(read_table(spark, d, "exchange_output"), WEBSOCKET_SCHEMA, id="record_no", text="websocket")


def output_documents(spark: SparkSession, d: str) -> DataFrame:
    """(id, e, a, w): the groups of each output as values; null where unreadable or no object."""
    group = lambda c: F.when(C.is_object(F.try_parse_json(c)), F.try_parse_json(c))
    return read_table(spark, d, "exchange_output").select(F.col("record_no").alias("id"), group("endpoints").alias("e"), group("auth").alias("a"), group("websocket").alias("w"))


def _text(v: str, path: str):
    return C.at(F.col(v), path, "string")


def _keys(v: str, path: str):
    return lambda docs: C.keys_of(docs, v, path)


def _sections(docs: DataFrame) -> DataFrame:
    return docs.select("id", F.explode(C.at(F.col("a"), "$.authenticated_sections", "array<string>")).alias("key")).where("key is not null")


def _element_rows(docs: DataFrame, v: str, path: str) -> DataFrame:
    """(id, pos, value) of the list below a path."""
    held = docs.select("id", C.at(F.col(v), path, "array<variant>").alias("l")).where("l is not null")
    return held.select("id", F.posexplode("l").alias("pos", "value"))


def _bad_names(docs: DataFrame) -> DataFrame:
    k = C.keys_of(docs, "e", "$.descriptors").where(C.is_object(F.col("value")))
    name = C.at(F.col("value"), "$.name", "string")
    return k.where(~name.eqNullSafe(F.col("key"))).select("id", F.concat(F.lit("/endpoints/descriptors/"), "key").alias("path"), F.lit("name differs from key").alias("message"))


def _bad_recipes(docs: DataFrame) -> DataFrame:
    k = C.keys_of(docs, "a", "$.sign_recipe")
    steps = F.coalesce(F.schema_of_variant(C.at(F.col("value"), "$.steps")).startswith("ARRAY"), F.lit(False))
    return k.where(~steps).select("id", F.concat(F.lit("/auth/sign_recipe/"), "key").alias("path"), F.lit("no list of steps").alias("message"))


def _bad_handlers(docs: DataFrame) -> DataFrame:
    rows = _element_rows(docs, "w", "$.dispatch.entries").where(C.is_object(F.col("value")))
    handler = F.coalesce(C.at(F.col("value"), "$.handler", "string"), F.lit(""))
    return rows.where(~handler.rlike("^handle[A-Z]")).select("id", F.concat(F.lit("/websocket/dispatch/entries/"), "pos").alias("path"), F.lit("no handler").alias("message"))


def _uncovered_errors(known: DataFrame):
    def check(docs: DataFrame) -> DataFrame:
        k = C.keys_of(docs, "e", "$.descriptors").select("id", "key", C.at(F.col("value"), "$.errors").alias("errors"))
        listed = k.select("id", "key", F.explode(C.at(F.col("errors"), "$", "array<variant>")).alias("value"))
        bare = k.where(C.is_object(F.col("errors"))).select("id", "key", F.col("errors").alias("value"))
        named = listed.unionByName(bare).select("id", "key", C.at(F.col("value"), "$.class", "string").alias("class")).where("class is not null").distinct()
        return named.join(known, "class", "left_anti").select("id", F.concat(F.lit("/endpoints/descriptors/"), "key", F.lit("/errors")).alias("path"), F.col("class").alias("message"))

    return check


def invariants(spark: SparkSession, d: str) -> dict[str, C.Check]:
    """The registry: inclusions, implications, vocabularies and shapes of the groups (row 168)."""
    known = durable(read_table(spark, d, "error_class_hierarchy").select(F.explode(F.map_keys("ancestors")).alias("class")).distinct())
    ping, alive = _text("w", "$.heartbeat.ping_kind"), _text("w", "$.heartbeat.keep_alive_ms")
    entries = F.size(F.coalesce(C.at(F.col("w"), "$.dispatch.entries", "array<variant>"), F.array().cast("array<variant>")))
    return {
        "unified_in_descriptors": C.key_set_difference(_keys("e", "$.unified"), _keys("e", "$.descriptors"), "/endpoints/unified/", "no descriptor"),
        "descriptor_names": _bad_names,
        "sections_have_recipes": C.key_set_difference(_sections, _keys("a", "$.sign_recipe"), "/auth/authenticated_sections/", "no recipe"),
        "recipes_have_sections": C.key_set_difference(_keys("a", "$.sign_recipe"), _sections, "/auth/sign_recipe/", "no section"),
        "recipe_shape": _bad_recipes,
        "heartbeat_kinds": C.where(~ping.isin(*PING_KINDS), "/websocket/heartbeat/ping_kind", "unknown kind"),
        "heartbeat_coherence": C.where((ping == "none") & alive.isNotNull(), "/websocket/heartbeat/keep_alive_ms", "interval without ping"),
        "sign_in_mechanisms": C.where(~_text("w", "$.auth.mechanism").isin(*MECHANISMS), "/websocket/auth/mechanism", "unknown mechanism"),
        "subscribe_discriminant": C.where((_text("w", "$.subscribe.mechanism") == "json_message") & _text("w", "$.subscribe.discriminant").isNull(), "/websocket/subscribe/discriminant", "message without discriminant"),
        "dispatch_entries": C.where((_text("w", "$.dispatch.kind") == "routed") & (entries == 0), "/websocket/dispatch/entries", "routed without entries"),
        "dispatch_handlers": _bad_handlers,
        "subscribe_none_dispatch_none": C.where((_text("w", "$.subscribe.mechanism") == "none") & (_text("w", "$.dispatch.kind") != "none"), "/websocket/dispatch/kind", "dispatch without subscribe"),
        "error_classes_covered": _uncovered_errors(known),
    }


def _allowed(spark: SparkSession) -> DataFrame:
    """Accepted: a sign-in by listen key is known by another name."""
    return spark.createDataFrame([("sign_in_mechanisms", "/websocket/auth/mechanism")], "invariant string, path string")


def contract_findings(spark, d):
    """All findings of all invariants over all outputs, before the allow-list (row 168)."""
    return C.run_invariants(durable(output_documents(spark, d)), invariants(spark, d)).withColumnRenamed("id", "record_no")


def contract_report(spark, d):
    """Findings per invariant after the allow-list, with the outputs they are in."""
    found = C.run_invariants(durable(output_documents(spark, d)), invariants(spark, d), allowed=_allowed(spark))
    return found.groupBy("invariant").agg(F.count("*").alias("findings"), F.countDistinct("id").alias("documents"))


def drift_report(spark, d):
    """Row 165: drift of each counting load against the exchange's load before; a first load has no baseline."""
    loads = durable(Q.consecutive_loads(spark, d).select(F.concat_ws("|", "exchange", "ccxt_version").alias("id"), "prev_version"))
    keyed = lambda q: q(spark, d).select(F.concat_ws("|", "exchange", "ccxt_version").alias("id"))
    out = C.drift_report({"stale_override": keyed(Q.drift_stale), "flipped_derived": keyed(Q.drift_flipped), "new_raw": keyed(Q.drift_new)}, loads.select("id"), loads.where("prev_version is not null").select("id"))
    return out


QUERIES = {f.__name__: f for f in (required_keys, websocket_schema, contract_findings, contract_report, drift_report)}
_DOCS = "x AS (SELECT record_no AS id, " + ", ".join(f"CASE WHEN json_valid({c}) AND json_type({c}) = 'OBJECT' THEN {c}::JSON END AS {a}" for c, a in (("endpoints", "e"), ("auth", "a"), ("websocket", "w"))) + " FROM exchange_output)"
_EACH = lambda v, path: f"(SELECT x.id, j.key, j.value FROM (SELECT * FROM x WHERE json_type({v}, '{path}') = 'OBJECT') x, json_each(x.{v}, '{path}') j)"
_SECTIONS = "(SELECT id, unnest(TRY_CAST(a->'$.authenticated_sections' AS VARCHAR[])) AS key FROM x WHERE json_type(a, '$.authenticated_sections') = 'ARRAY')"
_LACKS = lambda left, right, path, message, name: f"SELECT id, '{name}' AS invariant, '{path}' || key AS path, '{message}' AS message FROM (SELECT DISTINCT id, key FROM {left} l WHERE key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {right} r WHERE r.id = l.id AND r.key = l.key))"
_IN = lambda values: "('" + "', '".join(values) + "')"
_ONE = lambda cond, path, message, name: f"SELECT id, '{name}', '{path}', '{message}' FROM x WHERE {cond}"
FINDINGS_SQL = f"""
SELECT * FROM ({" UNION ALL ".join([
    _LACKS(_EACH('e', '$.unified'), _EACH('e', '$.descriptors'), '/endpoints/unified/', 'no descriptor', 'unified_in_descriptors'),
    f"SELECT id, 'descriptor_names', '/endpoints/descriptors/' || key, 'name differs from key' FROM {_EACH('e', '$.descriptors')} WHERE json_type(value) = 'OBJECT' AND (value->>'$.name') IS DISTINCT FROM key",
    _LACKS(_SECTIONS, _EACH('a', '$.sign_recipe'), '/auth/authenticated_sections/', 'no recipe', 'sections_have_recipes'),
    _LACKS(_EACH('a', '$.sign_recipe'), _SECTIONS, '/auth/sign_recipe/', 'no section', 'recipes_have_sections'),
    f"SELECT id, 'recipe_shape', '/auth/sign_recipe/' || key, 'no list of steps' FROM {_EACH('a', '$.sign_recipe')} WHERE coalesce(json_type(value, '$.steps'), '') <> 'ARRAY'",
    _ONE(f"(w->>'$.heartbeat.ping_kind') NOT IN {_IN(PING_KINDS)}", '/websocket/heartbeat/ping_kind', 'unknown kind', 'heartbeat_kinds'),
    _ONE("(w->>'$.heartbeat.ping_kind') = 'none' AND (w->>'$.heartbeat.keep_alive_ms') IS NOT NULL", '/websocket/heartbeat/keep_alive_ms', 'interval without ping', 'heartbeat_coherence'),
    _ONE(f"(w->>'$.auth.mechanism') NOT IN {_IN(MECHANISMS)}", '/websocket/auth/mechanism', 'unknown mechanism', 'sign_in_mechanisms'),
    _ONE("(w->>'$.subscribe.mechanism') = 'json_message' AND (w->>'$.subscribe.discriminant') IS NULL", '/websocket/subscribe/discriminant', 'message without discriminant', 'subscribe_discriminant'),
    _ONE("(w->>'$.dispatch.kind') = 'routed' AND (coalesce(json_type(w, '$.dispatch.entries'), '') <> 'ARRAY' OR json_array_length(w, '$.dispatch.entries') = 0)", '/websocket/dispatch/entries', 'routed without entries', 'dispatch_entries'),
    "SELECT id, 'dispatch_handlers', '/websocket/dispatch/entries/' || (i - 1), 'no handler' FROM (SELECT id, unnest(w->'$.dispatch.entries[*]') AS v, generate_subscripts(w->'$.dispatch.entries[*]', 1) AS i FROM x WHERE json_type(w, '$.dispatch.entries') = 'ARRAY') WHERE json_type(v) = 'OBJECT' AND NOT regexp_matches(coalesce(v->>'$.handler', ''), '^handle[A-Z]')",
    _ONE("(w->>'$.subscribe.mechanism') = 'none' AND (w->>'$.dispatch.kind') <> 'none'", '/websocket/dispatch/kind', 'dispatch without subscribe', 'subscribe_none_dispatch_none'),
    f"SELECT DISTINCT id, 'error_classes_covered', '/endpoints/descriptors/' || key || '/errors', c FROM (SELECT id, key, v->>'$.class' AS c FROM (SELECT id, key, unnest(CASE json_type(value, '$.errors') WHEN 'ARRAY' THEN value->'$.errors[*]' WHEN 'OBJECT' THEN [value->'$.errors'] ELSE [] END) AS v FROM {_EACH('e', '$.descriptors')})) WHERE c IS NOT NULL AND c NOT IN (SELECT unnest(map_keys(ancestors)) FROM error_class_hierarchy)",
])})"""
_WS = "x AS (SELECT record_no, websocket::JSON AS w, json_valid(websocket) AS ok FROM exchange_output WHERE websocket IS NOT NULL)"
SQL = {
    "required_keys": " UNION ALL ".join(
        f"SELECT record_no, {sum(len(k) for g, k in list(REQUIRED.items())[:i])} AS position, '{g}' AS \"group\", NULL AS key FROM exchange_output WHERE {g} IS NULL OR NOT json_valid({g}) OR json_type({g}) <> 'OBJECT'"
        + "".join(f" UNION ALL SELECT record_no, {sum(len(k) for g2, k in list(REQUIRED.items())[:i]) + n + 1}, '{g}', '{key}' FROM exchange_output WHERE json_valid({g}) AND json_type({g}) = 'OBJECT' AND NOT list_contains(json_keys({g}), '{key}')" for n, key in enumerate(keys))
        for i, (g, keys) in enumerate(REQUIRED.items())
    ),
    "websocket_schema": """WITH r AS (SELECT record_no, websocket AS t, json_valid(websocket) AS ok FROM exchange_output WHERE websocket IS NOT NULL),
o AS (SELECT record_no, TRY_CAST(t AS JSON) AS w FROM r WHERE ok), b AS (SELECT * FROM o WHERE json_type(w) = 'OBJECT'),
h AS (SELECT record_no, w->'$.heartbeat' AS h FROM b WHERE list_contains(json_keys(w), 'heartbeat')), s AS (SELECT record_no, w->'$.subscribe' AS s FROM b WHERE list_contains(json_keys(w), 'subscribe')),
ho AS (SELECT * FROM h WHERE json_type(h) = 'OBJECT'), so AS (SELECT * FROM s WHERE json_type(s) = 'OBJECT'), a AS (SELECT record_no, w->'$.auth' AS a FROM b WHERE list_contains(json_keys(w), 'auth'))
SELECT record_no, '' AS path, 'unreadable' AS keyword FROM r WHERE NOT ok
UNION ALL SELECT record_no, '', 'type' FROM o WHERE json_type(w) <> 'OBJECT'
UNION ALL SELECT record_no, '/heartbeat', 'required' FROM b WHERE NOT list_contains(json_keys(w), 'heartbeat')
UNION ALL SELECT record_no, '/subscribe', 'required' FROM b WHERE NOT list_contains(json_keys(w), 'subscribe')
UNION ALL SELECT record_no, '/heartbeat', 'type' FROM h WHERE json_type(h) <> 'OBJECT'
UNION ALL SELECT record_no, '/heartbeat/ping_kind', 'required' FROM ho WHERE NOT list_contains(json_keys(h), 'ping_kind')
UNION ALL SELECT record_no, '/heartbeat/keep_alive_ms', 'required' FROM ho WHERE NOT list_contains(json_keys(h), 'keep_alive_ms')
UNION ALL SELECT record_no, '/heartbeat/ping_kind', 'enum' FROM ho WHERE list_contains(json_keys(h), 'ping_kind') AND (json_type(h, '$.ping_kind') <> 'VARCHAR' OR (h->>'$.ping_kind') NOT IN ('native_frame', 'string_message', 'json_message', 'unknown'))
UNION ALL SELECT record_no, '/heartbeat/keep_alive_ms', 'type' FROM ho WHERE list_contains(json_keys(h), 'keep_alive_ms') AND json_type(h, '$.keep_alive_ms') NOT IN ('NULL', 'UBIGINT', 'BIGINT')
UNION ALL SELECT record_no, '/heartbeat/keep_alive_ms', 'minimum' FROM ho WHERE json_type(h, '$.keep_alive_ms') IN ('UBIGINT', 'BIGINT') AND (h->>'$.keep_alive_ms')::BIGINT < 20000
UNION ALL SELECT record_no, '/auth', 'oneOf' FROM a WHERE NOT (json_type(a) = 'NULL' OR (json_type(a) = 'OBJECT' AND json_type(a, '$.mechanism') = 'VARCHAR' AND (a->>'$.mechanism') IN ('sign_in_message', 'url_param', 'header', 'unknown', 'none')))
UNION ALL SELECT record_no, '/subscribe', 'type' FROM s WHERE json_type(s) NOT IN ('OBJECT', 'NULL')
UNION ALL SELECT record_no, '/subscribe/mechanism', 'required' FROM so WHERE NOT list_contains(json_keys(s), 'mechanism')
UNION ALL SELECT record_no, '/subscribe/discriminant', 'type' FROM so WHERE list_contains(json_keys(s), 'discriminant') AND json_type(s, '$.discriminant') NOT IN ('VARCHAR', 'NULL')
UNION ALL SELECT record_no, '/subscribe/discriminant', 'minLength' FROM so WHERE json_type(s, '$.discriminant') = 'VARCHAR' AND (s->>'$.discriminant') = ''
UNION ALL SELECT record_no, '/subscribe/discriminant', 'pattern' FROM so WHERE json_type(s, '$.discriminant') = 'VARCHAR' AND NOT regexp_full_match(s->>'$.discriminant', 'op|method')""",
    "contract_findings": f"WITH {_DOCS} SELECT id AS record_no, invariant, path, message FROM ({FINDINGS_SQL})",
    "contract_report": f"WITH {_DOCS} SELECT invariant, count(*) AS findings, count(DISTINCT id) AS documents FROM ({FINDINGS_SQL}) WHERE NOT (invariant = 'sign_in_mechanisms' AND path = '/websocket/auth/mechanism') GROUP BY invariant",
    "drift_report": f"""WITH {LOADS_SQL}, r AS (
  SELECT exchange || '|' || ccxt_version AS id, 'missing_baseline' AS category, 1::BIGINT AS n FROM loads WHERE seq = 1
  UNION ALL SELECT exchange || '|' || ccxt_version, 'stale_override', count(*) FROM ({Q.SQL['drift_stale']}) GROUP BY ALL
  UNION ALL SELECT exchange || '|' || ccxt_version, 'flipped_derived', count(*) FROM ({Q.SQL['drift_flipped']}) GROUP BY ALL
  UNION ALL SELECT exchange || '|' || ccxt_version, 'new_raw', count(*) FROM ({Q.SQL['drift_new']}) GROUP BY ALL) SELECT * FROM r""",
}
