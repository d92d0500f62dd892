"""Scopes, provenance, sentinels, error handling and field maps, over the tables' own rows or files made of them."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.functions import strings as X
from lamella.operators import ast as A
from lamella.operators import contracts as C
from lamella.operators import families as M
from lamella.operators import patch as P
from lamella.operators import resolve as R
from lamella.operators import scope as S
from lamella.operators import upsert as U
from lamella.plans import tree_text as T
from lamella.plans.class_fact_queries import _R, _counted, _rows, parser_files, raw_broadcasts, rest_rows, signing_files
from lamella.plans.family_queries import SQL as FAMILY_SQL
from lamella.plans.family_queries import family_sizes
from lamella.plans.runtime import durable, read_table
from lamella.plans.spec_queries import EDGES_SQL, METHODS_SQL, class_edges, class_methods


def scoped_ids(spark, d):
    """Ids from comma-separated options (row 18), made of nation and region names."""
    t = read_table(spark, d, "nation").join(read_table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return S.split_ids(t.select(F.concat_ws(" , ", "n_name", F.lit(""), "r_name", "n_name").alias("o")), "o")


def scope_resolved(spark, d):
    """Tiers cut to the universe of known exchanges, and one explicit id that is in it (row 17)."""
    entry = read_table(spark, d, "exchanges").select("tier_scope", F.explode("exchanges").alias("e")).select("tier_scope", F.lower(F.trim("e.id")).alias("id")).where("id is not null and id <> ''")
    universe = durable(entry.select("id").distinct())
    first = [r[0] for r in universe.agg(F.min("id")).collect() if r[0] is not None]
    members = entry.select(F.col("tier_scope").alias("tier"), "id").unionByName(spark.createDataFrame([("tier1", "no-such-exchange")], "tier string, id string"))
    return S.resolve(universe, ids=first, tiers=["tier1", "tier2"], tier_members=members)


def referrals(spark, d):
    """Referral of every delivered entry, whose JSON is a text, an object or null (row 30)."""
    e = read_table(spark, d, "exchanges").select("envelope_no", F.posexplode("exchanges").alias("pos", "e"))
    text = F.when(F.col("e.referral").isNull(), None).when(F.col("e.referral.discount").isNull(), F.to_json(F.array("e.referral.url"))).otherwise(F.to_json("e.referral"))
    text = F.when(text.startswith("["), F.substring(text, F.lit(2), F.length(text) - 2)).otherwise(text)
    r = S.referral(text)
    return e.select("envelope_no", "pos", r.alias("r")).select("envelope_no", "pos", "r.url", "r.discount")


def inverted_tree(spark, d):
    """Parents from lists of children (row 79)."""
    lists = class_edges(spark, d).where("parent is not null").groupBy("parent").agg(F.collect_set("node").alias("children"))
    return R.invert(lists)


def nested_classes(spark, d):
    """(class, parent) of nested class literals, one per tree: its classes below two levels (rows 84, 146)."""
    t = read_table(spark, d, "error_class_hierarchy").select("tree_no", F.array_sort(F.map_keys("ancestors")).alias("k")).where("k is not null").groupBy("tree_no").agg(F.max("k").alias("k"))
    leaves = F.array_join(F.transform("k", lambda x: F.concat(F.to_json(F.array(x)).substr(F.lit(2), F.length(F.to_json(F.array(x))) - 2), F.lit(":{}"))), ",")
    return A.derive(t.select(F.col("tree_no").alias("id"), F.concat(F.lit('{"#Base":{"#Mid":{'), leaves, F.lit('}},"#Other":null}')).alias("ast")), "class_tree").drop("status")


def provenance(spark, d):
    """Tags of each class's methods, ``raw`` by default, with its first and an unknown one overridden (row 105)."""
    t = class_methods(spark, d).groupBy("node").agg(F.array_sort(F.collect_list(F.concat(F.lit("/"), "name"))).alias("paths"))
    stamped = P.stamp_provenance(F.map_from_arrays("paths", F.transform("paths", lambda _: F.lit("raw"))), F.array(F.get("paths", 0), F.lit("/#new"), F.lit("/#new")))
    return t.select("node", F.explode(stamped).alias("path", "tag"))


def stripped_sentinels(spark, d):
    """Function texts of JSON as plain names at any depth (row 109)."""
    t = class_methods(spark, d)
    text = F.to_json(F.struct(F.concat(F.lit("__function:"), "name").alias("f"), F.array(F.concat(F.lit("__function:"), "node"), F.lit("x__function:y")).alias("l")))
    return t.select("node", "name", X.strip_functions_at_depth(text).alias("text"))


def normal_types(spark, d):
    """Node types in Pascal case at any depth (row 3): snake-case trees of the methods' names."""
    names = class_methods(spark, d).select("name").distinct()
    text = T.column('{"type":"call_expression","callee":{"type":"@t@"},"arguments":[{"type":"string_literal","value":"call_expression"}]}', t=F.lower(F.regexp_replace("name", "([a-z])([A-Z])", "$1_$2")))
    return A.derive(names.select(F.col("name").alias("id"), text.alias("ast")), "normal_types").select("id", "text")


def family_histogram(spark, d):
    """Families by size and kind (row 58)."""
    return family_sizes(spark, d).groupBy("kind", "total").agg(F.count("*").alias("families"))


def family_changed_keys(spark, d):
    """Names of classes with a parent that the parent has too, by how many change them (row 58)."""
    m = durable(class_methods(spark, d))
    return M.changed_names(class_edges(spark, d), m)


def customer_aggregate(spark, d):
    """Envelope of the customers after a scoped write of one nation (row 4)."""
    old = read_table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    new = old.where("c_nationkey = 3 and c_acctbal > 0")
    _, envelope = U.aggregate(old, new, old.where("c_nationkey = 3").select(F.col("c_custkey").alias("id")), id="c_custkey", old_stamp=["tier2", "exchange:b"], new_stamp=["exchange:a", "tier1"], tiers=["tier1", "tier2"], stats={"rich": F.count(F.when(F.col("c_acctbal") > 5000, 1))})
    return envelope


def bucket_algorithms(spark, d):
    """Algorithm of a bucket before that of its entity before the default (row 110)."""
    t = read_table(spark, d, "part")
    own, entity = F.when(F.col("p_size") > 30, F.lit("rollingWindow")), F.when(F.col("p_size") > 10, F.col("p_brand"))
    return t.select("p_partkey", X.rate_limit_algorithm(own, entity).alias("algorithm"))


def promoted_methods(spark, d):
    """Method names as write and chain methods, with those promoted that broadcast signed payloads (row 98)."""
    names = class_methods(spark, d).select("name").distinct()
    promoted = raw_broadcasts(spark, d).where("method is not null").select(F.col("method").alias("name")).distinct().withColumn("p", F.lit(True))
    p = F.coalesce("p", F.lit(False))
    return names.join(promoted, "name", "left").select("name", (X.is_transactional(F.col("name")) | p).alias("is_write"), (X.is_on_chain(F.col("name")) | p).alias("on_chain"))


# Fixed value: what a file of overrides may hold.
OVERRIDES = {
    "type": "object", "additionalProperties": False, "required": ["schema_version", "overrides"],
    "properties": {"schema_version": {"const": "1"}, "overrides": {"type": "array", "minItems": 1, "items": {"$ref": "#/$defs/Entry"}}},
    "$defs": {"Entry": {
        "type": "object", "additionalProperties": False, "required": ["path", "value", "reason"],
        "properties": {"path": {"type": "string", "pattern": "^/"}, "value": True, "reason": {"type": "string", "minLength": 1}, "verified_against": {"type": "string"}, "unverified": {"type": "boolean"}},
        "not": {"allOf": [{"required": ["verified_against"]}, {"properties": {"unverified": {"const": True}}, "required": ["unverified"]}]},
    }},
}


def override_files(spark, d):
    """Failures of override files against their schema (rows 104, 155); a class's file has one of four shapes."""
    t = rest_rows(spark, d)
    good = {"path": "/@id@", "value": None, "reason": "r"}
    shape = lambda *entries, **more: T.column(json.dumps({"schema_version": "1", "overrides": list(entries)} | more), id="name")
    text = T.choose(F.col("a"), shape(good), shape(), shape(good, good | {"path": "x/@id@", "reason": ""}, stray=1), shape(good | {"verified_against": "f:1", "unverified": True}, {"path": "/a", "value": 1, "extra": 2}, schema_version="2"))
    return C.schema_failures(t.select("id", text.alias("text")), OVERRIDES, id="id", text="text")


# ---- files -------------------------------------------------------------------------------------

def error_files(spark: SparkSession, d: str) -> DataFrame:
    """``handleErrors`` in four shapes: none; helpers; nested conditions with an else; a range, a text search and a plain throw."""
    t = rest_rows(spark, d)
    response, code, body, feedback = T.ident("response"), T.ident("code"), T.ident("body"), T.ident("feedback")
    throw = lambda name: {"type": "ThrowStatement", "argument": T.new(name, feedback)}
    is_ = lambda a, op, b: T.binary(op, a, b)
    make = lambda *s: T.column(T.method("handleErrors", *s), id="name")
    shapes = T.choose(
        F.col("a"), None,
        make(T.const("errorCode", T.this_call("safeString2", response, T.lit("code_@id@"), T.lit("ret"))), T.const("message", T.this_call("safeString", response, T.lit("msg"))),
             T.do(T.this_call("throwExactlyMatchedException", T.indexed(T.member(T.this(), "exceptions"), T.lit("exact")), T.ident("errorCode"), feedback)),
             T.do(T.this_call("throwBroadlyMatchedException", T.indexed(T.member(T.this(), "exceptions"), T.lit("broad")), T.ident("message"), feedback))),
        make(T.const("status", T.this_call("safeString", response, T.lit("status"))), T.when(is_(T.ident("status"), "!==", T.lit("ok")), T.when(is_(code, "===", T.lit(429)), throw("QuotaStale"), otherwise=T.block(throw("Other"))))),
        make(T.when(is_(code, ">=", T.lit(500)), throw("NonceBusy")), T.when(is_(T.call(T.member(body, "indexOf"), T.lit("gone @id@")), ">=", T.lit(0)), throw("Gone")), throw("ExchangeError")),
    )
    return t.select("id", T.class_file(F.array(shapes), F.col("name"), F.col("parent")).alias("ast"))


def error_fields(spark, d):
    """Row 128."""
    return _rows(error_files(spark, d), "error_fields").drop("status", "class")


def throw_dispatches(spark, d):
    """Row 129."""
    return _rows(error_files(spark, d), "throw_dispatches").drop("status", "class")


def error_dispatches(spark, d):
    """Rows 130 and 147."""
    return _rows(error_files(spark, d), "error_dispatch").drop("status", "class")


def sign_branches(spark, d):
    """Row 131."""
    return _counted(_rows(signing_files(spark, d), "sign_dispatch"))


def field_maps(spark, d):
    """Row 136."""
    return _counted(_rows(parser_files(spark, d), "field_map"))


def pagination_files(spark: SparkSession, d: str) -> DataFrame:
    """One paginated method per class in the four strategies; b 1 with further literals, b 2 with a target that is no literal."""
    t = rest_rows(spark, d)
    one = lambda name: F.when(F.col("b") == 2, T.column(T.method("fetchTrades", T.ret(T.this_call(name, T.ident("method")))))).when(
        F.col("b") == 1, T.column(T.method("fetchTrades", T.ret(T.this_call(name, T.lit("fetch @id@"), T.ident("symbol"), T.lit(100)))), id="name")
    ).otherwise(T.column(T.method("fetchTrades", T.ret(T.this_call(name, T.lit("fetch @id@")))), id="name"))
    call = T.choose(F.col("a"), *[one(n) for n in A.PAGINATION])
    return t.select("id", T.class_file(F.array(call), F.col("name"), F.col("parent")).alias("ast"))


def pagination_shapes(spark, d):
    """Row 124, all strategies."""
    return _rows(pagination_files(spark, d), "pagination").drop("status", "class")


def default_files(spark: SparkSession, d: str) -> DataFrame:
    """A request body given directly (a 0), by ``extend`` of a name (1), by a name that is assigned again (2), by two bodies (3)."""
    t = rest_rows(spark, d)
    body = T.obj(kind=T.lit("@id@"), depth=T.lit(5), nested=T.obj(a={"type": "UnaryExpression", "operator": "-", "argument": T.lit(1)}), free=T.ident("x"))
    send = lambda arg: T.do(T.this_call("privatePostOrder", arg))
    make = lambda *s: T.column(T.method("createOrder", *s), id="name")
    shapes = T.choose(
        F.col("a"), make(send(body)), make(T.const("request", body), send(T.this_call("extend", T.ident("request"), T.ident("params")))),
        make(T.const("request", body), T.assign(T.ident("request"), T.ident("other")), send(T.ident("request"))), make(send(T.obj(a=T.lit(1))), send(T.obj(a=T.lit(2)))),
    )
    return t.select("id", T.class_file(F.array(shapes), F.col("name"), F.col("parent")).alias("ast"))


def request_default_shapes(spark, d):
    """Row 125, literal, traced, reassigned and differing bodies."""
    return _rows(default_files(spark, d), "request_defaults").drop("status", "class")


QUERIES = {f.__name__: f for f in (
    scoped_ids, scope_resolved, referrals, inverted_tree, nested_classes, provenance, stripped_sentinels, normal_types, family_histogram, family_changed_keys, customer_aggregate, bucket_algorithms,
    promoted_methods, override_files, error_fields, throw_dispatches, error_dispatches, sign_branches, field_maps, pagination_shapes, request_default_shapes,
)}
_SNAKE = "lower(regexp_replace(name, '([a-z])([A-Z])', '\\1_\\2', 'g'))"
SQL = {
    "scoped_ids": "SELECT n_name AS id FROM nation JOIN region ON n_regionkey = r_regionkey UNION SELECT r_name FROM nation JOIN region ON n_regionkey = r_regionkey",
    "scope_resolved": """WITH e AS (SELECT tier_scope, lower(trim(x.id)) AS id FROM (SELECT tier_scope, unnest(exchanges) AS x FROM exchanges) WHERE trim(x.id) <> '') SELECT DISTINCT id FROM e WHERE tier_scope IN ('tier1', 'tier2') UNION SELECT min(id) FROM e HAVING min(id) IS NOT NULL""",
    "referrals": """WITH e AS (SELECT envelope_no, unnest(exchanges) AS e, CAST(generate_subscripts(exchanges, 1) - 1 AS INTEGER) AS pos FROM exchanges)
SELECT envelope_no, pos, e.referral.url AS url, CASE WHEN e.referral IS NOT NULL AND (e.referral.discount IS NOT NULL OR e.referral.url IS NOT NULL) THEN coalesce(e.referral.discount, 0)::DOUBLE END AS discount FROM e""",
    "inverted_tree": f"WITH {EDGES_SQL} SELECT node, parent FROM edges WHERE parent IS NOT NULL AND node IS NOT NULL",
    "nested_classes": """WITH k AS (SELECT tree_no, max(list_sort(map_keys(ancestors))) AS k FROM error_class_hierarchy WHERE ancestors IS NOT NULL GROUP BY 1)
SELECT tree_no::VARCHAR AS id, unnest(['#Base', '#Mid', '#Other']) AS class, unnest([NULL, '#Base', NULL]) AS parent FROM k UNION ALL SELECT tree_no::VARCHAR, unnest(k), '#Mid' FROM k""",
    "provenance": f"WITH {METHODS_SQL}, f AS (SELECT node, min(name) AS first FROM methods WHERE name IS NOT NULL GROUP BY node) SELECT m.node, '/' || name AS path, CASE WHEN name = first THEN 'override' ELSE 'raw' END AS tag FROM methods m JOIN f ON f.node = m.node WHERE name IS NOT NULL UNION ALL SELECT node, '/#new', 'override' FROM f",
    "stripped_sentinels": f"""WITH {METHODS_SQL} SELECT node, name, '{{"f":"' || name || '","l":["' || node || '","x__function:y"]}}' AS text FROM methods""",
    "normal_types": f"""WITH n AS (SELECT DISTINCT unnest(methods) AS name FROM class_hierarchy) SELECT name AS id, '{{"arguments":[{{"type":"StringLiteral","value":"call_expression"}}],"callee":{{"type":"' || array_to_string([upper(w[1]) || w[2:] FOR w IN string_split({_SNAKE}, '_')], '') || '"}},"type":"CallExpression"}}' AS text FROM n WHERE name IS NOT NULL""",
    "family_histogram": f"SELECT kind, total, count(*) AS families FROM ({FAMILY_SQL['family_sizes']}) GROUP BY ALL",
    "family_changed_keys": f"WITH {EDGES_SQL}, {METHODS_SQL} SELECT m.name, count(*) AS classes FROM edges e JOIN methods m ON m.node = e.node JOIN methods p ON p.node = e.parent AND p.name = m.name WHERE e.node <> e.parent GROUP BY m.name",
    "customer_aggregate": "SELECT count(*) AS count, count(*) FILTER (c_acctbal > 5000) AS rich, 'tier1,tier2,exchange:a,exchange:b' AS tier_scope FROM customer WHERE c_nationkey <> 3 OR c_acctbal > 0",
    "bucket_algorithms": "SELECT p_partkey, CASE WHEN p_size > 30 THEN 'rollingWindow' WHEN p_size > 10 THEN p_brand ELSE 'leakyBucket' END AS algorithm FROM part",
    "promoted_methods": f"WITH {_R}, n AS (SELECT DISTINCT unnest(methods) AS name FROM class_hierarchy), p AS (SELECT CASE a WHEN 1 THEN 'withdraw' ELSE 'transfer' END AS name FROM r WHERE a IN (1, 2)) SELECT name, NOT starts_with(name, 'fetch') OR name IN (SELECT name FROM p) AS is_write, starts_with(name, 'withdraw') OR name IN (SELECT name FROM p) AS on_chain FROM n",
    "override_files": f"""WITH {_R} SELECT id, unnest(CASE a WHEN 1 THEN [struct_pack(path := '/overrides', keyword := 'minItems')] WHEN 2 THEN [struct_pack(path := '/overrides/1/path', keyword := 'pattern'), struct_pack(path := '/overrides/1/reason', keyword := 'minLength'), struct_pack(path := '/stray', keyword := 'additionalProperties')]
  WHEN 3 THEN [struct_pack(path := '/schema_version', keyword := 'const'), struct_pack(path := '/overrides/0', keyword := 'not'), struct_pack(path := '/overrides/1/reason', keyword := 'required'), struct_pack(path := '/overrides/1/extra', keyword := 'additionalProperties')] ELSE [] END, recursive := true) FROM r""",
    "error_fields": f"""WITH {_R} SELECT id, unnest(CASE a WHEN 1 THEN [struct_pack(object := 'response', field := 'code_' || name, call := 'safeString2', role := 'error_code'), struct_pack(object := 'response', field := 'msg', call := 'safeString', role := 'error_message')]
  WHEN 2 THEN [struct_pack(object := 'response', field := 'status', call := 'safeString', role := 'status_sentinel')] ELSE [] END, recursive := true) FROM r""",
    "throw_dispatches": f"""WITH {_R} SELECT id, unnest([struct_pack(helper := 'throwExactlyMatchedException', "table" := 'this.exceptions["exact"]', field := 'code_' || name), struct_pack(helper := 'throwBroadlyMatchedException', "table" := 'this.exceptions["broad"]', field := 'msg')], recursive := true) FROM r WHERE a = 1""",
    "error_dispatches": f"""WITH {_R} SELECT id, unnest(CASE a WHEN 2 THEN [struct_pack(exception := 'QuotaStale', predicate := 'status !== "ok" && code === 429', kind := 'http_status_eq', literals := '[429]'), struct_pack(exception := 'Other', predicate := 'status !== "ok"', kind := 'other', literals := NULL)]
  WHEN 3 THEN [struct_pack(exception := 'NonceBusy', predicate := 'code >= 500', kind := 'http_status_range', literals := '[500]'), struct_pack(exception := 'Gone', predicate := 'body.indexOf("gone ' || name || '") >= 0', kind := 'body_contains', literals := '["gone ' || name || '"]'), struct_pack(exception := 'ExchangeError', predicate := NULL, kind := 'other', literals := NULL)] ELSE [] END, recursive := true) FROM r""",
    "sign_branches": f"""WITH {_R}, b AS (SELECT unnest(CASE a WHEN 1 THEN [struct_pack(position := 0::BIGINT, predicate := 'api === "private" || api === "wallet"', sections := 'private,wallet', is_else := false)]
  WHEN 2 THEN [struct_pack(position := 0::BIGINT, predicate := 'isPrivate', sections := '', is_else := false)] WHEN 3 THEN [struct_pack(position := 0::BIGINT, predicate := 'api === "public"', sections := 'public', is_else := false), struct_pack(position := 1::BIGINT, predicate := NULL, sections := '', is_else := true)] ELSE [] END, recursive := true) FROM r)
SELECT position, predicate, sections, is_else, count(*) AS n FROM b GROUP BY ALL""",
    "field_maps": f"WITH {_R} SELECT 'parseTicker' AS method, f AS field, CASE f WHEN 'last' THEN 'px' END AS key, CASE f WHEN 'last' THEN 'safeString' END AS call, NULL::VARCHAR AS reason, count(*) AS n FROM r, (VALUES ('symbol'), ('last')) v(f) GROUP BY ALL",
    "pagination_shapes": f"""WITH {_R} SELECT id, 'fetchTrades' AS method, CASE a WHEN 0 THEN 'dynamic' WHEN 1 THEN 'deterministic' WHEN 2 THEN 'cursor' ELSE 'incremental' END AS strategy, CASE WHEN b < 2 THEN 'fetch ' || name END AS target, CASE WHEN b = 1 THEN '[null, 100]' ELSE '[]' END AS arguments FROM r""",
    "request_default_shapes": f"""WITH {_R} SELECT id, 'createOrder' AS method, unnest([struct_pack(key := 'kind', value := '"' || name || '"', kind := 'literal'), struct_pack(key := 'depth', value := '5', kind := 'literal'), struct_pack(key := 'nested', value := '{{"a": -1}}', kind := 'literal'), struct_pack(key := 'free', value := NULL, kind := 'unresolved')], recursive := true) FROM r WHERE a < 2""",
}
