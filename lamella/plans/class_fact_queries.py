"""Signing, endpoints, signatures, parsers and broadcasts, from files that are made of the class table's rows.

As for stream classes, the file of a REST class takes its shapes from the length of its
name (``a``, four shapes) and its method count (``b``, three shapes).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.operators import ast as A
from lamella.operators import ast_shapes as SH
from lamella.operators import ast_signing as SG
from lamella.plans import tree_text as T
from lamella.plans.runtime import durable, read_table

_API, _PATH, _BODY = T.ident("api"), T.ident("path"), T.ident("body")
_GATE = T.do(T.this_call("checkRequiredCredentials"))
_IS = lambda name, on=_API: T.binary("===", on, T.lit(name))
API = {
    "public": {"get": {"ticker/{symbol}": 1, "all/@id@": {"cost": 2, "byLimit": [[1, 2]]}}, "post": ["order", "cancel/{id}/{x}"]},
    "private": {"v2": {"delete": {"x": "__function:anonymous"}, "put": {"y": {"noCoin": 0.5}}}},
    "spot": {"private": {"get": {"fills": 0.5}}},
}


def _literal(value: object) -> T.Node:
    if isinstance(value, dict):
        return {"type": "ObjectExpression", "properties": [T.prop(T.lit(k), _literal(v)) for k, v in value.items()]}
    return {"type": "ArrayExpression", "elements": [_literal(v) for v in value]} if isinstance(value, list) else T.lit(value)


def rest_rows(spark: SparkSession, d: str) -> DataFrame:
    """(id, name, parent, methods, a, b): the greatest row of each REST class."""
    t = read_table(spark, d, "class_hierarchy").where("class_type = 'rest' and class_name is not null").groupBy("node_key").agg(
        F.max("class_name").alias("name"), F.max("extends_raw").alias("parent"), F.max(F.coalesce("method_count", F.lit(0))).alias("n"), F.max("methods").alias("methods"),
    )
    return t.select(F.col("node_key").alias("id"), "name", "parent", "methods", (F.length("name") % 4).alias("a"), (F.col("n") % 3).alias("b"))


def signing_files(spark: SparkSession, d: str) -> DataFrame:
    t = rest_rows(spark, d)
    describe = T.column(T.method("describe", T.ret(T.this_call("deepExtend", T.call(T.member(T.ident("super"), "describe")), T.obj(api=_literal(API))))), id="name")
    payload = T.binary("+", T.binary("+", T.ident("nonce"), T.lit("@id@")), _PATH)
    by_header = T.method(
        "sign", T.const("nonce", T.call(T.member(T.this_call("nonce"), "toString"))),
        T.when(T.binary("||", _IS("private"), _IS("wallet")), _GATE, T.assign(_BODY, T.this_call("json", T.ident("params"))), T.const("payload", payload),
               T.const("signature", T.this_call("hmac", T.this_call("encode", T.ident("payload")), T.member(T.this(), "secret"), T.ident("sha256"))),
               T.assign(T.ident("headers"), T.obj(XKEY=T.member(T.this(), "apiKey"), XSIGN=T.ident("signature")))),
    )
    by_query = lambda *more: T.method(
        "sign", T.const("isPrivate", _IS("trade", T.indexed(_API, T.lit(0)))), T.const("query", T.this_call("keysort", T.ident("params"))),
        T.when(T.ident("isPrivate"), _GATE, T.assign(_BODY, T.this_call("urlencode", T.ident("query"))), *more,
               T.assign(T.ident("headers"), {"type": "ObjectExpression", "properties": [T.prop(T.lit("content-type"), T.lit("application/x-own"))]}),
               T.assign(T.ident("url"), T.binary("+", T.lit("?sig="), T.this_call("hash", _BODY, T.ident("md5"))), "+=")),
    )
    inverted = T.method("sign", T.when(_IS("public"), T.ret(_PATH), otherwise=T.block(_GATE)))
    both = T.column(by_query(T.when(_IS("POST", T.ident("method")), T.assign(_BODY, T.this_call("json", T.ident("query"))))))
    sign = T.choose(F.col("a"), None, T.column(by_header, id="name"), F.when(F.col("b") == 1, both).otherwise(T.column(by_query())), T.column(inverted))
    return t.select("id", T.class_file(F.array(describe, sign), F.col("name"), F.col("parent")).alias("ast"))


def _rows(files: DataFrame, name: str) -> DataFrame:
    return A.derive(files, name).where("status = 'ok'")


def _counted(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*[c for c in rows.columns if c not in ("id", "status", "class", "interface")]).agg(F.count("*").alias("n"))


def sign_sections(spark, d):
    """Row 127."""
    return _counted(_rows(signing_files(spark, d), "authenticated_sections"))


def sign_bodies(spark, d):
    """Row 135, body encoding and content type."""
    return _counted(_rows(signing_files(spark, d), "body_encoding"))


def sign_recipes(spark, d):
    """Row 133."""
    return _rows(signing_files(spark, d), "sign_recipe").drop("status", "class")


def api_documents(spark: SparkSession, d: str) -> DataFrame:
    """(id, ast): the api tree of each REST class; every fourth shape has none."""
    return rest_rows(spark, d).select("id", F.when(F.col("a") > 0, T.column(json.dumps(API), id="name")).otherwise("{}").alias("ast"))


def api_endpoints(spark, d):
    """Rows 112 and 114: endpoints with their cost and axes."""
    return _rows(api_documents(spark, d), "endpoint_tree").drop("status")


def section_endpoints(spark, d):
    """Row 114 by section: endpoints of what a class would name its authenticated sections."""
    sections = rest_rows(spark, d).select("id", F.explode(F.array(F.lit("private"), F.lit("spot.private"), F.lit("trade"))).alias("section"))
    return SG.section_endpoints(durable(_rows(api_documents(spark, d), "endpoint_tree")), sections)


def _auth(spark: SparkSession, d: str) -> DataFrame:
    t = read_table(spark, d, "exchange_output").select("record_no", "exchange", F.try_parse_json("auth").alias("v"))
    return t.where(F.schema_of_variant("v").startswith("OBJECT"))


def recipe_sync(spark, d):
    """Row 134 over all outputs: sections keep their own recipe, else take the exchange's from another record, else a default."""
    t = _auth(spark, d)
    sections = t.select("record_no", "exchange", F.explode(F.try_variant_get("v", "$.authenticated_sections", "array<string>")).alias("section")).where("section is not null")
    held = t.select("record_no", "exchange", F.try_variant_get("v", "$.sign_recipe", "variant").alias("r")).where(F.schema_of_variant("r").startswith("OBJECT"))
    own = durable(held.lateralJoin(spark.tvf.variant_explode(F.col("r").outer())).select("record_no", "exchange", F.col("key").alias("section"), F.to_json("value").alias("record")).where(F.col("record") != "null"))
    shared = own.groupBy("exchange", "section").agg(F.max("record").alias("record"))
    derived = sections.join(shared, ["exchange", "section"]).select(F.col("record_no").alias("id"), "section", "record").dropDuplicates(["id", "section"])
    out = SG.synced_records(sections.select(F.col("record_no").alias("id"), "section"), own.select(F.col("record_no").alias("id"), "section", "record"), derived)
    return out.select(F.col("id").alias("record_no"), "section", "origin", "reason")


def cost_bindings(spark, d):
    """Row 111: buckets of a class are its first methods, unresolved where the class states none."""
    t = rest_rows(spark, d).select("id", F.posexplode_outer(F.slice(F.coalesce("methods", F.array().cast("array<string>")), 1, 3)).alias("position", "m"), "b")
    return SG.cost_bindings(t.select("id", "position", F.when(F.col("m").isNotNull(), F.array("m", F.lit("ip"))).alias("axes"), F.when(F.col("b") == 2, "unset").alias("reason")))


# ---- signatures, parsers, broadcasts -----------------------------------------------------------

def interface_files(spark: SparkSession, d: str) -> DataFrame:
    """One interface per class: a signature for each method, with a typed and an optional parameter."""
    member = lambda m: T.column({"type": "TSMethodSignature", "key": T.ident("@m@"), "params": [T.typed("symbol", "String"), T.typed("limit", "Number") | {"optional": True}], "returnType": T.type_of("Promise")}, m=m)
    t = rest_rows(spark, d)
    head, tail = json.dumps({"type": "Program", "body": [T.lit(1), {"type": "ExportNamedDeclaration", "declaration": {"type": "TSInterfaceDeclaration", "id": T.ident("Exchange"), "body": {"type": "TSInterfaceBody", "body": ["@all@"]}}}]}).split('"@all@"')
    members = F.array_join(F.transform(F.array_distinct(F.array_compact(F.coalesce("methods", F.array().cast("array<string>")))), member), ",")
    return t.select("id", F.concat(F.lit(head), members, F.lit(tail)).alias("ast"))


def interface_signatures(spark, d):
    """Row 121."""
    return _counted(_rows(interface_files(spark, d), "interface_signatures"))


def descriptor_files(spark: SparkSession, d: str) -> DataFrame:
    """{"ast", "source"}: one promise method per class after a doc comment (a 1, 2), none (0), or one that returns no promise (3)."""
    doc = "/**\\n * @method\\n * @description reads é @id@\\n * more\\n * @param {string} [symbol] the market\\n * @param {object} params extra\\n * @returns {object} a ticker\\n * @throws {QuotaStale} when late\\n */\\n  "
    t = rest_rows(spark, d).withColumn("doc", F.when(F.col("a").isin(1, 2), T.column(doc.replace("\\n", "\n"), id="name")).otherwise("x = 1;\n"))
    at = F.octet_length("doc")
    fn = lambda returns: T.column(json.dumps({"type": "Program", "body": [{"type": "ClassDeclaration", "id": T.ident("C"), "body": {"type": "ClassBody", "body": [
        T.method("fetchTicker", params=(T.typed("symbol", "String"), {"type": "AssignmentPattern", "left": T.ident("params"), "right": T.obj()}), returns=T.type_of(returns)) | {"start": 987654321}]}}]}).replace("987654321", "@at@"), at=at.cast("string"))
    ast = F.when(F.col("a") == 3, fn("Order")).otherwise(fn("Promise"))
    return t.select("id", "name", F.concat(F.lit('{"ast":'), ast, F.lit(',"source":'), F.to_json(F.array(F.concat("doc", F.lit("async fetchTicker () {}")))).substr(F.lit(2), F.length(F.to_json(F.array(F.concat("doc", F.lit("async fetchTicker () {}"))))) - 2), F.lit("}")).alias("ast"))


def method_descriptors(spark, d):
    """Row 122."""
    return _rows(descriptor_files(spark, d), "descriptors").drop("status", "class")


def broadcast_files(spark: SparkSession, d: str) -> DataFrame:
    """A withdrawal that signs over a builder (a 1), directly (2), by a read only (3); b 1 imports a library, b 2 builds typed data."""
    t = rest_rows(spark, d)
    build = T.column(T.method("buildSig", T.ret(T.this_call("signL1Action", T.ident("x")))))
    out = T.choose(
        F.col("a"), None, T.column(T.method("withdraw", T.ret(T.this_call("buildSig")), asynchronous=True)), T.column(T.method("transfer", T.ret(T.this_call("starknetSign", T.this_call("buildSig"))), asynchronous=True)),
        T.column(T.method("fetchBalance", T.ret(T.this_call("buildSig")), asynchronous=True)),
    )
    typed = F.when(F.col("b") == 2, T.column(T.method("hashed", T.ret(T.this_call("hashTypedData")))))
    text = T.class_file(F.array(F.when(F.col("a") > 0, build), out, typed), F.col("name"), F.col("parent"))
    lib = T.column('{"type":"ImportDeclaration","source":{"type":"Literal","value":"../static/noble-curves/secp"}},')
    return t.select("id", F.when(F.col("b") == 1, F.replace(text, F.lit('"body":[{"type":"ClassDeclaration"'), F.concat(F.lit('"body":['), lib, F.lit('{"type":"ClassDeclaration"')))).otherwise(text).alias("ast"))


def raw_broadcasts(spark, d):
    """Row 126."""
    return _counted(_rows(broadcast_files(spark, d), "raw_broadcast"))


def parser_files(spark: SparkSession, d: str) -> DataFrame:
    """Parsers and their fetchers: a response passed on (a 0), looked up with a fall-back (1), by a name (2), as a member (3); b 1 nested, b 2 by a variable."""
    t = rest_rows(spark, d)
    response, use = T.ident("response"), lambda data: T.ret(T.this_call("parseTickers", data, T.ident("symbols")))
    fetch = lambda *s: T.column(T.method("fetchTickers", *s, asynchronous=True))
    shapes = T.choose(
        F.col("a"), fetch(use(response)), fetch(T.const("rows", T.this_call("safeList2", response, T.lit("data"), T.lit("result"), {"type": "ArrayExpression", "elements": []})), use(T.ident("rows"))),
        fetch(T.const("rows", T.this_call("safeValue", response, T.lit("list"))), use(T.ident("rows"))), fetch(use(T.member(response, "payload"))),
    )
    other = T.choose(
        F.col("b"), None, T.column(T.method("fetchOrders", T.const("x", T.this_call("safeList", T.member(response, "data"), T.lit("rows"))), T.ret(T.this_call("parseOrders", T.ident("x"))))),
        T.column(T.method("fetchOrders", T.ret(T.this_call("parseOrders", T.this_call("safeList", response, T.ident("key")))))),
    )
    parse = T.column(T.method("parseTicker", T.ret(T.this_call("safeTicker", T.obj(symbol=T.ident("symbol"), last=T.this_call("safeString", T.ident("ticker"), T.lit("px"))))), params=("ticker", "market")))
    return t.select("id", T.class_file(F.array(shapes, other, parse), F.col("name"), F.col("parent")).alias("ast"))


def response_envelopes(spark, d):
    """Row 138."""
    return _counted(_rows(parser_files(spark, d), "response_envelopes"))


def parser_digest(spark, d):
    """Row 137, digest."""
    return _counted(_rows(parser_files(spark, d), "parser_digest"))


def normalisation(spark, d):
    """Row 137: counts of digest, field maps and envelopes by parser type."""
    files = durable(parser_files(spark, d))
    fields = _rows(files, "field_map").where("key is not null").select("id", "method").withColumn("method", F.col("method"))
    parser = F.when(F.lit(False), F.lit(None).cast("string"))
    for p, names in SH.PARSERS.items():
        parser = parser.when(F.col("method").isin(*names), p)
    out = SH.normalisation_records(files.select("id"), _rows(files, "parser_digest").select("id", "method"), fields.withColumn("parser", parser), _rows(files, "response_envelopes").select("id", "parser"))
    return out.groupBy("parser", "methods", "fields", "fetchers", "reason").agg(F.count("*").alias("n"))


def currency_records(spark, d):
    """Row 94: described currencies, made of the releases' market symbols."""
    t = rest_rows(spark, d)
    text = {"currencies": {"BTX": {"id": "@id@", "info": {"x": 1}, "fee": "__undefined", "networks": {"N1": {"id": "n", "info": 2, "limits": {"min": "__undefined", "max": 3}}}}, "USDY": {"id": "@id@"}, "BAD": 7}}
    return _rows(t.select("id", F.when(F.col("a") > 0, T.column(json.dumps(text), id="name")).otherwise('{"currencies": null}').alias("ast")), "currencies").drop("status")


def test_hosts(spark, d):
    """Row 97."""
    t = rest_rows(spark, d)
    shapes = T.choose(
        F.col("a"), T.column('{"urls":{"test":{"rest":"https://test.{hostname}"}},"hostname":"@id@.example","options":{"sandboxMode":false}}', id="name"), T.column('{"urls":{"test":{}},"options":{"sandboxMode":true}}'),
        T.column('{"urls":{"test":{"rest":"https://t.example"}}}'), T.column('{"urls":null}'),
    )
    return _rows(t.select("id", shapes.alias("ast")), "test_hosts").drop("status")


def send_paths(spark, d):
    """Row 99."""
    t = rest_rows(spark, d)
    text = '{"public":{"get":{"sendTx":1,"other":2},"post":["sendTxBatch","SENDTX@id@",3]},"v1":{"private":{"post":{"SendTxs":{"cost":1},"list":["x"]}}}}'
    return _rows(t.where("a > 1").select("id", T.column(text, id="name").alias("ast")), "sendtx_paths").drop("status")


def suffix_dominance(spark, d):
    """Row 65: the suffix behind the last dash or underscore of market ids, per exchange."""
    m = read_table(spark, d, "load_markets").where("id is not null")
    suffix = F.regexp_extract("id", r"[-_]([A-Za-z]+)$", 1)
    return SH.dominant_suffix(m, by="exchange", suffix=F.when(suffix != "", suffix))


QUERIES = {f.__name__: f for f in (
    sign_sections, sign_bodies, sign_recipes, api_endpoints, section_endpoints, recipe_sync, cost_bindings, interface_signatures, method_descriptors, raw_broadcasts, response_envelopes, parser_digest,
    normalisation, currency_records, test_hosts, send_paths, suffix_dominance,
)}
_R = """r AS (SELECT node_key AS id, name, methods, length(name) % 4 AS a, n % 3 AS b FROM (
  SELECT node_key, max(class_name) AS name, max(coalesce(method_count, 0)) AS n, max(methods) AS methods FROM class_hierarchy WHERE class_type = 'rest' AND class_name IS NOT NULL GROUP BY 1))"""
_ENDPOINTS = """e AS (SELECT id, unnest([
  struct_pack(section := 'public', verb := 'get', path := 'ticker/{symbol}', params := 'symbol', cost := 1.0::DOUBLE, axes := NULL::VARCHAR), struct_pack(section := 'public', verb := 'get', path := 'all/' || name, params := '', cost := 2.0::DOUBLE, axes := '{"byLimit": [[1, 2]]}'),
  struct_pack(section := 'public', verb := 'post', path := 'order', params := '', cost := 1.0::DOUBLE, axes := NULL), struct_pack(section := 'public', verb := 'post', path := 'cancel/{id}/{x}', params := 'id,x', cost := 1.0::DOUBLE, axes := NULL),
  struct_pack(section := 'private.v2', verb := 'delete', path := 'x', params := '', cost := NULL::DOUBLE, axes := NULL), struct_pack(section := 'private.v2', verb := 'put', path := 'y', params := '', cost := 1.0::DOUBLE, axes := '{"noCoin": 0.5}'),
  struct_pack(section := 'spot.private', verb := 'get', path := 'fills', params := '', cost := 0.5::DOUBLE, axes := NULL)], recursive := true) FROM r WHERE a > 0)"""
SQL = {
    "sign_sections": f"WITH {_R}, s AS (SELECT unnest(CASE a WHEN 1 THEN ['private', 'spot.private', 'wallet'] WHEN 2 THEN ['trade'] WHEN 3 THEN ['private', 'spot', 'spot.private'] ELSE [] END) AS section FROM r) SELECT section, count(*) AS n FROM s GROUP BY 1",
    "sign_bodies": f"""WITH {_R} SELECT CASE WHEN a = 1 THEN 'json' WHEN a = 2 AND b <> 1 THEN 'form_urlencoded' WHEN a = 3 THEN 'none' END AS encoding, CASE WHEN a = 1 THEN 'application/json' WHEN a = 2 AND b <> 1 THEN 'application/x-own' END AS content_type,
  CASE WHEN a = 0 THEN 'no_sign_method' WHEN a = 2 AND b = 1 THEN 'ambiguous_body' END AS reason, count(*) AS n FROM r GROUP BY ALL""",
    "sign_recipes": f"""WITH {_R} SELECT id, CASE a WHEN 1 THEN 'hmac' WHEN 2 THEN 'hash' END AS crypto_op, CASE a WHEN 1 THEN 'sha256' END AS digest, CASE a WHEN 1 THEN 'nonce|"' || name || '"|path' WHEN 2 THEN 'body' END AS canonical_string,
  CASE a WHEN 1 THEN 'header:XSIGN' WHEN 2 THEN 'query' END AS signature_placement, CASE a WHEN 1 THEN 'XKEY=api_key' END AS auth_headers, CASE a WHEN 1 THEN 'nonce' END AS nonce,
  CASE a WHEN 1 THEN 'json,encode' WHEN 2 THEN 'keysort,urlencode' || CASE WHEN b = 1 THEN ',json' ELSE '' END END AS pre_sign_transforms, CASE a WHEN 0 THEN 'no_sign_method' WHEN 2 THEN 'not_yet_derived' WHEN 3 THEN 'custom_signing_family' END AS reason FROM r""",
    "api_endpoints": f"WITH {_R}, {_ENDPOINTS} SELECT * FROM e",
    "section_endpoints": f"""WITH {_R}, {_ENDPOINTS}, s AS (SELECT id, a, unnest(['private', 'spot.private', 'trade']) AS section FROM r)
SELECT s.id, s.section, CASE WHEN e.verb IS NOT NULL THEN 'ok' WHEN a > 0 THEN 'section_not_in_api' ELSE 'no_describe_api' END AS status, verb, path, params
FROM s LEFT JOIN e ON e.id = s.id AND (e.section = s.section OR starts_with(e.section, s.section || '.'))""",
    "recipe_sync": """WITH t AS (SELECT record_no, exchange, auth::JSON AS v FROM exchange_output WHERE auth IS NOT NULL AND json_valid(auth) AND json_type(auth) = 'OBJECT'),
s AS (SELECT DISTINCT record_no, exchange, x AS section FROM (SELECT record_no, exchange, unnest(TRY_CAST(v->'$.authenticated_sections' AS VARCHAR[])) AS x FROM t WHERE json_type(v, '$.authenticated_sections') = 'ARRAY') WHERE x IS NOT NULL),
o AS (SELECT record_no, exchange, e.key AS section FROM t, json_each(v, '$.sign_recipe') e WHERE json_type(v, '$.sign_recipe') = 'OBJECT' AND json_type(e.value) <> 'NULL')
SELECT record_no, section, CASE WHEN (record_no, section) IN (SELECT record_no, section FROM o) THEN 'existing' WHEN d THEN 'derived' ELSE 'default' END AS origin,
  CASE WHEN (record_no, section) IN (SELECT record_no, section FROM o) OR d THEN NULL ELSE 'not_yet_derived' END AS reason
FROM (SELECT s.*, EXISTS (SELECT 1 FROM o WHERE o.exchange = s.exchange AND o.section = s.section) AS d FROM s)""",
    "cost_bindings": f"WITH {_R} SELECT id, CASE WHEN b <> 2 AND methods[1] IS NOT NULL THEN 0 END AS bucket_index, CASE WHEN b <> 2 AND methods[1] IS NOT NULL THEN methods[1] || ',ip' END AS axes FROM r",
    "interface_signatures": f"WITH {_R}, m AS (SELECT DISTINCT id, unnest(methods) AS method FROM r) SELECT method, 'symbol: string, limit?: number' AS params, 'Promise' AS return_type, count(*) AS n FROM m WHERE method IS NOT NULL GROUP BY method",
    "method_descriptors": f"""WITH {_R} SELECT id, 'fetchTicker' AS method, 'symbol: string, params?' AS params, 'Promise' AS return_type, CASE WHEN a > 0 THEN 'reads é ' || name || ' more' END AS description,
  CASE WHEN a > 0 THEN '{{"params": "extra", "symbol": "the market"}}' END AS params_doc, CASE WHEN a > 0 THEN 'a ticker' END AS returns, CASE WHEN a > 0 THEN 'QuotaStale' END AS errors, CASE WHEN a = 0 THEN 'no_jsdoc' END AS reason FROM r WHERE a <> 3""",
    "raw_broadcasts": f"""WITH {_R} SELECT CASE b WHEN 1 THEN 'noble-curves' ELSE '' END AS imports, b = 2 AS typed_data, CASE a WHEN 1 THEN 'withdraw' WHEN 2 THEN 'transfer' END AS method, CASE a WHEN 1 THEN 'signL1Action' WHEN 2 THEN 'signL1Action,starknetSign' END AS helpers, count(*) AS n
FROM r WHERE a IN (1, 2) OR b = 2 OR (b = 1 AND a > 0) GROUP BY ALL""",
    "response_envelopes": f"""WITH {_R}, x AS (SELECT 'ticker' AS parser, 'fetchTickers' AS fetcher, CASE a WHEN 1 THEN 'data' WHEN 2 THEN 'list' WHEN 3 THEN 'payload' END AS key, CASE a WHEN 1 THEN 'result' ELSE '' END AS fallback_keys, CASE a WHEN 1 THEN '[]' END AS default_value, NULL::VARCHAR AS reason FROM r
UNION ALL SELECT 'order', 'fetchOrders', NULL, NULL, NULL, CASE b WHEN 1 THEN 'nested_response_unwrap' ELSE 'non_literal_key' END FROM r WHERE b > 0)
SELECT *, count(*) AS n FROM x GROUP BY ALL""",
    "parser_digest": f"WITH {_R} SELECT 'parseTicker' AS method, 'ticker, market' AS params, NULL::VARCHAR AS return_type, false AS is_async, 1::BIGINT AS statements, count(*) AS n FROM r HAVING count(*) > 0",
    "normalisation": f"""WITH {_R}, p AS (SELECT b, unnest(['ticker', 'trade', 'ohlcv', 'order', 'position', 'balance', 'market', 'transaction', 'deposit_address']) AS parser FROM r)
SELECT parser, CASE parser WHEN 'ticker' THEN 1 ELSE 0 END::BIGINT AS methods, CASE parser WHEN 'ticker' THEN 1 ELSE 0 END::BIGINT AS fields, CASE WHEN parser = 'ticker' OR (parser = 'order' AND b > 0) THEN 1 ELSE 0 END::BIGINT AS fetchers,
  CASE WHEN parser = 'ticker' OR (parser = 'order' AND b > 0) THEN NULL ELSE 'not_yet_derived' END AS reason, count(*) AS n FROM p GROUP BY ALL""",
    "currency_records": f"""WITH {_R} SELECT id, unnest([struct_pack(code := 'BTX', record := '{{"id":"' || name || '","networks":{{"N1":{{"id":"n","limits":{{"max":3}}}}}}}}'), struct_pack(code := 'USDY', record := '{{"id":"' || name || '","networks":{{}}}}'), struct_pack(code := 'BAD', record := '{{}}')], recursive := true) FROM r WHERE a > 0""",
    "test_hosts": f"""WITH {_R} SELECT id, CASE a WHEN 1 THEN 'sandbox_flag' WHEN 3 THEN 'none' ELSE 'separate_host' END AS pattern, CASE a WHEN 0 THEN '{{"rest":"https://test.' || name || '.example"}}' WHEN 2 THEN '{{"rest":"https://t.example"}}' END AS urls,
  CASE WHEN a < 2 THEN 'sandboxMode' END AS flag, CASE WHEN a = 3 THEN 'no_testnet_data' END AS reason FROM r""",
    "send_paths": f"""WITH {_R} SELECT id, unnest([struct_pack(path := 'public.get.sendTx', name := 'publicGetSendTx'), struct_pack(path := 'public.post.sendTxBatch', name := 'publicPostSendTxBatch'), struct_pack(path := 'public.post.SENDTX' || name, name := 'publicPostSENDTX' || name)], recursive := true) FROM r WHERE a > 1""",
    "suffix_dominance": r"""WITH c AS (SELECT exchange, nullif(regexp_extract(id, '[-_]([A-Za-z]+)$', 1), '') AS suffix, count(*) AS n FROM load_markets WHERE id IS NOT NULL GROUP BY ALL),
b AS (SELECT exchange, sum(n)::BIGINT AS total, max(struct_pack(n := n, s := suffix)) FILTER (suffix IS NOT NULL) AS b FROM c GROUP BY exchange)
SELECT exchange, CASE WHEN b.n / total >= 0.8 THEN b.s END AS suffix, coalesce(b.n, 0) AS n, total FROM b""",
}
