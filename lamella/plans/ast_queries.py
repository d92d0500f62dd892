"""Static-analysis queries over syntax trees that are made of the class table's rows.

No parser is at hand, so every class row becomes the ESTree document of a class whose
methods call, parse and paginate one another in the order of delivery.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.operators import ast as A
from lamella.plans.runtime import read_table

_ID = '{"type":"Identifier","name":"%s"}'
_THIS = '{"type":"CallExpression","callee":{"type":"MemberExpression","computed":false,"object":{"type":"ThisExpression"},"property":{"type":"Identifier","name":"%s"}},"arguments":[%s]}'


def class_documents(spark: SparkSession, d: str) -> DataFrame:
    """(id, ast): one file per distinct class and list of methods; the file of a class without methods is empty."""
    t = read_table(spark, d, "class_hierarchy").where("methods is not null").groupBy("node_key", "methods").agg(F.min("class_name").alias("class_name"), F.min("extends_raw").alias("extends_raw"))
    nxt = lambda i: F.element_at("methods", (i + 1) % F.size("methods") + 1)
    lit = lambda x: F.format_string('{"type":"Literal","value":"%s"}', x)
    call = lambda n, a: F.format_string(_THIS, n, a)
    body = lambda m, i: F.concat(
        F.lit('{"type":"BlockStatement","body":[{"type":"ExpressionStatement","expression":'), call(F.concat(F.lit("publicGet"), F.initcap(m)), F.lit('{"type":"ObjectExpression","properties":[{"type":"Property","computed":false,"key":{"type":"Identifier","name":"kind"},"value":{"type":"Literal","value":1}}]}')),
        F.lit('},{"type":"ExpressionStatement","expression":'), call(F.lit("fetchPaginatedCallCursor"), lit(m)),
        F.lit('},{"type":"ReturnStatement","argument":'), call(F.concat(F.lit("parse"), F.upper(F.substring(m, 1, 1)), F.substring(m, F.lit(2), F.length(m))), call(nxt(i), F.lit(""))), F.lit("}]}"),
    )
    method = lambda m, i: F.concat(
        F.lit('{"type":"MethodDefinition","computed":false,"key":'), F.format_string(_ID, m), F.lit(',"value":{"type":"FunctionExpression","async":'),
        F.when(m.startswith("fetch"), "true").otherwise("false"), F.lit(',"params":['), F.format_string(_ID, F.lit("params")), F.lit('],"body":'), body(m, i), F.lit("}}"),
    )
    ast = F.concat(
        F.lit('{"type":"Program","body":[{"type":"ClassDeclaration","id":'), F.format_string(_ID, "class_name"), F.lit(',"superClass":'), F.format_string(_ID, F.coalesce("extends_raw", F.lit(""))),
        F.lit(',"body":{"type":"ClassBody","body":['), F.array_join(F.transform("methods", method), ","), F.lit("]}}]}"),
    )
    key = F.concat_ws("|", "node_key", F.array_join("methods", ","))
    return t.select(key.alias("id"), F.when(F.size("methods") > 0, ast).otherwise("").alias("ast"))


def ast_inventory(spark, d):
    return A.derive(class_documents(spark, d), "inventory").groupBy("method", "is_async", "params", "statements", "status").agg(F.count("*").alias("n"))


def ast_parse_calls(spark, d):
    return A.derive(class_documents(spark, d), "parse_calls").where("status = 'ok'").groupBy("method", "called").agg(F.count("*").alias("n"))


def ast_pagination(spark, d):
    return A.derive(class_documents(spark, d), "pagination").where("status = 'ok'").groupBy("method", "strategy", "target").agg(F.count("*").alias("n"))


def ast_request_defaults(spark, d):
    return A.derive(class_documents(spark, d), "request_defaults").where("status = 'ok'").groupBy("method", "key", "value", "kind").agg(F.count("*").alias("n"))


def ast_interface_calls(spark, d):
    return A.derive(class_documents(spark, d), "interface_reach").where("status = 'ok'").groupBy("method", "called", "hops").agg(F.count("*").alias("n"))


def ast_node_types(spark, d):
    return A.edge_types(class_documents(spark, d))


QUERIES = {f.__name__: f for f in (ast_inventory, ast_parse_calls, ast_pagination, ast_request_defaults, ast_interface_calls, ast_node_types)}
_DOCS = """docs AS (SELECT node_key, methods FROM class_hierarchy WHERE methods IS NOT NULL GROUP BY ALL),
m AS (SELECT node_key || '|' || array_to_string(methods, ',') AS id, unnest(methods) AS method, unnest(list_concat(methods[2:], methods[:1])) AS follows FROM docs WHERE len(methods) > 0)"""
SQL = {
    "ast_inventory": f"""WITH {_DOCS} SELECT method, starts_with(method, 'fetch') AS is_async, 'params' AS params, 3::BIGINT AS statements, 'ok' AS status, count(*) AS n FROM m GROUP BY ALL
UNION ALL SELECT NULL, NULL, NULL, NULL, 'skip', count(*) FROM docs WHERE len(methods) = 0 HAVING count(*) > 0""",
    "ast_parse_calls": f"WITH {_DOCS} SELECT method, 'parse' || upper(method[1]) || method[2:] AS called, count(*) AS n FROM m GROUP BY ALL",
    "ast_pagination": f"WITH {_DOCS} SELECT method, 'cursor' AS strategy, method AS target, count(*) AS n FROM m GROUP BY ALL",
    "ast_request_defaults": f"WITH {_DOCS} SELECT method, 'kind' AS key, '1' AS value, 'literal' AS kind, count(*) AS n FROM m GROUP BY ALL",
    "ast_interface_calls": f"""WITH {_DOCS}, c AS (SELECT DISTINCT id, method, follows FROM m), h0 AS (SELECT DISTINCT id, method, method AS at, 0 AS hops FROM c WHERE regexp_matches(method, '^({'|'.join(A.UNIFIED)})')),
h1 AS (SELECT DISTINCT h.id, h.method, c.follows AS at, 1 AS hops FROM h0 h JOIN c ON c.id = h.id AND c.method = h.at), h2 AS (SELECT DISTINCT h.id, h.method, c.follows AS at, 2 AS hops FROM h1 h JOIN c ON c.id = h.id AND c.method = h.at),
h3 AS (SELECT DISTINCT h.id, h.method, c.follows AS at, 3 AS hops FROM h2 h JOIN c ON c.id = h.id AND c.method = h.at),
best AS (SELECT id, method, 'publicGet' || upper("at"[1]) || lower("at"[2:]) AS called, min(hops) AS hops FROM (SELECT * FROM h0 UNION ALL SELECT * FROM h1 UNION ALL SELECT * FROM h2 UNION ALL SELECT * FROM h3) GROUP BY ALL)
SELECT method, called, hops, count(*) AS n FROM best GROUP BY ALL""",
    # Each class has the nodes of the first rows once, and those of the second for each of its methods.
    "ast_node_types": f"""WITH {_DOCS}, k AS (SELECT count(*) FILTER (len(methods) > 0) AS files, coalesce(sum(len(methods)), 0)::BIGINT AS n FROM docs),
v AS (SELECT * FROM (VALUES ('Program', 'body', 'ClassDeclaration', 1), ('ClassDeclaration', 'id', 'Identifier', 1), ('ClassDeclaration', 'superClass', 'Identifier', 1), ('ClassDeclaration', 'body', 'ClassBody', 1)) t(p, f, c, x)),
w AS (SELECT * FROM (VALUES ('ClassBody', 'body', 'MethodDefinition', 1), ('MethodDefinition', 'key', 'Identifier', 1), ('MethodDefinition', 'value', 'FunctionExpression', 1), ('FunctionExpression', 'params', 'Identifier', 1), ('FunctionExpression', 'body', 'BlockStatement', 1),
  ('BlockStatement', 'body', 'ExpressionStatement', 2), ('BlockStatement', 'body', 'ReturnStatement', 1), ('ExpressionStatement', 'expression', 'CallExpression', 2), ('ReturnStatement', 'argument', 'CallExpression', 1),
  ('CallExpression', 'callee', 'MemberExpression', 4), ('MemberExpression', 'object', 'ThisExpression', 4), ('MemberExpression', 'property', 'Identifier', 4), ('CallExpression', 'arguments', 'ObjectExpression', 1), ('CallExpression', 'arguments', 'Literal', 1),
  ('CallExpression', 'arguments', 'CallExpression', 1), ('ObjectExpression', 'properties', 'Property', 1), ('Property', 'key', 'Identifier', 1), ('Property', 'value', 'Literal', 1)) t(p, f, c, x))
SELECT p AS parent_type, f AS field, c AS type, x * files AS n FROM v, k WHERE files > 0 UNION ALL SELECT p, f, c, x * n FROM w, k WHERE n > 0""",
}
