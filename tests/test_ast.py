import json

from pyspark.sql import functions as F

from lamella.operators import ast as A

ID = lambda n: {"type": "Identifier", "name": n}
LIT = lambda v: {"type": "Literal", "value": v}
CALL = lambda n, *a: {"type": "CallExpression", "callee": {"type": "MemberExpression", "computed": False, "object": {"type": "ThisExpression"}, "property": ID(n)}, "arguments": list(a)}
LET = lambda n, v: {"type": "VariableDeclaration", "declarations": [{"type": "VariableDeclarator", "id": ID(n), "init": v}]}
EXPR = lambda e: {"type": "ExpressionStatement", "expression": e}
RETURN = lambda e: {"type": "ReturnStatement", "argument": e}
OBJ = lambda **p: {"type": "ObjectExpression", "properties": [{"type": "Property", "computed": False, "key": ID(k), "value": v} for k, v in p.items()]}
BIN = lambda op, a, b: {"type": "BinaryExpression", "operator": op, "left": a, "right": b}
BLOCK = lambda *s: {"type": "BlockStatement", "body": list(s)}
THROW = lambda n: {"type": "ThrowStatement", "argument": {"type": "NewExpression", "callee": ID(n), "arguments": []}}


def program(**methods):
    members = [{"type": "MethodDefinition", "key": ID(k), "value": {"type": "FunctionExpression", "async": k.startswith("fetch"), "params": [ID("params")], "body": BLOCK(*body)}} for k, body in methods.items()]
    return {"type": "Program", "body": [{"type": "ClassDeclaration", "id": ID("x"), "superClass": ID("Exchange"), "body": {"type": "ClassBody", "body": members}}]}


def test_inventory_and_calls():
    p = program(fetchTime=[EXPR(CALL("publicGetTime")), RETURN(CALL("parseTicker", CALL("parse8601"), CALL("parseToInt")))], sign=[])
    assert list(A.inventory(p)) == [("x", "Exchange", "fetchTime", True, "params", None, 2), ("x", "Exchange", "sign", False, "params", None, 0)]
    assert list(A.parse_calls(p)) == [("x", "fetchTime", "parseTicker"), ("x", "fetchTime", "parseToInt")]
    assert ("x", "fetchTime", "publicGetTime", "interface") in list(A.calls(p))


def test_pagination_and_defaults():
    p = program(
        fetchA=[EXPR(CALL("fetchPaginatedCallCursor", LIT("fetchA"), LIT(3), ID("q")))], fetchB=[EXPR(CALL("fetchPaginatedCallDynamic", ID("m")))],
        fetchC=[LET("request", OBJ(type=LIT("t"), n=ID("v"))), EXPR(CALL("publicPostInfo", CALL("extend", ID("request"), ID("params"))))],
        fetchD=[LET("r", OBJ(a=LIT(1))), EXPR({"type": "AssignmentExpression", "operator": "=", "left": ID("r"), "right": ID("z")}), EXPR(CALL("publicPostInfo", ID("r")))],
        fetchE=[EXPR(CALL("publicPostInfo", OBJ(a=LIT(1)))), EXPR(CALL("publicPostInfo", OBJ(a=LIT(2))))],
    )
    assert list(A.pagination(p)) == [("x", "fetchA", "cursor", "fetchA", "[3, null]"), ("x", "fetchB", "dynamic", None, "[]")]
    assert list(A.request_defaults(p)) == [("x", "fetchC", "type", '"t"', "literal"), ("x", "fetchC", "n", None, "unresolved")]


def test_error_derivations():
    code = BIN("===", ID("code"), LIT(429))
    p = program(handleErrors=[
        LET("error", CALL("safeString", ID("response"), LIT("code"))), LET("message", CALL("safeString", ID("response"), LIT("msg"))),
        EXPR(CALL("throwExactlyMatchedException", ID("exact"), ID("error"), ID("feedback"))), EXPR(CALL("throwBroadlyMatchedException", ID("broad"), ID("message"))),
        {"type": "IfStatement", "test": BIN("!==", ID("error"), LIT("0")), "consequent": BLOCK({"type": "IfStatement", "test": code, "consequent": THROW("RateLimit"), "alternate": THROW("Other")}), "alternate": None},
        THROW("ExchangeError"),
    ])
    assert list(A.error_fields(p)) == [("x", "response", "code", "safeString", "error_code"), ("x", "response", "code", "safeString", "status_sentinel"), ("x", "response", "msg", "safeString", "error_message")]
    assert list(A.throw_dispatches(p)) == [("x", "throwExactlyMatchedException", "exact", "code"), ("x", "throwBroadlyMatchedException", "broad", "msg")]
    assert list(A.error_dispatch(p)) == [
        ("x", "RateLimit", 'error !== "0" && code === 429', "http_status_eq", "[429]"), ("x", "Other", 'error !== "0"', "other", None), ("x", "ExchangeError", None, "other", None),
    ]


def test_sign_and_fields():
    p = program(
        sign=[{"type": "IfStatement", "test": {"type": "LogicalExpression", "operator": "||", "left": BIN("===", ID("api"), LIT("private")), "right": BIN("===", LIT("sapi"), ID("api"))}, "consequent": BLOCK(), "alternate": BLOCK()}],
        parseTicker=[LET("last", CALL("safeString", ID("t"), LIT("l"))), RETURN({"type": "TSAsExpression", "expression": CALL("safeTicker", OBJ(last=ID("last"), high=CALL("safeNumber", ID("t"), LIT("h")), info=ID("t")))})],
        parseTrade=[RETURN(ID("t"))], parseOrder=[],
    )
    assert [r[1:] for r in A.sign_dispatch(p)] == [(0, 'api === "private" || "sapi" === api', "private,sapi", False), (1, None, "", True)]
    assert [r[1:] for r in A.field_map(p)] == [
        ("parseTicker", "last", "l", "safeString", None), ("parseTicker", "high", "h", "safeNumber", None), ("parseTicker", "info", None, None, None),
        ("parseTrade", None, None, None, "identifier_return"), ("parseOrder", None, None, None, "no_return_statement"),
    ]
    assert list(A.class_tree({"A": {"B": {}}, "C": None})) == [("A", None), ("B", "A"), ("C", None)]


def test_rows(spark):
    p = json.dumps(program(fetchA=[EXPR(CALL("helper"))], helper=[EXPR(CALL("publicGetX"))]))
    df = spark.createDataFrame([("a", p), ("b", "{"), ("c", None), ("d", "[]")], "id string, ast string")
    calls = A.derive(df, "calls")
    assert {(r.id, r.status) for r in calls.collect()} == {("a", "ok"), ("b", "error"), ("c", "skip")}
    assert {(r.method, r.called, r.hops) for r in A.interface_calls(calls.where("status = 'ok'")).collect()} == {("fetchA", "publicGetX", 1)}
    nodes = A.ast_nodes(df)
    assert nodes.where("parent is null").count() == 1 and nodes.where("type = 'CallExpression'").count() == 2
    for name in A.DERIVATIONS:
        assert A.derive(df, name).count() >= 2


def test_node_types_and_reach_move_no_nodes(spark):
    """Both read a file's own nodes only: no join, so no side that could be taken for small and sent to the driver."""
    from lamella.plans import ast_queries as Q

    for query in (Q.ast_node_types, Q.ast_interface_calls):
        assert "Join" not in query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    p = program(
        fetchA=[EXPR(CALL("one")), EXPR(CALL("publicGetX"))], one=[EXPR(CALL("two"))], two=[EXPR(CALL("three")), EXPR(CALL("publicGetX"))], three=[EXPR(CALL("four")), EXPR(CALL("privatePostY")), EXPR(CALL("fetchA"))],
        four=[EXPR(CALL("publicGetZ"))],
    )
    df = spark.createDataFrame([("a", json.dumps(p)), ("b", "{"), ("c", None), ("d", "[]"), ("e", json.dumps(p))], "id string, ast string")
    reach = A.derive(df, "interface_reach").where("status = 'ok'").drop("status")
    assert {tuple(r) for r in reach.select("id", "method", "called", "hops").collect()} == {(i, "fetchA", c, h) for i in "ae" for c, h in (("publicGetX", 0), ("privatePostY", 3))}
    by_joins = A.interface_calls(A.derive(df, "calls").where("status = 'ok'"))
    assert {tuple(r) for r in by_joins.collect()} == {tuple(r) for r in reach.select("id", "method", "called", "hops").collect()}
    n = A.ast_nodes(df)
    above = n.select("id", F.col("node").alias("parent"), F.col("type").alias("parent_type"))
    joined = n.join(above, ["id", "parent"]).groupBy("parent_type", "field", "type").agg(F.count("*").alias("n"))
    assert {tuple(r) for r in A.edge_types(df).collect()} == {tuple(r) for r in joined.collect()}
