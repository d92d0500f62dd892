"""Derivations over syntax trees: stream facts, signing, signatures, projections."""

import json

import pytest

from lamella.operators import ast as A
from lamella.operators import ast_shapes as SH
from lamella.operators import ast_signing as SG
from lamella.operators import ast_streams as ST
from lamella.plans import tree_text as T


def program(*members, name="Own"):
    return {"type": "Program", "body": [{"type": "ClassDeclaration", "id": T.ident(name), "superClass": T.ident("Base"), "body": {"type": "ClassBody", "body": list(members)}}]}


def test_heartbeat_kinds():
    of = lambda *m: list(ST.heartbeat(program(*m)))
    assert of(T.method("ping", T.ret(T.lit("x")))) == [("Own", "string_message", "x", False, None, None)]
    assert of(T.method("ping", T.ret(T.obj(op=T.ident("free")))), T.method("pong")) == [("Own", "json_message", None, True, None, None)]
    assert of(T.method("ping")) == [("Own", "unknown", None, False, None, "ping_return_not_literal")]
    assert of(T.method("describe", T.ret(T.obj(streaming=T.obj(keepAlive=T.lit(5)))))) == [("Own", None, None, False, 5, None)]
    assert list(ST.heartbeat(program())) == []


def test_sign_in_needs_a_message_that_is_sent():
    message = T.const("request", T.obj(method=T.lit("login")))
    assert list(ST.sign_in(program(T.method("authenticate", message)))) == [("Own", "unknown", None, None, "", "auth_not_classifiable")]
    sent = T.method("authenticate", message, T.do(T.call(T.member(T.ident("client"), "send"), T.ident("request"))))
    assert list(ST.sign_in(program(sent))) == [("Own", "sign_in_message", "method", "login", "", None)]
    assert list(ST.sign_in(program(T.method("other")))) == []


def test_templates_leave_what_is_not_literal():
    plus = lambda a, b: T.binary("+", a, b)
    watch = T.method("watchTicker", T.const("a", plus(plus(T.lit("x."), T.member(T.ident("market"), "id")), T.ident("timeframe"))), T.const("b", plus(T.ident("topic"), T.lit("y"))))
    assert list(ST.channels(program(watch, T.method("watch", T.ret(plus(T.lit("a"), T.lit("b"))))))) == [("Own", "watchTicker", "x.{symbol}{timeframe}")]


def test_dispatch_without_entries_and_discriminator_ties():
    assert list(ST.dispatch(program(T.method("handleMessage", T.ret(T.ident("x")))))) == [("Own", None, None, None, "dispatch_not_classifiable")]
    read = lambda k: T.this_call("safeString", T.ident("m"), T.lit(k))
    is_ = lambda a, v: T.when(T.binary("===", T.ident(a), T.lit(v)))
    book = T.method("handleOrderBook", T.const("t", read("type")), T.const("a", read("action")), is_("t", "update"), is_("a", "partial"), T.do(T.this_call("handleDelta")))
    assert list(ST.order_books(program(book))) == [("Own", "incremental", "action", "partial", None, "", None, None)]
    assert list(ST.order_books(program(T.method("handleSnapshot")))) == []


def test_sections_by_a_gate_and_by_its_absence():
    gate, test = T.do(T.this_call("checkRequiredCredentials")), T.binary("===", T.ident("api"), T.lit("private"))
    assert list(SG.authenticated_sections(program(T.method("sign", T.when(test, gate))))) == [("Own", "private")]
    assert list(SG.authenticated_sections(program(T.method("sign", T.when(test), otherwise_gate(gate, test))))) == []
    assert list(SG.authenticated_sections(program(T.method("other")))) == []


def otherwise_gate(gate, test):
    # Without a described api nothing follows from a gate in the else branch.
    return T.when(test, otherwise=T.block(gate))


def test_recipes_trace_names_and_admit_what_they_cannot():
    two = T.method("sign", T.const("a", T.this_call("hmac", T.ident("x"))), T.const("b", T.this_call("rsa", T.ident("x"))))
    assert [r[-1] for r in SG.sign_recipe(program(two))] == ["ambiguous_ast"]
    assert [r[-1] for r in SG.sign_recipe(program(T.method("other")))] == ["no_sign_method"]
    loop = T.method("sign", T.const("p", T.ident("p")), T.const("s", T.this_call("hmac", T.ident("p"))))
    assert [r[3] for r in SG.sign_recipe(program(loop))] == ["p"]


def test_endpoint_costs():
    tree = {"a": {"get": {"x/{id}": {"cost": "no", "ax": 1}, "y": True}, "delete": ["z", 5]}, "get": {"top": 2}}
    assert list(SG.endpoint_tree(tree)) == [
        ("a", "get", "x/{id}", "id", None, '{"ax": 1}'), ("a", "get", "y", "", None, None), ("a", "delete", "z", "", 1.0, None), ("", "get", "top", "", 2.0, None),
    ]
    assert list(SG.endpoint_tree([])) == []


def test_doc_comments():
    assert SH.doc_tags("/**\n * free text\n * @param {a|b} [x] is x\n *   goes on\n * @throws {E}\n */") == [("description", None, "free text"), ("param", "a|b", "[x] is x goes on"), ("throws", "E", "")]
    assert SH.doc_tags("/** */") == []


def test_broadcasts_reach_over_cycles():
    a = T.method("withdraw", T.ret(T.this_call("b")), asynchronous=True)
    b, c = T.method("b", T.ret(T.this_call("c"))), T.method("c", T.do(T.this_call("b")), T.ret(T.this_call("signEIP712")))
    assert list(SH.raw_broadcast(program(a, b, c))) == [("Own", "", False, "withdraw", "signEIP712")]
    assert list(SH.raw_broadcast(program(b))) == []


def test_projections_of_odd_values():
    assert list(SH.currencies({"currencies": {"A": None, "B": {"networks": 5}}})) == [("A", "{}"), ("B", '{"networks":{}}')]
    assert list(SH.currencies(None)) == [] and list(SH.test_hosts(7)) == [("none", None, None, "no_testnet_data")]
    assert list(SH.key_paths("send")({"a": {"b": ["SendX", {"c": 1}]}, "send": {"x": 1}, "sendY": 2})) == [("sendY", "sendY"), ("a.b.SendX", "aBSendX")]


@pytest.mark.parametrize("name", sorted(A.DERIVATIONS))
def test_documents_without_content(spark, name):
    df = spark.createDataFrame([("a", None, 1), ("b", "", 1), ("c", "{", 1), ("d", "[]", 1)], "id string, ast string, status int")
    got = {r.id: r.status for r in A.derive(df, name).select("id", "status").collect()}
    assert got["a"] == got["b"] == "skip" and got["c"] == "error" and got.get("d", "none") in ("none", "error", "ok")
    assert A.derive(df.limit(0), name).collect() == []


def test_sections_records_and_bindings(spark):
    e = spark.createDataFrame([("a", "spot.private", "get", "x", ""), ("b", "p", "get", "y", "")], "id string, section string, verb string, path string, params string")
    s = spark.createDataFrame([("a", "spot"), ("a", "spot.p"), ("c", "spot")], "id string, section string")
    got = {(r.id, r.section): (r.status, r.path) for r in SG.section_endpoints(e, s).collect()}
    assert got == {("a", "spot"): ("ok", "x"), ("a", "spot.p"): ("section_not_in_api", None), ("c", "spot"): ("no_describe_api", None)}
    own = spark.createDataFrame([("a", "spot", "E"), ("z", "old", "E")], "id string, section string, record string")
    derived = spark.createDataFrame([("a", "spot", "D"), ("a", "spot.p", "D")], "id string, section string, record string")
    assert {tuple(r) for r in SG.synced_records(s.unionByName(s), own, derived).collect()} == {
        ("a", "spot", "E", "existing", None), ("a", "spot.p", "D", "derived", None), ("c", "spot", None, "default", "not_yet_derived"),
    }
    b = spark.createDataFrame([("a", 0, ["x"], None), ("a", 1, None, None), ("b", 0, ["x"], "bad"), ("c", None, None, None)], "id string, position int, axes array<string>, reason string")
    assert {tuple(r) for r in SG.cost_bindings(b).collect()} == {("a", 0, "x"), ("b", None, None), ("c", None, None)}


def test_json_templates_escape_nothing_but_names(spark):
    row = spark.createDataFrame([("q",), (None,)], "x string").select(T.column(T.obj(a=T.lit("@x@ and @y@")), x="x").alias("t")).collect()
    assert [json.loads(r.t)["properties"][0]["value"]["value"] for r in row] == ["q and @y@", " and @y@"]
