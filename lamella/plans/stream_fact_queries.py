"""Facts on stream classes, from files that are made of the class table's rows, resolved along the hierarchy.

No parser is at hand: the file of a stream class takes the shapes of its methods from the
length of its name (``a``, four shapes) and its method count (``b``, three shapes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.operators import ast as A
from lamella.operators import ast_streams  # noqa: F401  (registers its derivations)
from lamella.operators import resolve as R
from lamella.plans import tree_text as T
from lamella.plans.runtime import durable, read_table
from lamella.plans.spec_queries import CHAIN_SQL, class_edges

_KLINE, _TRADE, _MESSAGE = T.member(T.this(), "handleOHLCV"), T.member(T.this(), "handleTrades"), T.ident("message")
_EQ = lambda name, value: T.binary("===", T.ident(name), T.lit(value))
_READ = lambda key: T.this_call("safeString", _MESSAGE, T.lit(key))
_HANDLED = lambda name: T.do(T.this_call(name, T.ident("client"), _MESSAGE))
_BOOK = T.ident("orderbook")


def stream_files(spark: SparkSession, d: str) -> DataFrame:
    """(id, ast, a, b): one file per stream class, of its greatest row."""
    t = read_table(spark, d, "class_hierarchy").where("class_type = 'ws' and class_name is not null").groupBy("node_key").agg(
        F.max("class_name").alias("name"), F.max("extends_raw").alias("parent"), F.max(F.coalesce("method_count", F.lit(0))).alias("n"), F.max("methods").alias("methods"),
    )
    t = t.withColumns({"a": F.length("name") % 4, "b": F.col("n") % 3})
    a, b, c = F.col("a"), F.col("b"), lambda *m: T.column(T.method(*m), id="name")
    ping = T.choose(a, None, c("ping", T.ret(T.lit("ping @id@"))), c("ping", T.ret(T.obj(op=T.lit("ping")))), c("ping", T.ret(T.this_call("pingMessage"))))
    alive = lambda n: c("describe", T.ret(T.this_call("deepExtend", T.call(T.member(T.ident("super"), "describe")), T.obj(streaming=T.obj(keepAlive=T.lit(n))))))
    describe = T.choose(b, None, alive(15000), alive(20000))
    pong = T.choose(b, None, c("handlePong", T.ret(_MESSAGE)), None)
    sign_in = T.choose(
        a, None,
        c("authenticate", T.const("operation", T.lit("login")), T.const("key", T.member(T.this(), "apiKey")), T.const("sig", T.this_call("hmac", T.member(T.this(), "secret"))),
          T.const("request", T.obj(op=T.ident("operation"), args=T.ident("sig"))), T.ret(T.this_call("watch", T.ident("url"), T.ident("request")))),
        c("authenticate", T.const("key", T.member(T.this(), "apiKey")), T.const("listenKey", T.this_call("safeString", T.ident("options"), T.lit("listenKey"))), T.ret(T.ident("listenKey"))),
        c("authenticate", T.ret(T.lit(None))),
    )
    envelope = T.choose(
        b, None, c("subscribePublic", T.ret(T.this_call("watch", T.obj(op=T.lit("subscribe"), args=T.ident("topics"))))),
        c("subscribePublic", T.const("verb", T.lit("SUBSCRIBE")), T.do(T.this_call("watch", T.obj(method=T.ident("verb"), params=T.ident("topics")))), T.ret(T.this_call("watch", T.obj(method=T.lit("UNSUBSCRIBE"), params=T.ident("topics"))))),
    )
    watch = lambda m: T.choose(
        a, T.column(T.method("@m@", T.const("topic", T.binary("+", T.binary("+", T.lit("book."), T.indexed(T.ident("market"), T.lit("id"))), T.lit(".raw")))), m=m),
        T.column(T.method("@m@", T.ret(T.obj(channel=T.lit("tick @m@"), instType=T.ident("kind")))), m=m),
        T.column(T.method("@m@", T.const("name", T.this_call("safeString", T.ident("options"), T.lit("name"), T.lit("deal"))), T.ret(T.binary("+", T.binary("+", T.lit("kline."), T.ident("symbol")), T.ident("timeframe")))), m=m),
        T.column(T.method("@m@", T.ret(T.binary("+", T.ident("topic"), T.lit(".x")))), m=m),
    )
    routed = {"type": "ObjectExpression", "properties": [T.prop(T.lit("kline"), _KLINE), T.prop(T.lit("trade"), _TRADE), T.prop(T.ident("x"), _TRADE, True), T.prop(T.ident("pong"), T.lit(1)), {"type": "SpreadElement", "argument": T.ident("more")}]}
    routes = T.choose(
        b, c("handleMessage", T.const("methods", routed)),
        c("handleMessage", T.const("topic", _READ("topic")), T.when(_EQ("topic", "kline"), _HANDLED("handleOHLCV"), otherwise=T.when(T.binary("||", _EQ("topic", "deal"), _EQ("topic", "trade")), _HANDLED("handleTrades")))),
        c("handleMessage", {"type": "SwitchStatement", "discriminant": _READ("e"), "cases": [{"type": "SwitchCase", "test": T.lit("tick"), "consequent": [_HANDLED("handleTicker")]}, {"type": "SwitchCase", "test": None, "consequent": []}]}),
    )
    routes = F.when(a == 3, c("handleMessage", T.ret(_MESSAGE))).otherwise(routes)
    book = T.choose(
        a, None,
        c("handleOrderBook", T.const("type", _READ("type")), T.const("u", T.this_call("safeInteger", _MESSAGE, T.lit("u"))), T.const("first", T.this_call("safeInteger2", _MESSAGE, T.lit("U"), T.lit("ts"))),
          T.when(_EQ("type", "snapshot"), T.do(T.call(T.member(_BOOK, "reset"), T.ident("snapshot"))), otherwise=T.when(_EQ("type", "delta"), T.do(T.this_call("handleDeltas", _BOOK))))),
        c("handleOrderBook", T.do(T.call(T.member(_BOOK, "reset"), _MESSAGE)), T.const("sum", T.this_call("safeInteger", _MESSAGE, T.lit("checksum")))),
        c("handleOrderBook", T.ret(_MESSAGE)),
    )
    limit = lambda field: T.this_call("safeInteger", T.member(T.this(), "options"), T.lit(field), T.lit(1000))
    trades = T.choose(
        b, c("handleTrades", T.const("limit", limit("tradesLimit")), T.const("stored", T.new("ArrayCache", T.ident("limit"))), T.const("id", T.this_call("safeString", T.ident("trade"), T.lit("tradeId"))), T.do(T.call(T.member(T.ident("stored"), "append"), T.ident("trade")))),
        c("handleTrades", T.do(T.call(T.member(T.ident("stored"), "clear")))), c("handleMyTrades", T.const("stored", T.new("ArrayCacheBySymbolById"))),
    )
    cache = lambda kind: c("handleOHLCV", T.const("stored", T.new(kind, limit("OHLCVLimit"))), T.const("frame", _READ("interval")), T.const("done", _READ("confirm")))
    candles = T.choose(a % 2, cache("ArrayCacheByTimestamp"), cache("ArrayCache"))
    watched = F.transform(F.filter(F.coalesce("methods", F.array().cast("array<string>")), lambda m: m.startswith("watch")), watch)
    members = F.concat(F.array(ping, describe, pong, sign_in, envelope, routes, book, trades, candles), F.array_distinct(watched))
    return t.select(F.col("node_key").alias("id"), T.class_file(members, F.col("name"), F.col("parent")).alias("ast"), "a", "b")


def _facts(spark: SparkSession, d: str, name: str) -> DataFrame:
    return A.derive(stream_files(spark, d), name).where("status = 'ok'")


def _counted(facts: DataFrame, *columns: str) -> DataFrame:
    return facts.groupBy(*columns).agg(F.count("*").alias("n"))


def stream_heartbeat(spark, d):
    """Ping and keep-alive interval of each class of the hierarchy: its own, those of the nearest ancestor that states any, or the base client's (row 139)."""
    facts = durable(_facts(spark, d, "heartbeat"))
    edges = durable(class_edges(spark, d))
    kind = R.nearest_value(edges, facts.where("ping_kind is not null").select(F.col("id").alias("node"), F.col("ping_kind").alias("value")), F.lit("native_frame"))
    alive = R.nearest_value(edges, facts.where("keep_alive is not null").select(F.col("id").alias("node"), F.col("keep_alive").alias("value")), F.lit(30000))
    return kind.select("node", F.col("value").alias("ping_kind"), F.col("origin").alias("ping_from")).join(
        alive.select("node", F.col("value").cast("long").alias("keep_alive"), F.col("origin").alias("keep_alive_from")), "node"
    )


def stream_heartbeat_facts(spark, d):
    """What the files themselves say (row 139)."""
    return _counted(_facts(spark, d, "heartbeat"), "ping_kind", "has_pong", "keep_alive", "reason")


def stream_sign_in(spark, d):
    """Row 140."""
    return _counted(_facts(spark, d, "sign_in"), "mechanism", "discriminant", "operation", "credentials", "reason")


def stream_sign_in_from(spark, d):
    """The class whose ``authenticate`` holds for each class of the hierarchy (row 140)."""
    facts = _facts(spark, d, "sign_in").select(F.col("id").alias("node"), F.col("mechanism").alias("value"))
    return R.nearest_value(class_edges(spark, d), facts, F.lit("none")).select("node", F.col("value").alias("mechanism"), "origin")


def stream_envelopes(spark, d):
    """Row 141."""
    return _counted(_facts(spark, d, "envelopes"), "discriminant", "subscribe_op", "unsubscribe_op", "args_key")


def stream_channels(spark, d):
    """Row 141."""
    return _counted(_facts(spark, d, "channels"), "method", "template")


def stream_dispatch(spark, d):
    """Row 142."""
    return _counted(_facts(spark, d, "dispatch"), "channel", "handler", "via", "reason")


def stream_order_books(spark, d):
    """Row 143."""
    return _counted(_facts(spark, d, "order_books"), "apply_mode", "discriminator", "snapshot", "delta", "sequence_fields", "checksum_key", "reason")


def stream_trades(spark, d):
    """Row 144."""
    return _counted(_facts(spark, d, "trades"), "own", "update_model", "cache", "dedup_key", "limit_field", "limit_default", "reason")


def stream_candles(spark, d):
    """Row 145."""
    return _counted(_facts(spark, d, "candles"), "update_model", "timeframe_key", "closed_signal", "cache", "limit_field", "limit_default", "reason")


QUERIES = {f.__name__: f for f in (
    stream_heartbeat, stream_heartbeat_facts, stream_sign_in, stream_sign_in_from, stream_envelopes, stream_channels, stream_dispatch, stream_order_books, stream_trades, stream_candles,
)}
_F = """files AS (SELECT node_key, length(name) % 4 AS a, n % 3 AS b, methods FROM (
  SELECT node_key, max(class_name) AS name, max(coalesce(method_count, 0)) AS n, max(methods) AS methods FROM class_hierarchy WHERE class_type = 'ws' AND class_name IS NOT NULL GROUP BY 1))"""
_NEAREST = """(SELECT node, arg_min(struct_pack(v := {0}, o := CASE WHEN distance = 0 THEN 'self' ELSE ancestor END), distance) AS f FROM chain JOIN facts ON facts.node_key = ancestor WHERE {0} IS NOT NULL GROUP BY node)"""
_FACTS = "facts AS (SELECT node_key, CASE a WHEN 1 THEN 'string_message' WHEN 2 THEN 'json_message' WHEN 3 THEN 'unknown' END AS kind, CASE b WHEN 1 THEN 15000 WHEN 2 THEN 20000 END AS alive, CASE a WHEN 1 THEN 'sign_in_message' WHEN 2 THEN 'url_param' WHEN 3 THEN 'unknown' END AS mechanism FROM files)"
SQL = {
    "stream_heartbeat": f"""WITH RECURSIVE {CHAIN_SQL}, {_F}, {_FACTS}, k AS {_NEAREST.format('kind')}, s AS {_NEAREST.format('alive')}
SELECT e.node, coalesce(k.f.v, 'native_frame') AS ping_kind, coalesce(k.f.o, 'default') AS ping_from, coalesce(s.f.v, 30000)::BIGINT AS keep_alive, coalesce(s.f.o, 'default') AS keep_alive_from
FROM edges e LEFT JOIN k ON k.node = e.node LEFT JOIN s ON s.node = e.node""",
    "stream_heartbeat_facts": f"""WITH {_F}, {_FACTS} SELECT kind AS ping_kind, b = 1 AS has_pong, alive::BIGINT AS keep_alive, CASE WHEN a = 3 THEN 'ping_return_not_literal' END AS reason, count(*) AS n
FROM files JOIN facts USING (node_key) GROUP BY ALL""",
    "stream_sign_in": f"""WITH {_F} SELECT CASE a WHEN 1 THEN 'sign_in_message' WHEN 2 THEN 'url_param' ELSE 'unknown' END AS mechanism, CASE a WHEN 1 THEN 'op' END AS discriminant, CASE a WHEN 1 THEN 'login' END AS operation,
  CASE a WHEN 1 THEN 'apiKey,secret' WHEN 2 THEN 'apiKey' ELSE '' END AS credentials, CASE a WHEN 3 THEN 'auth_not_classifiable' END AS reason, count(*) AS n FROM files WHERE a > 0 GROUP BY ALL""",
    "stream_sign_in_from": f"""WITH RECURSIVE {CHAIN_SQL}, {_F}, {_FACTS}, k AS {_NEAREST.format('mechanism')}
SELECT e.node, coalesce(k.f.v, 'none') AS mechanism, coalesce(k.f.o, 'default') AS origin FROM edges e LEFT JOIN k ON k.node = e.node""",
    "stream_envelopes": f"""WITH {_F} SELECT CASE b WHEN 1 THEN 'op' ELSE 'method' END AS discriminant, CASE b WHEN 1 THEN 'subscribe' ELSE 'SUBSCRIBE' END AS subscribe_op, CASE b WHEN 2 THEN 'UNSUBSCRIBE' END AS unsubscribe_op,
  CASE b WHEN 1 THEN 'args' ELSE 'params' END AS args_key, count(*) AS n FROM files WHERE b > 0 GROUP BY ALL""",
    "stream_channels": f"""WITH {_F}, m AS (SELECT DISTINCT node_key, a, unnest(methods) AS method FROM files),
w AS (SELECT method, unnest(CASE a WHEN 0 THEN ['book.{{symbol}}.raw'] WHEN 1 THEN ['tick ' || method] WHEN 2 THEN ['deal', 'kline.{{symbol}}{{timeframe}}'] ELSE [] END) AS template FROM m WHERE starts_with(method, 'watch'))
SELECT method, template, count(*) AS n FROM w GROUP BY ALL""",
    "stream_dispatch": f"""WITH {_F}, r AS (SELECT unnest(CASE WHEN a = 3 THEN [struct_pack(channel := NULL::VARCHAR, handler := NULL::VARCHAR, via := NULL::VARCHAR, reason := 'dispatch_not_classifiable')]
  WHEN b = 0 THEN [struct_pack(channel := 'kline', handler := 'handleOHLCV', via := 'map', reason := NULL), struct_pack(channel := 'trade', handler := 'handleTrades', via := 'map', reason := NULL),
    struct_pack(channel := NULL, handler := 'handleTrades', via := 'map', reason := 'computed_channel_key'), struct_pack(channel := 'pong', handler := NULL, via := 'map', reason := 'non_handler_value'), struct_pack(channel := NULL, handler := NULL, via := 'map', reason := 'spread_property')]
  WHEN b = 1 THEN [struct_pack(channel := 'kline', handler := 'handleOHLCV', via := 'if', reason := NULL), struct_pack(channel := 'deal', handler := 'handleTrades', via := 'if', reason := NULL), struct_pack(channel := 'trade', handler := 'handleTrades', via := 'if', reason := NULL)]
  ELSE [struct_pack(channel := 'tick', handler := 'handleTicker', via := 'switch', reason := NULL)] END, recursive := true) FROM files)
SELECT channel, handler, via, reason, count(*) AS n FROM r GROUP BY ALL""",
    "stream_order_books": f"""WITH {_F} SELECT CASE a WHEN 1 THEN 'both' WHEN 2 THEN 'replace' ELSE 'unknown' END AS apply_mode, CASE a WHEN 1 THEN 'type' END AS discriminator, CASE a WHEN 1 THEN 'snapshot' END AS snapshot, CASE a WHEN 1 THEN 'delta' END AS delta,
  CASE a WHEN 1 THEN 'U,u' ELSE '' END AS sequence_fields, CASE a WHEN 2 THEN 'checksum' END AS checksum_key, CASE a WHEN 3 THEN 'orderbook_not_classifiable' END AS reason, count(*) AS n FROM files WHERE a > 0 GROUP BY ALL""",
    "stream_trades": f"""WITH {_F} SELECT b = 2 AS own, CASE b WHEN 0 THEN 'append' WHEN 1 THEN 'replace' ELSE 'snapshot' END AS update_model, CASE b WHEN 0 THEN 'ArrayCache' WHEN 2 THEN 'ArrayCacheBySymbolById' END AS cache,
  CASE b WHEN 0 THEN 'tradeId' END AS dedup_key, CASE b WHEN 0 THEN 'tradesLimit' END AS limit_field, CASE b WHEN 0 THEN 1000 END::BIGINT AS limit_default, NULL::VARCHAR AS reason, count(*) AS n FROM files GROUP BY ALL""",
    "stream_candles": f"""WITH {_F} SELECT CASE WHEN a % 2 = 0 THEN 'replace_latest_then_append' ELSE 'unknown' END AS update_model, 'interval' AS timeframe_key, 'confirm' AS closed_signal, CASE WHEN a % 2 = 0 THEN 'ArrayCacheByTimestamp' ELSE 'ArrayCache' END AS cache,
  'OHLCVLimit' AS limit_field, 1000::BIGINT AS limit_default, CASE WHEN a % 2 = 1 THEN 'ohlcv_not_classifiable' END AS reason, count(*) AS n FROM files GROUP BY ALL""",
}
