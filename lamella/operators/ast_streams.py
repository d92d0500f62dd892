"""Facts on stream classes: heartbeat, sign-in, subscriptions, dispatch, order books, trades, candles.

Each derivation states what a class's own file says, and nothing of its parents; facts are
taken down the hierarchy by :func:`lamella.operators.resolve.inherited`. Shapes that are
not literal are ``unknown`` with a reason and are not guessed.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

from lamella.operators.ast import DERIVATIONS, Node, _bindings, literal, methods, property_name, this_call, walk

# Names that the derivations know.
PONG = ("pong", "handlePong", "handlePing")
CREDENTIALS = ("apiKey", "secret", "password", "uid", "privateKey", "walletAddress")
SENDERS = ("watch", "watchMultiple", "watchPrivate", "watchPublic", "send")
DISCRIMINANTS = ("op", "method", "event", "type", "action", "cmd", "command")
CARRIERS = ("args", "params", "channels", "topics")
CHANNEL_KEYS = ("channel", "topic", "name", "type", "instType")
SYMBOLS = ("symbol", "symbols", "symbolString")
MARKET_IDS = ("id", "lowercaseId", "uppercaseId", "baseId", "quoteId", "symbol", "marketId")
TIMEFRAMES = ("timeframe", "timeframeId", "interval", "rawTimeframe", "unfiedTimeframe")
BOOK_HANDLERS = ("handleOrderBook", "handleOrderBookMessage", "handleSnapshot", "handleChecksum", "checkOrderBookChecksum")
SNAPSHOT, DELTA = ("snapshot", "partial"), ("update", "delta", "change", "increment", "incremental")
SEQUENCE = (
    "U", "u", "pu", "fu", "lu", "seqId", "prevSeqId", "seq", "prevSeq", "nonce", "lastUpdateId", "sequence", "seqNum", "version", "changeId",
    "prevChangeId", "change_id", "prev_change_id", "first_update_id", "last_update_id",
)
CHECKSUM = ("checksum", "crc32", "crc")
INTEGERS = ("safeInteger", "safeInteger2", "safeIntegerProduct", "safeIntegerN", "safeInteger64")
LOOKUPS = ("safeString", "safeValue", "safeStringLower", "safeString2", "safeValue2")
TRADE_LIMITS = ("tradesLimit", "myTradesLimit")
CANDLE_CACHE, CANDLE_LIMIT = "ArrayCacheByTimestamp", "OHLCVLimit"
CANDLE_FRAMES, CANDLE_CLOSED = ("i", "interval"), ("confirm", "x", "closed")


def by_class(program: object) -> dict[str, dict[str, Node]]:
    """Functions of each class by method name; of equal names the first."""
    out: dict[str, dict[str, Node]] = {}
    for cls, _, name, fn in methods(program):
        out.setdefault(cls, {}).setdefault(name, fn)
    return out


def text_of(node: object, consts: dict[str, str]) -> str | None:
    """Text of a literal, or of a name bound to one."""
    ok, v = literal(node)
    if ok and isinstance(v, str):
        return v
    return consts.get(node.get("name")) if isinstance(node, dict) and node.get("type") == "Identifier" else None


def text_constants(fn: Node) -> dict[str, str]:
    return {n: v for n, inits in _bindings(fn).items() if len(inits) == 1 and (v := text_of(inits[0], {})) is not None}


def member_calls(fn: Node) -> Iterator[tuple[str, Node]]:
    """(name, call) of all calls of a member, whatever the object."""
    for n in walk(fn):
        if n.get("type") == "CallExpression" and (n.get("callee") or {}).get("type") == "MemberExpression":
            name = (n["callee"].get("property") or {}).get("name")
            if name:
                yield name, n


def safe_keys(fn: Node, names: tuple[str, ...]) -> Iterator[str]:
    """Literal keys that ``this.safe*`` calls read, in order."""
    for n in walk(fn):
        if this_call(n, names):
            for a in n.get("arguments", [])[1:]:
                ok, v = literal(a)
                if ok and isinstance(v, str):
                    yield v


def returned(fn: Node) -> object:
    found = [n.get("argument") for n in walk(fn) if n.get("type") == "ReturnStatement"]
    return found[-1] if found else None


def described(fns: dict[str, Node], key: str) -> object:
    """Literal value below a key of the object that ``describe`` returns."""
    if "describe" not in fns:
        return None
    value = returned(fns["describe"])
    if this_call(value, ("deepExtend", "extend")):
        value = value["arguments"][-1]
    for p in (value or {}).get("properties", []):
        if property_name(p) == key:
            ok, v = literal(p.get("value"))
            return v if ok else None
    return None


def heartbeat(program: object) -> Iterator[tuple]:
    """(class, ping_kind, payload, has_pong, keep_alive, reason); without a ``ping`` method the kind is null."""
    for cls, fns in by_class(program).items():
        kind = payload = reason = None
        if "ping" in fns:
            value = returned(fns["ping"])
            ok, v = literal(value)
            if ok and isinstance(v, str):
                kind, payload = "string_message", v
            elif isinstance(value, dict) and value.get("type") == "ObjectExpression":
                kind, payload = "json_message", json.dumps(v, sort_keys=True) if ok else None
            else:
                kind, reason = "unknown", "ping_return_not_literal"
        streaming = described(fns, "streaming")
        alive = streaming.get("keepAlive") if isinstance(streaming, dict) else None
        yield cls, kind, payload, any(p in fns for p in PONG), int(alive) if isinstance(alive, (int, float)) else None, reason


def sign_in(program: object) -> Iterator[tuple]:
    """(class, mechanism, discriminant, operation, credentials, reason) of ``authenticate``; a class without it has no row."""
    for cls, fns in by_class(program).items():
        fn = fns.get("authenticate")
        if fn is None:
            continue
        consts, message = text_constants(fn), None
        for n in walk(fn):
            if n.get("type") == "ObjectExpression" and message is None:
                for p in n.get("properties", []):
                    if property_name(p) in ("op", "method") and (v := text_of(p.get("value"), consts)) is not None:
                        message = (property_name(p), v)
                        break
        sends = any(name in SENDERS for name, _ in member_calls(fn))
        reads = {(n.get("property") or {}).get("name") for n in walk(fn) if n.get("type") == "MemberExpression" and (n.get("object") or {}).get("type") == "ThisExpression"}
        names = {n.get("name") for n in walk(fn) if n.get("type") == "Identifier"} | {literal(n)[1] for n in walk(fn) if literal(n)[0] and isinstance(literal(n)[1], str)}
        known = ",".join(c for c in CREDENTIALS if c in reads)
        if message and sends:
            yield cls, "sign_in_message", *message, known, None
        elif "listenKey" in names:
            yield cls, "url_param", None, None, known, None
        else:
            yield cls, "unknown", None, None, known, "auth_not_classifiable"


def envelopes(program: object) -> Iterator[tuple]:
    """(class, discriminant, subscribe, unsubscribe, args_key): the first object of a class that holds a subscribe verb, and its counterpart."""
    for cls, fns in by_class(program).items():
        found: dict[str, tuple] = {}
        for fn in fns.values():
            consts = text_constants(fn)
            for n in walk(fn):
                if n.get("type") != "ObjectExpression":
                    continue
                keys = [property_name(p) for p in n.get("properties", [])]
                for p in n.get("properties", []):
                    v = text_of(p.get("value"), consts)
                    if property_name(p) in DISCRIMINANTS and v and v.lower() in ("subscribe", "unsubscribe"):
                        found.setdefault(v.lower(), (property_name(p), v, next((k for k in keys if k in CARRIERS), None)))
        if found:
            first = found.get("subscribe") or found["unsubscribe"]
            yield cls, first[0], found.get("subscribe", (None, None))[1], found.get("unsubscribe", (None, None))[1], first[2]


def template(node: object, consts: dict[str, str]) -> str | None:
    """Text of a concatenation of literals, symbols and timeframes; null where a part is neither."""
    if not isinstance(node, dict):
        return None
    if node.get("type") == "BinaryExpression" and node.get("operator") == "+":
        a, b = template(node["left"], consts), template(node["right"], consts)
        return None if a is None or b is None else a + b
    if node.get("type") == "ParenthesizedExpression":
        return template(node["expression"], consts)
    if (v := text_of(node, consts)) is not None:
        return v
    if node.get("type") == "Identifier":
        return "{symbol}" if node["name"] in SYMBOLS else "{timeframe}" if node["name"] in TIMEFRAMES else None
    if node.get("type") == "MemberExpression":
        ok, key = literal(node.get("property")) if node.get("computed") else (True, (node.get("property") or {}).get("name"))
        return "{symbol}" if ok and key in MARKET_IDS else None
    return None


def channels(program: object) -> Iterator[tuple]:
    """(class, method, template): distinct channel names of ``watch*`` methods, from concatenations, channel properties and look-up defaults."""
    for cls, fns in by_class(program).items():
        for name, fn in fns.items():
            if not (name.startswith("watch") and name[5:6].isupper()):
                continue
            consts, found, inner = text_constants(fn), set(), set()
            for n in walk(fn):
                if n.get("type") == "BinaryExpression" and n.get("operator") == "+":
                    if id(n) not in inner and (t := template(n, consts)) is not None:
                        found.add(t)
                    todo = [n["left"], n["right"]]
                    while todo:
                        x = todo.pop()
                        if isinstance(x, dict) and x.get("type") == "BinaryExpression":
                            inner.add(id(x))
                            todo += [x["left"], x["right"]]
                if n.get("type") in ("Property", "ObjectProperty") and property_name(n) in CHANNEL_KEYS and (v := text_of(n.get("value"), consts)) is not None:
                    found.add(v)
                if this_call(n, ("safeString", "handleOptionAndParams")):
                    args = [literal(a)[1] if literal(a)[0] else None for a in n.get("arguments", [])]
                    found |= {b for a, b in zip(args, args[1:]) if a in ("channel", "name", "topic") and isinstance(b, str)}
            yield from ((cls, name, t) for t in sorted(found))


def handler_of(node: object) -> str | None:
    """``handle*`` method that a node refers to or calls on ``this``."""
    if isinstance(node, dict) and node.get("type") == "CallExpression":
        node = node.get("callee")
    if isinstance(node, dict) and node.get("type") == "MemberExpression" and (node.get("object") or {}).get("type") == "ThisExpression":
        name = (node.get("property") or {}).get("name") or ""
        return name if name.startswith("handle") else None
    return None


def dispatch(program: object) -> Iterator[tuple]:
    """(class, channel, handler, via, reason): what ``handleMessage`` routes where, by a map of handlers, an if chain or a switch.

    Entries that are not literal have no channel or handler but a reason; a
    ``handleMessage`` without any entry has one row ``dispatch_not_classifiable``.
    """
    for cls, fns in by_class(program).items():
        fn = fns.get("handleMessage")
        if fn is None:
            continue
        out: set[tuple] = set()
        for n in walk(fn):
            if n.get("type") == "ObjectExpression":
                props = n.get("properties", [])
                if not any(handler_of(p.get("value")) for p in props if p.get("type") in ("Property", "ObjectProperty")):
                    continue
                for p in props:
                    if p.get("type") not in ("Property", "ObjectProperty"):
                        out.add((None, None, "map", "spread_property"))
                    elif property_name(p) is None:
                        out.add((None, handler_of(p.get("value")), "map", "computed_channel_key"))
                    else:
                        h = handler_of(p.get("value"))
                        out.add((property_name(p), h, "map", None if h else "non_handler_value"))
            elif n.get("type") == "IfStatement":
                names = [v for c in walk(n["test"]) if c.get("type") == "BinaryExpression" and c.get("operator") == "===" for side in ("left", "right") if literal(c[side])[0] and isinstance(v := literal(c[side])[1], str)]
                called = [h for c in walk(n.get("consequent")) if c.get("type") == "CallExpression" and (h := handler_of(c))]
                if called:
                    out |= {(v, called[0], "if", None) for v in names}
            elif n.get("type") == "SwitchCase" and n.get("test") is not None and literal(n["test"])[0]:
                called = [h for s in n.get("consequent", []) for c in walk(s) if c.get("type") == "CallExpression" and (h := handler_of(c))]
                if called:
                    out.add((str(literal(n["test"])[1]), called[0], "switch", None))
        rows = sorted(out, key=lambda r: tuple(x or "" for x in r)) or [(None, None, None, "dispatch_not_classifiable")]
        yield from ((cls, *r) for r in rows)


def order_books(program: object) -> Iterator[tuple]:
    """(class, apply_mode, discriminator, snapshot, delta, sequence_fields, checksum_key, reason) of the order book handlers.

    The discriminator is the key that is read into what is compared with snapshot and
    delta words most often; of equals the least name.
    """
    for cls, fns in by_class(program).items():
        bodies = [fns[h] for h in BOOK_HANDLERS if h in fns]
        if not any(h in fns for h in BOOK_HANDLERS[:2]):
            continue
        hits: Counter = Counter()
        words: dict[str, set[str]] = {}
        integers, checks, calls_, crc = set(), set(), set(), False
        for fn in bodies:
            keys = {}
            for name, inits in _bindings(fn).items():
                if len(inits) == 1 and this_call(inits[0], LOOKUPS) and len(inits[0].get("arguments", [])) > 1 and literal(inits[0]["arguments"][1])[0]:
                    keys[name] = str(literal(inits[0]["arguments"][1])[1])
            for n in walk(fn):
                if n.get("type") == "BinaryExpression" and n.get("operator") in ("===", "==", "!=="):
                    for a, b in ((n["left"], n["right"]), (n["right"], n["left"])):
                        v = literal(b)[1] if literal(b)[0] else None
                        if a.get("name") in keys and v in SNAPSHOT + DELTA:
                            hits[keys[a["name"]]] += 1
                            words.setdefault(keys[a["name"]], set()).add(v)
            integers |= {k for k in safe_keys(fn, INTEGERS) if k in SEQUENCE}
            checks |= {k for k in safe_keys(fn, LOOKUPS + INTEGERS) if k in CHECKSUM}
            calls_ |= {name for name, _ in member_calls(fn)}
            crc = crc or "crc32" in calls_
        deltas, resets = "handleDeltas" in calls_ or "handleDelta" in calls_, "reset" in calls_ or "orderBook" in calls_
        mode = "both" if deltas and resets else "incremental" if deltas else "replace" if resets else "unknown"
        key = min(hits, key=lambda k: (-hits[k], k)) if hits else None
        pick = lambda vocabulary: next((w for w in vocabulary if key and w in words[key]), None)
        yield (
            cls, mode, key, pick(SNAPSHOT), pick(DELTA), ",".join(sorted(integers)), min(checks) if checks else "crc32" if crc else None,
            "orderbook_not_classifiable" if mode == "unknown" else None,
        )


def _limit(fn: Node, fields: tuple[str, ...]) -> tuple[str | None, int | None]:
    for n in walk(fn):
        if this_call(n, INTEGERS) and len(n.get("arguments", [])) > 1:
            ok, key = literal(n["arguments"][1])
            if ok and key in fields:
                ok, default = literal(n["arguments"][2]) if len(n["arguments"]) > 2 else (False, None)
                return key, default if ok and isinstance(default, int) else None
    return None, None


def _caches(fn: Node) -> list[str]:
    return [n["callee"]["name"] for n in walk(fn) if n.get("type") == "NewExpression" and (n.get("callee") or {}).get("name", "").startswith("ArrayCache")]


def trades(program: object) -> Iterator[tuple]:
    """(class, own, update_model, cache, dedup_key, limit_field, limit_default, reason) of trade handlers; ``own`` for those of one's own trades."""
    for cls, fns in by_class(program).items():
        for own, names in ((False, ("handleTrade", "handleTrades")), (True, ("handleMyTrade", "handleMyTrades"))):
            fn = next((fns[n] for n in names if n in fns), None)
            if fn is None:
                continue
            called, caches = {name for name, _ in member_calls(fn)}, _caches(fn)
            model = "append" if "append" in called else "replace" if called & {"reset", "clear"} else "snapshot" if caches else "unknown"
            key = next((k for k in safe_keys(fn, ("safeString", "safeString2")) if k.lower().endswith("id") or k in ("i", "t")), None)
            yield cls, own, model, caches[0] if caches else None, key, *_limit(fn, TRADE_LIMITS), "trades_not_classifiable" if model == "unknown" else None


def candles(program: object) -> Iterator[tuple]:
    """(class, update_model, timeframe_key, closed_signal, cache, limit_field, limit_default, reason) of ``handleOHLCV``."""
    for cls, fns in by_class(program).items():
        fn = fns.get("handleOHLCV")
        if fn is None:
            continue
        caches, keys = _caches(fn), list(safe_keys(fn, LOOKUPS + ("safeBool", "safeInteger")))
        model = "replace_latest_then_append" if caches and caches[0] == CANDLE_CACHE else "unknown"
        pick = lambda vocabulary: next((k for k in keys if k in vocabulary), None)
        yield cls, model, pick(CANDLE_FRAMES), pick(CANDLE_CLOSED), caches[0] if caches else None, *_limit(fn, (CANDLE_LIMIT,)), "ohlcv_not_classifiable" if model == "unknown" else None


DERIVATIONS |= {
    "heartbeat": (heartbeat, "class string, ping_kind string, payload string, has_pong boolean, keep_alive long, reason string"),
    "sign_in": (sign_in, "class string, mechanism string, discriminant string, operation string, credentials string, reason string"),
    "envelopes": (envelopes, "class string, discriminant string, subscribe_op string, unsubscribe_op string, args_key string"),
    "channels": (channels, "class string, method string, template string"),
    "dispatch": (dispatch, "class string, channel string, handler string, via string, reason string"),
    "order_books": (order_books, "class string, apply_mode string, discriminator string, snapshot string, delta string, sequence_fields string, checksum_key string, reason string"),
    "trades": (trades, "class string, own boolean, update_model string, cache string, dedup_key string, limit_field string, limit_default long, reason string"),
    "candles": (candles, "class string, update_model string, timeframe_key string, closed_signal string, cache string, limit_field string, limit_default long, reason string"),
}
