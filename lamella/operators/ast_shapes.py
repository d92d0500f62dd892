"""Signatures, descriptors, raw broadcasts, parser digests and response envelopes; projections of described values."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.operators.ast import DERIVATIONS, Node, _bindings, _type_text, inventory, literal, methods, property_name, render, this_call, walk
from lamella.operators.ast_streams import by_class

# Helpers that broadcast signed payloads, builders of typed data, markers of signing libraries, parser types and their functions.
BROADCASTERS = ("signL1Action", "signUserSignedAction", "signEIP712", "starknetSign", "createSignedRequest")
TYPED_DATA = ("ethEncodeStructuredData", "hashTypedData")
LIBRARIES = ("noble-curves", "ethers", "starknet")
PARSERS = {
    "ticker": ("parseTicker", "parseTickers"), "trade": ("parseTrade", "parseTrades"), "ohlcv": ("parseOHLCV", "parseOHLCVs"), "order": ("parseOrder", "parseOrders"),
    "position": ("parsePosition", "parsePositions"), "balance": ("parseBalance",), "market": ("parseMarket", "parseMarkets"),
    "transaction": ("parseTransaction", "parseTransactions"), "deposit_address": ("parseDepositAddress", "parseDepositAddresses"),
}
UNWRAPS = ("safeList", "safeList2", "safeListN", "safeValue", "safeValue2", "safeValueN")
UNDEFINED, SANDBOX = "__undefined", "sandboxMode"


def _params(fn: Node) -> str:
    out = []
    for p in fn.get("params", []):
        inner = p.get("left") if p.get("type") == "AssignmentPattern" else p
        kind = _type_text(inner.get("typeAnnotation"))
        out.append((inner.get("name") or f"<{inner.get('type')}>") + ("?" if inner.get("optional") or inner is not p else "") + (f": {kind}" if kind else ""))
    return ", ".join(out)


def interface_signatures(program: object) -> Iterator[tuple]:
    """(interface, method, params, return_type) of the first interface of a file; of equal names the last."""
    for n in program.get("body", []) if isinstance(program, dict) else ():
        n = n.get("declaration") or n
        if n.get("type") == "TSInterfaceDeclaration":
            found = {m["key"]["name"]: m for m in (n.get("body") or {}).get("body", []) if m.get("type") == "TSMethodSignature" and (m.get("key") or {}).get("name")}
            for name, m in sorted(found.items()):
                yield (n.get("id") or {}).get("name"), name, _params(m), _type_text(m.get("returnType") or m.get("typeAnnotation"))
            return


_TAG = re.compile(r"^@(\w+)\s*(?:\{([^}]*)\})?\s*(.*)$")


def doc_tags(comment: str) -> list[tuple[str, str | None, str]]:
    """(tag, type in braces, text) of a doc comment; lines without a tag go on with the one before, those before any are its description."""
    out: list[list] = []
    for line in comment.strip().removeprefix("/**").removesuffix("*/").split("\n"):
        text = line.strip().removeprefix("*").strip()
        if hit := _TAG.match(text):
            out.append([hit.group(1), hit.group(2), hit.group(3).strip()])
        elif text and out:
            out[-1][2] = f"{out[-1][2]} {text}".strip()
        elif text:
            out.append(["description", None, text])
    return [tuple(t) for t in out]


def descriptors(document: object) -> Iterator[tuple]:
    """(class, method, params, return_type, description, params_doc, returns, errors, reason) of the public methods that return a promise.

    ``document`` holds ``ast`` and ``source``; nodes' offsets count bytes of the source. The doc comment is
    the one that ends right before the method. Without it the documented parts are null.
    """
    source = document.get("source", "").encode()
    starts = {id(n.get("value") or n): n.get("start") for n in walk(document.get("ast")) if n.get("type") in ("MethodDefinition", "ClassMethod") and not n.get("static")}
    for cls, _, name, fn in methods(document.get("ast")):
        if id(fn) not in starts or name.startswith("_") or _type_text(fn.get("returnType")) != "Promise":
            continue
        start = starts.get(id(fn))
        before = source[:start].rstrip() if isinstance(start, int) else b""
        at = before.rfind(b"/**") if before.endswith(b"*/") else -1
        base = (cls, name, _params(fn), "Promise")
        if at < 0:
            yield (*base, None, None, None, None, "no_jsdoc")
            continue
        tags = doc_tags(before[at:].decode(errors="replace"))
        texts = lambda tag: [(k, t) for n, k, t in tags if n == tag]  # noqa: B023, E731
        described = next((t for _, t in texts("description")), None)
        docs = {t.split(" ", 1)[0].strip("[]"): t.split(" ", 1)[1] if " " in t else "" for _, t in texts("param") if t}
        back = next((t for _, t in texts("returns")), None)
        yield (*base, described, json.dumps(docs, sort_keys=True), back, ",".join(k for k, _ in texts("throws") if k), None)


def raw_broadcast(program: object) -> Iterator[tuple]:
    """(class, imports, typed_data, method, helpers): asynchronous methods other than ``fetch*`` that lead to a broadcast helper.

    What a method reaches is its own helpers and those of the methods it calls, to the fixpoint. A class
    with markers but no such method has one row with a null method; one without any has none.
    """
    imports = sorted({lib for n in walk(program) if n.get("type") == "ImportDeclaration" for lib in LIBRARIES if lib in str((n.get("source") or {}).get("value"))})
    for cls, fns in by_class(program).items():
        called = {name: {c for n in walk(fn) if (c := this_call(n))} for name, fn in fns.items()}
        reach = {name: {c for c in cs if c in BROADCASTERS} for name, cs in called.items()}
        grown = True
        while grown:
            grown = False
            for name, cs in called.items():
                more = set().union(*(reach[c] for c in cs if c in reach)) - reach[name]
                if more:
                    reach[name] |= more
                    grown = True
        typed = any(this_call(n, TYPED_DATA) for fn in fns.values() for n in walk(fn))
        found = [(m, ",".join(sorted(h))) for m, h in sorted(reach.items()) if h and fns[m].get("async") and not m.startswith("fetch")]
        if found or imports or typed:
            yield from ((cls, ",".join(imports), typed, m, h) for m, h in found or [(None, None)])


def parser_digest(program: object) -> Iterator[tuple]:
    """(class, method, params, return_type, is_async, statements) of ``parse*`` methods."""
    for cls, _, name, is_async, params, kind, n in inventory(program):
        if name.startswith("parse") and name[5:6].isupper():
            yield cls, name, params, kind, is_async, n


def response_envelopes(program: object) -> Iterator[tuple]:
    """(class, parser, fetcher, key, fallback_keys, default_value, reason): how ``fetch*`` methods unwrap responses for their parsers.

    The first look-up of ``response`` whose result a parser gets names the key and its fall-backs; a parser that gets
    ``response`` itself has a null key, one that gets a member of it that member.
    """
    for cls, fns in by_class(program).items():
        for name, fn in fns.items():
            if not name.startswith("fetch"):
                continue
            bound = {n: inits[0] for n, inits in _bindings(fn).items() if len(inits) == 1}
            for parser, names in PARSERS.items():
                uses = [n for n in walk(fn) if this_call(n, names) and n.get("arguments")]
                if not uses:
                    continue
                data = uses[0]["arguments"][0]
                data = bound.get(data.get("name"), data) if isinstance(data, dict) and data.get("name") != "response" else data
                yield cls, parser, name, *_unwrapped(data)


def _unwrapped(data: object) -> tuple[str | None, str | None, str | None, str | None]:
    if isinstance(data, dict) and data.get("name") == "response":
        return None, "", None, None
    if isinstance(data, dict) and data.get("type") == "MemberExpression" and (data.get("object") or {}).get("name") == "response":
        key = literal(data["property"])[1] if data.get("computed") else data["property"].get("name")
        return key, "", None, None
    if not this_call(data, UNWRAPS):
        return None, None, None, "no_safe_value_call"
    args = data.get("arguments", [])
    if not args or args[0].get("name") != "response":
        inside = args and "response" in render(args[0])
        return None, None, None, "nested_response_unwrap" if inside else "no_safe_value_call"
    call = this_call(data)
    at = args[1]["elements"] if call.endswith("N") and len(args) > 1 and args[1].get("type") == "ArrayExpression" else args[1 : 3 if call.endswith("2") else 2]
    rest = args[2:] if call.endswith("N") else args[1 + len(at) :]
    keys = [literal(a) for a in at]
    if not keys or not all(ok and isinstance(k, str) for ok, k in keys):
        return None, None, None, "non_literal_key"
    default = literal(rest[0]) if rest else (False, None)
    return keys[0][1], ",".join(k for _, k in keys[1:]), json.dumps(default[1]) if default[0] else None, None


def _stripped(value: object) -> object:
    if isinstance(value, dict):
        return {k: _stripped(v) for k, v in value.items() if v != UNDEFINED}
    return [_stripped(v) for v in value] if isinstance(value, list) else value


def currencies(value: object) -> Iterator[tuple]:
    """(code, record): entries of ``currencies`` without ``info``, with ``networks`` (without theirs), sentinels dropped at all depths."""
    held = value.get("currencies") if isinstance(value, dict) else None
    for code, entry in held.items() if isinstance(held, dict) else ():
        entry = {k: v for k, v in entry.items() if k != "info"} if isinstance(entry, dict) else None
        if entry is not None:
            nets = entry.get("networks", {})
            entry["networks"] = {k: {a: b for a, b in n.items() if a != "info"} if isinstance(n, dict) else {} for k, n in nets.items()} if isinstance(nets, dict) else {}
        yield code, json.dumps(_stripped(entry or {}), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_hosts(value: object) -> Iterator[tuple]:
    """(pattern, urls, flag, reason): ``separate_host`` with the test addresses, ``sandbox_flag``, or ``none``."""
    value = value if isinstance(value, dict) else {}
    part = lambda k: value.get(k) if isinstance(value.get(k), dict) else {}
    urls, flag = part("urls").get("test"), SANDBOX if SANDBOX in part("options") else None
    if isinstance(urls, dict) and urls:
        host = value.get("hostname")
        text = json.dumps(urls, sort_keys=True, separators=(",", ":"))
        yield "separate_host", text.replace("{hostname}", host) if isinstance(host, str) else text, flag, None
    else:
        yield ("sandbox_flag", None, flag, None) if flag else ("none", None, None, "no_testnet_data")


def key_paths(prefix: str):
    """A derivation that finds scalar keys and list texts that begin with ``prefix`` in any case: (path, name), the name joined in camel case."""

    def search(value: object) -> Iterator[tuple]:
        todo: list[tuple[object, tuple[str, ...]]] = [(value, ())]
        while todo:
            node, path = todo.pop()
            hits = [x for x in node if isinstance(x, str)] if isinstance(node, list) else [k for k, v in node.items() if not isinstance(v, (dict, list))] if isinstance(node, dict) else []
            for h in hits:
                if h.lower().startswith(prefix.lower()):
                    full = (*path, h)
                    yield ".".join(full), full[0] + "".join(p[:1].upper() + p[1:] for p in full[1:])
            if isinstance(node, dict):
                todo += [(v, (*path, k)) for k, v in reversed(node.items()) if isinstance(v, (dict, list))]

    return search


def normalisation_records(ids: DataFrame, digest: DataFrame, fields: DataFrame, envelopes: DataFrame) -> DataFrame:
    """The normalisation block of each id by parser type: (id, parser, methods, fields, fetchers, reason).

    Counts of digest methods, mapped fields and fetchers; a parser type of an id without any is a stub with the
    reason ``not_yet_derived``. The sides are reduced to a row per id and parser before they meet.
    """
    of = F.when(F.lit(False), F.lit(None).cast("string"))
    for parser, names in PARSERS.items():
        of = of.when(F.col("method").isin(*names), parser)
    count = lambda df, name, key: df.withColumn("parser", key).where("parser is not null").groupBy("id", "parser").agg(F.count("*").alias(name))
    every = ids.select("id").distinct().select("id", F.explode(F.array(*[F.lit(p) for p in PARSERS])).alias("parser"))
    j = every
    for side in (count(digest, "methods", of), count(fields, "fields", of), count(envelopes, "fetchers", F.col("parser"))):
        j = j.join(side, ["id", "parser"], "left")
    none = F.col("methods").isNull() & F.col("fields").isNull() & F.col("fetchers").isNull()
    return j.select("id", "parser", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("methods", "fields", "fetchers")], F.when(none, "not_yet_derived").alias("reason"))


def dominant_suffix(rows: DataFrame, *, by: str, suffix: Column, threshold: float = 0.8) -> DataFrame:
    """Suffix that at least ``threshold`` of all rows of a group have (rows without one count too): (by, suffix, n, total); null if none has."""
    counts = rows.groupBy(by, suffix.alias("suffix")).agg(F.count("*").alias("n"))
    best = counts.groupBy(by).agg(F.sum("n").alias("total"), F.max(F.when(F.col("suffix").isNotNull(), F.struct("n", F.col("suffix").alias("s")))).alias("b"))
    good = F.coalesce(F.col("b.n") / F.col("total") >= threshold, F.lit(False))
    return best.select(by, F.when(good, F.col("b.s")).alias("suffix"), F.coalesce("b.n", F.lit(0)).alias("n"), "total")


DERIVATIONS |= {
    "interface_signatures": (interface_signatures, "interface string, method string, params string, return_type string"),
    "descriptors": (descriptors, "class string, method string, params string, return_type string, description string, params_doc string, returns string, errors string, reason string"),
    "raw_broadcast": (raw_broadcast, "class string, imports string, typed_data boolean, method string, helpers string"),
    "parser_digest": (parser_digest, "class string, method string, params string, return_type string, is_async boolean, statements long"),
    "response_envelopes": (response_envelopes, "class string, parser string, fetcher string, key string, fallback_keys string, default_value string, reason string"),
    "currencies": (currencies, "code string, record string"),
    "test_hosts": (test_hosts, "pattern string, urls string, flag string, reason string"),
    "sendtx_paths": (key_paths("sendtx"), "path string, name string"),
}
