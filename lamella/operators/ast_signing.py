"""How classes sign and shape requests: authenticated sections, signing recipes, body encodings, endpoint trees and costs."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.operators.ast import DERIVATIONS, Node, _bindings, literal, property_name, render, this_call, walk
from lamella.operators.ast_streams import by_class, described

# Calls and vocabularies of signing.
GATE = "checkRequiredCredentials"
JSON_BODY, FORM_BODY = ("json",), ("urlencode", "urlencodeNested", "urlencodeWithArrayRepeat", "rawencode")
CONTENT_TYPES = {"json": "application/json", "form_urlencoded": "application/x-www-form-urlencoded"}
CRYPTO = {"hmac": "hmac", "hash": "hash", "rsa": "rsa", "ecdsa": "ecdsa", "eddsa": "eddsa", "jwt": "jwt"}
TRANSFORMS = ("keysort", "omit", "extend", "urlencode", "urlencodeNested", "rawencode", "json", "encode", "stringToBase64", "base64ToBinary")
CLOCKS = {"nonce": "nonce", "milliseconds": "milliseconds", "seconds": "seconds", "microseconds": "microseconds", "iso8601": "iso8601"}
CREDENTIAL_HEADERS = {"apiKey": "api_key", "secret": "secret", "password": "password", "uid": "uid"}
VERBS = ("get", "post", "put", "delete", "patch")
RECIPE_FIELDS = ("crypto_op", "canonical_string", "signature_placement", "auth_headers", "nonce", "pre_sign_transforms")


def _calls(node: object, name: str) -> bool:
    return any(this_call(n) == name for n in walk(node))


def _compared(test: object, bound: dict[str, list[str]]) -> list[str]:
    """Section names that a condition tests: ``api === x``, ``api[n] === x``, or a name bound to such a comparison."""
    out: list[str] = []
    for n in walk(test):
        if n.get("type") == "BinaryExpression" and n.get("operator") in ("===", "=="):
            for a, b in ((n["left"], n["right"]), (n["right"], n["left"])):
                of = a.get("object") if a.get("type") == "MemberExpression" and a.get("computed") else a
                if isinstance(of, dict) and of.get("name") == "api" and literal(b)[0] and isinstance(literal(b)[1], str):
                    out.append(literal(b)[1])
        elif n.get("type") == "Identifier" and n.get("name") in bound:
            out += bound[n["name"]]
    return out


def authenticated_sections(program: object) -> Iterator[tuple]:
    """(class, section) for the sections of ``sign`` that a credentials gate guards.

    A gate in the branch of a condition proves the sections that it tests; a gate in the ``else``
    branch alone proves all sections of the described api but those. A child of an api section
    that is named like a proven section is one too (``parent.child``).
    """
    for cls, fns in by_class(program).items():
        fn = fns.get("sign")
        if fn is None:
            continue
        api = described(fns, "api")
        api = api if isinstance(api, dict) else {}
        bound = {n: c for n, inits in _bindings(fn).items() if len(inits) == 1 and (c := _compared(inits[0], {}))}
        found: set[str] = set()
        for n in walk(fn):
            if n.get("type") == "IfStatement" and (names := _compared(n["test"], bound)):
                if _calls(n.get("consequent"), GATE):
                    found.update(names)
                elif api and _calls(n.get("alternate"), GATE):
                    found.update(set(api) - set(names))
        nested = {f"{p}.{c}" for p, sub in api.items() if isinstance(sub, dict) for c in sub if c in found}
        yield from ((cls, s) for s in sorted(found | nested))


def _assignments(fn: Node) -> Iterator[tuple[Node, Node]]:
    for n in walk(fn):
        if n.get("type") == "AssignmentExpression":
            yield n["left"], n


def body_encoding(program: object) -> Iterator[tuple]:
    """(class, encoding, content_type, reason) of what ``sign`` assigns to ``body``; different encodings are ``ambiguous_body``."""
    for cls, fns in by_class(program).items():
        fn = fns.get("sign")
        if fn is None:
            yield cls, None, None, "no_sign_method"
            continue
        kinds = set()
        for left, n in _assignments(fn):
            if left.get("name") == "body":
                c = this_call(n["right"])
                kinds.add("json" if c in JSON_BODY else "form_urlencoded" if c in FORM_BODY else None)
        kinds.discard(None)
        if len(kinds) > 1:
            yield cls, None, None, "ambiguous_body"
            continue
        kind = kinds.pop() if kinds else "none"
        stated = {literal(n.get("value"))[1] for n in walk(fn) if n.get("type") in ("Property", "ObjectProperty") and (property_name(n) or "").lower() == "content-type" and literal(n.get("value"))[0]}
        yield cls, kind, None if kind == "none" else stated.pop() if len(stated) == 1 else CONTENT_TYPES[kind], None


def _parts(node: object) -> list[str]:
    if isinstance(node, dict) and node.get("type") == "BinaryExpression" and node.get("operator") == "+":
        return _parts(node["left"]) + _parts(node["right"])
    return [json.dumps(literal(node)[1]) if literal(node)[0] else render(node)]


def sign_recipe(program: object) -> Iterator[tuple]:
    """(class, crypto_op, digest, canonical_string, signature_placement, auth_headers, nonce, pre_sign_transforms, reason) of ``sign``.

    One cryptographic call must make the signature; none leaves the recipe to a
    custom family, several with different operations are ambiguous. The canonical string is the list
    of parts that are signed, traced through names that are bound once.
    """
    for cls, fns in by_class(program).items():
        fn = fns.get("sign")
        if fn is None:
            yield (cls, *[None] * 7, "no_sign_method")
            continue
        found = [(CRYPTO[c], n) for n in walk(fn) if (c := this_call(n, CRYPTO))]
        signing = [f for f in found if f[0] != "hash"] or found
        if not signing:
            yield (cls, *[None] * 7, "custom_signing_family")
            continue
        if len({op for op, _ in signing}) > 1:
            yield (cls, *[None] * 7, "ambiguous_ast")
            continue
        op, made = signing[0]
        bound = {n: inits[0] for n, inits in _bindings(fn).items() if len(inits) == 1}
        args = made.get("arguments", [])
        payload, seen = (args[0] if args else None), set()
        while this_call(payload, ("encode",)) or (isinstance(payload, dict) and payload.get("name") in bound and payload["name"] not in seen):
            if payload.get("type") == "CallExpression":
                payload = (payload.get("arguments") or [None])[0]
            else:
                seen.add(payload["name"])
                payload = bound[payload["name"]]
        digest = next((render(a) for a in args[2:3]), None)
        names = {n for n, init in bound.items() if any(x is made for x in walk(init))}
        signed = lambda node: any(x is made or x.get("name") in names for x in walk(node))
        place, headers = None, {}
        for n in walk(fn):
            if n.get("type") == "AssignmentExpression" and signed(n["right"]):
                left = n["left"]
                if left.get("name") in ("query", "url", "path"):
                    place = place or "query"
                elif left.get("name") == "body":
                    place = place or "body"
                elif left.get("type") == "MemberExpression" and (left.get("object") or {}).get("name") == "headers":
                    key = literal(left["property"])[1] if left.get("computed") else left["property"].get("name")
                    place = place or f"header:{key}"
            if n.get("type") == "AssignmentExpression" and n["left"].get("name") == "headers" and isinstance(n["right"], dict):
                for p in n["right"].get("properties", []):
                    key, v = property_name(p), p.get("value") or {}
                    if key and signed(v):
                        place = place or f"header:{key}"
                    elif key and v.get("type") == "MemberExpression" and (v.get("object") or {}).get("type") == "ThisExpression" and v["property"].get("name") in CREDENTIAL_HEADERS:
                        headers[key] = CREDENTIAL_HEADERS[v["property"]["name"]]
        clock = next((CLOCKS[c] for n in walk(fn) if (c := this_call(n, CLOCKS))), None)
        changes: list[str] = []
        for n in walk(fn):
            if (c := this_call(n, TRANSFORMS)) and c not in changes:
                changes.append(c)
        text = "|".join(_parts(payload)) if payload is not None else None
        values = (op, digest, text, place, ",".join(f"{k}={v}" for k, v in sorted(headers.items())) or None, clock, ",".join(changes))
        yield (cls, *values, "not_yet_derived" if any(v is None for v in (text, place, values[4], clock)) else None)


def endpoint_tree(value: object) -> Iterator[tuple]:
    """(section, verb, path, params, cost, axes) of an api tree: verbs are leaves, sections above them join by dots.

    Costs follow the forms of an endpoint's configuration: a number; an object whose ``cost`` is 1 if
    absent and null if no number, all other keys being axes; a bare path costs 1; a
    function (a ``__function`` text) has none.
    """

    def row(section: str, verb: str, path: str, config: object, bare: bool) -> tuple:
        cost: object = None
        axes: dict = {}
        if bare:
            cost = 1
        elif isinstance(config, dict):
            cost = config.get("cost", 1)
            axes = {k: v for k, v in config.items() if k != "cost"}
        else:
            cost = config
        good = isinstance(cost, (int, float)) and not isinstance(cost, bool)
        params = ",".join(part.split("}", 1)[0] for part in path.split("{")[1:] if "}" in part)
        return section, verb, path, params, float(cost) if good else None, json.dumps(axes, sort_keys=True) if axes else None

    def down(node: object, section: tuple[str, ...]) -> Iterator[tuple]:
        if not isinstance(node, dict):
            return
        for key, child in node.items():
            if key in VERBS and isinstance(child, (dict, list)):
                pairs = child.items() if isinstance(child, dict) else ((c, None) for c in child if isinstance(c, str))
                for path, config in pairs:
                    yield row(".".join(section), key, path, config, isinstance(child, list))
            else:
                yield from down(child, (*section, key))

    yield from down(value, ())


def section_endpoints(endpoints: DataFrame, sections: DataFrame) -> DataFrame:
    """Endpoints of each section: (id, section, status, verb, path, params); ``section_not_in_api`` where its api lacks it, ``no_describe_api`` without any api.

    ``endpoints`` are rows of :func:`endpoint_tree` with their id, ``sections`` are (id, section). An endpoint
    belongs to a section if its own is that section or lies below it.
    """
    part = F.explode(F.sequence(F.lit(1), F.size(F.split("at", r"\."))))
    below = endpoints.select("id", F.col("section").alias("at"), "verb", "path", "params").withColumn("k", part).withColumn("section", F.array_join(F.slice(F.split("at", r"\."), 1, F.col("k")), ".")).drop("k", "at")
    has = endpoints.select("id").distinct().withColumn("has", F.lit(True))
    j = sections.join(below, ["id", "section"], "left").join(has, "id", "left")
    status = F.when(F.col("verb").isNotNull(), "ok").when(F.col("has"), "section_not_in_api").otherwise("no_describe_api")
    return j.select("id", "section", status.alias("status"), "verb", "path", "params")


def synced_records(sections: DataFrame, existing: DataFrame, derived: DataFrame, *, reason: str = "not_yet_derived") -> DataFrame:
    """One record per (id, section): the existing one, else the derived one, else none with ``reason``: (id, section, record, origin, reason).

    Records of sections that are not in ``sections`` go. ``existing`` and ``derived`` are (id, section, record), each at most once per key.
    """
    e = existing.select("id", "section", F.col("record").alias("__e"))
    d = derived.select("id", "section", F.col("record").alias("__d"))
    j = sections.select("id", "section").distinct().join(e, ["id", "section"], "left").join(d, ["id", "section"], "left")
    record = F.coalesce("__e", "__d")
    origin = F.when(F.col("__e").isNotNull(), "existing").when(F.col("__d").isNotNull(), "derived").otherwise("default")
    return j.select("id", "section", record.alias("record"), origin.alias("origin"), F.when(record.isNull(), reason).alias("reason"))


def cost_bindings(buckets: DataFrame) -> DataFrame:
    """What costs count against: (id, bucket_index, axes) of the first bucket of each id.

    ``buckets`` are (id, position, axes array, reason); null where the first bucket has no axes or any
    bucket of the id is unresolved. Ids without buckets must have one row with a null position.
    """
    first = F.min_by(F.struct("axes"), "position").alias("f")
    agg = buckets.groupBy("id").agg(first, F.count(F.when(F.col("reason").isNotNull(), 1)).alias("bad"))
    usable = (F.col("bad") == 0) & F.col("f.axes").isNotNull()
    return agg.select("id", F.when(usable, 0).alias("bucket_index"), F.when(usable, F.array_join("f.axes", ",")).alias("axes"))


DERIVATIONS |= {
    "authenticated_sections": (authenticated_sections, "class string, section string"),
    "body_encoding": (body_encoding, "class string, encoding string, content_type string, reason string"),
    "sign_recipe": (sign_recipe, "class string, crypto_op string, digest string, canonical_string string, signature_placement string, auth_headers string, nonce string, pre_sign_transforms string, reason string"),
    "endpoint_tree": (endpoint_tree, "section string, verb string, path string, params string, cost double, axes string"),
}
