"""Static analysis of ESTree documents: node rows and per-method derivations.

A document is the JSON of one source file. :func:`ast_nodes` turns it into rows for
joins; derivations that need the order of statements or the predicates around a node
run per document, vectorised over Arrow batches, and return flat rows.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Node = dict
# Fixed values.
SAFE_CALLS = ("safeString", "safeString2", "safeStringN", "safeNumber", "safeNumber2", "safeInteger", "safeInteger2", "safeTimestamp", "safeValue")
PAGINATION = {
    "fetchPaginatedCallDynamic": "dynamic", "fetchPaginatedCallDeterministic": "deterministic",
    "fetchPaginatedCallCursor": "cursor", "fetchPaginatedCallIncremental": "incremental",
}
THROWERS = {"throwExactlyMatchedException": "error_code", "throwBroadlyMatchedException": "error_message"}
VERBS = ("Get", "Post", "Put", "Delete", "Patch")
UNIFIED = ("fetch", "create", "cancel", "edit", "withdraw", "transfer", "set", "add", "reduce", "borrow", "repay", "close")


def children(node: Node) -> Iterator[tuple[str, int | None, Node]]:
    """Child nodes with their field and position, in source order of fields."""
    for name, value in node.items():
        if isinstance(value, dict) and "type" in value:
            yield name, None, value
        elif isinstance(value, list):
            for i, v in enumerate(value):
                if isinstance(v, dict) and "type" in v:
                    yield name, i, v


def walk(node: object) -> Iterator[Node]:
    """All nodes below and including one, parents first, in source order."""
    todo = [node] if isinstance(node, dict) else []
    while todo:
        n = todo.pop()
        yield n
        todo += [c for _, _, c in reversed(list(children(n)))]


def label(node: Node) -> str | None:
    """Name or literal of a leaf as text."""
    if "name" in node and isinstance(node["name"], str):
        return node["name"]
    return json.dumps(node["value"]) if node.get("type") in ("Literal", "StringLiteral", "NumericLiteral", "BooleanLiteral") else None


def this_call(node: object, names: Iterable[str] | None = None) -> str | None:
    """Method name of a ``this.name(...)`` call, if it is one (of ``names``)."""
    if not isinstance(node, dict) or node.get("type") != "CallExpression":
        return None
    callee = node.get("callee") or {}
    if callee.get("type") != "MemberExpression" or (callee.get("object") or {}).get("type") not in ("ThisExpression", "Super"):
        return None
    name = (callee.get("property") or {}).get("name")
    return name if name and (names is None or name in names) else None


def literal(node: object) -> tuple[bool, object]:
    """(whether it is literal all through, value)."""
    if not isinstance(node, dict):
        return False, None
    kind = node.get("type")
    if kind in ("TSAsExpression", "ParenthesizedExpression"):
        return literal(node.get("expression"))
    if kind and kind.endswith("Literal") and kind != "TemplateLiteral":
        return True, node.get("value")
    if kind == "UnaryExpression" and node.get("operator") == "-":
        ok, v = literal(node.get("argument"))
        return ok and isinstance(v, (int, float)), -v if ok and isinstance(v, (int, float)) else None
    if kind == "ArrayExpression":
        each = [literal(e) for e in node.get("elements", [])]
        return all(ok for ok, _ in each), [v for _, v in each]
    if kind == "ObjectExpression" and all(p.get("type") in ("Property", "ObjectProperty") for p in node.get("properties", [])):
        pairs = [(property_name(p), literal(p.get("value"))) for p in node["properties"]]
        return all(k is not None and v[0] for k, v in pairs), {k: v[1] for k, v in pairs}
    return False, None


def property_name(prop: Node) -> str | None:
    key = prop.get("key") or {}
    return None if prop.get("computed") else key.get("name") if key.get("type") == "Identifier" else str(key["value"]) if "value" in key else None


def render(node: object) -> str:
    """Compact source form of an expression; shapes without one are their type in brackets."""
    if not isinstance(node, dict):
        return ""
    kind = node.get("type", "")
    if kind in ("BinaryExpression", "LogicalExpression", "AssignmentExpression"):
        return f"{render(node['left'])} {node['operator']} {render(node['right'])}"
    if kind in ("MemberExpression", "OptionalMemberExpression"):
        return f"{render(node['object'])}[{render(node['property'])}]" if node.get("computed") else f"{render(node['object'])}.{render(node['property'])}"
    if kind == "CallExpression":
        return f"{render(node['callee'])}({', '.join(render(a) for a in node.get('arguments', []))})"
    if kind == "UnaryExpression":
        return f"{node['operator']}{render(node['argument'])}"
    if kind == "ThisExpression":
        return "this"
    if kind == "ParenthesizedExpression":
        return f"({render(node['expression'])})"
    own = label(node)
    return own if own is not None else f"<{kind}>"


def methods(program: object) -> Iterator[tuple[str, Node, str, Node]]:
    """(class name, class node, method name, function node) of every class in a file."""
    for node in walk(program):
        if node.get("type") in ("ClassDeclaration", "ClassExpression"):
            name = (node.get("id") or {}).get("name") or ""
            for m in (node.get("body") or {}).get("body", []):
                if m.get("type") in ("MethodDefinition", "ClassMethod"):
                    key = property_name(m)
                    if key:
                        yield name, node, key, m.get("value") or m


def _type_text(annotation: object) -> str | None:
    if not isinstance(annotation, dict):
        return None
    inner = annotation.get("typeAnnotation", annotation)
    named = inner.get("typeName") or {}
    return named.get("name") or inner.get("type", "").removeprefix("TS").removesuffix("Keyword").lower() or None


def inventory(program: object) -> Iterator[tuple]:
    """(class, parent, method, async, parameters with types, return type, statements)."""
    for cls, node, name, fn in methods(program):
        params = []
        for p in fn.get("params", []):
            inner = p.get("left") if p.get("type") == "AssignmentPattern" else p
            kind = _type_text(inner.get("typeAnnotation"))
            params.append((inner.get("name") or f"<{inner.get('type')}>") + (f": {kind}" if kind else ""))
        body = (fn.get("body") or {}).get("body", [])
        yield cls, render(node.get("superClass")) or None, name, bool(fn.get("async")), ", ".join(params), _type_text(fn.get("returnType")), len(body)


def parse_calls(program: object) -> Iterator[tuple]:
    """(class, method, called): distinct ``this.parse*`` calls, a capital after the prefix."""
    for cls, _, name, fn in methods(program):
        found = {c for n in walk(fn) if (c := this_call(n)) and c.startswith("parse") and c[5:6].isupper()}
        yield from ((cls, name, c) for c in sorted(found))


def is_interface_call(name: str) -> bool:
    """A generated transport method: a verb inside, not a helper."""
    return any(v in name for v in VERBS) and not name.startswith(("is", "handle"))


def calls(program: object) -> Iterator[tuple]:
    """(class, method, called, kind): distinct calls on ``this``, to an ``interface`` or to an ``own`` method."""
    for cls, _, name, fn in methods(program):
        for c in sorted({c for n in walk(fn) if (c := this_call(n))}):
            yield cls, name, c, "interface" if is_interface_call(c) else "own"


def interface_reach(program: object) -> Iterator[tuple]:
    """(method, called, hops): what :func:`interface_calls` finds, inside one file, whose calls lead nowhere else."""
    direct: dict[str, set[str]] = {}
    own: dict[str, set[str]] = {}
    for _, name, called, kind in calls(program):
        (direct if kind == "interface" else own).setdefault(name, set()).add(called)
    for start in sorted({*direct, *own}):
        if not start.startswith(UNIFIED):
            continue
        found: dict[str, int] = {}
        seen = fresh = {start}
        for hops in range(4):
            for called in sorted({c for m in fresh for c in direct.get(m, ())}):
                found.setdefault(called, hops)
            fresh = {n for m in fresh for n in own.get(m, ())} - seen
            seen = seen | fresh
        yield from ((start, called, hops) for called, hops in found.items())


def pagination(program: object) -> Iterator[tuple]:
    """(class, method, strategy, target, arguments): paginated calls with their literal arguments; a target that is no literal is null."""
    for cls, _, name, fn in methods(program):
        for n in walk(fn):
            if kind := this_call(n, PAGINATION):
                args = n.get("arguments", [])
                ok, target = literal(args[0]) if args else (False, None)
                rest = [literal(a) for a in args[1:]]
                yield cls, name, PAGINATION[kind], target if ok and isinstance(target, str) else None, json.dumps([v if good else None for good, v in rest])


def _bindings(fn: Node) -> dict[str, list[Node]]:
    out: dict[str, list[Node]] = {}
    for n in walk(fn):
        if n.get("type") == "VariableDeclarator" and (n.get("id") or {}).get("type") == "Identifier":
            out.setdefault(n["id"]["name"], []).append(n.get("init"))
    return out


def _assigned(fn: Node) -> set[str]:
    out = set()
    for n in walk(fn):
        target = n.get("left") if n.get("type") == "AssignmentExpression" else n.get("argument") if n.get("type") == "UpdateExpression" else None
        if isinstance(target, dict) and target.get("type") == "Identifier":
            out.add(target["name"])
    return out


def request_defaults(program: object) -> Iterator[tuple]:
    """(class, method, key, value, kind): properties of the one literal body that a method sends.

    The body is an object given directly, through ``this.extend``, or by a name
    that is declared once and never assigned again. Methods that send different
    bodies are left out. A value that is not literal all through is ``unresolved``.
    """
    for cls, _, name, fn in methods(program):
        declared, again = _bindings(fn), _assigned(fn)

        def body(arg: object, declared=declared, again=again) -> Node | None:  # noqa: ANN001
            if not isinstance(arg, dict):
                return None
            if arg.get("type") == "ObjectExpression":
                return arg
            if this_call(arg, ("extend",)) and arg.get("arguments"):
                return body(arg["arguments"][0])
            if arg.get("type") == "Identifier" and arg["name"] not in again and len(declared.get(arg["name"], ())) == 1:
                init = declared[arg["name"]][0]
                return body(init) if not (isinstance(init, dict) and init.get("type") == "Identifier") else None
            return None

        bodies = []
        for n in walk(fn):
            if (c := this_call(n)) and is_interface_call(c) and n.get("arguments"):
                found = body(n["arguments"][0])
                if found is not None and found.get("properties"):
                    bodies.append([(k, *literal(p.get("value"))) for p in found["properties"] if (k := property_name(p)) is not None])
        if bodies and all(b == bodies[0] for b in bodies):
            for k, ok, v in bodies[0]:
                yield cls, name, k, json.dumps(v) if ok else None, "literal" if ok else "unresolved"


def _safe_fields(fn: Node) -> dict[str, tuple[str, str, str]]:
    """Names bound once to a safe* call: name -> (object, field, call)."""
    out = {}
    for name, inits in _bindings(fn).items():
        if len(inits) == 1 and (c := this_call(inits[0], SAFE_CALLS)):
            args = inits[0].get("arguments", [])
            if len(args) > 1 and literal(args[1])[0]:
                out[name] = (render(args[0]), str(literal(args[1])[1]), c)
    return out


def error_fields(program: object) -> Iterator[tuple]:
    """(class, object, field, call, role): fields that ``handleErrors`` reads and what for."""
    for cls, _, name, fn in methods(program):
        if name != "handleErrors":
            continue
        bound, found = _safe_fields(fn), set()
        for n in walk(fn):
            if (c := this_call(n, THROWERS)) and len(n.get("arguments", [])) > 1 and n["arguments"][1].get("name") in bound:
                found.add((*bound[n["arguments"][1]["name"]], THROWERS[c]))
            if n.get("type") == "BinaryExpression" and n.get("operator") in ("===", "!=="):
                for a, b in ((n["left"], n["right"]), (n["right"], n["left"])):
                    if a.get("name") in bound and literal(b)[0]:
                        found.add((*bound[a["name"]], "status_sentinel"))
        yield from ((cls, *f) for f in sorted(found))


def throw_dispatches(program: object) -> Iterator[tuple]:
    """(class, helper, table, field): calls of the throw helpers in ``handleErrors``, in order."""
    for cls, _, name, fn in methods(program):
        if name == "handleErrors":
            bound = _safe_fields(fn)
            for n in walk(fn):
                if (c := this_call(n, THROWERS)) and (args := n.get("arguments")):
                    yield cls, c, render(args[0]), bound.get(args[1].get("name"), (None, None, None))[1] if len(args) > 1 else None


def _comparisons(test: Node) -> list[Node]:
    if test.get("type") == "ParenthesizedExpression":
        return _comparisons(test["expression"])
    if test.get("type") == "LogicalExpression" and test.get("operator") == "||":
        return _comparisons(test["left"]) + _comparisons(test["right"])
    return [test]


def predicate_kind(test: Node | None) -> tuple[str, list]:
    """Kind of a condition and the literals it compares: http_status_eq, http_status_range, body_contains, identifier_check, other."""
    if test is None:
        return "other", []
    parts, kinds, values = _comparisons(test), [], []
    for p in parts:
        op = p.get("operator")
        left, right = p.get("left") or {}, p.get("right") or {}
        if p.get("type") == "BinaryExpression" and left.get("name") == "code" and isinstance(literal(right)[1], int):
            kinds.append("http_status_eq" if op in ("===", "==") else "http_status_range")
            values.append(literal(right)[1])
        elif p.get("type") == "BinaryExpression" and left.get("type") == "CallExpression" and (left["callee"].get("property") or {}).get("name") == "indexOf" and left.get("arguments"):
            kinds.append("body_contains")
            values.append(literal(left["arguments"][0])[1])
        elif p.get("type") == "Identifier" or (p.get("type") == "BinaryExpression" and op in ("===", "==") and (left.get("type") == "Identifier" or right.get("type") == "Identifier") and (literal(left)[0] or literal(right)[0])):
            kinds.append("identifier_check")
        else:
            kinds.append("other")
    if set(kinds) <= {"http_status_eq", "http_status_range"}:
        return ("http_status_range" if "http_status_range" in kinds else "http_status_eq"), values
    return (kinds[0], values) if len(set(kinds)) == 1 else ("other", [])


def error_dispatch(program: object) -> Iterator[tuple]:
    """(class, exception, predicate, kind, values): literal throws of ``handleErrors`` under the conditions around them.

    An ``else`` branch stands under the outer conditions only. The innermost
    condition gives the kind.
    """
    for cls, _, name, fn in methods(program):
        if name != "handleErrors":
            continue
        todo: list[tuple[object, tuple[Node, ...]]] = [(fn.get("body"), ())]
        while todo:
            n, tests = todo.pop()
            if not isinstance(n, dict):
                continue
            if n.get("type") == "ThrowStatement" and (n.get("argument") or {}).get("type") == "NewExpression":
                kind, values = predicate_kind(tests[-1] if tests else None)
                yield cls, render(n["argument"]["callee"]), " && ".join(map(render, tests)) or None, kind, json.dumps(values) if values else None
            elif n.get("type") == "IfStatement":
                todo += [(n.get("alternate"), tests), (n.get("consequent"), (*tests, n["test"]))]
            else:
                todo += [(c, tests) for _, _, c in reversed(list(children(n)))]


def sign_dispatch(program: object) -> Iterator[tuple]:
    """(class, position, predicate, sections, is_else): branches of the if chain of ``sign`` in order, with the ``api`` literals they test."""
    for cls, _, name, fn in methods(program):
        if name != "sign":
            continue
        at = 0
        for statement in (fn.get("body") or {}).get("body", []):
            n = statement
            while isinstance(n, dict) and n.get("type") == "IfStatement":
                hits = sorted({
                    str(literal(b)[1]) for c in walk(n["test"]) if c.get("type") == "BinaryExpression" and c.get("operator") in ("===", "==")
                    for a, b in ((c["left"], c["right"]), (c["right"], c["left"])) if a.get("name") == "api" and literal(b)[0]
                })
                yield cls, at, render(n["test"]), ",".join(hits), False
                at, n = at + 1, n.get("alternate")
                if isinstance(n, dict) and n.get("type") != "IfStatement":
                    yield cls, at, None, "", True
                    at += 1


def field_map(program: object) -> Iterator[tuple]:
    """(class, method, field, key, call, reason): fields of the object that a ``parse*`` method returns, or of its ``this.safe*`` argument.

    A field is a safe* call with a literal key, given directly or by a name bound
    once. Without such a return there is one row with a reason.
    """
    for cls, _, name, fn in methods(program):
        if not (name.startswith("parse") and name[5:6].isupper()):
            continue
        returns = [n.get("argument") for n in walk(fn) if n.get("type") == "ReturnStatement"]
        if not returns:
            yield cls, name, None, None, None, "no_return_statement"
            continue
        value = returns[-1]
        while isinstance(value, dict) and value.get("type") in ("TSAsExpression", "ParenthesizedExpression"):
            value = value.get("expression")
        call = this_call(value)
        if call and call.startswith("safe") and value.get("arguments"):
            value = value["arguments"][0]
        if not isinstance(value, dict) or value.get("type") != "ObjectExpression":
            kind = f"non_safe_return:{call}" if call else "identifier_return" if (value or {}).get("type") == "Identifier" else "unrecognized_return_shape"
            yield cls, name, None, None, None, kind
            continue
        bound = _safe_fields(fn)
        for p in value.get("properties", []):
            key, v = property_name(p), p.get("value") or {}
            c = this_call(v, SAFE_CALLS)
            args = v.get("arguments", []) if c else []
            if c and len(args) > 1 and literal(args[1])[0]:
                yield cls, name, key, str(literal(args[1])[1]), c, None
            elif v.get("name") in bound:
                yield cls, name, key, bound[v["name"]][1], bound[v["name"]][2], None
            elif key is not None:
                yield cls, name, key, None, None, None


def class_tree(value: object, parent: str | None = None) -> Iterator[tuple]:
    """(class, parent) of a nested literal of classes; roots have none."""
    if isinstance(value, dict):
        for k, v in value.items():
            yield k, parent
            yield from class_tree(v, k)


def normal_types(value: object) -> Iterator[tuple]:
    """(text): the tree with every ``type`` in Pascal case, keys sorted; other texts stay."""

    def renamed(v: object) -> object:
        if isinstance(v, dict):
            return {k: "".join(p[:1].upper() + p[1:] for p in x.split("_")) if k == "type" and isinstance(x, str) else renamed(x) for k, x in v.items()}
        return [renamed(x) for x in v] if isinstance(v, list) else v

    yield (json.dumps(renamed(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False),)


#: Derivations by name: function and the columns of its rows.
DERIVATIONS: dict[str, tuple[Callable[[object], Iterator[tuple]], str]] = {
    "inventory": (inventory, "class string, parent string, method string, is_async boolean, params string, return_type string, statements long"),
    "parse_calls": (parse_calls, "class string, method string, called string"),
    "calls": (calls, "class string, method string, called string, kind string"),
    "interface_reach": (interface_reach, "method string, called string, hops int"),
    "pagination": (pagination, "class string, method string, strategy string, target string, arguments string"),
    "request_defaults": (request_defaults, "class string, method string, key string, value string, kind string"),
    "error_fields": (error_fields, "class string, object string, field string, call string, role string"),
    "throw_dispatches": (throw_dispatches, "class string, helper string, table string, field string"),
    "error_dispatch": (error_dispatch, "class string, exception string, predicate string, kind string, literals string"),
    "sign_dispatch": (sign_dispatch, "class string, position long, predicate string, sections string, is_else boolean"),
    "field_map": (field_map, "class string, method string, field string, key string, call string, reason string"),
    "class_tree": (class_tree, "class string, parent string"),
    "normal_types": (normal_types, "text string"),
}


def derive(documents: DataFrame, name: str, *, id: str = "id", ast: str = "ast") -> DataFrame:
    """Rows (id, status, ...) of a derivation. A document that is null or empty is skipped (``skip``), an unreadable one ``error``; both have one row."""
    function, columns = DERIVATIONS[name]
    names = [c.split()[0] for c in columns.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out: list[tuple] = []
            for key, text in b.itertuples(index=False, name=None):
                try:
                    rows = [(key, "ok", *r) for r in function(json.loads(text))] if text else [(key, "skip", *[None] * len(names))]
                except (ValueError, TypeError, AttributeError, KeyError):
                    rows = [(key, "error", *[None] * len(names))]
                out += rows
            frame = pd.DataFrame(out, columns=["id", "status", *names])
            for c in columns.split(", "):
                if c.endswith((" long", " boolean")):
                    frame[c.split()[0]] = frame[c.split()[0]].astype("Int64" if c.endswith("long") else "boolean")
            yield frame

    return documents.select(F.col(id).cast("string").alias("id"), ast).mapInPandas(run, f"id string, status string, {columns}")


def ast_nodes(documents: DataFrame, *, id: str = "id", ast: str = "ast") -> DataFrame:
    """Node rows (id, node, parent, field, position, type, begin, end, label) of readable documents; the root's parent is null."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out: list[tuple] = []
            for key, text in b.itertuples(index=False, name=None):
                try:
                    root = json.loads(text)
                except (TypeError, ValueError):
                    continue
                if not isinstance(root, dict):
                    continue
                todo, n = [(None, None, None, root)], 0
                while todo:
                    parent, name, at, node = todo.pop()
                    own, n = n, n + 1
                    out.append((key, own, parent, name, at, node.get("type"), node.get("start"), node.get("end"), label(node)))
                    todo += [(own, f, i, c) for f, i, c in reversed(list(children(node)))]
                if len(out) > 50_000:
                    yield _frame(out)
                    out = []
            yield _frame(out)

    return documents.select(F.col(id).cast("string").alias("id"), ast).mapInPandas(
        run, "id string, node long, parent long, field string, position long, type string, begin long, end long, label string"
    )


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["id", "node", "parent", "field", "position", "type", "begin", "end", "label"])
    return out.astype({c: "Int64" for c in ("node", "parent", "position", "begin", "end")})


def edge_types(documents: DataFrame, *, ast: str = "ast") -> DataFrame:
    """How often nodes of one type have nodes of another in a field: (parent_type, field, type, n), over all readable documents.

    A node's parent is in the same document, so edges are counted where it is read; no node moves.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            n: Counter[tuple] = Counter()
            for text in b["ast"]:
                try:
                    root = json.loads(text)
                except (TypeError, ValueError):
                    continue
                for node in walk(root):
                    above = node.get("type")
                    n.update((above, name, c["type"]) for name, _, c in children(node))
            yield pd.DataFrame([(*k, v) for k, v in n.items()], columns=["parent_type", "field", "type", "n"])

    counts = documents.select(F.col(ast).alias("ast")).mapInPandas(run, "parent_type string, field string, type string, n long")
    return counts.groupBy("parent_type", "field", "type").agg(F.sum("n").alias("n"))


def interface_calls(call_rows: DataFrame) -> DataFrame:
    """Interface methods that a unified method leads to, directly or over up to three own methods: (id, method, called, hops)."""
    own = call_rows.where("kind = 'own'").select("id", F.col("method").alias("m"), F.col("called").alias("next"))
    direct = call_rows.where("kind = 'interface'").select("id", F.col("method").alias("m"), "called")
    reach = call_rows.where(F.col("method").rlike("^(" + "|".join(UNIFIED) + ")")).select("id", "method").distinct().withColumns({"m": F.col("method"), "hops": F.lit(0)})
    found = None
    for hop in range(4):
        hit = reach.join(direct, ["id", "m"]).select("id", "method", "called", "hops")
        found = hit if found is None else found.unionByName(hit)
        if hop < 3:
            reach = reach.join(own, ["id", "m"]).select("id", "method", F.col("next").alias("m"), F.lit(hop + 1).alias("hops")).distinct()
    return found.groupBy("id", "method", "called").agg(F.min("hops").alias("hops"))
