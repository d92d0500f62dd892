"""Syntax trees as JSON templates for documents that queries make of table rows.

Nodes are dicts; ``@name@`` inside their texts stands for a column. A template becomes a
column by replacement, so documents are made inside the JVM.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

Node = dict


def ident(name: str) -> Node:
    return {"type": "Identifier", "name": name}


def lit(value: object) -> Node:
    return {"type": "Literal", "value": value}


def this() -> Node:
    return {"type": "ThisExpression"}


def member(of: Node, name: str) -> Node:
    return {"type": "MemberExpression", "computed": False, "object": of, "property": ident(name)}


def indexed(of: Node, key: Node) -> Node:
    return {"type": "MemberExpression", "computed": True, "object": of, "property": key}


def call(callee: Node, *args: Node) -> Node:
    return {"type": "CallExpression", "callee": callee, "arguments": list(args)}


def this_call(name: str, *args: Node) -> Node:
    return call(member(this(), name), *args)


def new(name: str, *args: Node) -> Node:
    return {"type": "NewExpression", "callee": ident(name), "arguments": list(args)}


def obj(**values: Node) -> Node:
    return {"type": "ObjectExpression", "properties": [{"type": "Property", "computed": False, "key": ident(k), "value": v} for k, v in values.items()]}


def prop(key: Node, value: Node, computed: bool = False) -> Node:
    return {"type": "Property", "computed": computed, "key": key, "value": value}


def binary(op: str, a: Node, b: Node) -> Node:
    return {"type": "LogicalExpression" if op in ("||", "&&") else "BinaryExpression", "operator": op, "left": a, "right": b}


def do(e: Node) -> Node:
    return {"type": "ExpressionStatement", "expression": e}


def assign(target: Node, value: Node, op: str = "=") -> Node:
    return do({"type": "AssignmentExpression", "operator": op, "left": target, "right": value})


def const(name: str, value: Node) -> Node:
    return {"type": "VariableDeclaration", "kind": "const", "declarations": [{"type": "VariableDeclarator", "id": ident(name), "init": value}]}


def ret(value: Node) -> Node:
    return {"type": "ReturnStatement", "argument": value}


def block(*statements: Node) -> Node:
    return {"type": "BlockStatement", "body": list(statements)}


def when(test: Node, *then: Node, otherwise: Node | None = None) -> Node:
    return {"type": "IfStatement", "test": test, "consequent": block(*then), "alternate": otherwise}


def method(name: str, *statements: Node, params: tuple = (), asynchronous: bool = False, returns: Node | None = None) -> Node:
    fn = {"type": "FunctionExpression", "async": asynchronous, "params": [p if isinstance(p, dict) else ident(p) for p in params], "body": block(*statements)}
    return {"type": "MethodDefinition", "computed": False, "key": ident(name), "value": fn | ({"returnType": returns} if returns else {})}


def typed(name: str, kind: str) -> Node:
    return ident(name) | {"typeAnnotation": {"type": "TSTypeAnnotation", "typeAnnotation": {"type": f"TS{kind}Keyword"}}}


def type_of(name: str) -> Node:
    return {"type": "TSTypeAnnotation", "typeAnnotation": {"type": "TSTypeReference", "typeName": ident(name)}}


def column(node: Node | str, **values: Column | str) -> Column:
    """A template as a column; ``@name@`` is replaced by each of ``values``."""
    out = F.lit(node if isinstance(node, str) else json.dumps(node, separators=(",", ":")))
    for name, value in values.items():
        out = F.replace(out, F.lit(f"@{name}@"), F.coalesce(F.col(value) if isinstance(value, str) else value, F.lit("")))
    return out


def class_file(members: Column, name: Column, parent: Column) -> Column:
    """The file of one class; ``members`` is an array of method texts, nulls are left out."""
    return F.concat(
        F.lit('{"type":"Program","body":[{"type":"ClassDeclaration","id":{"type":"Identifier","name":"'), name,
        F.lit('"},"superClass":{"type":"Identifier","name":"'), F.coalesce(parent, F.lit("")), F.lit('"},"body":{"type":"ClassBody","body":['),
        F.array_join(F.array_compact(members), ","), F.lit("]}}]}"),
    )


def choose(on: Column, *shapes: Column | None) -> Column:
    """The text for ``on`` 0, 1, ...; None for no text."""
    out = F.lit(None).cast("string")
    for i, s in enumerate(shapes):
        if s is not None:
            out = F.when(on == i, s).otherwise(out)
    return out
