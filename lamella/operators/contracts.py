"""Contracts of documents: required keys, schemas, invariants with baselines, drift reports."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TYPES = {
    "object": lambda v: isinstance(v, dict), "array": lambda v: isinstance(v, list), "string": lambda v: isinstance(v, str), "null": lambda v: v is None,
    "boolean": lambda v: isinstance(v, bool), "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "integer": lambda v: not isinstance(v, bool) and (isinstance(v, int) or (isinstance(v, float) and v.is_integer())),
}


def is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def at(v: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, path, kind)


def present(v: Column, path: str) -> Column:
    """Whether a path exists; a JSON null is there."""
    return at(v, path).isNotNull()


def missing_keys(rows: DataFrame, required: Mapping[str, Sequence[str]], *, id: str) -> DataFrame:
    """Required keys that JSON groups lack, in order: (id, position, group, key).

    ``rows`` have a text column for each group. A key whose value is null is there. A group that is no readable
    object has one row with a null key. All groups are checked in one pass without a shuffle.
    """
    checks, position = [], 0
    for group, keys in required.items():
        v = F.try_parse_json(group)
        row = lambda key, p: F.struct(F.lit(p).alias("position"), F.lit(group).alias("group"), F.lit(key).cast("string").alias("key"))  # noqa: B023, E731
        checks.append(F.when(~is_object(v), row(None, position)))
        for key in keys:
            position += 1
            checks.append(F.when(is_object(v) & ~present(v, f"$.{key}"), row(key, position)))
    return rows.select(id, F.explode(F.array_compact(F.array(*checks))).alias("c")).select(id, "c.*")


class Schema:
    """A JSON Schema (draft 2020-12, without remote references) that reports failures as (path, keyword).

    Known keywords: type, const, enum, required, properties, patternProperties, additionalProperties, items, minItems, maxItems,
    minProperties, minLength, pattern, minimum, maximum, allOf, anyOf, oneOf, not and local $ref. Of anyOf, oneOf and not only the
    keyword itself is reported, at the value.
    """

    def __init__(self, schema: dict):
        self.root = schema

    def failures(self, value: object) -> list[tuple[str, str]]:
        return list(self._check(value, self.root, ""))

    def _ref(self, ref: str) -> dict:
        node: object = self.root
        for part in ref.removeprefix("#").strip("/").split("/"):
            node = node[part.replace("~1", "/").replace("~0", "~")] if part else node
        return node

    def _check(self, v: object, s: object, path: str) -> Iterator[tuple[str, str]]:
        if s is True or s is False:
            if s is False:
                yield path, "false"
            return
        if "$ref" in s:
            yield from self._check(v, self._ref(s["$ref"]), path)
        kinds = s.get("type")
        if kinds is not None and not any(_TYPES[k](v) for k in ([kinds] if isinstance(kinds, str) else kinds)):
            yield path, "type"
            return
        same = lambda a, b: a == b and isinstance(a, bool) == isinstance(b, bool)
        if "const" in s and not same(v, s["const"]):
            yield path, "const"
        if "enum" in s and not any(same(v, e) for e in s["enum"]):
            yield path, "enum"
        good = lambda sub: not any(True for _ in self._check(v, sub, path))
        for sub in s.get("allOf", ()):
            yield from self._check(v, sub, path)
        if "anyOf" in s and not any(good(sub) for sub in s["anyOf"]):
            yield path, "anyOf"
        if "oneOf" in s and sum(good(sub) for sub in s["oneOf"]) != 1:
            yield path, "oneOf"
        if "not" in s and good(s["not"]):
            yield path, "not"
        if isinstance(v, str):
            if len(v) < s.get("minLength", 0):
                yield path, "minLength"
            if "pattern" in s and not re.search(s["pattern"], v):
                yield path, "pattern"
        if _TYPES["number"](v):
            if "minimum" in s and v < s["minimum"]:
                yield path, "minimum"
            if "maximum" in s and v > s["maximum"]:
                yield path, "maximum"
        if isinstance(v, list):
            if len(v) < s.get("minItems", 0):
                yield path, "minItems"
            if "maxItems" in s and len(v) > s["maxItems"]:
                yield path, "maxItems"
            for i, x in enumerate(v):
                yield from self._check(x, s.get("items", True), f"{path}/{i}")
        if isinstance(v, dict):
            yield from ((f"{path}/{_pointer(k)}", "required") for k in s.get("required", ()) if k not in v)
            if len(v) < s.get("minProperties", 0):
                yield path, "minProperties"
            known, patterns = s.get("properties", {}), s.get("patternProperties", {})
            for k, x in v.items():
                below, hit = f"{path}/{_pointer(k)}", False
                if k in known:
                    hit = True
                    yield from self._check(x, known[k], below)
                for p, sub in patterns.items():
                    if re.search(p, k):
                        hit = True
                        yield from self._check(x, sub, below)
                if not hit and s.get("additionalProperties", True) is not True:
                    if s["additionalProperties"] is False:
                        yield below, "additionalProperties"
                    else:
                        yield from self._check(x, s["additionalProperties"], below)


def _pointer(key: str) -> str:
    return key.replace("~", "~0").replace("/", "~1")


def schema_failures(rows: DataFrame, schema: dict, *, id: str, text: str) -> DataFrame:
    """Failures of JSON texts against a schema: (id, path, keyword). Null texts are none; unreadable ones have the keyword ``unreadable``.

    Runs per Arrow batch; each distinct text of a batch is checked once.
    """
    kind = rows.schema[id].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        s = Schema(schema)
        for b in batches:
            known: dict[str, list[tuple[str, str]]] = {}
            out = []
            for key, value in b.itertuples(index=False, name=None):
                if value is None:
                    continue
                if value not in known:
                    try:
                        known[value] = s.failures(json.loads(value))
                    except ValueError:
                        known[value] = [("", "unreadable")]
                out += [(key, *f) for f in known[value]]
            yield pd.DataFrame(out, columns=["id", "path", "keyword"])

    return rows.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInPandas(run, f"id {kind}, path string, keyword string").withColumnRenamed("id", id)


#: A check takes documents and returns findings (id, path, message).
Check = Callable[[DataFrame], DataFrame]


def run_invariants(documents: DataFrame, registry: Mapping[str, Check], *, allowed: DataFrame | None = None) -> DataFrame:
    """Findings of all invariants: (id, invariant, path, message); those in ``allowed`` (invariant, path) are left out.

    An allow-list holds what is known and accepted: a finding on its path, whatever the id, is none.
    """
    found = None
    for name, check in registry.items():
        part = check(documents).select("id", F.lit(name).alias("invariant"), "path", "message")
        found = part if found is None else found.unionByName(part)
    return found if allowed is None else found.join(allowed.select("invariant", "path").distinct(), ["invariant", "path"], "left_anti").select("id", "invariant", "path", "message")


def where(broken: Column, path: Column | str, message: str) -> Check:
    """An invariant of one document by a condition that is true where it is broken."""
    p = F.lit(path) if isinstance(path, str) else path
    return lambda docs: docs.where(F.coalesce(broken, F.lit(False))).select("id", p.alias("path"), F.lit(message).alias("message"))


def keys_of(docs: DataFrame, v: str, path: str) -> DataFrame:
    """(id, key, value) of the object below a path; documents without one there have none."""
    held = docs.select("id", at(F.col(v), path).alias("o")).where(is_object(F.col("o")))
    return held.lateralJoin(docs.sparkSession.tvf.variant_explode(F.col("o").outer())).select("id", "key", "value")


def key_set_difference(left: Callable[[DataFrame], DataFrame], right: Callable[[DataFrame], DataFrame], path: str, message: str) -> Check:
    """An invariant of inclusion: keys (id, key) of ``left`` that ``right`` lacks for the same id."""
    return lambda docs: left(docs).select("id", "key").distinct().join(right(docs).select("id", "key").distinct(), ["id", "key"], "left_anti").select(
        "id", F.concat(F.lit(path), F.col("key")).alias("path"), F.lit(message).alias("message")
    )


def drift_report(findings: Mapping[str, DataFrame], current: DataFrame, baseline: DataFrame) -> DataFrame:
    """Findings per id and category: (id, category, n).

    ``findings`` are (id, ...) by category; ``current`` and ``baseline`` list the ids there are. An id without a
    baseline has one ``missing_baseline`` row and is not compared.
    """
    cur = current.select("id").distinct()
    known = cur.join(baseline.select("id").distinct(), "id", "left_semi")
    lost = cur.join(baseline.select("id").distinct(), "id", "left_anti").select("id", F.lit("missing_baseline").alias("category"), F.lit(1).cast("long").alias("n"))
    out = lost
    for category, rows in findings.items():
        out = out.unionByName(rows.join(known, "id", "left_semi").groupBy("id").agg(F.count("*").alias("n")).select("id", F.lit(category).alias("category"), "n"))
    return out
