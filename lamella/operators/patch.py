"""JSON Pointers, ordered patches, and recursive rewriting of JSON texts."""

from __future__ import annotations

import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Keys that differ from run to run. Fixed values.
VOLATILE = ("extracted_at", "generated_at", "checked_at", "validated_at", "recorded_at")


class _ABSENT:
    """Stands for a value that is not there; a class, so that it stays itself when functions are sent to workers."""


def pointer_keys(pointer: str) -> list[str]:
    """Segments of a JSON Pointer; ``/`` is one empty segment, ``~1`` a slash and ``~0`` a tilde. Must begin with a slash."""
    if not pointer.startswith("/"):
        raise ValueError(f"{pointer!r} does not begin with /")
    return [s.replace("~1", "/").replace("~0", "~") for s in pointer[1:].split("/")]


def _step(node: object, key: str) -> object:
    if isinstance(node, dict):
        return node.get(key, _ABSENT)
    if isinstance(node, list) and key.isdigit() and int(key) < len(node):
        return node[int(key)]
    return _ABSENT


def pointer_get(document: object, pointer: str) -> object:
    """Value at a pointer, None if there is none; a path without a slash is the whole document, a root that is no object gives None."""
    if not isinstance(document, dict):
        return None
    if "/" not in pointer:
        return document
    for key in pointer_keys(pointer):
        document = _step(document, key)
        if document is _ABSENT:
            return None
    return document


def put(document: object, keys: Sequence[str], value: object) -> bool:
    """Set a value in place, making objects on the way; False if the way leads through a scalar or past a list's end."""
    node = document
    for i, key in enumerate(keys):
        last = i == len(keys) - 1
        if isinstance(node, dict):
            if last:
                node[key] = value
                return True
            if node.get(key) is None:
                node[key] = {}
            node = node[key]
        elif isinstance(node, list) and key.isdigit() and int(key) < len(node):
            if last:
                node[int(key)] = value
                return True
            node = node[int(key)]
        else:
            return False
    return False


def _dumps(v: object) -> str:
    return json.dumps(v, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def _loads(text: str | None) -> object:
    try:
        return _ABSENT if text is None else json.loads(text)
    except ValueError:
        return _ABSENT


@F.pandas_udf(T.StringType())
def json_at(document: pd.Series, pointer: pd.Series) -> pd.Series:
    """Value at a pointer as JSON text; null for an unreadable document, an absent value, or a bad pointer."""

    def one(d: str | None, p: str | None) -> str | None:
        v = _loads(d)
        if v is _ABSENT or p is None:
            return None
        try:
            found = pointer_get(v, p)
        except ValueError:
            return None
        return None if found is None else _dumps(found)

    return pd.Series([one(d, p) for d, p in zip(document, pointer)], dtype="object")


def patch_documents(documents: DataFrame, entries: DataFrame, *, id: str = "id", document: str = "document") -> DataFrame:
    """Documents with their entries (id, ord, path, value as JSON) put in, in order: (id, document, applied, failed).

    Entries that cannot be put are counted and skipped. Entries of one document are
    few by nature (a file that people keep), so they meet in one row.
    """
    own = entries.groupBy(id).agg(F.array_sort(F.collect_list(F.struct("ord", "path", "value"))).alias("__entries"))

    @F.pandas_udf("struct<document:string,applied:long,failed:long>")
    def apply(text: pd.Series, ops: pd.Series) -> pd.DataFrame:
        out = []
        for t, todo in zip(text, ops):
            v = _loads(t)
            ok = bad = 0
            for e in todo if todo is not None else ():
                value = _loads(e["value"])
                try:
                    done = v is not _ABSENT and value is not _ABSENT and put(v, pointer_keys(e["path"]), value)
                except ValueError:
                    done = False
                ok, bad = ok + done, bad + (not done)
            out.append((t if v is _ABSENT else _dumps(v), ok, bad))
        return pd.DataFrame(out, columns=["document", "applied", "failed"])

    joined = documents.select(id, document).join(own, id, "left")
    return joined.select(id, apply(document, "__entries").alias("r")).select(id, "r.*")


def entry_errors(entries: DataFrame, allowed_version: str) -> DataFrame:
    """Faults of override entries (id, schema_version, path, reason, verified_against, unverified, is_set): (id, path, fault)."""
    faults = F.array_compact(F.array(
        F.when(~F.col("schema_version").eqNullSafe(F.lit(allowed_version)), F.lit("schema_version")),
        F.when(~F.coalesce(F.col("path").startswith("/"), F.lit(False)), F.lit("path")),
        F.when(F.coalesce(F.trim("reason"), F.lit("")) == "", F.lit("reason")),
        F.when(F.col("verified_against").isNotNull() & F.coalesce(F.col("unverified"), F.lit(False)), F.lit("exclusive")),
    ))
    single = entries.select("id", "path", F.explode(faults).alias("fault"))
    twice = entries.groupBy("id", "path").agg(F.count("*").alias("n")).where("n > 1").select("id", "path", F.lit("duplicate_path").alias("fault"))
    return single.unionByName(twice)


def translate_pointer(pointer: Column, prefixes: Sequence[tuple[str, str]]) -> Column:
    """Rewrite of the first prefix that a pointer equals or continues after a slash; others stay."""
    out = F.when(F.lit(False), pointer)
    for old, new in prefixes:
        out = out.when((pointer == old) | pointer.startswith(old + "/"), F.concat(F.lit(new), F.substring(pointer, F.lit(len(old) + 1), F.length(pointer))))
    return out.otherwise(pointer)


def stamp_provenance(default: Column, paths: Column, tag: str = "override") -> Column:
    """A provenance map with the tags of the given paths replaced; paths outside the map are added."""
    changed = F.map_from_arrays(F.array_distinct(paths), F.transform(F.array_distinct(paths), lambda _: F.lit(tag)))
    kept = F.map_filter(default, lambda k, _: ~F.array_contains(F.coalesce(paths, F.array().cast("array<string>")), k))
    return F.map_concat(kept, F.coalesce(changed, F.map_filter(default, lambda k, v: F.lit(False))))


def strip_keys(value: object, drop: Sequence[str] = VOLATILE) -> object:
    """A value without the named keys, at any depth."""
    if isinstance(value, dict):
        return {k: strip_keys(v, drop) for k, v in value.items() if k not in drop}
    return [strip_keys(v, drop) for v in value] if isinstance(value, list) else value


def strip_undefined(value: object) -> object:
    """A value without entries and elements that are ``__undefined``, at any depth."""
    if isinstance(value, dict):
        return {k: strip_undefined(v) for k, v in value.items() if v != "__undefined"}
    return [strip_undefined(v) for v in value if v != "__undefined"] if isinstance(value, list) else value


def substitute(value: object, name: str, text: str) -> object:
    """``{name}`` replaced in strings at any depth."""
    if isinstance(value, str):
        return value.replace("{" + name + "}", text)
    if isinstance(value, dict):
        return {k: substitute(v, name, text) for k, v in value.items()}
    return [substitute(v, name, text) for v in value] if isinstance(value, list) else value


def nesting_depth(value: object, items: int = 10, keys: int = 50) -> int:
    """Depth of containers (scalar 0, empty container 1) over the first items of lists and keys of objects, as the report defines it."""
    deepest, todo = 0, [(value, 0)]
    while todo:
        v, d = todo.pop()
        if isinstance(v, dict):
            children = list(v.values())[:keys]
        elif isinstance(v, list):
            children = v[:items]
        else:
            deepest = max(deepest, d)
            continue
        deepest = max(deepest, d + 1)
        todo += [(c, d + 1) for c in children]
    return deepest


def json_udf(kind: T.DataType, change):  # noqa: ANN001, ANN201
    """A vectorised function of a JSON text; null for unreadable texts."""

    @F.pandas_udf(kind)
    def run(text: pd.Series) -> pd.Series:
        values = [_loads(t) for t in text]
        return pd.Series([None if v is _ABSENT else change(v) for v in values], dtype="Int64" if isinstance(kind, T.LongType) else "object")

    return run


canonical_json = json_udf(T.StringType(), _dumps)
without_volatile = json_udf(T.StringType(), lambda v: _dumps(strip_keys(v)))
without_undefined = json_udf(T.StringType(), lambda v: _dumps(strip_undefined(v)))
json_depth = json_udf(T.LongType(), nesting_depth)


@F.pandas_udf(T.StructType([T.StructField("position", T.LongType()), T.StructField("left", T.StringType()), T.StructField("right", T.StringType())]))
def first_difference(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """First differing byte of two texts, with 20 bytes before and after; position null if they are equal or one is null."""
    out = []
    for x, y in zip(a, b):
        if x is None or y is None or x == y:
            out.append((None, None, None))
            continue
        p, q = x.encode(), y.encode()
        n = next((i for i, (u, v) in enumerate(zip(p, q)) if u != v), min(len(p), len(q)))
        cut = lambda s: s[max(0, n - 20) : n + 20].decode("utf-8", "replace")  # noqa: B023, E731
        out.append((n, cut(p), cut(q)))
    return pd.DataFrame(out, columns=["position", "left", "right"]).astype({"position": "Int64"})
