"""Deeply nested records to flat, linked child rows, by vectorised structural indexing.

A batch of JSON texts is indexed at once: bitmaps of quotes (with escapes resolved),
of bytes inside strings, of brackets and delimiters; nesting depth as prefix sums over
brackets; and from these, without parsing value by value, every element's container,
key, position and span. The texts' grammar is checked on the same arrays. Child rows
are then read off the index along a declared layout.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text that are indexed at once; a longer text is indexed alone.
CHUNK_BYTES = 2_000_000
UNDEFINED = "__undefined"

ROW = "source_table string, record_no long, entity string, parent_path string, record_path string"
_OUT = pa.schema([("source_table", pa.string()), ("record_no", pa.int64()), ("entity", pa.string()), ("parent_path", pa.string()), ("record_path", pa.string())])

_SCALAR = re.compile(rb"(?:true|false|null|-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)\Z")
_CLASS = np.zeros(256, np.uint8)  # 1 { 2 } 3 [ 4 ] 5 , 6 : 7 " 8 white space, 0 other
for _i, _c in enumerate(b'{}[],:"', 1):
    _CLASS[_c] = _i
_CLASS[list(b" \t\n\r")] = 8
_ESCAPABLE = np.zeros(256, bool)
_ESCAPABLE[list(b'"\\/bfnrtu')] = True
_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdefABCDEF")] = True


@dataclass(frozen=True)
class Level:
    """A level of children below a record or a group.

    ``at``: keys from there to the children. ``form``: ``list`` (children by
    position) or ``map`` (by key; a list in its place is named by the elements'
    ``name``). ``entity``: what its rows are called; None gives no rows, its
    elements are only passed through, and children link to them all the same.
    ``keep_null``: a null entry of a map is a record as well.
    """

    entity: str | None
    at: tuple[str, ...]
    form: str
    children: tuple[Level, ...] = field(default=())
    keep_null: bool = False


def escape(key: str) -> str:
    """A key as a segment of a JSON Pointer."""
    return key.replace("~", "~0").replace("/", "~1")


class Index:
    """Structural index over several texts. Values are told by the index of their first token."""

    def __init__(self, texts: Sequence[bytes]):
        self.data = b"".join(texts)
        b = self.b = np.frombuffer(self.data, np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.begin = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        n, docs = len(b), len(texts)
        doc = np.repeat(np.arange(docs), sizes)
        bad = sizes == 0
        first = np.zeros(n + 1, bool)
        first[self.begin] = True
        first = first[:n]

        # Runs of backslashes: what follows an odd run is escaped.
        slash = b == 92
        after = np.zeros(n, bool)
        after[1:] = slash[:-1]
        after &= ~first
        pos = np.arange(n)
        run = np.maximum.accumulate(np.where(slash & ~after, pos, 0)) if n else pos
        odd = slash & ((pos - run) % 2 == 0)
        escaped = np.zeros(n, bool)
        escaped[1:] = odd[:-1]
        escaped &= ~first

        cls = _CLASS[b]
        quote = (cls == 7) & ~escaped
        count = np.cumsum(quote)
        base = np.where(sizes > 0, count[np.minimum(self.begin, max(n - 1, 0))] - quote[np.minimum(self.begin, max(n - 1, 0))], 0) if n else np.zeros(docs, int)
        inside = (count - base[doc]) % 2 == 1  # from an opening quote up to before its closing one
        ends = self.begin + sizes - 1
        bad[sizes > 0] |= inside[ends[sizes > 0]]
        text = inside & ~quote
        bad[doc[text & (b < 32)]] = True
        lead = np.flatnonzero(odd & text & ~escaped)
        nxt = b[np.minimum(lead + 1, max(n - 1, 0))]
        wrong = ~_ESCAPABLE[nxt]
        u = lead[nxt == 117]
        if len(u):
            digits = _HEX[b[np.minimum(u[:, None] + np.arange(2, 6), n - 1)]] & (u[:, None] + np.arange(2, 6) <= ends[doc[u]][:, None])
            bad[doc[u[~digits.all(1)]]] = True
        bad[doc[lead[wrong]]] = True

        outer = ~inside
        mark = outer & (cls >= 1) & (cls <= 6)
        other = outer & (cls == 0)
        begins = other.copy()
        begins[1:] &= ~(other[:-1] & ~first[1:])
        tok = np.flatnonzero(mark | (quote & inside) | begins)
        kind = np.where(begins[tok], 0, cls[tok])
        tdoc = doc[tok]
        m = len(tok)
        self.tok, self.kind, self.tdoc = tok, kind, tdoc

        # Ends of strings and scalars.
        stop = np.zeros(m, np.int64)
        closing = np.flatnonzero(quote & ~inside)
        strings = np.flatnonzero(kind == 7)
        at = np.searchsorted(closing, tok[strings])
        stop[strings] = np.append(closing, n)[at] + 1
        over = np.zeros(n, bool)
        over[:-1] = other[:-1] & ~(other[1:] & ~first[1:])
        if n:
            over[-1] = other[-1]
        scalars = np.flatnonzero(kind == 0)
        stop[scalars] = np.flatnonzero(over) + 1
        self.stop = stop
        seen: dict[bytes, bool] = {}
        for i in scalars.tolist():
            s = self.data[tok[i] : stop[i]]
            if s not in seen:
                seen[s] = _SCALAR.match(s) is not None
            if not seen[s]:
                bad[tdoc[i]] = True

        # Depth by prefix sums, per text.
        opens, closes = (kind == 1) | (kind == 3), (kind == 2) | (kind == 4)
        step = opens.astype(np.int64) - closes
        total = np.cumsum(step)
        tfirst = np.zeros(m, bool)
        if m:
            tfirst[0] = True
            tfirst[1:] = tdoc[1:] != tdoc[:-1]
        starts = np.flatnonzero(tfirst)
        depth = total - np.repeat(total[starts] - step[starts], np.diff(np.append(starts, m))) if m else total
        tlast = (np.append(starts[1:], m) - 1)[: len(starts)]
        bad[tdoc[tlast[depth[tlast] != 0]]] = True
        bad[tdoc[depth < 0]] = True
        empty = np.ones(docs, bool)
        empty[tdoc] = False
        bad |= empty
        self.root = np.full(docs, -1)
        self.root[tdoc[starts]] = starts

        # Containers: in each (text, level) the last bracket that opened that level.
        level = np.where(opens, depth - 1, np.where(closes, depth + 1, depth))
        own = np.flatnonzero(opens)
        who = np.concatenate((own, np.arange(m)))
        lev = np.concatenate((depth[own], level))
        lev = np.maximum(lev, 0)
        is_mark = np.concatenate((np.ones(len(own), bool), np.zeros(m, bool)))
        order = np.lexsort((~is_mark, who, lev, tdoc[who]))
        group = tdoc[who][order] * (int(lev.max(initial=0)) + 2) + lev[order]
        last = np.maximum.accumulate(np.where(is_mark[order], np.arange(len(order)), -1)) if len(order) else order
        ok = (last >= 0) & (group[last] == group)
        holder = np.full(m, -1)
        plain = ~is_mark[order]
        holder[who[order][plain]] = np.where(ok, who[order][last], -1)[plain]
        self.holder = holder

        # Grammar: what may follow what.
        hkind = np.where(holder >= 0, kind[np.maximum(holder, 0)], 0)
        prev = np.append(-1, kind[:-1])
        prev[tfirst] = -1
        key = (kind == 7) & (hkind == 1) & ((prev == 1) | (prev == 5))
        value = ~key & ((kind == 0) | (kind == 7) | opens)
        pkey = np.append(False, key[:-1]) & ~tfirst
        expects = tfirst | (prev == 3) | ((prev == 5) & (hkind == 3)) | ((prev == 6) & (hkind == 1))
        ended = ~tfirst & ~pkey & ((prev == 0) | (prev == 7) | (prev == 2) | (prev == 4))
        fine = np.where(
            value, expects,
            np.where(
                key, True,
                np.where(
                    kind == 6, pkey,
                    np.where(kind == 5, ended & (hkind > 0), np.where(kind == 2, (hkind == 1) & (ended | (prev == 1)), (hkind == 3) & (ended | (prev == 3)))),
                ),
            ),
        )
        bad[tdoc[~fine]] = True
        self.bad = bad
        self.value = value

        # Children of each container, in order.
        kids = np.flatnonzero(value & (holder >= 0) & ~bad[tdoc])
        kids = kids[np.argsort(holder[kids], kind="stable")]
        self.kids = kids
        self.kid_at = np.searchsorted(holder[kids], np.arange(m + 1))
        self.null = (kind == 0) & (b[tok] == 110) if m else np.zeros(0, bool)
        self.entry_kids = kids[kind[holder[kids]] == 1]
        slashes = np.cumsum(slash)
        self.slashed = (kind == 7) & (slashes[np.clip(stop - 1, 0, n - 1)] > slashes[tok]) & ~bad[tdoc] if m else np.zeros(0, bool)
        self.absent = self.null | self.equals(np.arange(m), UNDEFINED)
        self.known: dict[str, np.ndarray] = {}

    def equals(self, t: np.ndarray, text: str) -> np.ndarray:
        """Which of the tokens are strings that read as ``text``."""
        raw = text.encode()
        out = (self.kind[t] == 7) & (self.stop[t] - self.tok[t] == len(raw) + 2)
        at = np.flatnonzero(out)
        for j, byte in enumerate(raw):
            at = at[self.b[self.tok[t[at]] + 1 + j] == byte]
        out[:] = False
        out[at] = True
        for i in np.flatnonzero(self.slashed[t]).tolist():
            out[i] = self.string(int(t[i])) == text
        return out

    def entry(self, key: str) -> np.ndarray:
        """For every token the value of its entry ``key``, -1 without one; of equal keys the last."""
        if key not in self.known:
            out = np.full(len(self.tok), -1)
            hit = self.entry_kids[self.equals(self.entry_kids - 2, key)]
            out[self.holder[hit]] = hit
            self.known[key] = out
        return self.known[key]

    def expand(self, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Children of all containers in ``t``: (index into t, position, child)."""
        low = self.kid_at[t]
        count = self.kid_at[t + 1] - low
        src = np.repeat(np.arange(len(t)), count)
        pos = np.arange(len(src)) - np.repeat(np.cumsum(count) - count, count)
        return src, pos, self.kids[np.repeat(low, count) + pos]

    def items(self, t: int) -> list[int]:
        return self.kids[self.kid_at[t] : self.kid_at[t + 1]].tolist()

    def string(self, t: int) -> str:
        raw = self.data[self.tok[t] : self.stop[t]]
        return json.loads(raw) if b"\\" in raw else raw[1:-1].decode()

    def object_of(self, d: int) -> tuple[int | None, str | None]:
        """The text's object, below lists of one element; or the text inside, if it is a string."""
        if self.bad[d]:
            return None, None
        t = int(self.root[d])
        while self.kind[t] == 3 and len(inner := self.items(t)) == 1:
            t = inner[0]
        if self.kind[t] == 7:
            return None, self.string(t)
        return (t if self.kind[t] == 1 else None), None


def _names(ix: Index, level: Level, t: np.ndarray) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Records of a level below the values ``t``: (index into t, name, value)."""
    kind = ix.kind[t]
    if level.form == "list":
        lists = np.flatnonzero((kind == 3) & ~ix.absent[t])
        src, pos, x = ix.expand(t[lists])
        keep = ~ix.null[x]
        bare = np.flatnonzero((kind != 3) & ~ix.absent[t])
        names = [str(i) for i in pos[keep].tolist()] + ["0"] * len(bare)
        return np.concatenate((lists[src[keep]], bare)), names, np.concatenate((x[keep], t[bare]))
    maps = np.flatnonzero(kind == 1)
    src, _, x = ix.expand(t[maps])
    src = maps[src]
    # Of equal keys the last holds.
    last = {(s, ix.string(v - 2)): v for s, v in zip(src.tolist(), x.tolist())}
    for i in np.flatnonzero(kind == 3).tolist():
        for pos, v in enumerate(ix.items(int(t[i]))):
            if not ix.null[v]:
                name = ix.entry("name")[v] if ix.kind[v] == 1 else -1
                last[i, ix.string(int(name)) if name >= 0 and ix.kind[name] == 7 else str(pos)] = v
    src, names, x = np.fromiter((k[0] for k in last), np.int64, len(last)), [k[1] for k in last], np.fromiter(last.values(), np.int64, len(last))
    listed = kind[src] == 3
    keep = np.flatnonzero(listed | ~ix.absent[x]) if not level.keep_null else np.arange(len(x))
    return src[keep], [names[i] for i in keep.tolist()], x[keep]


def level_rows(ix: Index, level: Level, t: np.ndarray, doc: np.ndarray, path: list[str], parent: list[str]) -> Iterator[tuple[str, np.ndarray, list[str], list[str]]]:
    """Rows of a level and those below it, per entity: (entity, texts, parent paths, record paths).

    ``t`` are values of the texts ``doc`` at the paths ``path``. All texts of the index go down a level at once.
    """
    for k in level.at:
        found = np.where(ix.kind[t] == 1, ix.entry(k)[t], -1)
        at = np.flatnonzero(found >= 0)
        step, rows = "/" + escape(k), at.tolist()
        t, doc, path, parent = found[at], doc[at], [path[i] + step for i in rows], [parent[i] for i in rows]
    if not len(t):
        return
    src, names, x = _names(ix, level, t)
    if not len(x):
        return
    rows, docs = src.tolist(), doc[src]
    own = [f"{path[i]}/{n if '/' not in n and '~' not in n else escape(n)}" for i, n in zip(rows, names)]
    if level.entity:
        yield level.entity, docs, [parent[i] for i in rows], own
    for below in level.children:
        if below.at or level.entity is None:
            yield from level_rows(ix, below, x, docs, own, own)
        else:
            objects = np.flatnonzero(ix.kind[x] == 1)
            inner = [own[i] for i in objects.tolist()]
            yield from level_rows(ix, below, x[objects], docs[objects], inner, inner)


def _chunks(rows: list[tuple]) -> Iterator[list[tuple]]:
    chunk, size = [], 0
    for r in rows:
        if chunk and size + len(r[-1]) > CHUNK_BYTES:
            yield chunk
            chunk, size = [], 0
        chunk.append(r)
        size += len(r[-1])
    if chunk:
        yield chunk


def read_groups(rows: list[tuple[str, int, str, bytes]], layout: dict[str, tuple[Level, ...]]) -> Iterator[pa.RecordBatch]:
    """Child rows of (source table, record number, group, text) rows, a batch per entity and chunk."""
    while rows:
        inner = []
        for chunk in _chunks(rows):
            ix = Index([r[-1] for r in chunk])
            tables = pa.array([r[0] for r in chunk], pa.string())
            numbers = pa.array([r[1] for r in chunk], pa.int64())
            roots: dict[str, tuple[list[int], list[int]]] = {}
            for d, (table, number, group, _) in enumerate(chunk):
                t, text = ix.object_of(d)
                if text is not None:
                    inner.append((table, number, group, text.encode("utf-8", "replace")))
                if t is not None:
                    at = roots.setdefault(group, ([], []))
                    at[0].append(t)
                    at[1].append(d)
            for group, (ts, ds) in roots.items():
                prefix = f"/{escape(group)}" if group else ""
                for level in layout[group]:
                    for entity, docs, parents, own in level_rows(ix, level, np.array(ts), np.array(ds), [prefix] * len(ts), [""] * len(ts)):
                        at = pa.array(docs)
                        cols = [tables.take(at), numbers.take(at), pa.array([entity] * len(own), pa.string()), pa.array(parents, pa.string()), pa.array(own, pa.string())]
                        yield pa.RecordBatch.from_arrays(cols, schema=_OUT)
        rows = inner  # texts inside texts, shorter each time


def flatten_nested(groups: DataFrame, layout: dict[str, tuple[Level, ...]]) -> DataFrame:
    """Child rows of nested groups: (source_table, record_no, entity, parent_path, record_path).

    ``groups`` has source_table, record_no, group_name and group_text (JSON). Paths
    are JSON Pointers that begin with the group's name (none for the group ``""``).
    A null text, one that is not valid JSON or whose value is not an object has no
    records; a group may also be JSON text in a JSON string, or the only element of
    a list, to any depth. Null, absent and ``__undefined`` lists are empty; a bare
    element in a list's place is element 0; null elements are counted but are no
    records; null or ``__undefined`` entries of a map are none either, but where
    the level keeps them. Of equal keys or names the last holds. Repeated rows give
    repeated results, extra columns are not looked at.

    Needs no shuffle: each Arrow batch is indexed where it is read, in chunks of a
    bounded size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b["group_text"].cast(pa.binary())
            rows = [
                (t, n, g, x)
                for t, n, g, x in zip(b["source_table"].to_pylist(), b["record_no"].to_pylist(), b["group_name"].to_pylist(), texts.to_pylist())
                if x is not None
            ]
            yield from read_groups(rows, layout)

    known = groups.where(F.col("group_name").isin(*layout)).select("source_table", F.col("record_no").cast("long").alias("record_no"), "group_name", "group_text")
    return known.where("group_text is not null").mapInArrow(run, ROW)
