"""Parent links to full hierarchies by contraction of partition-local chains.

A *record* says how one node's path starts: the path before node ``id`` is the path
before ``parent`` followed by ``seg``, which stands for ``w`` keys (the lowest of which is
``low``). At first ``seg`` is just the parent's key. A parent that has no
record is a root. What segments are and how they join is a :class:`Fold`: keys of a path, or
one value that is taken down a path. Contracting replaces chains by longer segments:

* records are laid out in key ranges, where related keys tend to be neighbours, and
  every chain inside a range is followed to its *exit*, the record whose parent lies
  elsewhere;
* exits whose parent is a root, or runs into a cycle of its range, are solved unless
  others hang on them; all others become the records of a smaller forest, solved in
  the same way;
* paths of the smaller forest are then extended inside each range.

The smaller forest's last level, of at most ``RECORDS_PER_TASK`` records, is solved in one
task. Where ranges contract too little, a level of coin contraction by joins takes the
place: records whose coin is 1 and whose parent's coin is 0 are bypassed, a quarter
of them on average whatever the keys look like. Coins are thrown anew on every level, for
the same ones would leave the same records. Each level is written before the next begins.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.plans.runtime import durable, release, settled

#: Records that one task follows in memory.
RECORDS_PER_TASK = 200_000
#: A level of ranges that leaves more than this share is followed by coin contraction.
POOR = 0.7
#: A level of coin contraction that leaves at most this share is followed by another.
POOR_COIN = 0.85
#: Characters of paths in one output batch.
BATCH_CHARS = 4_000_000

RECORD = "tree_no long, id string, parent string, w long, seg string, low string, tag int"
SOLUTION = "tree_no long, id string, root string, depth long, prefix string, cyclic boolean, tag int"
_CONTRACTED = "answer boolean, tree_no long, id string, top string, w long, seg string, low string, parent string, cycle string, part int"


#: Hexadecimal digits of one block of a set, and members that it stands for: a long without its sign.
DIGITS, BITS = 15, 60


def block_at(text: Column, at: Column) -> Column:
    """The block of a set's text that begins at ``at`` (from 1), as a long."""
    return F.conv(F.substring(text, at, F.lit(DIGITS)), 16, 10).cast("long")


def block_text(bits: Column) -> Column:
    return F.lpad(F.hex(bits), DIGITS, "0")


def bits_text(bits: Column, n: int) -> Column:
    """Text of a set from ``bits``, a map of block (from 0) to long: ``n`` blocks of ``DIGITS`` digits."""
    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda b: block_text(F.coalesce(bits[b], F.lit(0).cast("long")))), "")


@dataclass(frozen=True)
class Fold:
    """How segments join: ``path`` lines keys up by ``sep``; ``nearest`` keeps the lower of two that are not null, ``least`` the lesser;
    ``union`` joins sets in the form of :func:`bits_text`, all of one length."""

    kind: str
    sep: str = "/"

    def joined(self, upper: Column, lower: Column) -> Column:
        if self.kind == "path":
            return F.concat_ws(self.sep, upper, lower)
        if self.kind == "union":
            blocks = F.sequence(F.lit(1), F.length(upper), F.lit(DIGITS))
            both = F.array_join(F.transform(blocks, lambda at: block_text(block_at(upper, at).bitwiseOR(block_at(lower, at)))), "")
            return F.when(upper.isNull(), lower).when(lower.isNull(), upper).otherwise(both)
        return F.coalesce(lower, upper) if self.kind == "nearest" else F.least(upper, lower)

    def prefix(self, seg: Column) -> Column:
        return F.concat(seg, F.lit(self.sep)) if self.kind == "path" else seg

    def step(self, above: str | None, seg: str | None) -> str | None:
        """What goes on the stack of a path for one record: its own part of a path's text, or the value so far."""
        if self.kind == "path":
            return seg + self.sep
        if above is None or seg is None:
            return seg if above is None else above
        if self.kind == "union":
            return f"{int(above, 16) | int(seg, 16):0{len(seg)}X}"
        return seg if self.kind == "nearest" else min(above, seg, key=str.encode)

    def held(self, stack: list) -> str | None:
        return "".join(stack) if self.kind == "path" else stack[-1]


PATH = Fold("path")


class _Local:
    """Chains among the records of one group."""

    def __init__(self, g: pd.DataFrame, fold: Fold):
        self.fold = fold
        self.tree, self.id = g["tree_no"].to_numpy(), g["id"].to_numpy(object)
        self.parent, self.seg, self.low = (g[c].to_numpy(object) for c in ("parent", "seg", "low"))
        self.w = g["w"].to_numpy(np.int64)
        n = self.n = len(g)
        self.trees = np.unique(self.tree)
        self.index = pd.Index(self._named(self.tree, self.id))
        up = self.index.get_indexer(self._named(self.tree, self.parent))
        self.up = np.where(up < 0, n, up).astype(np.int64)
        self._cycles()

    def _named(self, tree: np.ndarray, key: np.ndarray) -> np.ndarray | list:
        return key if len(self.trees) == 1 else [f"{t}/{k}" for t, k in zip(tree.tolist(), key.tolist())]

    def find(self, g: pd.DataFrame) -> np.ndarray:
        """Positions of the (tree_no, id) rows of ``g`` that are records here."""
        g = g[g["tree_no"].isin(self.trees)]
        at = self.index.get_indexer(self._named(g["tree_no"].to_numpy(), g["id"].to_numpy(object))) if len(g) else np.array([], int)
        return at[at >= 0]

    def _cycles(self) -> None:
        """``cycle[i]``: smallest key of the cycle that record i is on or runs into, else None."""
        n = self.n
        jump = np.append(self.up, n)
        for _ in range(max(1, n.bit_length()) + 1):
            jump = jump[jump]
        self.cycle = np.full(n, None, dtype=object)
        into = np.flatnonzero(jump[:n] < n)
        of: dict[int, str] = {}
        for i in set(jump[into].tolist()):
            if i in of:
                continue
            ring, j = [i], int(self.up[i])
            while j != i:
                ring.append(j)
                j = int(self.up[j])
            smallest = min((self.low[r] for r in ring), key=str.encode)
            of.update(dict.fromkeys(ring, smallest))
        for i in into.tolist():
            self.cycle[i] = of[int(jump[i])]
        self.free = jump[:n] == n

    def walk(self, start: Callable[[int], str | None]) -> Iterator[tuple[int, int, int, list, list]]:
        """Acyclic records from the exits down: (record, exit, keys below the exit's path, stack of segments, lows).

        Depth first, so that only the path that is being followed is held.
        """
        n, step = self.n, self.fold.step
        below = np.flatnonzero(self.free & (self.up < n))
        below = below[np.argsort(self.up[below], kind="stable")]
        first = np.searchsorted(self.up[below], np.arange(n + 1)).tolist()
        kids, w, seg, low = below.tolist(), self.w.tolist(), self.seg, self.low
        for top in np.flatnonzero(self.free & (self.up == n)).tolist():
            stack, weight, lows = [start(top)], [0], [None]
            yield top, top, 0, stack, lows
            todo = [(c, 1) for c in kids[first[top] : first[top + 1]]]
            while todo:
                i, d = todo.pop()
                del stack[d:], weight[d:], lows[d:]
                stack.append(step(stack[-1], seg[i]))
                weight.append(weight[-1] + w[i])
                lows.append(low[i])
                yield i, top, weight[-1], stack, lows
                if first[i] < first[i + 1]:
                    todo += [(c, d + 1) for c in kids[first[i] : first[i + 1]]]


def _groups(batches: Iterator[pd.DataFrame], column: str) -> Iterator[pd.DataFrame]:
    """Whole groups of rows that are sorted by ``column``; a group's size is bounded by its layout."""
    held: list[pd.DataFrame] = []
    for b in batches:
        while len(b):
            first = b[column].iloc[0]
            if held and held[-1][column].iloc[-1] != first:
                yield pd.concat(held, ignore_index=True)
                held = []
            run = int((b[column].to_numpy() == first).cumprod().sum())
            held.append(b.iloc[:run])
            b = b.iloc[run:]
    if held:
        yield pd.concat(held, ignore_index=True)


def _batched(rows: Iterator[tuple], columns: list[str], text_at: int) -> Iterator[pd.DataFrame]:
    out, size = [], 0
    for r in rows:
        out.append(r)
        size += len(r[text_at] or "")
        if size > BATCH_CHARS or len(out) >= 20_000:
            yield pd.DataFrame(out, columns=columns)
            out, size = [], 0
    if out:
        yield pd.DataFrame(out, columns=columns)


_SOLVED = [c.split()[0] for c in SOLUTION.split(", ")]
_PARTS = [c.split()[0] for c in _CONTRACTED.split(", ")]


def _solve_group(fold: Fold) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Solutions of records and, in ``kind`` 2, of exits that were solved elsewhere."""

    def rows(g: pd.DataFrame) -> Iterator[tuple]:
        own = g[g["kind"] == 0]
        x = _Local(own, fold)
        tag, tree = own["tag"].tolist(), x.tree.tolist()
        for i in np.flatnonzero(~x.free).tolist():
            yield tree[i], x.id[i], x.cycle[i], -1, None, True, tag[i]
        known = {k[:2]: k[2:] for k in g.loc[g["kind"] == 2, _SOLVED[:6]].itertuples(index=False, name=None)}
        exits: dict[int, tuple] = {}

        def start(i: int) -> str | None:
            found = known.get((tree[i], x.id[i]))
            own_prefix = x.seg[i] + fold.sep if fold.kind == "path" else x.seg[i]
            exits[i] = found or (x.parent[i], int(x.w[i]), own_prefix, False)
            return ("" if exits[i][2] is None else exits[i][2]) if fold.kind == "path" else exits[i][2]

        for i, top, w, stack, _ in x.walk(start):
            root, depth, _, cyclic = exits[top]
            if cyclic:
                yield tree[i], x.id[i], root, -1, None, True, tag[i]
            else:
                yield tree[i], x.id[i], root, int(depth) + w, fold.held(stack), False, tag[i]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in _groups(batches, "part"):
            yield from _batched(rows(g), _SOLVED, 4)

    return run


def _contract_group(fold: Fold) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Exits of each range, and for the records asked for from elsewhere the way to their exit."""

    def rows(g: pd.DataFrame) -> Iterator[tuple]:
        x = _Local(g[g["kind"] == 0], fold)
        wanted = set(x.find(g[g["kind"] == 1]).tolist())
        part, tree = int(g["part"].iloc[0]), x.tree.tolist()
        for i in wanted:
            if not x.free[i]:
                yield True, tree[i], x.id[i], None, 0, None, None, None, x.cycle[i], part
        for i, top, w, stack, lows in x.walk(lambda _: "" if fold.kind == "path" else None):
            if i == top:
                yield False, tree[i], x.id[i], None, int(x.w[i]), x.seg[i], x.low[i], x.parent[i], None, part
            if i in wanted:
                way, low = None, None
                if i != top:
                    way, low = fold.held(stack), min(lows[1:], key=str.encode)
                    way = way[: -len(fold.sep)] if fold.kind == "path" else way
                yield True, tree[i], x.id[i], x.id[top], w, way, low, None, None, part

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in _groups(batches, "part"):
            yield from _batched(rows(g), _PARTS, 5)

    return run


def _laid_out(rows: DataFrame, parts: int) -> DataFrame:
    return rows.repartition(parts, "part").sortWithinPartitions("part", "kind")


def _by_ranges(records: DataFrame, n: int, level: int, fold: Fold) -> DataFrame:
    """Records are laid out in ranges of their keys, contracted there, and extended again."""
    width = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(n, width), math.ceil(n / RECORDS_PER_TASK))
    placed = durable(records.repartitionByRange(parts, "tree_no", "id").withColumn("part", F.spark_partition_id()))
    target = placed.select("tree_no", F.col("id").alias("parent"), F.col("part").alias("to"))
    own = durable(placed.join(target, ["tree_no", "parent"], "left").withColumn("kind", F.lit(0)))
    release(placed)
    asked = own.where("part <> to").select("tree_no", F.col("parent").alias("id"), F.col("to").alias("part")).distinct().withColumn("kind", F.lit(1))
    work = own.drop("to").unionByName(asked, allowMissingColumns=True)
    split = durable(_laid_out(work, parts).mapInPandas(_contract_group(fold), _CONTRACTED))
    answers = split.where("answer").select("tree_no", F.col("id").alias("parent"), "top", F.col("w").alias("aw"), F.col("seg").alias("aseg"), F.col("low").alias("alow"), "cycle", "answer")
    exits = split.where("not answer").select("tree_no", "id", "parent", "w", "seg", "low", "part").join(answers, ["tree_no", "parent"], "left")
    exits = durable(exits)
    release(split)
    further = exits.where("answer and cycle is null")
    tops = further.select("tree_no", F.col("top").alias("id")).distinct().withColumn("needed", F.lit(True))
    ended = durable(exits.where("answer is null or cycle is not null").join(tops, ["tree_no", "id"], "left"))
    solved = ended.where("needed is null").select(
        "tree_no", "id",
        F.coalesce("cycle", "parent").alias("root"),
        F.when(F.col("cycle").isNull(), F.col("w")).otherwise(-1).alias("depth"),
        F.when(F.col("cycle").isNull(), fold.prefix(F.col("seg"))).alias("prefix"),
        F.col("cycle").isNotNull().alias("cyclic"), F.col("part").alias("tag"),
    )
    # An ended exit on which others hang stays a record; one that runs into a cycle becomes a cycle of its own.
    rest = further.select(
        "tree_no", "id", F.col("top").alias("parent"), (F.col("w") + F.col("aw")).alias("w"),
        fold.joined(F.col("aseg"), F.col("seg")).alias("seg"), _lower(F.col("low"), F.col("alow")).alias("low"), F.col("part").alias("tag"),
    ).unionByName(
        ended.where("needed").select(
            "tree_no", "id", F.when(F.col("cycle").isNull(), F.col("parent")).otherwise(F.col("id")).alias("parent"), "w", "seg",
            F.coalesce("cycle", "low").alias("low"), F.col("part").alias("tag"),
        )
    )
    rest = durable(rest)
    release(exits)
    left = rest.count()
    below = solve(rest, fold, left, coin=left > POOR * n, level=level + 1)
    if left > RECORDS_PER_TASK:
        release(rest)
    known = solved.unionByName(below).withColumnRenamed("tag", "part").withColumn("kind", F.lit(2))
    both = own.drop("to").unionByName(known, allowMissingColumns=True)
    return _laid_out(both, parts).mapInPandas(_solve_group(fold), SOLUTION)


def _lower(a: Column, b: Column) -> Column:
    return F.least(a, b)


def _by_coin(records: DataFrame, n: int, level: int, fold: Fold) -> DataFrame:
    """One level of coin contraction: bypassed records hang on a kept parent, their children are moved up to it."""
    coin = lambda key: F.pmod(F.xxhash64(F.lit(level), "tree_no", key), F.lit(2))
    # A record is bypassed only if its parent has a record too or is a root: either way the parent stays.
    marked = durable(records.withColumn("out", (coin("id") == 1) & (coin("parent") == 0)))
    out = marked.where("out").drop("out")
    via = out.select("tree_no", F.col("id").alias("parent"), F.col("parent").alias("vparent"), F.col("w").alias("vw"), F.col("seg").alias("vseg"), F.col("low").alias("vlow"))
    kept = marked.where("not out").drop("out").join(via, ["tree_no", "parent"], "left").select(
        "tree_no", "id", F.coalesce("vparent", "parent").alias("parent"), (F.col("w") + F.coalesce("vw", F.lit(0))).alias("w"),
        fold.joined(F.col("vseg"), F.col("seg")).alias("seg"), F.coalesce(_lower(F.col("low"), F.col("vlow")), F.col("low")).alias("low"), "tag",
    )
    kept = durable(kept)
    left = kept.count()
    # Coins leave cycles of one record, which ranges take out.
    done = settled(lambda: solve(kept, fold, left, coin=left <= POOR_COIN * n, level=level + 1))
    release(kept)
    over = done.select("tree_no", F.col("id").alias("parent"), F.col("root").alias("proot"), F.col("depth").alias("pdepth"), F.col("prefix").alias("pprefix"), "cyclic")
    acyclic = ~F.coalesce(F.col("cyclic"), F.lit(False))
    prefix = F.concat(F.coalesce("pprefix", F.lit("")), fold.prefix(F.col("seg"))) if fold.kind == "path" else fold.joined(F.col("pprefix"), F.col("seg"))
    back = out.join(over, ["tree_no", "parent"], "left").select(
        "tree_no", "id", F.coalesce("proot", "parent").alias("root"),
        F.when(acyclic, F.coalesce("pdepth", F.lit(0)) + F.col("w")).otherwise(-1).alias("depth"),
        F.when(acyclic, prefix).alias("prefix"), F.coalesce("cyclic", F.lit(False)).alias("cyclic"), "tag",
    )
    return done.unionByName(back)


def solve(records: DataFrame, fold: Fold, n: int, *, coin: bool = False, level: int = 0) -> DataFrame:
    """Solution of every record: root (or the cycle's smallest key), depth, what the path before the node folds to.

    More than ``RECORDS_PER_TASK`` records, and those of level 0, are read here and not again when the result is.
    """
    if level and n <= RECORDS_PER_TASK:
        known = F.lit(None)
        one = records.withColumns({
            "part": F.lit(0), "kind": F.lit(0), "root": known.cast("string"), "depth": known.cast("long"), "prefix": known.cast("string"), "cyclic": known.cast("boolean"),
        })
        return one.coalesce(1).mapInPandas(_solve_group(fold), SOLUTION)
    return _by_coin(records, n, level, fold) if coin else _by_ranges(records, n, level, fold)


def linked_nodes(nodes: DataFrame) -> DataFrame:
    """(tree_no, node_key, parent, has) of :func:`hierarchy`'s input: the row of each node that holds; ``has`` where the parent is a node."""
    trimmed = F.regexp_replace("parent_key", r"(?U)^[\s\p{Z}]+|[\s\p{Z}]+$", "")
    last = nodes.where("node_key is not null").groupBy("tree_no", "node_key").agg(
        F.max(F.struct(F.col("at"), trimmed.alias("parent"))).alias("r")
    )
    known = durable(
        last.select("tree_no", "node_key", F.when(~F.col("r.parent").isin("", "__undefined"), F.col("r.parent")).alias("parent"))
    )
    keys = known.select("tree_no", F.col("node_key").alias("parent"), F.lit(True).alias("has"))
    linked = durable(known.join(keys, ["tree_no", "parent"], "left"))
    release(known)
    return linked


def solved_nodes(linked: DataFrame, fold: Fold, seg: Column) -> DataFrame:
    """Solutions of the nodes of ``linked`` that have a parent; ``seg`` is what a node's parent adds to the fold."""
    records = linked.where("has").select(
        "tree_no", F.col("node_key").alias("id"), "parent", F.lit(1).cast("long").alias("w"), seg.alias("seg"), F.col("parent").alias("low"), F.lit(0).alias("tag")
    )
    return solve(records, fold, records.count()).drop("tag")


def hierarchy(nodes: DataFrame, *, sep: str = "/") -> DataFrame:
    """Root, depth and full path of every node of ``nodes`` (tree_no, node_key, parent_key, at).

    Of several rows of a node the one with the latest ``at`` holds (null lowest,
    ties by greatest parent key); rows with a null node key are left out. Parent
    keys are trimmed of whitespace. A null, blank or ``__undefined`` parent, or one
    without a node in its tree, makes a root. Columns out: tree_no, node_key,
    root_key, depth, full_path. Nodes on a cycle, or whose ancestors run into one,
    have depth -1, an empty path, and the smallest key of the cycle as root.
    """
    linked = linked_nodes(nodes)
    roots = linked.where("has is null").select(
        "tree_no", "node_key", F.col("node_key").alias("root_key"), F.lit(0).cast("long").alias("depth"), F.col("node_key").alias("full_path")
    )
    solved = solved_nodes(linked, Fold("path", sep), F.col("parent"))
    inner = solved.select(
        "tree_no", F.col("id").alias("node_key"), F.col("root").alias("root_key"), "depth",
        F.when(F.col("cyclic"), "").otherwise(F.concat("prefix", "id")).alias("full_path"),
    )
    return roots.unionByName(inner)


def taken_down(linked: DataFrame, values: DataFrame, kind: str) -> DataFrame:
    """What each node gets from its ancestors: (tree_no, node_key, depth, cyclic, above).

    ``values`` are (tree_no, node_key, value as text), each node at most once. ``above`` is that of the
    nearest ancestor that has one (``kind`` nearest), the least of all ancestors' (least) or all of theirs
    together (union), null if none has any. Nodes on a cycle or below one, and roots, have none. One value goes down each path, so
    the work does not grow with the number of ancestor-descendant pairs.
    """
    of_parent = values.select("tree_no", F.col("node_key").alias("parent"), "value")
    with_value = durable(linked.join(of_parent, ["tree_no", "parent"], "left"))
    solved = solved_nodes(with_value, Fold(kind), F.col("value"))
    release(with_value)
    none = F.lit(None).cast("string")
    roots = linked.where("has is null").select("tree_no", "node_key", F.lit(0).cast("long").alias("depth"), F.lit(False).alias("cyclic"), none.alias("above"))
    return roots.unionByName(solved.select("tree_no", F.col("id").alias("node_key"), "depth", "cyclic", F.when(~F.col("cyclic"), F.col("prefix")).alias("above")))


_TOTALS = "tree_no long, id string, size long, tall long, tag int"
_SUMMED = "answer boolean, tree_no long, id string, parent string, top string, w long, size long, tall long, part int"


class _Sums:
    """Sizes and heights inside one group of (tree_no, id, parent, w, size, tall) records, children before parents."""

    def __init__(self, g: pd.DataFrame):
        self.tree, self.id, self.parent = g["tree_no"].to_numpy(), g["id"].to_numpy(object), g["parent"].to_numpy(object)
        self.w, self.size, self.tall = (g[c].to_numpy(np.int64).copy() for c in ("w", "size", "tall"))
        n = self.n = len(g)
        self.trees = np.unique(self.tree)
        self.index = pd.Index(self.named(self.tree, self.id))
        up = self.index.get_indexer(self.named(self.tree, self.parent))
        self.up = np.where(up < 0, n, up).astype(np.int64)
        # Steps and distance to the top of the fragment, by doubling.
        top = np.where(self.up < n, self.up, np.arange(n))
        step, far = (self.up < n).astype(np.int64), np.where(self.up < n, self.w, 0)
        for _ in range(max(1, n.bit_length()) + 1):
            step, far, top = step + step[top], far + far[top], top[top]
        self.top, self.step, self.far = top, step, far

    def named(self, tree: np.ndarray, key: np.ndarray) -> np.ndarray | list:
        return key if len(self.trees) == 1 else [f"{t}/{k}" for t, k in zip(tree.tolist(), key.tolist())]

    def find(self, g: pd.DataFrame) -> np.ndarray:
        g = g[g["tree_no"].isin(self.trees)]
        return self.index.get_indexer(self.named(g["tree_no"].to_numpy(), g["id"].to_numpy(object))) if len(g) else np.array([], int)

    def sum(self) -> None:
        order = np.argsort(-self.step, kind="stable")
        levels = self.step[order]
        for block in np.split(order, np.flatnonzero(np.diff(levels)) + 1) if self.n else ():
            inner = block[self.up[block] < self.n]
            np.add.at(self.size, self.up[inner], self.size[inner])
            np.maximum.at(self.tall, self.up[inner], self.tall[inner] + self.w[inner])


def _sum_contract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Fragments of each range with their size and height, and for records asked for from elsewhere the way to their top."""
    columns = [c.split()[0] for c in _SUMMED.split(", ")]
    for g in _groups(batches, "part"):
        x, part = _Sums(g[g["kind"] == 0]), int(g["part"].iloc[0])
        asked = x.find(g[g["kind"] == 1])
        x.sum()
        tops = np.flatnonzero(x.up == x.n)
        asked = asked[asked >= 0]
        none = lambda k: np.full(k, None, object)
        yield pd.DataFrame(dict(zip(columns, (False, x.tree[tops], x.id[tops], x.parent[tops], none(len(tops)), x.w[tops], x.size[tops], x.tall[tops], part))), columns=columns)
        yield pd.DataFrame(dict(zip(columns, (True, x.tree[asked], x.id[asked], none(len(asked)), x.id[x.top[asked]], x.far[asked], 0, 0, part))), columns=columns)


def _sum_expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Totals of all records: their own, and in ``kind`` 2 what fragments of other ranges add to a record."""
    for g in _groups(batches, "part"):
        x, more = _Sums(g[g["kind"] == 0]), g[g["kind"] == 2]
        at = x.find(more)
        more = more[more["tree_no"].isin(x.trees)][at >= 0]
        at = at[at >= 0]
        np.add.at(x.size, at, more["size"].to_numpy(np.int64))
        np.maximum.at(x.tall, at, more["tall"].to_numpy(np.int64))
        x.sum()
        tags = g.loc[g["kind"] == 0, "tag"].to_numpy()
        yield pd.DataFrame({"tree_no": x.tree, "id": x.id, "size": x.size, "tall": x.tall, "tag": tags})


def _totals(records: DataFrame, n: int, level: int = 0) -> DataFrame:
    """Sizes and heights of (tree_no, id, parent, w, size, tall, tag) records of an acyclic forest; a record's edge to its parent is ``w`` long."""
    if level and n <= RECORDS_PER_TASK:
        return records.withColumns({"part": F.lit(0), "kind": F.lit(0)}).coalesce(1).mapInPandas(_sum_expand, _TOTALS)
    width = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(n, width), math.ceil(n / RECORDS_PER_TASK))
    placed = durable(records.repartitionByRange(parts, "tree_no", "id").withColumn("part", F.spark_partition_id()))
    target = placed.select("tree_no", F.col("id").alias("parent"), F.col("part").alias("to"))
    own = durable(placed.join(target, ["tree_no", "parent"], "left").withColumn("kind", F.lit(0)))
    release(placed)
    asked = own.where("part <> to").select("tree_no", F.col("parent").alias("id"), F.col("to").alias("part")).distinct().withColumn("kind", F.lit(1))
    split = durable(_laid_out(own.drop("to").unionByName(asked, allowMissingColumns=True), parts).mapInPandas(_sum_contract, _SUMMED))
    ways = split.where("answer").select("tree_no", F.col("id").alias("parent"), "top", F.col("w").alias("aw"), F.col("part").alias("to"))
    tops = durable(split.where("not answer").select("tree_no", "id", "parent", "w", "size", "tall", "part").join(ways, ["tree_no", "parent"], "left"))
    release(split)
    rest = tops.select("tree_no", "id", F.col("top").alias("parent"), (F.col("w") + F.coalesce("aw", F.lit(0))).alias("w"), "size", "tall", F.col("part").alias("tag"))
    rest = durable(rest)
    left = rest.count()
    below = _by_joins(rest) if left > POOR * n and left > RECORDS_PER_TASK else _totals(rest, left, level + 1)
    if left > RECORDS_PER_TASK:
        release(rest)
    sums = below.select("tree_no", "id", F.col("size").alias("__size"), F.col("tall").alias("__tall"))
    added = tops.where("to is not null").join(sums, ["tree_no", "id"]).groupBy("tree_no", "parent", "to").agg(
        F.sum("__size").alias("size"), F.max(F.col("__tall") + F.col("w")).alias("tall")
    ).select("tree_no", F.col("parent").alias("id"), F.col("to").alias("part"), "size", "tall", F.lit(2).alias("kind"))
    return _laid_out(own.drop("to").unionByName(added, allowMissingColumns=True), parts).mapInPandas(_sum_expand, _TOTALS)


def _by_joins(records: DataFrame) -> DataFrame:
    """The same without ranges, for forests whose keys say nothing of the tree: leaves are merged into their parents, a level a round."""
    todo, done = records, None
    while True:
        inner = todo.select("tree_no", F.col("parent").alias("id")).where("id is not null").distinct()
        leaves = durable(todo.join(inner, ["tree_no", "id"], "left_anti"))
        done = leaves if done is None else durable(done.unionByName(leaves))
        add = leaves.where("parent is not null").groupBy("tree_no", F.col("parent").alias("id")).agg(F.sum("size").alias("__s"), F.max(F.col("tall") + F.col("w")).alias("__t"))
        todo = durable(todo.join(inner, ["tree_no", "id"], "left_semi").join(add, ["tree_no", "id"], "left").select(
            "tree_no", "id", "parent", "w", (F.col("size") + F.coalesce("__s", F.lit(0))).alias("size"), F.greatest("tall", F.coalesce("__t", F.lit(0))).alias("tall"), "tag",
        ))
        if todo.isEmpty():
            return done.select("tree_no", "id", "size", "tall", "tag")


def descendant_counts(nodes: DataFrame) -> DataFrame:
    """Descendants, children and height of each acyclic node that has any: (tree_no, node_key, descendants, children, height).

    Sizes and heights go up the same contraction as paths go down; pairs are never made.
    """
    linked = linked_nodes(nodes)
    acyclic = durable(taken_down(linked, linked.select("tree_no", "node_key", F.lit(None).cast("string").alias("value")).limit(0), "nearest").where("not cyclic").select("tree_no", "node_key"))
    kept = linked.join(acyclic, ["tree_no", "node_key"], "left_semi").select(
        "tree_no", F.col("node_key").alias("id"), F.when(F.col("has"), F.col("parent")).alias("parent"), F.lit(1).cast("long").alias("w"), F.lit(1).cast("long").alias("size"), F.lit(0).cast("long").alias("tall"), F.lit(0).alias("tag"),
    )
    kept = durable(kept)
    children = kept.where("parent is not null").groupBy("tree_no", F.col("parent").alias("id")).agg(F.count("*").alias("children"))
    out = _totals(kept, kept.count()).where("size > 1").join(children, ["tree_no", "id"])
    return out.select("tree_no", F.col("id").alias("node_key"), (F.col("size") - 1).alias("descendants"), "children", F.col("tall").alias("height"))


def marked_below(linked: DataFrame, marked: DataFrame) -> DataFrame:
    """(tree_no, node_key) of acyclic nodes that are in ``marked`` (tree_no, node_key), each once, or have a descendant there.

    Counts of marked nodes go up the contraction; neither paths nor pairs are made. ``linked`` is a copy and is deleted.
    """
    cyclic = settled(lambda: solved_nodes(linked, Fold("nearest"), F.lit(None).cast("string")).where("cyclic").select("tree_no", F.col("id").alias("node_key")))
    acyclic = linked.join(cyclic, ["tree_no", "node_key"], "left_anti").join(marked.withColumn("marked", F.lit(True)), ["tree_no", "node_key"], "left")
    kept = durable(acyclic.select(
        "tree_no", F.col("node_key").alias("id"), F.when(F.col("has"), F.col("parent")).alias("parent"), F.lit(1).cast("long").alias("w"),
        F.when(F.col("marked"), 1).otherwise(0).cast("long").alias("size"), F.lit(0).cast("long").alias("tall"), F.lit(0).alias("tag"),
    ))
    release(linked, cyclic)
    totals = _totals(kept, kept.count())
    release(kept)
    return totals.where("size > 0").select("tree_no", F.col("id").alias("node_key"))


#: Separator that joins keys where a path is taken apart again; no key may contain it.
UNSEEN = "\u0000"


def descendants(nodes: DataFrame) -> DataFrame:
    """Every ancestor-descendant pair of acyclic nodes: (tree_no, ancestor, descendant, distance).

    Rows are as many as all depths together, and come from the paths by an
    explode without a shuffle.
    """
    full = hierarchy(nodes, sep=UNSEEN).where("depth > 0")
    keys = F.split("full_path", UNSEEN)
    pairs = full.select("tree_no", "node_key", "depth", F.posexplode(F.slice(keys, 1, F.size(keys) - 1)).alias("pos", "ancestor"))
    return pairs.select("tree_no", "ancestor", F.col("node_key").alias("descendant"), (F.col("depth") - F.col("pos")).alias("distance"))
