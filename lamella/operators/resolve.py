"""Values along hierarchies: ancestor closures, fallbacks, inherited sets, reachability."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamella.operators import hierarchy as H
from lamella.plans.runtime import broadcast_if_small, durable, release, settled


def closure(nodes: DataFrame) -> DataFrame:
    """(node, ancestor, distance) of (node, parent) rows, each node with itself at 0.

    Parents without a node end a chain. Nodes on a cycle or below one have only
    themselves. Rows come from full paths without a join per level.
    """
    shaped = nodes.select(F.lit(0).cast("long").alias("tree_no"), F.col("node").alias("node_key"), F.col("parent").alias("parent_key"), F.lit(0).alias("at"))
    pairs = H.descendants(shaped).select(F.col("descendant").alias("node"), "ancestor", "distance")
    own = nodes.where("node is not null").select("node").distinct().select("node", F.col("node").alias("ancestor"), F.lit(0).cast("long").alias("distance"))
    return own.unionByName(pairs)


def _linked(nodes: DataFrame) -> DataFrame:
    """Nodes (node, parent) with an optional ``tree_no`` as the hierarchy operators take them."""
    tree = F.col("tree_no").cast("long") if "tree_no" in nodes.columns else F.lit(0).cast("long")
    return H.linked_nodes(nodes.select(tree.alias("tree_no"), F.col("node").alias("node_key"), F.col("parent").alias("parent_key"), F.lit(0).alias("at")))


def roots(nodes: DataFrame) -> DataFrame:
    """(node, root, depth) of acyclic nodes. No path is written down."""
    linked = _linked(nodes)
    below = H.solved_nodes(linked, H.Fold("nearest"), F.lit(None).cast("string")).where("not cyclic").select(F.col("id").alias("node"), "root", "depth")
    return linked.where("has is null").select(F.col("node_key").alias("node"), F.col("node_key").alias("root"), F.lit(0).cast("long").alias("depth")).unionByName(below)


def adjacency(edges: DataFrame) -> DataFrame:
    """Children of each parent: (parent, n, children as sorted text). Null parents and children are left out."""
    known = edges.where("parent is not null and node is not null").select("parent", "node").distinct()
    return known.groupBy("parent").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("node")), ",").alias("children"))


def invert(adjacent: DataFrame) -> DataFrame:
    """Child to parent from (parent, children array); of several parents the greatest holds."""
    return adjacent.select("parent", F.explode("children").alias("node")).groupBy("node").agg(F.max("parent").alias("parent"))


def nearest_value(nodes: DataFrame, values: DataFrame, default: Column | None = None) -> DataFrame:
    """First present value along each node's chain, itself first: (node, value, origin, distance).

    A row in ``values`` (node, value) is presence, so a present null stops the
    search. ``origin`` is ``self``, the ancestor, or ``default`` where no node of the
    chain has a row; then the value is ``default``. Nodes on a cycle or below one
    have their own value only. The nearest holder goes down each path; ancestor-descendant
    pairs are never made.
    """
    held = durable(values.select("node", F.col("value").alias("v")))
    holders = held.select(F.lit(0).cast("long").alias("tree_no"), F.col("node").alias("node_key"), F.col("node").alias("value"))
    down = settled(lambda: H.taken_down(_linked(nodes), holders, "nearest").select(F.col("node_key").alias("node"), "depth", "above"))
    own = held.select("node", F.lit(True).alias("has"))
    at = down.join(own, "node", "left").withColumn("holder", F.when(F.col("has"), F.col("node")).otherwise(F.col("above")))
    depths = down.select(F.col("node").alias("holder"), F.col("depth").alias("hdepth")).join(held.withColumnRenamed("node", "holder"), "holder")
    found = at.join(depths, "holder", "left")
    origin = F.when(F.col("holder").isNull(), "default").when(F.col("has"), "self").otherwise(F.col("holder"))
    value = F.when(F.col("holder").isNull(), default if default is not None else F.lit(None)).otherwise(F.col("v"))
    return found.select("node", value.alias("value"), origin.alias("origin"), (F.col("depth") - F.col("hdepth")).alias("distance"))


def parent_fallback(nodes: DataFrame, values: DataFrame) -> DataFrame:
    """Own value, else that of the parent, one hop and no further: (node, value)."""
    own = values.select("node", F.col("value").alias("own"))
    above = values.select(F.col("node").alias("parent"), F.col("value").alias("above"))
    return nodes.join(own, "node", "left").join(above, "parent", "left").select("node", F.coalesce("own", "above").alias("value"))


def merge_parent_map(nodes: DataFrame, entries: DataFrame) -> DataFrame:
    """Entries (node, key, value) of each node over those of its parent; the child's hold, one hop, flat."""
    own = entries.select("node", "key", "value", F.lit(0).alias("hop"))
    above = nodes.where("parent is not null").select("node", "parent").join(entries.select(F.col("node").alias("parent"), "key", "value"), "parent")
    both = own.unionByName(above.select("node", "key", "value", F.lit(1).alias("hop")))
    return both.groupBy("node", "key").agg(F.min_by("value", "hop").alias("value"), F.min("hop").alias("hop"))


def override_classes(chain: DataFrame, members: DataFrame) -> DataFrame:
    """Members (node, name) of each node against all of its ancestors': overridden, new or inherited."""
    above = chain.where("distance > 0").join(members.select(F.col("node").alias("ancestor"), "name").distinct(), "ancestor").select("node", "name", F.lit(0).alias("own"), F.lit(1).alias("above"))
    own = members.select("node", "name", F.lit(1).alias("own"), F.lit(0).alias("above"))
    both = own.unionByName(above).groupBy("node", "name").agg(F.max("own").alias("own"), F.max("above").alias("above"))
    return both.select("node", "name", F.when(F.col("own") + F.col("above") == 2, "overridden").when(F.col("own") == 1, "new").otherwise("inherited").alias("status"))


def override_counts(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """How many members of each node are overridden, new or inherited, as :func:`override_classes` has them: (node, status, n).

    Names are numbered, and each node's are a set of bits that goes down the paths and is joined with those
    below: neither ancestor-descendant pairs nor a row for each inherited name is made. ``members`` may repeat rows.
    """
    members = members.select("node", "name")
    names = durable(members.select("name").distinct().select("name", (F.row_number().over(Window.orderBy("name")) - 1).alias("no")))
    blocks = math.ceil(names.count() / H.BITS)
    if not blocks:
        return members.limit(0).select("node", F.lit("new").alias("status"), F.lit(0).cast("long").alias("n"))
    numbers = broadcast_if_small(names.withColumnRenamed("name", "known"))
    numbered = members.join(numbers, F.col("name").eqNullSafe(F.col("known")))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("no") % H.BITS)
    sets = numbered.groupBy("node", F.floor(F.col("no") / H.BITS).cast("int").alias("block")).agg(F.bit_or(bit).alias("bits"))
    own = durable(sets.groupBy("node").agg(H.bits_text(F.map_from_entries(F.collect_list(F.struct("block", "bits"))), blocks).alias("own")))
    held = own.where("node is not null").select(F.lit(0).cast("long").alias("tree_no"), F.col("node").alias("node_key"), F.col("own").alias("value"))
    above = H.taken_down(_linked(nodes), held, "union").where("above is not null").select(F.col("node_key").alias("node"), "above")
    none = F.lit("0" * (H.DIGITS * blocks))
    both = own.join(above, "node", "full").select("node", F.coalesce("own", none).alias("own"), F.coalesce("above", none).alias("above"))
    starts = F.sequence(F.lit(1), F.length("own"), F.lit(H.DIGITS))
    held_at, above_at = (lambda at, c=c: H.block_at(F.col(c), at) for c in ("own", "above"))
    total = lambda bits: F.aggregate(F.transform(starts, lambda at: F.bit_count(bits(at)).cast("long")), F.lit(0).cast("long"), lambda a, b: a + b)
    counts = F.array(
        F.struct(F.lit("overridden").alias("status"), total(lambda at: held_at(at).bitwiseAND(above_at(at))).alias("n")),
        F.struct(F.lit("new").alias("status"), total(lambda at: held_at(at).bitwiseAND(F.bitwise_not(above_at(at)))).alias("n")),
        F.struct(F.lit("inherited").alias("status"), total(lambda at: above_at(at).bitwiseAND(F.bitwise_not(held_at(at)))).alias("n")),
    )
    return both.select("node", F.explode(counts).alias("c")).select("node", "c.*").where("n > 0")


def walk_up(nodes: DataFrame, steps: int, *, stop: str | None = None) -> DataFrame:
    """(node, top): where at most ``steps`` (a power of two) steps to the parent lead from each node.

    A walk ends at a node without a parent, whose parent is no node, itself or ``stop``. Steps are
    doubled, so ``steps`` of them take log2 joins; a cycle ends a walk nowhere but by its steps.
    """
    known = durable(nodes.where("node is not null").groupBy("node").agg(F.max("parent").alias("parent")))
    has = known.select(F.col("node").alias("parent"), F.lit(True).alias("has"))
    ends = ~F.coalesce("has", F.lit(False)) | (F.col("parent") == F.lit(stop) if stop is not None else F.lit(False))
    at = durable(known.join(has, "parent", "left").select("node", F.when(ends, F.col("node")).otherwise(F.col("parent")).alias("top")))
    release(known)
    done = 1
    while done < steps:
        last, at = at, durable(at.join(at.select(F.col("node").alias("top"), F.col("top").alias("next")), "top").select("node", F.col("next").alias("top")))
        release(last)
        done *= 2
    return at


def expand_tiers(nodes: DataFrame, tier_roots: DataFrame, *, steps: int = 8, stop: str | None = "Exchange") -> DataFrame:
    """Members of each tier: nodes that a walk of at most ``steps`` parents leads to one of its roots, and the roots themselves in any case: (tier, id)."""
    below = walk_up(nodes, steps, stop=stop).join(tier_roots.select("tier", F.col("id").alias("top")), "top").select("tier", F.col("node").alias("id"))
    return below.unionByName(tier_roots.select("tier", "id")).distinct()


def priority_bucket(nodes: DataFrame, bucket_roots: Sequence[tuple[str, str]], other: str = "non_retryable") -> DataFrame:
    """Bucket of each node: the first in order of which an ancestor (or itself) is a root, else ``other``: (tree_no, node, bucket).

    ``nodes`` are (node, parent) with an optional tree_no; ``bucket_roots`` are (bucket, class) pairs in
    order of priority, a short fixed list. The least rank goes down each path. Nodes on a
    cycle or below one count for themselves only.
    """
    linked = _linked(nodes)
    rank = F.when(F.lit(False), F.lit(None).cast("string"))
    for i, (_, name) in enumerate(bucket_roots):
        rank = rank.when(F.col("node_key") == name, F.lit(f"{i:04d}"))
    ranked = linked.withColumn("value", rank)
    down = H.taken_down(linked, ranked.where("value is not null").select("tree_no", "node_key", "value"), "least")
    names = F.array(*[F.lit(b) for b, _ in bucket_roots])
    best = F.least("above", rank).cast("int")
    return down.select("tree_no", F.col("node_key").alias("node"), F.coalesce(F.get(names, best), F.lit(other)).alias("bucket"))


def close_scope(chain: DataFrame, scope: DataFrame) -> DataFrame:
    """Scope ids with all of their ancestors: (id, added), ``added`` for those that scope lacked."""
    all_ = chain.join(scope.select(F.col("id").alias("node")).distinct(), "node", "left_semi").groupBy(F.col("ancestor").alias("id")).agg(F.min("distance").alias("d"))
    asked = scope.select("id").distinct().withColumn("asked", F.lit(True))
    return all_.join(asked, "id", "full").select("id", F.col("asked").isNull().alias("added"))


def scope_with_ancestors(nodes: DataFrame, scope: DataFrame) -> DataFrame:
    """What :func:`close_scope` gives for the closure of ``nodes`` (node, parent): (id, added), without making the closure."""
    ids = durable(scope.select("id").distinct())
    held = H.marked_below(_linked(nodes), ids.select(F.lit(0).cast("long").alias("tree_no"), F.col("id").alias("node_key")))
    above = held.select(F.col("node_key").alias("id")).join(ids, "id", "left_anti")
    return ids.select("id", F.lit(False).alias("added")).unionByName(above.select("id", F.lit(True).alias("added")))


def reachable(edges: DataFrame, start: DataFrame, *, depth: int | None = None) -> DataFrame:
    """(start, node, hops) for nodes that calls lead to, with the fewest hops; ``depth`` bounds them.

    Semi-naive: each round joins only pairs that the round before added, is written,
    and the pairs known so far are subtracted, so cycles end the search.
    """
    step = durable(edges.where("src is not null and dst is not null").select("src", "dst").distinct())
    known = durable(start.select(F.col("id").alias("start"), F.col("id").alias("node"), F.lit(0).alias("hops")).distinct())
    fresh, hops = known, 0
    while depth is None or hops < depth:
        hops += 1
        found = fresh.join(step, fresh["node"] == step["src"]).select("start", F.col("dst").alias("node")).distinct()
        fresh = durable(found.join(known.select("start", "node"), ["start", "node"], "left_anti").withColumn("hops", F.lit(hops)))
        if fresh.isEmpty():
            break
        known = durable(known.unionByName(fresh))
    return known
