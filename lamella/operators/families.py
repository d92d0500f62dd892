"""Families of a hierarchy, inventories of value types, fixed rollups, import links, round trips."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def families(rooted: DataFrame, aliases: DataFrame, streaming: DataFrame) -> DataFrame:
    """Per root: variants, aliases, total (the root, its variants and aliases), kind, and whether the root has a stream class.

    ``rooted`` has (node, root), ``aliases`` and ``streaming`` have (node).
    """
    marked = rooted.join(aliases.select("node").distinct().withColumn("is_alias", F.lit(True)), "node", "left")
    other = F.col("node") != F.col("root")
    sizes = marked.groupBy("root").agg(
        F.count(F.when(other & F.col("is_alias").isNull(), 1)).alias("variants"), F.count(F.when(other & F.col("is_alias"), 1)).alias("aliases")
    )
    has = streaming.select(F.col("node").alias("root")).distinct().withColumn("s", F.lit(True))
    total = F.col("variants") + F.col("aliases") + 1
    return sizes.join(has, "root", "left").select(
        "root", "variants", "aliases", total.alias("total"), F.coalesce("s", F.lit(False)).alias("has_stream"),
        F.when(total > 1, "multi_member").otherwise("standalone").alias("kind"),
    )


def shared_members(rooted: DataFrame, members: DataFrame) -> DataFrame:
    """Names (root, name) of a root that no other member of its family has itself; ``members`` may repeat rows."""
    family = rooted.where("node <> root").select("node", "root", F.lit(True).alias("below")).unionByName(
        rooted.select("root").distinct().select(F.col("root").alias("node"), "root", F.lit(False).alias("below"))
    )
    both = family.join(members.select("node", "name"), "node").groupBy("root", "name").agg(F.min("below").alias("none_at_root"), F.max("below").alias("any_below"))
    return both.where("not none_at_root and not any_below").select("root", "name")


def touched_families(rooted: DataFrame, scope: DataFrame) -> DataFrame:
    """Roots of the families of which any member is in scope."""
    return rooted.join(scope.select(F.col("id").alias("node")).distinct(), "node", "left_semi").select("root").distinct()


def family_rollup(rooted: DataFrame, members: DataFrame) -> DataFrame:
    """Names that members below a root have themselves, by how many members have them: (name, members), each once per member."""
    return rooted.where("node <> root").join(members.select("node", "name").distinct(), "node").groupBy("name").agg(F.count("*").alias("members"))


def changed_names(edges: DataFrame, members: DataFrame) -> DataFrame:
    """Names that a class and its parent both have, by how many classes change them: (name, classes)."""
    own = members.select("node", "name").distinct()
    above = own.select(F.col("node").alias("parent"), "name")
    return edges.where("node <> parent").join(own, "node").join(above, ["parent", "name"]).groupBy("name").agg(F.count("*").alias("classes"))


def type_inventory(documents: DataFrame, *, text: str, by: Sequence[str] = ()) -> DataFrame:
    """Top-level keys of JSON objects with the types of their values: (*by, key, type, n).

    Types are object, array, string, number, boolean, null, undefined (the
    sentinel). Unreadable texts and other values have no keys.
    """
    v = documents.select(*by, F.try_parse_json(text).alias("v")).where(F.schema_of_variant("v").startswith("OBJECT"))
    rows = v.lateralJoin(v.sparkSession.tvf.variant_explode(F.col("v").outer())).select(*by, "key", "value")
    kind = F.schema_of_variant("value")
    name = (
        F.when(kind == "VOID", "null").when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array")
        .when(F.try_variant_get("value", "$", "string") == "__undefined", "undefined").when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean").otherwise("number")
    )
    return rows.groupBy(*by, "key", name.alias("type")).agg(F.count("*").alias("n"))


def fixed_rollup(rows: DataFrame, *, bucket: str, name: str, buckets: Sequence[str]) -> DataFrame:
    """One row: the sorted distinct names of every bucket of a fixed list as text, empty where there are none."""
    return rows.agg(*[F.array_join(F.array_sort(F.collect_set(F.when(F.col(bucket) == b, F.col(name)))), ",").alias(b) for b in buckets])


def import_links(classes: DataFrame, imports: DataFrame) -> DataFrame:
    """Parent key of each class (id, kind, extends) by imports (id, kind, alias, path).

    A path that begins ``../`` leads to a rest class, ``./`` to one of the same
    kind, others nowhere. Without an import the class of the same kind holds.
    """
    target = F.regexp_extract("path", r"([^/]+?)(\.[a-z]+)?$", 1)
    kind = F.when(F.col("path").startswith("../"), "rest").when(F.col("path").startswith("./"), F.col("kind"))
    known = imports.select("id", "kind", F.col("alias").alias("extends"), F.concat_ws(":", kind, target).alias("linked"), kind.isNotNull().alias("leads"))
    own = F.concat_ws(":", F.col("kind"), F.col("extends"))
    return classes.join(known, ["id", "kind", "extends"], "left").select("id", "kind", F.when(F.col("leads").isNull(), own).when(F.col("leads"), F.col("linked")).alias("parent_key"))


def round_trip(output: DataFrame, source: DataFrame, *, id: str, sections: Sequence[str]) -> DataFrame:
    """Sections (JSON texts) of outputs that are not what their source has: (id, section); key order and spaces do not matter."""
    text = lambda c: F.to_json(F.try_parse_json(c))
    long = lambda df, v: df.select(id, F.explode(F.array(*[F.struct(F.lit(s).alias("section"), text(F.col(s)).alias(v)) for s in sections])).alias("x")).select(id, "x.*")
    return long(output, "a").join(long(source, "b"), [id, "section"], "full").where(~F.col("a").eqNullSafe(F.col("b"))).select(id, "section")
