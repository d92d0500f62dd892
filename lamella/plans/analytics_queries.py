"""Frequencies, tiers, families, distributions, dominance, coverage and market patterns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.functions import strings as X
from lamella.operators import frequency as Q
from lamella.operators import rules as V
from lamella.operators.references import normal_key
from lamella.plans.runtime import read_table

# The method families.
PREFIXES = ("fetch", "parse", "create", "cancel", "edit", "watch", "handle", "set", "get", "load", "build", "encode", "decode", "sign")


def _key(c: str) -> str:
    return f"nullif(lower(regexp_replace({c}, '^\\s+|\\s+$', '', 'g')), '')"


def dataset_rows(spark: SparkSession, d: str) -> DataFrame:
    """(id, dataset, kind) once per entity and dataset."""
    t = read_table(spark, d, "discoveries").select(normal_key(F.col("id")).alias("id"), "dataset", "entry_count").where("id is not null")
    return t.groupBy("id", "dataset").agg(F.when(F.max("entry_count") >= 150, "big").otherwise("small").alias("kind"))


ROWS_SQL = f"rows AS (SELECT {_key('id')} AS id, dataset, CASE WHEN max(entry_count) >= 150 THEN 'big' ELSE 'small' END AS kind FROM discoveries WHERE {_key('id')} IS NOT NULL GROUP BY 1, 2)"
FREQ_SQL = f"""
WITH {ROWS_SQL}, total AS (SELECT count(DISTINCT id) AS n FROM rows),
each AS (SELECT dataset AS key, kind, count(*) AS n FROM rows WHERE dataset IS NOT NULL GROUP BY ALL)
SELECT key, CAST(sum(e.n) AS BIGINT) AS count, round(CAST(sum(e.n) AS BIGINT) * 100.0::DOUBLE / total.n, 1) AS pct,
       string_agg(kind || ':' || e.n, ',' ORDER BY kind || ':' || e.n) AS kinds, total.n AS total
FROM each e, total GROUP BY key, total.n"""


def key_frequency(spark, d):
    return Q.key_frequency(dataset_rows(spark, d), entity="id", key="dataset", kind="kind")


def key_tiers(spark, d):
    f = key_frequency(spark, d)
    return f.select("key", "count", Q.tier(F.col("count"), F.col("total")).alias("tier"))


TIER_SQL = "CASE WHEN count = total THEN 'universal' WHEN count > 0.9 * total THEN 'common' WHEN count > 0.5 * total THEN 'frequent' WHEN count >= 5 THEN 'uncommon' ELSE 'rare' END"


def tier_groups(spark, d):
    return Q.tier_members(key_frequency(spark, d))


def member_rows(spark: SparkSession, d: str) -> DataFrame:
    """(node_key, class_type, name): a row per method of every delivered class row."""
    return read_table(spark, d, "class_hierarchy").select("node_key", "class_type", F.explode("methods").alias("name"))


MEMBERS_SQL = "members AS (SELECT node_key, class_type, unnest(methods) AS name FROM class_hierarchy)"
FAMILY_SQL = (
    f"CASE WHEN regexp_extract(name, '^([a-z]+)[A-Z]', 1) IN {PREFIXES} THEN regexp_extract(name, '^([a-z]+)[A-Z]', 1) WHEN name IN {PREFIXES} THEN name ELSE 'other' END"
)


def distinct_keys(spark, d):
    return member_rows(spark, d).select("name").where("name is not null").distinct()


def method_families(spark, d):
    return Q.family_stats(member_rows(spark, d), name="name", known=PREFIXES)


def method_occurrences(spark, d):
    return Q.occurrence_counts(member_rows(spark, d), name="name", entity="node_key")


def base_spread(spark, d):
    return Q.spread_sets(read_table(spark, d, "load_markets").select("exchange", F.col("base").alias("name")), name="name", entity="exchange")


def method_distribution(spark, d):
    return Q.size_distribution(read_table(spark, d, "class_hierarchy"), size="method_count", by=["class_type"])


def lines_per_order(spark, d):
    sizes = read_table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("lines"))
    return Q.size_distribution(sizes, size="lines")


def cross_methods(spark, d):
    m = member_rows(spark, d)
    return Q.cross_sets(m.where("class_type = 'rest'"), m.where("class_type = 'ws'"), name="name")


def flag_patterns(spark, d):
    e = read_table(spark, d, "exchanges").select(F.explode("exchanges").alias("e")).select(normal_key(F.col("e.id")).alias("id"), "e.certified", "e.pro", "e.alias")
    flags = e.where("id is not null").select("id", F.explode(F.array(*[F.struct(F.lit(f).alias("flag"), F.col(f).alias("is_on")) for f in ("alias", "certified", "pro")])).alias("f"))
    return Q.flag_patterns(flags.select("id", "f.flag", "f.is_on"), entity="id", flag="flag", on="is_on")


def dominant_types(spark, d):
    return Q.dominant_value(read_table(spark, d, "load_markets"), by=["exchange"], value="market_type")


def dominant_priority(spark, d):
    c, o = read_table(spark, d, "customer"), read_table(spark, d, "orders")
    return Q.dominant_value(o.join(c, F.col("o_custkey") == F.col("c_custkey")).select("c_mktsegment", "o_orderpriority"), by=["c_mktsegment"], value="o_orderpriority", threshold=0.2)


def id_rows(spark, d):
    m = read_table(spark, d, "load_markets").where("market_type is not null and market_type <> '__undefined'")
    structure = X.id_structure(F.col("id"), F.col("base"), F.col("quote"))
    return m.select("row_no", "exchange", "market_type", structure.alias("structure"), X.letter_case(F.col("id")).alias("letter_case"), X.is_numeric(F.col("id")).alias("is_numeric"))


def id_structures(spark, d):
    return id_rows(spark, d).groupBy("market_type", "structure", "letter_case", "is_numeric").agg(F.count("*").alias("n"))


def id_anomalies(spark, d):
    rows = id_rows(spark, d)
    best = Q.dominant_value(rows, by=["exchange", "market_type"], value="structure")
    return Q.anomalies(rows, best, by=["exchange", "market_type"], value="structure").select("row_no", "exchange", "structure", "dominant")


def symbol_examples(spark, d):
    rows = read_table(spark, d, "load_markets").where("market_type is not null and market_type <> '__undefined' and symbol is not null").select("market_type", "symbol").distinct()
    return Q.top_rows(rows, by=["market_type"], order=[F.col("symbol")], k=3)


def symbols_index(spark, d):
    m = read_table(spark, d, "load_markets")
    return m.groupBy("exchange").agg(F.count(F.when(F.col("market_type") == "spot", 1)).alias("spot"), F.count(F.when(F.col("market_type") == "swap", 1)).alias("swap"))


def undefined_density(spark, d):
    return V.undefined_density(read_table(spark, d, "load_markets"), entity="exchange", fields=["symbol", "base", "quote", "market_type", "linear", "inverse"])


# Datasets that coverage layers look for.
LAYERS = ("describe", "methods_rest", "methods_ws", "sign_method", "handle_errors", "parse_methods", "ws_methods", "overrides")


def coverage_rows(spark, d):
    e = read_table(spark, d, "exchanges").select(F.explode("exchanges").alias("e")).select(normal_key(F.col("e.id")).alias("id"), "e.alias", "e.pro").where("id is not null")
    e = e.groupBy("id").agg(F.max("alias").alias("alias"), F.max("pro").alias("pro"))
    have = dataset_rows(spark, d).groupBy("id").pivot("dataset", list(LAYERS)).agg(F.count(F.lit(1)))
    loads = read_table(spark, d, "load_manifest").groupBy(normal_key(F.col("exchange")).alias("id")).agg(F.max(F.col("status") == "succeeded").alias("loaded"), F.lit(True).alias("tried"))
    classes = read_table(spark, d, "class_hierarchy").select(normal_key(F.col("id")).alias("id")).distinct().withColumn("classed", F.lit(True))
    return e.join(have, "id", "left").join(loads.where("id is not null"), "id", "left").join(classes.where("id is not null"), "id", "left")


def coverage_layers():
    """Present, applicable and the reason of a gap of each of the ten layers."""
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    has = lambda n: F.coalesce(F.col(n), F.lit(0)) > 0
    plain, every, lost = ~yes("alias"), F.lit(True), F.lit("not_found")
    return {
        "describe": (has("describe"), plain, F.lit("not_extracted")),
        "load_markets": (yes("loaded"), plain, F.when(yes("tried"), "failed").otherwise("not_extracted")),
        "class_hierarchy": (yes("classed"), every, lost), "methods_rest": (has("methods_rest"), every, lost),
        "methods_ws": (has("methods_ws"), has("methods_ws") | yes("pro"), lost),
        "sign_method": (has("sign_method"), plain, lost), "handle_errors": (has("handle_errors"), plain, lost), "parse_methods": (has("parse_methods"), plain, lost),
        "ws_methods": (has("ws_methods"), has("ws_methods") | yes("pro"), lost),
        "overrides": (has("overrides"), has("overrides"), lost),
    }


def coverage(spark, d):
    return V.coverage(coverage_rows(spark, d), coverage_layers(), id="id")


def coverage_by_layer(spark, d):
    return V.layer_counts(coverage_rows(spark, d), coverage_layers())


def undefined_mean(spark, d):
    return V.undefined_mean(undefined_density(spark, d))


def id_trait_anomalies(spark, d):
    """Market ids that differ from their exchange and type in structure, letters or digits."""
    return Q.trait_anomalies(id_rows(spark, d), by=["exchange", "market_type"], traits=["structure", "letter_case", "is_numeric"], id="row_no").select("row_no", "traits")


def coverage_summary(spark, d):
    return V.coverage_summary(coverage(spark, d))


def market_findings(spark, d):
    rules, skip = V.market_rules()
    return V.row_findings(read_table(spark, d, "load_markets"), rules, keep=["row_no", "exchange"], skip=skip)


def findings_rollup(spark, d):
    rules, skip = V.market_rules()
    return V.rollup(market_findings(spark, d), [r.name for r in [*rules, skip]])


def exchange_counts(spark, d):
    """Total, real (not alias), alias and pro entities; aliases without a class; class rows per kind; families of REST classes."""
    alias = F.coalesce("alias", F.lit(False))
    n = coverage_rows(spark, d).agg(
        F.count("*").alias("total"), F.count(F.when(~alias, 1)).alias("n_real"), F.count(F.when(alias, 1)).alias("aliases"), F.count(F.when(F.col("pro"), 1)).alias("pro"),
        F.count(F.when(alias & F.col("classed").isNull(), 1)).alias("orphan_aliases"),
    )
    t = read_table(spark, d, "class_hierarchy")
    own = t.select("node_key", "class_type", F.regexp_replace("parent_key", r"(?U)^\s+|\s+$", "").alias("p"))
    kinds = own.agg(F.countDistinct(F.when(F.col("class_type") == "rest", F.col("node_key"))).alias("rest"), F.countDistinct(F.when(F.col("class_type") == "ws", F.col("node_key"))).alias("ws"))
    linked = own.where("class_type = 'rest'").join(own.select(F.col("node_key").alias("p")).distinct().withColumn("has", F.lit(True)), "p", "left").groupBy("node_key").agg(F.max("has").alias("has"))
    families = linked.agg(F.count(F.when(F.col("has").isNull(), 1)).alias("families"))
    one = F.lit(1)
    return n.withColumn("one", one).join(F.broadcast(kinds.withColumn("one", one)), "one").join(F.broadcast(families.withColumn("one", one)), "one").drop("one")  # three single rows


QUERIES = {
    f.__name__: f
    for f in (
        key_frequency, key_tiers, tier_groups, distinct_keys, method_families, method_occurrences, base_spread, method_distribution, lines_per_order,
        cross_methods, flag_patterns, dominant_types, dominant_priority, id_structures, id_anomalies, symbol_examples, symbols_index, undefined_density,
        coverage, coverage_by_layer, coverage_summary, undefined_mean, id_trait_anomalies, market_findings, findings_rollup, exchange_counts,
    )
}


def _structure_sql() -> str:
    out = "CASE WHEN coalesce(id, '') = '' OR coalesce(base, '') = '' THEN 'opaque'"
    q = "coalesce(quote, '')"
    for label, a, b in (("base{}quote", "base", q), ("quote{}base", q, "base")):
        for s in X.SEPARATORS:
            j = f"({a} || '{s}' || {b})"
            guard = "true" if label.startswith("base") else f"{q} <> ''"
            out += f" WHEN {guard} AND id = {j} THEN '{label.format(s)}' WHEN {q} <> '' AND starts_with(id, {j}) THEN '{label.format(s)}+suffix'"
    return out + " WHEN id = base THEN 'base_only' WHEN regexp_full_match(id, '@*[+-]?[0-9]+') THEN 'numeric' ELSE 'opaque' END"


LETTERS = "regexp_replace(id, '[^A-Za-z]', '', 'g')"
IDS_SQL = f"""ids AS (SELECT row_no, exchange, market_type, {_structure_sql()} AS structure,
  CASE WHEN {LETTERS} = '' THEN NULL WHEN {LETTERS} = upper({LETTERS}) THEN 'upper' WHEN {LETTERS} = lower({LETTERS}) THEN 'lower'
       WHEN id IS NULL THEN NULL ELSE 'mixed' END AS letter_case, coalesce(regexp_full_match(id, '@*[+-]?[0-9]+'), false) AS is_numeric
  FROM load_markets WHERE market_type IS NOT NULL AND market_type <> '__undefined')"""


def dominant_sql(source: str, by: str, value: str, threshold: float) -> str:
    return f"""SELECT {by}, CAST(sum(n) AS BIGINT) AS total,
  CASE WHEN max(n) FILTER (v IS NOT NULL) / sum(n) >= {threshold} THEN arg_min(v, (-n, v)) FILTER (v IS NOT NULL) END AS dominant,
  round(coalesce(max(n) FILTER (v IS NOT NULL) / sum(n), 0)::DOUBLE, 4) AS share
  FROM (SELECT {by}, {value} AS v, count(*) AS n FROM {source} GROUP BY ALL) GROUP BY {by}"""


ENTITY_SQL = f"entity AS (SELECT {_key('e.id')} AS id, bool_or(e.alias) AS alias, bool_or(e.pro) AS pro FROM (SELECT unnest(exchanges) AS e FROM exchanges) WHERE {_key('e.id')} IS NOT NULL GROUP BY 1)"
_have = lambda n: f"(id IN (SELECT id FROM rows WHERE dataset = '{n}'))"
_plain, _pro = "NOT coalesce(alias, false)", "coalesce(pro, false)"
_LAYER = {
    "describe": (_have("describe"), _plain, "'not_extracted'"), "load_markets": ("(id IN (SELECT id FROM loaded WHERE good))", _plain, "CASE WHEN id IN (SELECT id FROM loaded) THEN 'failed' ELSE 'not_extracted' END"),
    "class_hierarchy": ("(id IN (SELECT id FROM classed))", "true", "'not_found'"), "methods_rest": (_have("methods_rest"), "true", "'not_found'"),
    "methods_ws": (_have("methods_ws"), f"({_pro} OR {_have('methods_ws')})", "'not_found'"), **{n: (_have(n), _plain, "'not_found'") for n in ("sign_method", "handle_errors", "parse_methods")},
    "ws_methods": (_have("ws_methods"), f"({_pro} OR {_have('ws_methods')})", "'not_found'"), "overrides": (_have("overrides"), _have("overrides"), "'not_found'"),
}
_COVERED = f"""{ROWS_SQL}, {ENTITY_SQL},
loaded AS (SELECT {_key('exchange')} AS id, bool_or(status = 'succeeded') AS good FROM load_manifest WHERE {_key('exchange')} IS NOT NULL GROUP BY 1), classed AS (SELECT DISTINCT {_key('id')} AS id FROM class_hierarchy WHERE {_key('id')} IS NOT NULL)"""
COVERAGE_SQL = f"""
WITH {_COVERED},
s AS (SELECT id, ({' + '.join(f'({a} AND {p})::INT' for p, a, _ in _LAYER.values())})::BIGINT AS score, ({' + '.join(f'({a})::INT' for _, a, _ in _LAYER.values())})::BIGINT AS max,
  array_to_string(list_sort(list_filter([{', '.join(f"CASE WHEN {a} AND NOT {p} THEN '{n}: ' || {r} END" for n, (p, a, r) in _LAYER.items())}], lambda x: x IS NOT NULL)), '; ') AS gaps FROM entity)
SELECT id, score, max, CASE WHEN max > 0 THEN round(score * 100.0::DOUBLE / max, 1) ELSE 0 END AS pct, gaps FROM s"""
_u = lambda c: f"({c} IS NULL OR {c} = '__undefined')"
_RULES = {
    **{f"required_{f}": ("error", _u(f)) for f in ("id", "base", "quote")}, "soft_type": ("warning", _u("market_type")),
    **{f"boolean_{f}": ("error", f"{f} IS NOT NULL AND {f} NOT IN ('true', 'false', '__undefined')") for f in ("linear", "inverse")},
    **{f"map_{f}": ("error", f"{f} IS NULL") for f in ("precisions", "limits")},
    "contract_and_spot": ("error", "contract AND market_type = 'spot'"), "type_without_contract": ("error", "NOT contract AND market_type IN ('swap', 'future', 'option')"),
    "linear_without_contract": ("error", "NOT contract AND linear = 'true'"), "inverse_without_contract": ("error", "NOT contract AND inverse = 'true'"),
}
_NO_SYMBOL = "coalesce(trim(symbol, ' '), '') = ''"
FINDINGS_SQL = " UNION ALL ".join(
    [f"SELECT '{n}' AS rule, '{lv}' AS level, row_no, exchange FROM load_markets WHERE NOT {_NO_SYMBOL} AND {b}" for n, (lv, b) in _RULES.items()]
    + [f"SELECT 'missing_symbol', 'warning', row_no, exchange FROM load_markets WHERE {_NO_SYMBOL}"]
)
_UNDEF = ("symbol", "base", "quote", "market_type", "linear", "inverse")
SQL = {
    "key_frequency": FREQ_SQL,
    "key_tiers": f"SELECT key, count, {TIER_SQL} AS tier FROM ({FREQ_SQL})",
    "tier_groups": f"SELECT tier, count(*) AS n, string_agg(key, ',' ORDER BY key) AS keys FROM (SELECT key, {TIER_SQL} AS tier FROM ({FREQ_SQL})) GROUP BY tier",
    "distinct_keys": f"WITH {MEMBERS_SQL} SELECT DISTINCT name FROM members WHERE name IS NOT NULL",
    "method_families": f"""WITH {MEMBERS_SQL}, each AS (SELECT {FAMILY_SQL} AS family, name, count(*) AS n FROM members WHERE name IS NOT NULL GROUP BY ALL)
SELECT family, CAST(sum(n) AS BIGINT) AS occurrences, round(sum(n) * 100.0::DOUBLE / (SELECT count(*) FROM members WHERE name IS NOT NULL), 1) AS pct, count(*) AS names, string_agg(name, ',' ORDER BY n DESC, name) AS members FROM each GROUP BY family""",
    "method_occurrences": f"WITH {MEMBERS_SQL} SELECT name, count(*) AS occurrences, count(DISTINCT node_key) AS entities FROM members WHERE name IS NOT NULL GROUP BY name",
    "base_spread": """WITH t AS (SELECT count(DISTINCT exchange) AS total FROM load_markets), n AS (SELECT base AS name, count(DISTINCT exchange) AS n FROM load_markets WHERE base IS NOT NULL GROUP BY 1)
SELECT name, n, s AS set FROM n, t, (VALUES ('universal'), ('unique'), ('rare')) v(s) WHERE (s = 'universal' AND n = total) OR (s = 'unique' AND n = 1) OR (s = 'rare' AND n < 5)""",
    "method_distribution": """SELECT class_type, count(method_count) AS n, min(method_count)::BIGINT AS min, max(method_count)::BIGINT AS max, quantile_disc(method_count, 0.25)::BIGINT AS p25,
  quantile_disc(method_count, 0.5)::BIGINT AS median, quantile_disc(method_count, 0.75)::BIGINT AS p75, round(avg(method_count), 1) AS mean FROM class_hierarchy WHERE method_count IS NOT NULL GROUP BY class_type""",
    "lines_per_order": """WITH s AS (SELECT l_orderkey, count(*) AS lines FROM lineitem GROUP BY 1)
SELECT count(*) AS n, min(lines) AS min, max(lines) AS max, quantile_disc(lines, 0.25) AS p25, quantile_disc(lines, 0.5) AS median, quantile_disc(lines, 0.75) AS p75, round(avg(lines), 1) AS mean FROM s""",
    "cross_methods": f"""WITH {MEMBERS_SQL}, s AS (SELECT name, bool_or(class_type = 'rest') AS l, bool_or(class_type = 'ws') AS r FROM members WHERE name IS NOT NULL AND class_type IN ('rest', 'ws') GROUP BY 1)
SELECT name, CASE WHEN l AND r THEN 'shared' WHEN l THEN 'left_only' ELSE 'right_only' END AS side FROM s""",
    "flag_patterns": f"""WITH f AS (SELECT {_key('e.id')} AS id, bool_or(e.alias) AS a, bool_or(e.certified) AS c, bool_or(e.pro) AS p FROM (SELECT unnest(exchanges) AS e FROM exchanges) WHERE {_key('e.id')} IS NOT NULL GROUP BY 1)
SELECT concat_ws(',', CASE WHEN a THEN 'alias' END, CASE WHEN c THEN 'certified' END, CASE WHEN p THEN 'pro' END) AS pattern, count(*) AS entities FROM f GROUP BY 1""",
    "dominant_types": dominant_sql("load_markets", "exchange", "market_type", 0.8),
    "dominant_priority": dominant_sql("(SELECT c_mktsegment, o_orderpriority FROM orders JOIN customer ON o_custkey = c_custkey)", "c_mktsegment", "o_orderpriority", 0.2),
    "id_structures": f"WITH {IDS_SQL} SELECT market_type, structure, letter_case, is_numeric, count(*) AS n FROM ids GROUP BY ALL",
    "id_anomalies": f"""WITH {IDS_SQL}, best AS ({dominant_sql('ids', 'exchange, market_type', 'structure', 0.8)})
SELECT row_no, i.exchange, structure, dominant FROM ids i JOIN best b ON i.exchange = b.exchange AND i.market_type = b.market_type WHERE dominant IS NOT NULL AND structure IS DISTINCT FROM dominant""",
    "symbol_examples": """SELECT market_type, symbol, CAST(row_number() OVER (PARTITION BY market_type ORDER BY symbol) AS INTEGER) AS rank
FROM (SELECT DISTINCT market_type, symbol FROM load_markets WHERE market_type IS NOT NULL AND market_type <> '__undefined' AND symbol IS NOT NULL) QUALIFY rank <= 3""",
    "symbols_index": "SELECT exchange, count(*) FILTER (market_type = 'spot') AS spot, count(*) FILTER (market_type = 'swap') AS swap FROM load_markets GROUP BY exchange",
    "undefined_density": f"""SELECT exchange, count(*) * {len(_UNDEF)} AS fields, CAST(sum({' + '.join(f"coalesce(({c} = '__undefined')::INT, 0)" for c in _UNDEF)}) AS BIGINT) AS undefined,
  round(undefined * 100.0::DOUBLE / fields, 1) AS pct FROM load_markets GROUP BY exchange""",
    "coverage": COVERAGE_SQL,
    "coverage_by_layer": f"WITH {_COVERED} " + " UNION ALL ".join(f"SELECT '{n}' AS layer, count(*) FILTER ({p}) AS present, count(*) FILTER ({a}) AS applicable, count(*) FILTER ({a} AND NOT {p}) AS gaps FROM entity" for n, (p, a, _) in _LAYER.items()),
    "undefined_mean": f"""SELECT count(*) AS entities, coalesce(round(avg(pct), 1), 0) AS mean_pct FROM (SELECT exchange, round(CAST(sum({' + '.join(f"coalesce(({c} = '__undefined')::INT, 0)" for c in _UNDEF)}) AS BIGINT) * 100.0::DOUBLE / (count(*) * {len(_UNDEF)}), 1) AS pct FROM load_markets GROUP BY exchange)""",
    "id_trait_anomalies": f"""WITH {IDS_SQL}, l AS (SELECT row_no, exchange, market_type, unnest([struct_pack(trait := 'structure', v := structure), struct_pack(trait := 'letter_case', v := letter_case), struct_pack(trait := 'is_numeric', v := is_numeric::VARCHAR)], recursive := true) FROM ids),
best AS ({dominant_sql('l', 'exchange, market_type, trait', 'v', 0.8)})
SELECT row_no, string_agg(trait, ',' ORDER BY trait) AS traits FROM l JOIN best b USING (exchange, market_type, trait) WHERE dominant IS NOT NULL AND v IS DISTINCT FROM dominant GROUP BY row_no""",
    "coverage_summary": f"""SELECT count(*) AS entities, count(*) FILTER (pct = 100) AS full, count(*) FILTER (pct = 0) AS none, count(*) FILTER (pct > 0 AND pct < 100) AS partial,
  coalesce(round(avg(pct), 1), 0) AS mean_pct FROM ({COVERAGE_SQL})""",
    "market_findings": FINDINGS_SQL,
    "findings_rollup": f"""SELECT r.rule, count(f.rule) AS n FROM (SELECT unnest([{', '.join(f"'{n}'" for n in [*_RULES, 'missing_symbol'])}]) AS rule) r
LEFT JOIN ({FINDINGS_SQL}) f ON f.rule = r.rule GROUP BY r.rule""",
    "exchange_counts": rf"""WITH {ENTITY_SQL}, c AS (SELECT node_key, class_type, regexp_replace(parent_key, '^\s+|\s+$', '', 'g') AS p FROM class_hierarchy),
l AS (SELECT node_key, bool_or(p IN (SELECT node_key FROM c WHERE node_key IS NOT NULL)) AS has FROM c WHERE class_type = 'rest' GROUP BY 1), k AS (SELECT DISTINCT {_key('id')} AS id FROM class_hierarchy WHERE {_key('id')} IS NOT NULL)
SELECT count(*) AS total, count(*) FILTER (NOT coalesce(alias, false)) AS n_real, count(*) FILTER (alias) AS aliases, count(*) FILTER (pro) AS pro, count(*) FILTER (alias AND id NOT IN (SELECT id FROM k)) AS orphan_aliases,
  (SELECT count(DISTINCT node_key) FROM class_hierarchy WHERE class_type = 'rest') AS rest, (SELECT count(DISTINCT node_key) FROM class_hierarchy WHERE class_type = 'ws') AS ws, (SELECT count(*) FROM l WHERE NOT coalesce(has, false)) AS families FROM entity""",
}
