"""Query keys for rule-based catalog classification and taxonomy reports.

The catalog is ``part`` (id = 13-digit code, name = p_name); rule lists and the taxonomy are the
stand-in seeds of ``gondola.schemas``. Oracle SQL text for the rules is generated from the same
seed lists (they are data, not logic).
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gondola import schemas as S, seeds
from gondola.operators import reports, rules
from gondola.plans.registry import register
from gondola.plans.sql_standins import CATALOG_PRODUCTS, with_
from gondola.sources import standins


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql_null(v, typ="BIGINT"):
    return f"CAST(NULL AS {typ})" if v is None else str(v)


CATEGORIES_SQL = """
categories AS (SELECT * FROM (VALUES {rows}) AS t(id_categoria, nombre, nivel, parent_id, id_macro))""".format(
    rows=", ".join(f"(CAST({i} AS BIGINT), {_q(n)}, CAST({lv} AS INTEGER), {_sql_null(p)}, CAST({m} AS INTEGER))"
                   for i, n, lv, p, m in S.CATEGORY_ROWS))

MACROS_SQL = """
macros AS (SELECT * FROM (VALUES {rows}) AS t(id_macro, nombre))""".format(
    rows=", ".join(f"(CAST({i} AS INTEGER), {_q(n)})" for i, n in S.MACRO_ROWS))


def _hits_sql(kws):
    return " + ".join(f"CAST(instr(lower(producto), {_q(k)}) > 0 AS INTEGER)" for k in kws)


def keyword_seed_sql(fixed=None):
    cat = "CASE " + " ".join(f"WHEN {_hits_sql(k)} > 0 THEN CAST({c} AS BIGINT)" for c, k in S.KEYWORD_RULES) \
          + " ELSE CAST(NULL AS BIGINT) END"
    if fixed is None:
        conf = "CASE " + " ".join(
            f"WHEN {_hits_sql(k)} > 0 THEN round(least(0.7 + 0.1 * ({_hits_sql(k)}), 0.95), 2)"
            for c, k in S.KEYWORD_RULES) + " ELSE 0.0 END"
    else:
        conf = "CASE " + " ".join(f"WHEN {_hits_sql(k)} > 0 THEN {fixed}" for c, k in S.KEYWORD_RULES) + " ELSE 0.0 END"
    return f"""
mapping AS (SELECT id_producto, {cat} AS id_categoria, CAST(NULL AS BIGINT) AS id_subcategoria,
                   'regla' AS metodo, CAST({conf} AS DOUBLE) AS confianza
            FROM catalog_products)"""


def _products(t):
    return standins.catalog_products(t.part)


def _seed_mapping(t):
    return rules.keyword_seed(_products(t), S.KEYWORD_RULES)


@register("keyword_seed", with_(CATALOG_PRODUCTS, keyword_seed_sql()) + "SELECT * FROM mapping",
          ids="PIP-3 UDF-1 SCA-21 SCA-29 PRJ-2")
def keyword_seed(t):
    return _seed_mapping(t)


@register("keyword_first", with_(CATALOG_PRODUCTS, keyword_seed_sql(0.80)) + "SELECT * FROM mapping",
          ids="PIP-4")
def keyword_first(t):
    return rules.keyword_seed(_products(t), S.KEYWORD_RULES, fixed_confidence=0.80)


_GROCERY = list(enumerate(seeds.GROCERY_KEYWORDS.values(), start=1))   # categories numbered in rule order


@register("grocery_keywords", f"""
WITH d AS (SELECT doc_id, lower(text) AS n FROM documents),
h AS (SELECT doc_id, [{", ".join(" + ".join(f"CAST(instr(n, {_q(k)}) > 0 AS INTEGER)" for k in kws) for _, kws in _GROCERY)}] AS hits
      FROM d),
f AS (SELECT doc_id, hits, list_position(list_transform(hits, lambda x: x > 0), true) AS first FROM h)
SELECT CAST(doc_id AS VARCHAR) AS id_producto, CAST(nullif(first, 0) AS BIGINT) AS id_categoria, CAST(NULL AS BIGINT) AS id_subcategoria,
       'regla' AS metodo, CAST(CASE WHEN first > 0 THEN round(least(0.7 + 0.1 * hits[first], 0.95), 2) ELSE 0.0 END AS DOUBLE) AS confianza
FROM f""", ids="PIP-3 SCA-21")
def grocery_keywords(t):
    """The original keyword rules over the document texts."""
    texts = t.documents.select(F.col("doc_id").cast("string").alias("id_producto"), F.col("text").alias("producto"))
    return rules.keyword_seed(texts, _GROCERY)


@register("coverage_report", with_(CATALOG_PRODUCTS, keyword_seed_sql()) + """
SELECT estado, total, confianza_promedio, round(total * 100.0 / sum(total) OVER (), 2) AS porcentaje
FROM (SELECT CASE WHEN id_categoria IS NULL THEN 'SIN CLASIFICAR' ELSE 'CLASIFICADO' END AS estado,
             count(*) AS total, round(avg(confianza), 2) AS confianza_promedio
      FROM mapping GROUP BY 1)""", ids="PIP-5 AGG-13 WIN-5 PRJ-4")
def coverage_report(t):
    return reports.coverage_report(_seed_mapping(t))


@register("category_top20", with_(CATALOG_PRODUCTS, keyword_seed_sql(), CATEGORIES_SQL) + """
SELECT categoria, productos, confianza_avg, porcentaje FROM (
  SELECT c.nombre AS categoria, a.productos, round(a.s / a.productos, 2) AS confianza_avg,
         round(a.productos * 100.0 / sum(a.productos) OVER (), 2) AS porcentaje
  FROM (SELECT id_categoria, count(*) AS productos, sum(confianza) AS s FROM mapping
        WHERE id_categoria IS NOT NULL GROUP BY id_categoria) a
  JOIN categories c ON a.id_categoria = c.id_categoria)
ORDER BY productos DESC, categoria ASC LIMIT 20""", ids="PIP-5 ORD-2 AGG-13 JN-14")
def category_top20(t):
    return reports.category_top(_seed_mapping(t), S.categories_df(t.spark), 20)


def _pattern_sql():
    case_c = "CASE " + " ".join(f"WHEN instr(lower(producto), {_q(p)}) > 0 THEN CAST({c} AS BIGINT)"
                                for p, c, m in S.PATTERN_RULES) + " END"
    case_m = "CASE " + " ".join(f"WHEN instr(lower(producto), {_q(p)}) > 0 THEN {_q(m)}"
                                for p, c, m in S.PATTERN_RULES) + " END"
    return f"""
src AS (SELECT id_producto, c AS pc, m AS pm,
               CASE WHEN m = 'llm_discovery' THEN 0.9 WHEN m = 'regla' THEN 0.85 END AS pf
        FROM (SELECT id_producto, {case_c} AS c, {case_m} AS m FROM catalog_products) WHERE c IS NOT NULL)"""


@register("pattern_assign", with_(CATALOG_PRODUCTS, keyword_seed_sql(), _pattern_sql()) + """
SELECT m.id_producto,
       CASE WHEN s.id_producto IS NOT NULL AND m.id_categoria IS NULL THEN s.pc ELSE m.id_categoria END AS id_categoria,
       m.id_subcategoria,
       CASE WHEN s.id_producto IS NOT NULL AND m.id_categoria IS NULL THEN s.pm ELSE m.metodo END AS metodo,
       CASE WHEN s.id_producto IS NOT NULL AND m.id_categoria IS NULL THEN s.pf ELSE m.confianza END AS confianza
FROM mapping m LEFT JOIN src s ON m.id_producto = s.id_producto""", ids="PIP-11 JN-21 DML-2 SET-1")
def pattern_assign(t):
    return rules.assign_by_pattern(_seed_mapping(t), _products(t), S.PATTERN_RULES)


_ASSIGNED_SQL = """
assigned AS (SELECT CASE WHEN s.id_producto IS NOT NULL AND m.id_categoria IS NULL THEN s.pc ELSE m.id_categoria END AS id_categoria,
                    CASE WHEN s.id_producto IS NOT NULL AND m.id_categoria IS NULL THEN s.pm ELSE m.metodo END AS metodo,
                    CASE WHEN s.id_producto IS NOT NULL AND m.id_categoria IS NULL THEN s.pf ELSE m.confianza END AS confianza
             FROM mapping m LEFT JOIN src s ON m.id_producto = s.id_producto)"""


@register("method_breakdown", with_(CATALOG_PRODUCTS, keyword_seed_sql(), _pattern_sql(), _ASSIGNED_SQL) + """
SELECT metodo, estado, total, confianza_promedio, confianza_min, confianza_max,
       round(total * 100.0 / sum(total) OVER (), 2) AS porcentaje
FROM (SELECT metodo, CASE WHEN id_categoria IS NULL THEN 'SIN CLASIFICAR' ELSE 'CLASIFICADO' END AS estado, count(*) AS total,
             round(avg(confianza), 2) AS confianza_promedio, min(confianza) AS confianza_min, max(confianza) AS confianza_max
      FROM assigned GROUP BY 1, 2)""", ids="PIP-5 AGG-13 WIN-5")
def method_breakdown(t):
    return reports.method_breakdown(rules.assign_by_pattern(_seed_mapping(t), _products(t), S.PATTERN_RULES))


@register("category_top15", with_(CATALOG_PRODUCTS, keyword_seed_sql(), _pattern_sql(), _ASSIGNED_SQL, CATEGORIES_SQL) + """
SELECT categoria, productos, confianza_avg, porcentaje FROM (
  SELECT c.nombre AS categoria, a.productos, round(a.s / a.productos, 2) AS confianza_avg,
         round(a.productos * 100.0 / sum(a.productos) OVER (), 2) AS porcentaje
  FROM (SELECT id_categoria, count(*) AS productos, sum(confianza) AS s FROM assigned
        WHERE id_categoria IS NOT NULL GROUP BY id_categoria) a
  JOIN categories c ON a.id_categoria = c.id_categoria)
ORDER BY productos DESC, categoria ASC LIMIT 15""", ids="PIP-5 ORD-2 AGG-13 JN-14")
def category_top15(t):
    """Top 15 of the mapping after the pattern rules."""
    return reports.category_top(rules.assign_by_pattern(_seed_mapping(t), _products(t), S.PATTERN_RULES), S.categories_df(t.spark), 15)


def _reassign_sql():
    by_parent = {}
    for parent, pat, sub, order, excl in S.SUBCATEGORY_RULES:
        by_parent.setdefault(parent, []).append((order, pat, sub, excl))
    outer = []
    for parent, rs in by_parent.items():
        inner = []
        for order, pat, sub, excl in sorted(rs):
            cond = f"instr(lower(p.producto), {_q(pat)}) > 0" + "".join(
                f" AND instr(lower(p.producto), {_q(e)}) = 0" for e in excl)
            inner.append(f"WHEN {cond} THEN CAST({sub} AS BIGINT)")
        outer.append(f"WHEN m.id_categoria = {parent} THEN (CASE {' '.join(inner)} END)")
    return f"""
src AS (SELECT * FROM (SELECT m.id_producto, CASE {' '.join(outer)} END AS sub
                       FROM mapping m JOIN catalog_products p ON m.id_producto = p.id_producto)
        WHERE sub IS NOT NULL)"""


@register("reassign_rules", with_(CATALOG_PRODUCTS, keyword_seed_sql(), _reassign_sql()) + """
SELECT m.id_producto, m.id_categoria, CASE WHEN s.id_producto IS NOT NULL THEN s.sub ELSE m.id_subcategoria END
       AS id_subcategoria, m.metodo, m.confianza
FROM mapping m LEFT JOIN src s ON m.id_producto = s.id_producto""", ids="PIP-12 WIN-3 DML-1 PRJ-7")
def reassign_rules(t):
    return rules.reassign_subcategory(_seed_mapping(t), _products(t), S.SUBCATEGORY_RULES)


def _correct_sql():
    ctes = ["c0 AS (SELECT m.*, lower(p.producto) AS n FROM mapping m LEFT JOIN catalog_products p "
            "ON m.id_producto = p.id_producto)"]
    for i, (src, likes, target) in enumerate(S.CORRECTION_RULES, start=1):
        m = " OR ".join(f"coalesce(n LIKE {_q(p)}, false)" for p in likes)
        tgt = _sql_null(target)
        ctes.append(f"c{i} AS (SELECT * REPLACE (CASE WHEN id_categoria = {src} AND ({m}) THEN {tgt} "
                    f"ELSE id_categoria END AS id_categoria) FROM c{i - 1})")
    return ctes, f"c{len(S.CORRECTION_RULES)}"


_CTES, _LAST = _correct_sql()


@register("correct_rules", with_(CATALOG_PRODUCTS, keyword_seed_sql(), *_CTES) +
          f"SELECT id_producto, id_categoria, id_subcategoria, metodo, confianza FROM {_LAST}",
          ids="PIP-13 DML-4 JN-7 PRJ-7")
def correct_rules(t):
    return rules.correct_misclassified(_seed_mapping(t), _products(t), S.CORRECTION_RULES)


_REMAP = T.StructType([T.StructField("old_id", T.LongType()), T.StructField("new_id", T.LongType())])
_RENAME = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


def _full_mapping(t):
    """Mapping after keyword seed + pattern fill + sub-category rules (the gold mapping stand-in)."""
    m = rules.assign_by_pattern(_seed_mapping(t), _products(t), S.PATTERN_RULES)
    return rules.reassign_subcategory(m, _products(t), S.SUBCATEGORY_RULES)


def _full_mapping_sql():
    """SQL for the same gold mapping stand-in (seed -> pattern fill -> sub-category rules)."""
    return [keyword_seed_sql(), _pattern_sql(), """
filled AS (SELECT m.id_producto,
       CASE WHEN s.id_producto IS NOT NULL AND m.id_categoria IS NULL THEN s.pc ELSE m.id_categoria END AS id_categoria,
       m.id_subcategoria,
       CASE WHEN s.id_producto IS NOT NULL AND m.id_categoria IS NULL THEN s.pm ELSE m.metodo END AS metodo,
       CASE WHEN s.id_producto IS NOT NULL AND m.id_categoria IS NULL THEN s.pf ELSE m.confianza END AS confianza
       FROM mapping m LEFT JOIN src s ON m.id_producto = s.id_producto)""",
            _reassign_sql().replace("src AS", "src2 AS").replace("FROM mapping m", "FROM filled m"), """
gold AS (SELECT m.id_producto, m.id_categoria,
       CASE WHEN s.id_producto IS NOT NULL THEN s.sub ELSE m.id_subcategoria END AS id_subcategoria,
       m.metodo, m.confianza FROM filled m LEFT JOIN src2 s ON m.id_producto = s.id_producto)"""]


GOLD_SQL = _full_mapping_sql()


def _normalised(t):
    spark = t.spark
    remap = spark.createDataFrame(S.CATEGORY_REMAP, _REMAP)
    ren = spark.createDataFrame(S.CATEGORY_RENAMES, _RENAME)
    mapping = _full_mapping(t)
    # make the merge visible: products of 'rods' with 'hot' were filed under the duplicate id 10
    mapping = mapping.withColumn("id_categoria", F.when(F.col("id_categoria") == 1, F.lit(10).cast("long"))
                                 .otherwise(F.col("id_categoria")))
    return reports.normalise_taxonomy(mapping, S.categories_df(spark), remap, ren)


_REMAP_SQL = " ".join(f"WHEN {o} THEN {n}" for o, n in S.CATEGORY_REMAP)
_RENAME_SQL = " ".join(f"WHEN id_categoria = {i} THEN {_q(n)}" for i, n in S.CATEGORY_RENAMES)
_GONE_SQL = ", ".join(str(o) for o, _ in S.CATEGORY_REMAP)


@register("taxonomy_normalise", with_(CATALOG_PRODUCTS, *GOLD_SQL, CATEGORIES_SQL, f"""
dup AS (SELECT * REPLACE (CASE WHEN id_categoria = 1 THEN CAST(10 AS BIGINT) ELSE id_categoria END AS id_categoria)
        FROM gold)""", f"""
nm AS (SELECT * REPLACE (CAST(coalesce(CASE id_categoria {_REMAP_SQL} END, id_categoria) AS BIGINT) AS id_categoria,
                         CAST(coalesce(CASE id_subcategoria {_REMAP_SQL} END, id_subcategoria) AS BIGINT) AS id_subcategoria)
       FROM dup)""", f"""
nc AS (SELECT * REPLACE (CASE WHEN id_categoria IN ({_GONE_SQL}) THEN '_DELETED_' || nombre
                              ELSE coalesce(CASE {_RENAME_SQL} END, nombre) END AS nombre) FROM categories)""") + """
SELECT c.id_categoria, c.nombre, CAST(coalesce(k.productos, 0) AS BIGINT) AS productos
FROM nc c LEFT JOIN (SELECT id_categoria, count(*) AS productos FROM nm GROUP BY id_categoria) k
  ON c.id_categoria = k.id_categoria
WHERE NOT starts_with(c.nombre, '_DELETED_') AND NOT starts_with(c.nombre, '_OLD_')""",
          ids="PIP-53 DML-3 PRJ-7")
def taxonomy_normalise(t):
    m, c = _normalised(t)
    return reports.products_per_category(m, c)


@register("taxonomy_rollup", with_(CATALOG_PRODUCTS, *GOLD_SQL, CATEGORIES_SQL, MACROS_SQL, """
cat1 AS (SELECT id_categoria, id_macro FROM categories WHERE nivel = 1)""", """
g AS (SELECT id_categoria, count(*) AS n_prod FROM gold WHERE id_categoria IS NOT NULL GROUP BY id_categoria)""", """
u AS (SELECT DISTINCT c.id_macro, gold.id_subcategoria AS sub FROM gold JOIN cat1 c ON gold.id_categoria = c.id_categoria
      WHERE gold.id_subcategoria IS NOT NULL)""") + """
SELECT mc.id_macro, mc.nombre AS macro,
       (SELECT count(*) FROM cat1 WHERE cat1.id_macro = mc.id_macro) AS categorias,
       CAST(coalesce((SELECT sum(g.n_prod) FROM g JOIN cat1 ON g.id_categoria = cat1.id_categoria
                      WHERE cat1.id_macro = mc.id_macro), 0) AS BIGINT) AS productos,
       (SELECT count(*) FROM u WHERE u.id_macro = mc.id_macro) AS subcategorias_usadas
FROM macros mc""", ids="PIP-54 JN-15 AGG-2 DML-10")
def taxonomy_rollup(t):
    return reports.taxonomy_rollup(_full_mapping(t), S.categories_df(t.spark), S.macros_df(t.spark))


@register("metric_stack", with_(CATALOG_PRODUCTS, *GOLD_SQL) + """
SELECT metric, CAST(value AS BIGINT) AS value FROM (
  SELECT count(*) AS total, count(id_categoria) AS clasificados,
         count(*) FILTER (WHERE id_categoria IS NULL) AS sin_clasificar,
         count(id_subcategoria) AS con_subcategoria, count(DISTINCT id_categoria) AS categorias_distintas
  FROM gold) UNPIVOT (value FOR metric IN (total, clasificados, sin_clasificar, con_subcategoria,
                                           categorias_distintas))""", ids="SET-3 AGG-2 AGG-6")
def metric_stack(t):
    return reports.metric_stack(_full_mapping(t))


@register("gap_estimate", with_(CATALOG_PRODUCTS, keyword_seed_sql()) + """
SELECT min(n) AS min_size, round(avg(n), 4) AS mean_size, median(n) AS median_size, max(n) AS max_size,
       count(*) AS categories,
       (SELECT count(*) FROM mapping WHERE id_categoria IS NULL) AS unclassified,
       CAST(floor((SELECT count(*) FROM mapping WHERE id_categoria IS NULL) / median(n)) AS BIGINT) AS estimated_missing
FROM (SELECT id_categoria, count(*) AS n FROM mapping WHERE id_categoria IS NOT NULL GROUP BY id_categoria)""",
          ids="PIP-52 AGG-16 AGG-4 AGG-14")
def gap_estimate(t):
    return reports.gap_estimate(_seed_mapping(t))
