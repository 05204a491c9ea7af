"""More query keys: receipt strategy union and match context, nearest-rank percentiles, hash-ordered
samples with two-role category joins, the two meanings of "unclassified", table maintenance via
nested subqueries, and the native hashed TF-IDF encoder."""

from __future__ import annotations

from pyspark.sql import functions as F

from gondola import schemas as S
from gondola.operators import encoders, mutate, quality, receipts, rules, sampling
from gondola.plans import loop_q, receipts_q
from gondola.plans.catalog_q import CATEGORIES_SQL, GOLD_SQL, _full_mapping, _products, _seed_mapping, keyword_seed_sql
from gondola.plans.propagate_q import _grams_sql
from gondola.plans.registry import register
from gondola.plans.sql_standins import CATALOG_PRODUCTS, with_

NON_ITEMS = ", ".join(f"'{w}'" for w in receipts.NON_ITEM_WORDS)


@register("combine_strategies", receipts_q.BASE + f"""
, b AS (SELECT file, pos, trim(regexp_extract(line_text, '^([A-Z][A-Z ]*[A-Z])', 1)) AS producto,
              try_cast(replace(regexp_extract_all(line_text, '(-?[0-9]+[,.][0-9]{{2}})', 1)[-1], ',', '.') AS DOUBLE)
                AS precio
       FROM lines WHERE regexp_matches(line_text, '[0-9]+[,.][0-9]{{2}}$')
         AND trim(regexp_extract(line_text, '^([A-Z][A-Z ]*[A-Z])', 1)) <> ''
         AND regexp_extract(line_text, '^([A-Z]+)', 1) NOT IN ({NON_ITEMS})),
u AS (SELECT file, producto, precio, bool_or(a) AS a, bool_or(bb) AS bb, min(pos) AS pos FROM (
        SELECT file, pos, producto, precio_pagado AS precio, true AS a, false AS bb FROM items
        UNION ALL SELECT file, pos, producto, precio, false, true FROM b) GROUP BY file, producto, precio)
SELECT file, count(*) FILTER (WHERE a AND bb) AS both, count(*) FILTER (WHERE a AND NOT bb) AS ids_only,
       count(*) FILTER (WHERE NOT a AND bb) AS price_only, count(*) AS union_items, arg_min(producto, pos) AS first_item
FROM u GROUP BY file""", ids="PIP-46 SET-2 AGG-6 AGG-11 SET-1")
def combine_strategies(t):
    lines = receipts_q._lines(t)
    return receipts.combine_strategies(receipts_q._items(t), receipts.price_only_items(lines))


@register("receipt_context", receipts_q.BASE + """
SELECT file, pos, line_text, CASE WHEN m = 1 THEN 'match' ELSE 'context' END AS label FROM (
  SELECT *, CAST(line_text LIKE '%PROMO%' AS INTEGER) AS m,
         max(CAST(line_text LIKE '%PROMO%' AS INTEGER)) OVER (PARTITION BY file ORDER BY pos
                                                              ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) AS near
  FROM lines) WHERE near = 1""", ids="WIN-10 PRJ-14 PIP-36")
def receipt_context(t):
    return receipts.match_context(receipts_q._lines(t), "%PROMO%", before=1, after=2)


@register("iteration_percentiles", loop_q.BASE + """
, r AS (SELECT run_id, iteration, confianza,
              row_number() OVER (PARTITION BY run_id, iteration ORDER BY confianza) AS rn,
              count(*) OVER (PARTITION BY run_id, iteration) AS n FROM staged)
SELECT run_id, iteration, max(n) AS n,
       max(CASE WHEN rn = floor(n * 0.1) + 1 THEN confianza END) AS p10_nearest,
       round(quantile_cont(confianza, 0.1), 6) AS p10_interp,
       max(CASE WHEN rn = floor(n * 0.9) + 1 THEN confianza END) AS p90_nearest,
       round(quantile_cont(confianza, 0.9), 6) AS p90_interp
FROM r GROUP BY run_id, iteration""", ids="AGG-5 AGG-4 PIP-26")
def iteration_percentiles(t):
    return quality.nearest_rank_percentiles(loop_q._staged(t), ["run_id", "iteration"], "confianza")


@register("sample_named", with_(CATALOG_PRODUCTS, *GOLD_SQL, CATEGORIES_SQL) + """
SELECT g.id_producto, p.producto, c1.nombre AS categoria, c2.nombre AS subcategoria
FROM gold g JOIN catalog_products p ON g.id_producto = p.id_producto
JOIN categories c1 ON g.id_categoria = c1.id_categoria
LEFT JOIN categories c2 ON g.id_subcategoria = c2.id_categoria
ORDER BY md5(g.id_producto || '42') LIMIT 100""", ids="ORD-4 ORD-6 JN-4 SCA-27 AGG-8")
def sample_named(t):
    cats = S.categories_df(t.spark)
    c1 = F.broadcast(cats.select("id_categoria", F.col("nombre").alias("categoria")))
    c2 = F.broadcast(cats.select(F.col("id_categoria").alias("id_subcategoria"), F.col("nombre").alias("subcategoria")))
    named = (_full_mapping(t).join(_products(t), "id_producto").join(c1, "id_categoria")
             .join(c2, "id_subcategoria", "left").select("id_producto", "producto", "categoria", "subcategoria"))
    return sampling.sample_n(named, "id_producto", 100)


@register("sample_fraction", with_(CATALOG_PRODUCTS) + """
SELECT id_producto, producto FROM catalog_products
WHERE CAST('0x' || substr(md5(id_producto || '42'), 1, 8) AS BIGINT) < 429496729""", ids="ORD-5")
def sample_fraction(t):
    return sampling.sample_fraction(_products(t), "id_producto", 0.1)


DROPPED = "%widget%"


@register("unclassified_products", with_(CATALOG_PRODUCTS, keyword_seed_sql(), f"""
m2 AS (SELECT m.* FROM mapping m JOIN catalog_products p ON m.id_producto = p.id_producto
       WHERE NOT coalesce(m.id_categoria IS NULL AND lower(p.producto) LIKE '{DROPPED}', false))""") + """
SELECT p.id_producto, m2.id_producto IS NULL AS absent,
       m2.id_producto IS NOT NULL AND m2.id_categoria IS NULL AS null_assigned
FROM catalog_products p LEFT JOIN m2 ON p.id_producto = m2.id_producto
WHERE m2.id_producto IS NULL OR m2.id_categoria IS NULL""", ids="JN-6 SET-4 DML-6 JN-5")
def unclassified_products(t):
    prods = _products(t)
    named = _seed_mapping(t).join(prods.select("id_producto", "producto"), "id_producto")
    m2 = mutate.delete_where(named, F.col("id_categoria").isNull() & F.lower("producto").like(DROPPED)).drop("producto")
    both = rules.unclassified(prods, m2, include_null_assigned=True)
    absent = rules.unclassified(prods, m2, include_null_assigned=False).select("id_producto", F.lit(True).alias("absent"))
    return (both.join(absent, "id_producto", "left")
            .select("id_producto", F.coalesce("absent", F.lit(False)).alias("absent"),
                    (~F.coalesce("absent", F.lit(False))).alias("null_assigned")))


@register("mapping_maintenance", with_(CATALOG_PRODUCTS, keyword_seed_sql(), """
hot AS (SELECT id_producto FROM catalog_products WHERE lower(producto) LIKE '%hot%')""") + """
SELECT m.id_producto, m.id_categoria,
       CASE WHEN m.id_producto IN (SELECT id_producto FROM mapping WHERE id_categoria = 4
                                   AND id_producto IN (SELECT id_producto FROM hot))
            THEN CAST(41 AS BIGINT) ELSE m.id_subcategoria END AS id_subcategoria,
       m.metodo, m.confianza, coalesce(CAST(NULL AS VARCHAR), 'sin revisar') AS notas
FROM mapping m""", ids="DML-5 DML-7 DML-8 DML-4")
def mapping_maintenance(t):
    spark = t.spark
    m = spark.createDataFrame([], S.PRODUCT_CATEGORY).unionByName(_seed_mapping(t))     # DML-8: typed table
    m = mutate.add_column(m, "notas", "string", F.lit("sin revisar"))                  # DML-7
    hot = _products(t).filter(F.lower("producto").like("%hot%")).select("id_producto")
    target = m.filter(F.col("id_categoria") == 4).select("id_producto").join(hot, "id_producto", "left_semi")
    return mutate.update_where_in(m, target, "id_producto", {"id_subcategoria": F.lit(41).cast("long")})  # DML-5


def _load_letters():
    """An encoder as a user would plug one in: the share of each letter a to z in a text."""
    import numpy as np

    def encode(texts):
        out = np.zeros((len(texts), 26))
        for i, text in enumerate(texts):
            codes = np.frombuffer(text.lower().encode(), np.uint8).astype(int) - ord("a")
            out[i] = np.bincount(codes[(codes >= 0) & (codes < 26)], minlength=26) / max(1, len(text))
        return out

    return encode


@register("embed_plugged", with_(CATALOG_PRODUCTS) + """
SELECT id_producto, 'letters_26' AS encoder,
       list_transform(range(97, 123), lambda c: round((length(producto) - length(replace(lower(producto), chr(CAST(c AS INTEGER)), '')))
                                                      / greatest(1, length(producto)), 9)) AS vector
FROM catalog_products""", ids="UDF-4")
def embed_plugged(t):
    """Vectors of an encoder given by the caller, loaded once per Python worker."""
    v = encoders.embed_with(_products(t), "id_producto", "producto", "letters_26", _load_letters, 26)
    return v.withColumn("vector", F.transform("vector", lambda x: F.round(x, 9)))


DIMS = 64


@register("embed_names", with_(CATALOG_PRODUCTS) + rf"""
, g AS (SELECT id_producto, unnest({_grams_sql('producto')}) AS gram FROM catalog_products),
tf AS (SELECT id_producto, CAST(CAST('0x' || substr(md5(gram), 1, 8) AS BIGINT) % {DIMS} AS INTEGER) AS b,
              count(*) AS tf FROM g GROUP BY ALL),
idf AS (SELECT b, ln((1 + (SELECT count(*) FROM catalog_products)) / (1 + count(*))) AS i FROM tf GROUP BY b),
w AS (SELECT tf.id_producto, tf.b, tf.tf * (idf.i + 1.0) AS w0 FROM tf JOIN idf ON tf.b = idf.b),
wn AS (SELECT id_producto, b, w0 / sqrt(sum(w0 * w0) OVER (PARTITION BY id_producto)) AS w FROM w)
SELECT k.id_producto, 'hashed_tfidf_{DIMS}' AS encoder, CAST(count(wn.w) AS INTEGER) AS nnz,
       list(round(coalesce(wn.w, 0.0), 6) ORDER BY r.i) AS vector
FROM (SELECT DISTINCT id_producto FROM wn) k CROSS JOIN range(0, {DIMS}) r(i)
LEFT JOIN wn ON wn.id_producto = k.id_producto AND wn.b = r.i
GROUP BY k.id_producto""", ids="UDF-4 SCA-15 AGG-17")
def embed_names(t):
    v = encoders.hashed_tfidf(_products(t), "id_producto", "producto", DIMS)
    return v.select("id_producto", "encoder", F.size(F.filter("vector", lambda x: x != 0)).cast("int").alias("nnz"),
                    F.transform("vector", lambda x: F.round(x, 6)).alias("vector"))
