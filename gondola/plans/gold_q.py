"""Query keys for the merged gold mapping, taxonomy centroids, vectors as JSON text, and two orderings."""

from __future__ import annotations

from pyspark.sql import functions as F

from gondola import schemas as S
from gondola.functions.vectors import l2norm, round_vec
from gondola.operators import mutate, sampling
from gondola.operators import vectors as V
from gondola.operators.quality import latest_per_product
from gondola.operators.review import PENDING
from gondola.plans import loop_q
from gondola.plans.catalog_q import CATEGORIES_SQL, GOLD_SQL, _full_mapping, _seed_mapping, keyword_seed_sql
from gondola.operators.scan import numbered
from gondola.plans.registry import register
from gondola.plans.sql_standins import CATALOG_PRODUCTS, with_
from gondola.sources import standins

AUTO_MIN = 0.5
CATCH_ALL = ("sin_clasificar", "otros")


@register("gold_merged", with_(CATALOG_PRODUCTS, CATEGORIES_SQL, keyword_seed_sql(), loop_q.STAGED_SQL, loop_q.QUEUE_SQL, f"""
one AS (SELECT * EXCLUDE (rn2) FROM (SELECT *, row_number() OVER (PARTITION BY id_producto
        ORDER BY iteration DESC, confianza DESC, id_categoria ASC) AS rn2 FROM lt) WHERE rn2 = 1)""", f"""
src AS (SELECT id_producto, id_categoria, CAST(0.80 AS DOUBLE) AS confianza, 'regla' AS metodo, 0 AS p
          FROM mapping WHERE id_categoria IS NOT NULL
        UNION ALL SELECT id_producto, id_categoria, confianza, 'embedding_auto', 1 FROM one WHERE confianza >= {AUTO_MIN}
        UNION ALL SELECT q.id_producto, c.id_categoria, q.similitud, 'pendiente_revision', 2
          FROM queue q JOIN categories c ON c.nombre = q.top_categoria WHERE q.estado = 'pendiente')""") + """
SELECT id_producto, id_categoria, round(confianza, 6) AS confianza, metodo FROM (
  SELECT *, row_number() OVER (PARTITION BY id_producto ORDER BY p, confianza DESC, id_categoria) AS rn FROM src) WHERE rn = 1""",
          ids="PIP-50 SET-1")
def gold_merged(t):
    rules_ = _seed_mapping(t).where("id_categoria is not null").select(
        "id_producto", "id_categoria", F.lit(0.80).alias("confianza"), F.lit("regla").alias("metodo"))
    auto = latest_per_product(loop_q._staged(t), keys=("id_producto",)).where(F.col("confianza") >= AUTO_MIN).select(
        "id_producto", "id_categoria", "confianza", F.lit("embedding_auto").alias("metodo"))
    cats = S.categories_df(t.spark).select("id_categoria", F.col("nombre").alias("top_categoria"))
    pend = loop_q._queue(t).where(F.col("estado") == PENDING).join(cats, "top_categoria").select(
        "id_producto", "id_categoria", F.col("similitud").alias("confianza"), F.lit("pendiente_revision").alias("metodo"))
    out = mutate.merge_by_priority([rules_, auto, pend], "id_producto", [F.col("confianza").desc(), F.col("id_categoria").asc()])
    return out.withColumn("confianza", F.round("confianza", 6))


def _retired(t):
    """The gold mapping with some products still filed under the deprecated category 11."""
    m = _full_mapping(t)
    old = (F.col("id_categoria") == 4) & F.col("id_producto").endswith("7")
    return (m.withColumn("id_subcategoria", F.when(old, F.lit(None)).otherwise(F.col("id_subcategoria")))
            .withColumn("id_categoria", F.when(old, F.lit(11).cast("long")).otherwise(F.col("id_categoria"))))


@register("centroids_taxonomy", with_(CATALOG_PRODUCTS, CATEGORIES_SQL, *GOLD_SQL, f"""
fin AS (SELECT g.id_producto, c.id_categoria AS id FROM (
          SELECT id_producto, CASE WHEN id_categoria = 4 AND id_producto LIKE '%7' THEN 11
                                   ELSE coalesce(id_subcategoria, id_categoria) END AS f FROM gold) g
        JOIN categories c ON g.f = c.id_categoria
        WHERE c.nombre NOT IN {CATCH_ALL} AND NOT starts_with(c.nombre, '_OLD_') AND NOT starts_with(c.nombre, '_DELETED_'))""", """
vec AS (SELECT '779' || lpad(CAST(vec_id AS VARCHAR), 10, '0') AS id_producto, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
el AS (SELECT id, unnest(generate_series(1, len(v))) AS i, unnest(v) AS x FROM fin JOIN vec USING (id_producto)),
ce AS (SELECT id, list(m ORDER BY i) AS c FROM (SELECT id, i, avg(x) AS m FROM el GROUP BY id, i) GROUP BY id),
nn AS (SELECT id, count(*) AS n FROM fin JOIN vec USING (id_producto) GROUP BY id),
cu AS (SELECT id, c, sqrt(list_sum(list_transform(c, lambda x: x * x))) AS norm FROM ce)""") + """
SELECT id AS id_categoria, n AS n_productos,
       list_transform(CASE WHEN norm > 1e-10 THEN list_transform(c, lambda x: x / norm) ELSE c END, lambda x: round(x, 5)) AS centroid
FROM cu JOIN nn USING (id)""", ids="PIP-18 JN-14 PRJ-7 AGG-17")
def centroids_taxonomy(t):
    final = V.final_categories(_retired(t), S.categories_df(t.spark), CATCH_ALL)
    vec = t.embeddings.select(standins.barcode_of(F.col("vec_id")).alias("id_producto"), "embedding")
    c = V.centroids(final.join(vec, "id_producto"), "id_categoria_final", "embedding", "id_categoria")
    return c.select("id_categoria", "n_productos", round_vec(F.col("centroid"), 5).alias("centroid"))


@register("vector_json", """
SELECT vec_id, CAST(len(embedding) AS INTEGER) AS dims,
       round(sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x))), 6) AS norm FROM embeddings""", ids="SNK-11")
def vector_json(t):
    """Vectors written as JSON text and parsed back."""
    text = t.embeddings.select("vec_id", F.to_json(F.col("embedding").cast("array<double>")).alias("vector_json"))
    back = text.select("vec_id", F.from_json("vector_json", "array<double>").alias("v"))
    return back.select("vec_id", F.size("v").alias("dims"), F.round(l2norm(F.col("v")), 6).alias("norm"))


@register("name_rank_slice", """
SELECT p_name, n, CAST(rn AS INTEGER) AS rank FROM (
  SELECT p_name, n, row_number() OVER (ORDER BY n DESC, p_name ASC) AS rn FROM (SELECT p_name, count(*) AS n FROM part GROUP BY p_name))
WHERE rn BETWEEN 51 AND 100""", ids="ORD-3 AGG-13")
def name_rank_slice(t):
    counts = t.part.groupBy("p_name").agg(F.count(F.lit(1)).alias("n"))
    return sampling.rank_slice(counts, [F.col("n").desc(), F.col("p_name").asc()], 51, 100)


@register("category_order", with_(CATALOG_PRODUCTS, *GOLD_SQL) + """
SELECT id_categoria, id_subcategoria, n,
       CAST(row_number() OVER (ORDER BY id_categoria ASC NULLS FIRST, n DESC, id_subcategoria ASC NULLS FIRST) AS INTEGER) AS rank
FROM (SELECT id_categoria, id_subcategoria, count(*) AS n FROM gold GROUP BY ALL)""", ids="ORD-1")
def category_order(t):
    counts = _full_mapping(t).groupBy("id_categoria", "id_subcategoria").agg(F.count(F.lit(1)).alias("n"))
    order = [F.col("id_categoria").asc_nulls_first(), F.col("n").desc(), F.col("id_subcategoria").asc_nulls_first()]
    return numbered(counts, order).withColumn("rank", F.col("rank").cast("int"))
