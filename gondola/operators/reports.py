"""Coverage, taxonomy and metric reports (PIP-5, PIP-52, PIP-53, PIP-54, SET-3, AGG-13/14/16).

Every report is a partial+final aggregate over the mapping; windows without PARTITION BY run only
over already-aggregated rows (a handful of groups), never over fact rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gondola.operators import mutate


def _all():
    """Empty-partition window — only ever applied to an aggregate of a few rows."""
    return Window.partitionBy()


def share(count_col: str = "n", digits: int = 2):
    """AGG-13: ``count * 100 / SUM(count) OVER ()`` on an aggregated frame."""
    return F.round(F.col(count_col) * 100.0 / F.sum(count_col).over(_all()), digits)


def coverage_report(mapping: DataFrame) -> DataFrame:
    """PIP-5: classified vs unclassified — total, share of all, mean confidence."""
    estado = F.when(F.col("id_categoria").isNull(), "SIN CLASIFICAR").otherwise("CLASIFICADO")
    return (mapping.groupBy(estado.alias("estado"))
            .agg(F.count(F.lit(1)).alias("total"), F.round(F.avg("confianza"), 2).alias("confianza_promedio"))
            .withColumn("porcentaje", share("total")))


def category_top(mapping: DataFrame, categories: DataFrame, n: int = 20) -> DataFrame:
    """PIP-5: top-n categories by products, with mean confidence and share (ties by name)."""
    agg = (mapping.filter(F.col("id_categoria").isNotNull())
           .groupBy("id_categoria")
           .agg(F.count(F.lit(1)).alias("productos"), F.sum("confianza").alias("_s")))
    cats = F.broadcast(categories.select("id_categoria", F.col("nombre").alias("categoria")))
    return (agg.join(cats, "id_categoria", "inner")
            .select("categoria", "productos", F.round(F.col("_s") / F.col("productos"), 2).alias("confianza_avg"),
                    share("productos").alias("porcentaje"))
            .orderBy(F.col("productos").desc(), F.col("categoria").asc())
            .limit(n))


def method_breakdown(mapping: DataFrame) -> DataFrame:
    """PIP-5: classified products by method and state: number, share of all, mean, least and highest confidence."""
    estado = F.when(F.col("id_categoria").isNull(), "SIN CLASIFICAR").otherwise("CLASIFICADO")
    return (mapping.groupBy("metodo", estado.alias("estado"))
            .agg(F.count(F.lit(1)).alias("total"), F.round(F.avg("confianza"), 2).alias("confianza_promedio"),
                 F.min("confianza").alias("confianza_min"), F.max("confianza").alias("confianza_max"))
            .withColumn("porcentaje", share("total")))


def normalise_taxonomy(mapping: DataFrame, categories: DataFrame, remap: DataFrame,
                       renames: DataFrame) -> tuple[DataFrame, DataFrame]:
    """PIP-53: merge duplicate categories (remap old→kept on both levels of the mapping) and rename.

    Returns (new mapping, new categories); merged-away categories are marked ``_DELETED_<name>``.
    """
    new_map = mutate.remap_values(mapping, "id_categoria", remap)
    new_map = mutate.remap_values(new_map, "id_subcategoria", remap)
    gone = remap.select(F.col("old_id").alias("id_categoria"), F.lit(True).alias("_gone"))
    ren = renames.select(F.col("id").alias("id_categoria"), F.col("name").alias("_new_name"))
    new_cats = (categories.join(F.broadcast(gone), "id_categoria", "left")
                .join(F.broadcast(ren), "id_categoria", "left")
                .withColumn("nombre", F.when(F.col("_gone"), F.concat(F.lit("_DELETED_"), F.col("nombre")))
                            .otherwise(F.coalesce(F.col("_new_name"), F.col("nombre"))))
                .select(*categories.columns))
    return new_map, new_cats


def products_per_category(mapping: DataFrame, categories: DataFrame) -> DataFrame:
    """Category listing with product counts (deprecated names excluded, zero-count kept)."""
    counts = mapping.groupBy("id_categoria").agg(F.count(F.lit(1)).alias("productos"))
    return (categories.filter(~F.col("nombre").startswith("_DELETED_") & ~F.col("nombre").startswith("_OLD_"))
            .join(counts, "id_categoria", "left")
            .select("id_categoria", "nombre", F.coalesce("productos", F.lit(0)).cast("long").alias("productos")))


def taxonomy_rollup(mapping: DataFrame, categories: DataFrame, macros: DataFrame) -> DataFrame:
    """PIP-54: per macro — categories (level 1), products, distinct sub-categories in use.

    Mapping is pre-aggregated per (category, subcategory) before the star of left joins (JN-15), so a
    macro's subcategories are counted over distinct rows and never held as one array."""
    per_cat = (mapping.filter(F.col("id_categoria").isNotNull())
               .groupBy("id_categoria", "id_subcategoria").agg(F.count(F.lit(1)).alias("n_prod")))
    lvl1 = categories.filter(F.col("nivel") == 1).select("id_categoria", "id_macro")
    cat_stats = lvl1.join(per_cat, "id_categoria", "left")
    return (macros.join(cat_stats, "id_macro", "left")
            .groupBy("id_macro", F.col("nombre").alias("macro"))
            .agg(F.count_distinct("id_categoria").alias("categorias"),
                 F.coalesce(F.sum("n_prod"), F.lit(0)).cast("long").alias("productos"),
                 F.count_distinct("id_subcategoria").alias("subcategorias_usadas")))


def metric_stack(mapping: DataFrame) -> DataFrame:
    """SET-3: several counts in ONE pass, unpivoted with ``stack`` into (metric, value) rows."""
    one = mapping.agg(
        F.count(F.lit(1)).alias("total"),
        F.count("id_categoria").alias("clasificados"),
        F.count_if(F.col("id_categoria").isNull()).alias("sin_clasificar"),
        F.count("id_subcategoria").alias("con_subcategoria"),
        F.count_distinct("id_categoria").alias("categorias_distintas"))
    return one.select(F.expr(
        "stack(5, 'total', total, 'clasificados', clasificados, 'sin_clasificar', sin_clasificar, "
        "'con_subcategoria', con_subcategoria, 'categorias_distintas', categorias_distintas) "
        "AS (metric, value)")).withColumn("value", F.col("value").cast("long"))


def gap_estimate(mapping: DataFrame) -> DataFrame:
    """PIP-52 / AGG-16: group-size statistics of categories and the estimated number of missing
    categories = unclassified // median products per category."""
    sizes = (mapping.filter(F.col("id_categoria").isNotNull())
             .groupBy("id_categoria").agg(F.count(F.lit(1)).alias("n")))
    stats = sizes.agg(F.min("n").alias("min_size"), F.round(F.avg("n"), 4).alias("mean_size"),
                      F.median("n").alias("median_size"), F.max("n").alias("max_size"),
                      F.count(F.lit(1)).alias("categories"))
    unc = mapping.select(F.count_if(F.col("id_categoria").isNull())).scalar()  # scalar subquery
    return (stats.withColumn("unclassified", unc)
            .withColumn("estimated_missing",
                        F.floor(F.col("unclassified") / F.col("median_size")).cast("long")))
