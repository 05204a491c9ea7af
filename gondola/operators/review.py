"""Human review queue (PIP-32 … PIP-35, DML-9, DML-11, AGG-12/13/20/24).

The queue is a table upserted on the product id (pin D23): a product appears once, with its newest
suggestion. Approvals/rejections are status transitions produced by a semi-join flag, never by
string-built ``IN (...)`` lists.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gondola.operators import mutate

PENDING, APPROVED, REJECTED = "pendiente", "aprobado", "rechazado"


def upsert_queue(rows: DataFrame, key: str = "id_producto", order: Sequence[Column] | None = None) -> DataFrame:
    """Keep the newest row per product (``order`` = newest first)."""
    w = Window.partitionBy(key).orderBy(*(order or [F.col("fecha_creacion").desc()]))
    return rows.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def inspect(queue: DataFrame, examples: int = 5) -> DataFrame:
    """PIP-32: pending rows grouped by suggestion × new-category flag: count and the first
    ``examples`` names (alphabetical) — a bounded list per group."""
    pend = queue.filter(F.col("estado") == PENDING)
    w = Window.partitionBy("llm_sugerencia", "es_categoria_nueva").orderBy("producto", "id_producto")
    ex = (pend.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= examples)
          .groupBy("llm_sugerencia", "es_categoria_nueva")
          .agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", "producto"))), lambda s: s["producto"])
               .alias("ejemplos")))
    cnt = pend.groupBy("llm_sugerencia", "es_categoria_nueva").agg(F.count(F.lit(1)).alias("n"))
    return cnt.join(ex, ["llm_sugerencia", "es_categoria_nueva"], "left")


def pending_ids(queue: DataFrame, suggestion: str) -> DataFrame:
    return queue.filter((F.col("estado") == PENDING) & (F.col("llm_sugerencia") == suggestion)).select("id_producto")


def set_status(queue: DataFrame, ids: DataFrame, status: str) -> DataFrame:
    """DML-11: status transition for the given ids (semi-join flag)."""
    return mutate.update_where_in(queue, ids, "id_producto", {"estado": F.lit(status)})


def approve(queue: DataFrame, mapping: DataFrame, ids: DataFrame, id_categoria: int,
            method: str = "revision_manual") -> tuple[DataFrame, DataFrame]:
    """PIP-33: approved products get the category in the mapping (upsert keep-last) and the queue
    rows turn ``aprobado``. Returns (new queue, new mapping)."""
    new_rows = ids.select("id_producto", F.lit(id_categoria).cast("long").alias("id_categoria"),
                          F.lit(None).cast("long").alias("id_subcategoria"), F.lit(method).alias("metodo"),
                          F.lit(1.0).alias("confianza"))
    return set_status(queue, ids, APPROVED), mutate.upsert_keep_last(mapping, new_rows, "id_producto")


def new_categories(queue: DataFrame, categories: DataFrame) -> DataFrame:
    """PIP-33 ``create_category`` / DML-9: suggested new names not yet in the taxonomy get ids
    ``max(id) + row_number()`` (alphabetical)."""
    names = (queue.filter(F.col("es_categoria_nueva") & F.col("llm_sugerencia").isNotNull())
             .select(F.col("llm_sugerencia").alias("nombre")).distinct()
             .join(categories.select("nombre"), "nombre", "left_anti"))
    return mutate.next_ids(categories, "id_categoria", names, "nombre").select(
        "id_categoria", "nombre", F.lit(1).alias("nivel"))


def progress(queue: DataFrame) -> DataFrame:
    """PIP-34: counts per status, share, distinct suggestions."""
    g = queue.groupBy("estado").agg(F.count(F.lit(1)).alias("n"),
                                    F.count_distinct("llm_sugerencia").alias("sugerencias"))
    return g.withColumn("pct", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 6))


def diagnostics(queue: DataFrame, bands: Sequence[float], near: tuple[float, float]) -> DataFrame:
    """PIP-35 / AGG-20 / AGG-24: one table of (dimension, bucket, n): reasons, similarity bands,
    top macros, and near misses inside ``near``."""
    band = F.lit(f"<{bands[0]}")
    for lo, hi in zip(bands, list(bands[1:]) + [None]):
        label = f"{lo}-{hi}" if hi is not None else f">={lo}"
        cond = (F.col("similitud") >= lo) if hi is None else ((F.col("similitud") >= lo) & (F.col("similitud") < hi))
        band = F.when(cond, F.lit(label)).otherwise(band)
    parts = [
        queue.groupBy(F.lit("razon").alias("dimension"), F.col("razon").alias("bucket")).count(),
        queue.groupBy(F.lit("banda").alias("dimension"), band.alias("bucket")).count(),
        queue.groupBy(F.lit("macro").alias("dimension"), F.col("top_macro").cast("string").alias("bucket")).count(),
        queue.filter(F.col("similitud").between(near[0], near[1]))
        .groupBy(F.lit("near_miss").alias("dimension"), F.col("top_categoria").alias("bucket")).count(),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumnRenamed("count", "n")
