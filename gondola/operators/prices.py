"""Price reports joined with the catalog mapping (PIP-49, PIP-50, JN-20, AGG-22)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cents(c: str) -> F.Column:
    """Exact integer cents of a 2-decimal price (sums and means stay exact in any engine)."""
    return F.round(F.col(c) * 100).cast("long")


def enrich_prices(prices: DataFrame, mapping: DataFrame, categories: DataFrame) -> DataFrame:
    """PIP-50 / JN-20: every price row with its category (left joins: unclassified rows kept).

    The mapping has one row per product (dimension-sized); categories are a seed (broadcast)."""
    cats = F.broadcast(categories.select("id_categoria", F.col("nombre").alias("categoria")))
    m = mapping.select("id_producto", "id_categoria", "id_subcategoria", "metodo")
    return prices.join(m, "id_producto", "left").join(cats, "id_categoria", "left")


def price_comparison(enriched: DataFrame, category_id: int) -> DataFrame:
    """PIP-49 / AGG-22: mean price by week × chain × product inside one category.

    Mean = (sum of cents / rows) / 100: exact sums, one division each — reproducible bit-for-bit."""
    return (enriched.filter(F.col("id_categoria") == category_id)
            .groupBy("week_date", "cadena", "id_producto", "producto")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(cents("precio")).alias("_s"),
                 F.min("precio").alias("precio_min"), F.max("precio").alias("precio_max"))
            .withColumn("precio_promedio", F.col("_s") / F.col("n") / 100.0)
            .drop("_s"))
