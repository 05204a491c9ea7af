"""Classification quality checks (PIP-28, PIP-29, PIP-30, PIP-55, AGG-3/4/6/7/18, WIN-9).

All checks are aggregates over (staging or gold) ⋈ catalog ⋈ taxonomy seed. Counts are distinct
products on both sides of a ratio (pin D17), so price rows never inflate an error count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gondola.operators.scan import exact_percentiles


def latest_per_product(staging: DataFrame, keys: Sequence[str] = ("run_id", "id_producto")) -> DataFrame:
    """One staged row per (run, product): the newest iteration, then highest confidence, then lowest id."""
    w = Window.partitionBy(*keys).orderBy(F.col("iteration").desc(), F.col("confianza").desc(),
                                          F.col("id_categoria").asc())
    return staging.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def spot_check_errors(name: Column, category_name: Column,
                      rules: Sequence[tuple[Sequence[str], str]]) -> Column:
    """Boolean: the name matches a rule's LIKE patterns but the category is not the expected one,
    or the category is deprecated (``_OLD_`` prefix, pin D16)."""
    err = category_name.startswith("_OLD_")
    for likes, expected in rules:
        hit = F.lit(False)
        for p in likes:
            hit = hit | name.like(p)
        err = err | (hit & (category_name != expected))
    return F.coalesce(err, F.lit(False))


def validate_staging(staging: DataFrame, catalog: DataFrame, categories: DataFrame,
                     rules: Sequence[tuple[Sequence[str], str]], min_accuracy: float = 80.0) -> DataFrame:
    """PIP-28 + gate of PIP-31: per run — distinct products, detectable errors, estimated accuracy
    (%, rounded at one decimal on the integer scale) and pass/fail against ``min_accuracy``."""
    cats = F.broadcast(categories.select("id_categoria", F.col("nombre").alias("_cat")))
    rows = (latest_per_product(staging)
            .join(catalog.select("id_producto", F.lower("producto").alias("_n")), "id_producto")
            .join(cats, "id_categoria"))
    g = rows.groupBy("run_id").agg(
        F.count_distinct("id_producto").alias("total"),
        F.count_distinct(F.when(spot_check_errors(F.col("_n"), F.col("_cat"), rules), F.col("id_producto")))
        .alias("errors"))
    acc = F.round((F.col("total") - F.col("errors")) * 1000.0 / F.col("total")) / 10.0
    return g.select("run_id", "total", "errors", acc.alias("accuracy_pct"), (acc >= min_accuracy).alias("passed"))


def semantic_mismatches(mapping: DataFrame, catalog: DataFrame, categories: DataFrame,
                        rules: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """PIP-29: per category — products whose name matches a keyword regex while sitting in one of
    that rule's forbidden categories; categories with at least one mismatch, with the rate."""
    cats = F.broadcast(categories.select("id_categoria", F.col("nombre").alias("categoria")))
    rows = (mapping.join(catalog.select("id_producto", F.lower("producto").alias("_n")), "id_producto")
            .join(cats, "id_categoria"))
    mis = F.lit(False)
    for regex, forbidden in rules:
        mis = mis | (F.col("_n").rlike(regex) & F.col("categoria").isin(list(forbidden)))
    g = rows.groupBy("categoria").agg(
        F.count_distinct("id_producto").alias("total_products"),
        F.count_distinct(F.when(mis, F.col("id_producto"))).alias("mismatch_count"))
    return (g.filter(F.col("mismatch_count") > 0)   # AGG-7: HAVING on the alias
            .withColumn("error_rate", F.round(F.col("mismatch_count") / F.col("total_products"), 6)))


def category_quality(mapping: DataFrame, categories: DataFrame, top_n: int = 10,
                     risk_std: float = 0.03, dominance_pct: float = 15.0) -> DataFrame:
    """PIP-30: top-n categories by products with confidence mean/std/min/max/p10/p90, share of all
    classified products, risk flag (std < 0.03) and dominance flag (share > 15 %)."""
    cats = categories.select("id_categoria", F.col("nombre").alias("nombre"))
    total = mapping.select(F.count_distinct("id_producto")).scalar()
    named = mapping.join(cats, "id_categoria")
    g = named.groupBy("nombre").agg(
        F.count_distinct("id_producto").alias("n"),
        F.avg("confianza").alias("avg_conf"), F.stddev("confianza").alias("std_conf"),
        F.min("confianza").alias("min_conf"), F.max("confianza").alias("max_conf"))
    ranks = exact_percentiles(named, ["nombre"], "confianza", [0.10, 0.90])
    ranks = ranks.select(F.col("nombre").alias("_nombre"), F.col("p10_interp").alias("p10_conf"), F.col("p90_interp").alias("p90_conf"))
    top = g.orderBy(F.col("n").desc(), F.col("nombre").asc()).limit(top_n)
    top = top.join(ranks, F.col("nombre").eqNullSafe(F.col("_nombre")), "left")
    pct = F.col("n") * 100.0 / total
    out = top.select("nombre", "n", *[F.round(c, 6).alias(c) for c in
                                      ("avg_conf", "std_conf", "min_conf", "max_conf", "p10_conf", "p90_conf")],
                     F.round(pct, 6).alias("pct"),
                     F.coalesce(F.col("std_conf") < risk_std, F.lit(False)).alias("high_risk"),
                     (pct > dominance_pct).alias("dominant"))
    return out


def category_entropy(mapping: DataFrame) -> DataFrame:
    """AGG-18: Shannon entropy (bits) of the products-per-category distribution, with the total and
    the top category's count and share — one aggregate over a per-category aggregate."""
    per = mapping.groupBy("id_categoria").agg(F.count_distinct("id_producto").alias("c"))
    tot = per.select(F.sum("c")).scalar()
    p = F.col("c") / tot
    return per.agg(F.round(-F.sum(p * F.log2(p)), 6).alias("entropy_bits"),
                   F.sum("c").cast("long").alias("total"),
                   F.max("c").alias("top_count"),
                   F.round(F.max("c") * 100.0 / F.sum("c"), 6).alias("top_pct"),
                   F.count(F.lit(1)).alias("categories"))


def unclassified_tracking(staging: DataFrame, catch_all_id: int) -> DataFrame:
    """PIP-55 / WIN-9: per run and iteration — classified products, catch-all count, escape rate
    (share NOT in the catch-all), and deltas to the previous iteration via ``lag``."""
    g = staging.groupBy("run_id", "iteration").agg(
        F.count_distinct("id_producto").alias("classified"),
        F.count_distinct(F.when(F.col("id_categoria") == catch_all_id, F.col("id_producto"))).alias("catch_all"))
    w = Window.partitionBy("run_id").orderBy("iteration")
    return (g.withColumn("escape_rate", F.round((F.col("classified") - F.col("catch_all")) / F.col("classified"), 6))
            .withColumn("delta_classified", F.col("classified") - F.lag("classified").over(w))
            .withColumn("delta_catch_all", F.col("catch_all") - F.lag("catch_all").over(w)))


def nearest_rank_percentiles(df: DataFrame, group_cols: Sequence[str], value_col: str,
                             qs: Sequence[float] = (0.10, 0.90)) -> DataFrame:
    """AGG-5: nearest-rank percentiles ``sorted(values)[int(n * q)]`` per group, and the interpolated ones
    (AGG-4) for comparison, by distributed selection (``scan.exact_percentiles``)."""
    out = exact_percentiles(df, list(group_cols), value_col, list(qs))
    tags = [f"{round(q * 100):02d}" for q in qs]
    return out.select(*group_cols, "n", *[c for t in tags for c in (
        F.col(f"p{t}_nearest"), F.round(f"p{t}_interp", 6).alias(f"p{t}_interp"))])
