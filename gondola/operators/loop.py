"""Stage → validate → promote loop (PIP-25, PIP-26, PIP-27, PIP-31, SNK-12, DML-12).

Each iteration is one Spark job whose results are *written* (Parquet, partitioned by run and
iteration, under the shared ``spark.checkpoint.dir``) and re-read by the next iteration, so the plan
never grows and a lost executor only recomputes the current iteration. Re-running an iteration
overwrites exactly its own partition (dynamic partition overwrite), which makes the loop resumable
and idempotent on (run, iteration, id) (pins D22, D23). Only one-row aggregates reach the driver.
"""

from __future__ import annotations

import uuid

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.functions.vectors import l2norm, scale
from gondola.operators import mutate, vectors
from gondola.operators.quality import latest_per_product
from gondola.operators.scan import shared_table
from gondola.session import read_if_written, scratch_path


def adapt_threshold(rate: float, current: float, lo: float, hi: float, step: float = 0.05,
                    low_rate: float = 0.40, high_rate: float = 0.60) -> float:
    """PIP-25: lower the threshold when too few rows are auto-assigned, raise it when too many."""
    if rate < low_rate:
        current -= step
    elif rate > high_rate:
        current += step
    return round(min(hi, max(lo, current)), 6)


def resume_point(spark: SparkSession, metrics_path: str, run_id: str) -> int:
    """PIP-27: the last finished iteration of a run, 0 before the first — from the metrics table, which is
    written last in every iteration."""
    m = read_if_written(spark, metrics_path)
    if m is None:
        return 0
    return int(m.filter(F.col("run_id") == run_id).agg(F.coalesce(F.max("iteration"), F.lit(0))).first()[0])


def centroid_sums(rows: DataFrame, cat_id: str, vec_col: str) -> DataFrame:
    """(``cat_id``, n, total): vectors of each category counted and added up; rows without either are left out."""
    rows = rows.where(F.col(cat_id).isNotNull() & F.col(vec_col).isNotNull())
    return rows.groupBy(cat_id).agg(F.count(F.lit(1)).alias("n"), Summarizer.sum(array_to_vector(F.col(vec_col))).alias("_t")).select(
        F.col(cat_id).cast("long").alias(cat_id), "n", vector_to_array("_t").alias("total"))


def merge_sums(states: DataFrame, key: str) -> DataFrame:
    """Sums of the same key added up; a category has a row per iteration, so groups are tiny."""
    return states.groupBy(key).agg(F.sum("n").alias("n"), Summarizer.sum(array_to_vector(F.col("total"))).alias("_t")).select(
        key, "n", vector_to_array("_t").alias("total"))


def unit_centroids(sums: DataFrame, key: str) -> DataFrame:
    """(``key``, n_productos, centroid): the L2-normalised mean of each category."""
    mean = sums.withColumn("_c", F.transform("total", lambda x: x / F.col("n")))
    mean = mean.withColumn("_norm", l2norm(F.col("_c")))
    return mean.select(key, F.col("n").alias("n_productos"), F.when(F.col("_norm") > vectors.NORM_EPS, scale(F.col("_c"), F.col("_norm")))
                       .otherwise(F.col("_c")).alias("centroid"))


def hash_bucket(key_col: str, buckets: int, seed: int) -> Column:
    """A row's batch: a seeded hash of its key, so that it does not depend on the table's size or order."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key_col).cast("string"))), 1, 8), 16, 10).cast("long") % buckets


def converge(spark: SparkSession, items: DataFrame, gold: DataFrame, key_col: str, vec_col: str, cat_id: str, macros: DataFrame,
             macro_id: str, run_id: str | None = None, base_path: str | None = None, buckets: int = 4, refresh_every: int = 2,
             max_iterations: int | None = None, macro_auto: float = 0.90, category_auto: float = 0.75,
             cat_bounds: tuple[float, float] = (0.50, 0.80), seed: int = 42) -> DataFrame:
    """PIP-26: classify the rows that have no category yet, batch by batch, one batch per iteration.

    ``gold`` (key, category, vector) starts the centroids and is left out of the work; ``macros`` (category,
    macro) places categories below macros, and categories without a macro are not chosen. Unlabelled =
    items minus gold minus staged minus queued (anti-joins), one row per key (the smallest vector of a key
    that repeats; null keys are left out). The batch of iteration i is hash bucket i - 1 of ``buckets``: no sort, and no row's
    iteration depends on the size of the table. Auto rows go to staging, the rest to the review queue, a metrics row is written last (SNK-12), the
    category threshold adapts from the auto rate (PIP-25). The centroids are kept as (sum vector, count) per category:
    every iteration writes the sums of its own auto rows, and every ``refresh_every`` iterations they are merged
    into the centroids that the next iterations use, without reading an earlier row again.

    Everything an iteration writes goes to its own partition, and what it reads comes from earlier ones, so
    a run that stopped goes on with the same rows, threshold and centroids. Returns the metrics, read back.
    """
    run_id = run_id or f"run-{uuid.uuid4().hex[:8]}"
    base = base_path or scratch_path(spark, f"loop/{run_id}")
    stg, que, met, sums_at = f"{base}/staging", f"{base}/review_queue", f"{base}/metrics", f"{base}/centroid_sums"
    one = items.where(F.col(key_col).isNotNull()).groupBy(key_col).agg(F.min(vec_col).alias(vec_col))
    one = one.withColumn("_bucket", hash_bucket(key_col, buckets, seed))
    todo = one.join(gold.select(key_col).distinct(), key_col, "left_anti")
    macros = macros.select(F.col(cat_id).cast("long").alias(cat_id), macro_id).distinct()
    parted = {"partitionOverwriteMode": "dynamic"}

    def put(df: DataFrame, path: str) -> None:
        df.write.mode("overwrite").options(**parted).partitionBy("run_id", "iteration").parquet(path)

    def mine(path: str) -> DataFrame | None:
        out = read_if_written(spark, path)
        return None if out is None else out.where(F.col("run_id") == run_id)

    def tagged(df: DataFrame, it: int) -> DataFrame:
        return df.withColumn("run_id", F.lit(run_id)).withColumn("iteration", F.lit(it))

    thr = category_auto
    last = resume_point(spark, met, run_id)
    if last:
        m = mine(met).filter(F.col("iteration") == last).first()
        if m["batch_size"]:
            thr = adapt_threshold(m["auto_assigned"] / m["batch_size"], m["threshold"], *cat_bounds)
    else:
        put(tagged(centroid_sums(gold.select(cat_id, vec_col), cat_id, vec_col), 0), sums_at)
    for it in range(last + 1, buckets + 1):
        if max_iterations is not None and it > max_iterations:
            break
        # iterations up to the last refresh count; iteration 0 is gold
        upto = (it - 1) // refresh_every * refresh_every
        state = merge_sums(mine(sums_at).where(F.col("iteration") <= upto).select(cat_id, "n", "total"), cat_id)
        cat_c = unit_centroids(state, cat_id).join(macros, cat_id)
        macro_c = unit_centroids(merge_sums(state.join(macros, cat_id).select(macro_id, "n", "total"), macro_id), macro_id)
        batch = todo.where(F.col("_bucket") == it - 1).drop("_bucket")
        for path in (stg, que):
            done = mine(path)
            if done is not None:
                # only earlier iterations: a re-run of iteration `it` rebuilds the very same batch
                batch = batch.join(done.filter(F.col("iteration") < it).select(key_col), key_col, "left_anti")
        scored = vectors.classify_hierarchical(batch, [key_col, vec_col], vec_col, macro_c, macro_id, cat_c, cat_id, macro_id,
                                               macro_auto=macro_auto, category_auto=thr)
        scored = shared_table(tagged(scored, it), "scored")   # scored once, read four times
        auto = scored.filter(F.col("decision") == "auto").withColumn(cat_id, F.col("top_categoria"))
        put(auto.select(key_col, cat_id, F.lit("embedding_hierarchical_convergence").alias("metodo"),
                        F.col("similitud").alias("confianza"), "run_id", "iteration"), stg)
        put(scored.filter(F.col("decision") == "review").select(
            key_col, "razon", "top_macro", "similitud_macro", "top_categoria", "similitud",
            F.lit("pendiente").alias("estado"), "run_id", "iteration"), que)
        put(tagged(centroid_sums(auto, cat_id, vec_col), it), sums_at)
        n, n_auto = scored.agg(F.count(F.lit(1)), F.count_if(F.col("decision") == "auto")).first()
        put(spark.createDataFrame([(run_id, it, n, n_auto, n - n_auto, float(thr))],
                                  "run_id string, iteration int, batch_size long, auto_assigned long, review_queue long, threshold double"), met)
        if n:
            thr = adapt_threshold(n_auto / n, thr, *cat_bounds)
    return spark.read.parquet(met).filter(F.col("run_id") == run_id)


def promote(gold: DataFrame, staging: DataFrame, validation: DataFrame, key: str = "id_producto") -> DataFrame:
    """PIP-31: all-or-nothing per run — rows of runs that passed validation are upserted into gold
    (newest iteration wins; pin D22); failed runs stay in staging. Promoting twice = promoting once."""
    ok = validation.filter("passed").select("run_id")
    rows = latest_per_product(staging.join(ok, "run_id", "left_semi"), keys=(key,))
    return mutate.upsert_keep_last(gold, rows.select(*gold.columns), key)
