"""Query keys for written tables: versions that become current by one switch, and run tables that are
written idempotently, evolve their columns and take inserts by column list. What they write lies below
``spark.checkpoint.dir``."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gondola.operators import review
from gondola.operators import silver as silver_ops
from gondola.plans import loop_q, silver_q
from gondola.plans.catalog_q import CATEGORIES_SQL, _seed_mapping, keyword_seed_sql
from gondola.plans.registry import register
from gondola.plans.sql_standins import CATALOG_PRODUCTS, with_
from gondola.session import scratch_path
from gondola.sources import sinks


@register("silver_versioned", silver_q.SILVER_SQL, ids="SNK-2 SNK-8 SNK-9 PIP-1")
def silver_versioned(t):
    """Silver recomputed twice, and a third version that is written but never switched to."""
    spark = t.spark
    name = uuid.uuid4().hex[:8]
    base, view = scratch_path(spark, f"silver_versioned/{name}"), f"silver_current_{name}"
    products, stores, chains = silver_q._bronze(t)

    def silver(feed):
        return silver_ops.silver_prices(feed, stores, chains, silver_q._AREAS, silver_q._LOCS)

    sinks.publish(silver(products.where("week_date < '1995-01-01'")), base, view)   # what had arrived by then
    sinks.publish(silver(products), base, view)
    sinks.write_version(spark.table(view).limit(0), base, 3)                        # a recompute that stopped before its switch
    return spark.table(view)


@register("table_writes", loop_q.BASE + """
SELECT id_producto, CASE WHEN run_id <> 'run_2' THEN id_categoria END AS id_categoria, CASE WHEN run_id <> 'run_2' THEN confianza END AS confianza,
       CASE WHEN run_id = 'run_1' THEN 'iter ' || iteration END AS nota, run_id
FROM staged WHERE run_id IN ('run_0', 'run_1', 'run_2')""", ids="SNK-1 SNK-3 SNK-4 SNK-5")
def table_writes(t):
    """Run 0; run 1 with a new column, cut short and retried; run 2 by column list. Written twice: the same table."""
    spark = t.spark
    name = f"staging_runs_{uuid.uuid4().hex[:8]}"
    path = scratch_path(spark, name)
    rows = loop_q._staged(t).select("id_producto", "id_categoria", "confianza", F.concat(F.lit("iter "), F.col("iteration").cast("string")).alias("nota"), "run_id")
    zero, one, two = (rows.where(F.col("run_id") == f"run_{i}") for i in range(3))
    for _ in range(2):
        sinks.append_run(zero.drop("nota"), name, "run_id", "run_0", path)
        sinks.append_run(one.limit(10), name, "run_id", "run_1")
        sinks.append_run(one, name, "run_id", "run_1")
        sinks.append_run(two.limit(0), name, "run_id", "run_2")   # a plain INSERT adds; an empty run comes first
        sinks.insert_columns(two.select("id_producto", "run_id"), name)
    return spark.table(name).select("id_producto", "id_categoria", "confianza", "nota", "run_id")


@register("review_mapping", with_(CATALOG_PRODUCTS, CATEGORIES_SQL, loop_q.STAGED_SQL, loop_q.QUEUE_SQL, keyword_seed_sql(), f"""
ok AS (SELECT DISTINCT id_producto FROM queue WHERE estado = 'pendiente' AND llm_sugerencia = '{loop_q.APPROVE_SUGGESTION}')""") + f"""
SELECT id_producto, id_categoria, metodo FROM mapping WHERE id_producto NOT IN (SELECT id_producto FROM ok)
UNION ALL SELECT id_producto, CAST({loop_q.APPROVE_CATEGORY} AS BIGINT), 'revision_manual' FROM ok""", ids="PIP-33 DML-12")
def review_mapping(t):
    """The mapping after approval: approved products have the category that the review chose."""
    q = loop_q._queue(t)
    _, mapping = review.approve(q, _seed_mapping(t), review.pending_ids(q, loop_q.APPROVE_SUGGESTION), loop_q.APPROVE_CATEGORY)
    return mapping.select("id_producto", F.col("id_categoria").cast("long").alias("id_categoria"), "metodo")
