"""Query keys for staging validation, promotion, quality metrics, the convergence loop, the review
queue and model-answer resolution.

Stand-ins (events as staged work): product = part row ``event_id % |part|``, run = ``user_id % 5``,
iteration = day of month, category = ``floor(value) % 9 + 1``, confidence = ``min(value / 100, 1)``.
The review queue takes the same rows with a status from ``event_type`` and is upserted on the
product (newest event wins).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gondola import schemas as S
from gondola.operators import asks, loop, quality, review
from gondola.operators import vectors as V
from gondola.operators.ngrams import cluster_coherence
from gondola.plans import vectors_q
from gondola.plans.catalog_q import CATEGORIES_SQL, MACROS_SQL, _seed_mapping, keyword_seed_sql
from gondola.plans.registry import REGISTRY, register
from gondola.plans.sql_standins import CATALOG_PRODUCTS, with_
from gondola import seeds
from gondola.sources import standins

N_RUNS = 5
GATE_MIN_ACCURACY = 65.0
SPOT_RULES = [(["%gear%"], "gears"), (["%bolt%"], "bolts"), (["%ring%"], "rings")]
MISMATCH_RULES = [("gear|cog", ["rings", "bolts"]), ("ring", ["gears", "anvils"]),
                  ("bolt|rod", ["gizmos", "plates"]), ("widget", ["anvils", "otros"])]
CATCH_ALL_ID = 9
BANDS = [0.1, 0.2, 0.3, 0.5]
NEAR = (0.25, 0.30)


def _q(s):
    return "'" + s.replace("'", "''") + "'"


# ---------------------------------------------------------------------------------------------
# Stand-ins (Spark)

def _event_products(t):
    n = t.part.select(F.count(F.lit(1))).scalar()
    e = t.events.withColumn("_pk", F.col("event_id") % n)
    p = t.part.select("p_partkey", "p_name")
    return e.join(p, e["_pk"] == p["p_partkey"])


def _staged(t):
    return _event_products(t).select(
        standins.barcode_of(F.col("p_partkey")).alias("id_producto"),
        (F.floor("value") % 9 + 1).cast("long").alias("id_categoria"),
        F.lit(None).cast("long").alias("id_subcategoria"),
        F.lit("embedding_hierarchical_convergence").alias("metodo"),
        F.least(F.col("value") / 100.0, F.lit(1.0)).alias("confianza"),
        F.concat(F.lit("run_"), (F.col("user_id") % N_RUNS).cast("string")).alias("run_id"),
        F.dayofmonth("ts").cast("int").alias("iteration"))


def _queue(t):
    cats = F.broadcast(S.categories_df(t.spark).select("id_categoria", F.col("nombre").alias("_cn"), "id_macro"))
    ev = _event_products(t).withColumn("_cid", (F.floor("value") % 9 + 1).cast("long"))
    rows = ev.join(cats, ev["_cid"] == cats["id_categoria"]).select(
        standins.barcode_of(F.col("p_partkey")).alias("id_producto"), F.col("p_name").alias("producto"),
        F.col("_cn").alias("top_categoria"),
        F.when(F.col("event_type") == "signup", F.concat(F.lit("nuevo "), F.split("p_name", " ")[1]))
        .otherwise(F.col("_cn")).alias("llm_sugerencia"),
        F.least(F.col("value") / 100.0, F.lit(1.0)).alias("similitud"), F.col("id_macro").alias("top_macro"),
        (F.col("event_type") == "signup").alias("es_categoria_nueva"),
        F.when(F.col("event_type") == "purchase", review.APPROVED).when(F.col("event_type") == "error", review.REJECTED)
        .otherwise(review.PENDING).alias("estado"),
        F.when(F.col("value") < 10, "low_macro_similarity").when(F.col("value") < 40, "low_category_similarity")
        .otherwise("no_categories_in_macro").alias("razon"),
        F.col("ts").alias("fecha_creacion"), "event_id")
    return review.upsert_queue(rows, order=[F.col("fecha_creacion").desc(), F.col("event_id").desc()])


def _products(t):
    return standins.catalog_products(t.part)


# ---------------------------------------------------------------------------------------------
# Stand-ins (SQL)

STAGED_SQL = f"""
ev AS (SELECT e.*, p.p_partkey, p.p_name FROM events e
       JOIN part p ON e.event_id % (SELECT count(*) FROM part) = p.p_partkey),
staged AS (SELECT '779' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS id_producto,
                  CAST(floor(value) AS BIGINT) % 9 + 1 AS id_categoria, CAST(NULL AS BIGINT) AS id_subcategoria,
                  'embedding_hierarchical_convergence' AS metodo, least(value / 100.0, 1.0) AS confianza,
                  'run_' || CAST(user_id % {N_RUNS} AS VARCHAR) AS run_id, CAST(day(ts) AS INTEGER) AS iteration
           FROM ev),
lt AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY run_id, id_producto
                                   ORDER BY iteration DESC, confianza DESC, id_categoria ASC) AS rn FROM staged)
       WHERE rn = 1)"""

QUEUE_SQL = """
qraw AS (SELECT '779' || lpad(CAST(ev.p_partkey AS VARCHAR), 10, '0') AS id_producto, ev.p_name AS producto,
                c.nombre AS top_categoria,
                CASE WHEN ev.event_type = 'signup' THEN 'nuevo ' || split_part(ev.p_name, ' ', 2) ELSE c.nombre END
                  AS llm_sugerencia,
                least(ev.value / 100.0, 1.0) AS similitud, c.id_macro AS top_macro,
                ev.event_type = 'signup' AS es_categoria_nueva,
                CASE ev.event_type WHEN 'purchase' THEN 'aprobado' WHEN 'error' THEN 'rechazado' ELSE 'pendiente' END
                  AS estado,
                CASE WHEN ev.value < 10 THEN 'low_macro_similarity' WHEN ev.value < 40 THEN 'low_category_similarity'
                     ELSE 'no_categories_in_macro' END AS razon,
                ev.ts AS fecha_creacion, ev.event_id
         FROM ev JOIN categories c ON CAST(floor(ev.value) AS BIGINT) % 9 + 1 = c.id_categoria),
queue AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id_producto
                                      ORDER BY fecha_creacion DESC, event_id DESC) AS rn FROM qraw) WHERE rn = 1)"""


def _err_sql(n="n", cat="cat"):
    parts = [f"starts_with({cat}, '_OLD_')"]
    for likes, expected in SPOT_RULES:
        hit = " OR ".join(f"{n} LIKE {_q(p)}" for p in likes)
        parts.append(f"(({hit}) AND {cat} <> {_q(expected)})")
    return "coalesce(" + " OR ".join(parts) + ", false)"


VALIDATE_SQL = f"""
vrows AS (SELECT lt.run_id, lt.id_producto, lower(cp.producto) AS n, c.nombre AS cat
          FROM lt JOIN catalog_products cp ON lt.id_producto = cp.id_producto
          JOIN categories c ON lt.id_categoria = c.id_categoria),
vg AS (SELECT run_id, count(DISTINCT id_producto) AS total,
              count(DISTINCT CASE WHEN {_err_sql()} THEN id_producto END) AS errors FROM vrows GROUP BY run_id),
validation AS (SELECT run_id, total, errors,
                      round(CAST(total - errors AS DOUBLE) * 1000.0 / CAST(total AS DOUBLE)) / 10.0 AS accuracy_pct
               FROM vg)"""

BASE = with_(CATALOG_PRODUCTS, CATEGORIES_SQL, MACROS_SQL, STAGED_SQL)


def _validation(t):
    return quality.validate_staging(_staged(t), _products(t), S.categories_df(t.spark), SPOT_RULES,
                                    GATE_MIN_ACCURACY)


@register("validate_gate", with_(CATALOG_PRODUCTS, CATEGORIES_SQL, STAGED_SQL, VALIDATE_SQL) + f"""
SELECT run_id, total, errors, accuracy_pct, accuracy_pct >= {GATE_MIN_ACCURACY} AS passed FROM validation""",
          ids="PIP-28 PIP-31 AGG-6 AGG-2")
def validate_gate(t):
    return _validation(t)


@register("promote_upsert", with_(CATALOG_PRODUCTS, CATEGORIES_SQL, STAGED_SQL, VALIDATE_SQL, keyword_seed_sql(), f"""
ok AS (SELECT run_id FROM validation WHERE accuracy_pct >= {GATE_MIN_ACCURACY})""", """
prom AS (SELECT id_producto, id_categoria, id_subcategoria, metodo, confianza FROM (
           SELECT *, row_number() OVER (PARTITION BY id_producto ORDER BY iteration DESC, confianza DESC,
                                        id_categoria ASC) AS rn
           FROM staged WHERE run_id IN (SELECT run_id FROM ok)) WHERE rn = 1)""") + """
SELECT * FROM prom
UNION ALL
SELECT * FROM mapping WHERE id_producto NOT IN (SELECT id_producto FROM prom)""", ids="PIP-31 DML-12 SNK-4")
def promote_upsert(t):
    return loop.promote(_seed_mapping(t), _staged(t), _validation(t))


@register("resume_run", with_(CATALOG_PRODUCTS, STAGED_SQL, keyword_seed_sql(), """
per AS (SELECT run_id, max(iteration) AS max_iteration, count(*) AS staged,
               count(*) FILTER (WHERE id_producto NOT IN (SELECT id_producto FROM mapping WHERE id_categoria IS NOT NULL))
                 AS pending
        FROM staged GROUP BY run_id)""") + """
SELECT *, coalesce(run_id = (SELECT max(run_id) FROM per WHERE pending > 0), false) AS is_resume_target FROM per""",
          ids="PIP-27 SRC-10 JN-5 AGG-10")
def resume_run(t):
    st = _staged(t)
    cls = _seed_mapping(t).filter(F.col("id_categoria").isNotNull()).select("id_producto", F.lit(True).alias("_c"))
    per = (st.join(cls, "id_producto", "left").groupBy("run_id")
           .agg(F.max("iteration").alias("max_iteration"), F.count(F.lit(1)).alias("staged"),
                F.count_if(F.col("_c").isNull()).alias("pending")))
    target = per.filter("pending > 0").select(F.max("run_id")).scalar()
    return per.withColumn("is_resume_target", F.coalesce(F.col("run_id") == target, F.lit(False)))


def _mis_sql():
    parts = []
    for regex, forb in MISMATCH_RULES:
        parts.append(f"(regexp_matches(n, {_q(regex)}) AND categoria IN ({', '.join(_q(f) for f in forb)}))")
    return " OR ".join(parts)


@register("semantic_mismatch", BASE + f"""
, rows AS (SELECT lt.id_producto, lower(cp.producto) AS n, c.nombre AS categoria
          FROM lt JOIN catalog_products cp ON lt.id_producto = cp.id_producto
          JOIN categories c ON lt.id_categoria = c.id_categoria)
SELECT categoria, total_products, mismatch_count, round(mismatch_count / total_products, 6) AS error_rate FROM (
  SELECT categoria, count(DISTINCT id_producto) AS total_products,
         count(DISTINCT CASE WHEN {_mis_sql()} THEN id_producto END) AS mismatch_count
  FROM rows GROUP BY categoria) WHERE mismatch_count > 0""", ids="PIP-29 AGG-6 AGG-7 PRJ-8")
def semantic_mismatch(t):
    return quality.semantic_mismatches(quality.latest_per_product(_staged(t)), _products(t),
                                       S.categories_df(t.spark), MISMATCH_RULES)


@register("category_quality", BASE + """
, tot AS (SELECT count(DISTINCT id_producto) AS total FROM lt),
g AS (SELECT c.nombre, count(DISTINCT lt.id_producto) AS n, avg(confianza) AS avg_conf, stddev(confianza) AS std_conf,
             min(confianza) AS min_conf, max(confianza) AS max_conf, quantile_cont(confianza, 0.10) AS p10_conf,
             quantile_cont(confianza, 0.90) AS p90_conf
      FROM lt JOIN categories c ON lt.id_categoria = c.id_categoria GROUP BY c.nombre),
top AS (SELECT * FROM g ORDER BY n DESC, nombre ASC LIMIT 10)
SELECT nombre, n, round(avg_conf, 6) AS avg_conf, round(std_conf, 6) AS std_conf, round(min_conf, 6) AS min_conf,
       round(max_conf, 6) AS max_conf, round(p10_conf, 6) AS p10_conf, round(p90_conf, 6) AS p90_conf,
       round(n * 100.0 / (SELECT total FROM tot), 6) AS pct, coalesce(std_conf < 0.03, false) AS high_risk,
       n * 100.0 / (SELECT total FROM tot) > 15.0 AS dominant
FROM top""", ids="PIP-30 AGG-3 AGG-4 ORD-2")
def category_quality(t):
    return quality.category_quality(quality.latest_per_product(_staged(t)), S.categories_df(t.spark), 10)


@register("category_entropy", BASE + """
, per AS (SELECT id_categoria, count(DISTINCT id_producto) AS c FROM lt GROUP BY id_categoria)
SELECT round(-sum((c / s) * log2(c / s)), 6) AS entropy_bits, CAST(sum(c) AS BIGINT) AS total, max(c) AS top_count,
       round(max(c) * 100.0 / sum(c), 6) AS top_pct, count(*) AS categories
FROM (SELECT c, sum(c) OVER () AS s FROM per)""", ids="AGG-18 AGG-16")
def category_entropy(t):
    return quality.category_entropy(quality.latest_per_product(_staged(t)))


@register("unclassified_tracking", BASE + f"""
, g AS (SELECT run_id, iteration, count(DISTINCT id_producto) AS classified,
              count(DISTINCT CASE WHEN id_categoria = {CATCH_ALL_ID} THEN id_producto END) AS catch_all
       FROM staged GROUP BY run_id, iteration)
SELECT run_id, iteration, classified, catch_all, round((classified - catch_all) / classified, 6) AS escape_rate,
       classified - lag(classified) OVER (PARTITION BY run_id ORDER BY iteration) AS delta_classified,
       catch_all - lag(catch_all) OVER (PARTITION BY run_id ORDER BY iteration) AS delta_catch_all
FROM g""", ids="PIP-55 WIN-9 AGG-2")
def unclassified_tracking(t):
    return quality.unclassified_tracking(_staged(t), CATCH_ALL_ID)


#: Every fifth vector is gold; four batches, centroids refreshed after every second one.
LOOP_GOLD, LOOP_BUCKETS, LOOP_REFRESH, LOOP_BOUNDS, LOOP_SEED = 5, 4, 2, (0.10, 0.35), 42


def _convergence_sql() -> str:
    """The loop unrolled: one block of CTEs per iteration, centroids merged from the sums so far."""
    lo, hi = LOOP_BOUNDS
    ctes = [f"""
e AS (SELECT vec_id, label, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) + 1e-10 AS vn,
        CAST('0x' || substr(md5('{LOOP_SEED}:' || vec_id), 1, 8) AS BIGINT) % {LOOP_BUCKETS} AS bucket
      FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)),
r0 AS (SELECT label AS id, v FROM e WHERE vec_id % {LOOP_GOLD} = 0),
t1 AS (SELECT CAST({vectors_q.HIER_CAT} AS DOUBLE) AS thr)"""]

    def unit(x):
        return (f"SELECT id, n, CASE WHEN norm > 1e-10 THEN list_transform(c, lambda x: x / norm) ELSE c END AS centroid FROM (SELECT *, "
                f"sqrt(list_sum(list_transform(c, lambda x: x * x))) AS norm FROM (SELECT id, any_value(n) AS n, list(t / n ORDER BY i) AS c FROM {x} GROUP BY id))")

    def best(name, source):
        return f"{name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, id ASC) AS rn FROM ({source})) WHERE rn = 1)"

    for it in range(1, LOOP_BUCKETS + 1):
        k = (it - 1) // LOOP_REFRESH * LOOP_REFRESH
        if k == it - 1:
            rows = " UNION ALL ".join(f"SELECT id, v FROM r{j}" for j in range(k + 1))
            ctes.append(f"""
g{k} AS MATERIALIZED (SELECT id, i, sum(x) AS t, count(*) AS n FROM (SELECT id, unnest(generate_series(1, len(v))) AS i, unnest(v) AS x FROM ({rows})) GROUP BY id, i),
m{k} AS (SELECT id % 3 AS id, i, sum(t) AS t, sum(n) AS n FROM g{k} GROUP BY id % 3, i),
cat{k} AS MATERIALIZED ({unit(f"g{k}")}),
mac{k} AS MATERIALIZED ({unit(f"m{k}")})""")
        ctes.append(best(f"""
mb{it}""", f"SELECT e.vec_id, e.v, e.vn, m.id, list_dot_product(e.v, m.centroid) / e.vn AS score FROM e CROSS JOIN mac{k} m "
                   f"WHERE e.vec_id % {LOOP_GOLD} <> 0 AND e.bucket = {it - 1}"))
        ctes.append(best(f"""
cb{it}""", f"SELECT b.vec_id, b.v, b.score AS msim, c.id, list_dot_product(b.v, c.centroid) / b.vn AS score FROM mb{it} b JOIN cat{k} c ON c.id % 3 = b.id"))
        ctes.append(f"""
r{it} AS MATERIALIZED (SELECT id, v FROM cb{it} WHERE msim >= {vectors_q.HIER_MACRO} AND score >= (SELECT thr FROM t{it})),
x{it} AS MATERIALIZED (SELECT {it} AS iteration, (SELECT count(*) FROM mb{it}) AS n, (SELECT count(*) FROM r{it}) AS n_auto, thr FROM t{it}),
t{it + 1} AS (SELECT CASE WHEN n = 0 THEN thr ELSE round(least({hi}, greatest({lo}, CASE WHEN n_auto / n < 0.40 THEN thr - 0.05
         WHEN n_auto / n > 0.60 THEN thr + 0.05 ELSE thr END)), 6)::DOUBLE END AS thr FROM x{it})""")
    rows = " UNION ALL ".join(f"SELECT * FROM x{it}" for it in range(1, LOOP_BUCKETS + 1))
    return "WITH" + ",".join(ctes) + f"""
SELECT CAST(iteration AS INTEGER) AS iteration, n AS batch_size, n_auto AS auto_assigned, n - n_auto AS review_queue, CAST(thr AS DOUBLE) AS threshold FROM ({rows})"""


@register("convergence_metrics", _convergence_sql(), ids="PIP-26 PIP-25 SNK-12 SNK-3 JN-5")
def convergence_metrics(t):
    """The loop over ``embeddings``; what it writes lies under spark.checkpoint.dir."""
    emb = t.embeddings.select("vec_id", "embedding", F.col("label").alias("id_categoria"))
    macros = emb.select("id_categoria", (F.col("id_categoria") % 3).alias("id_macro"))
    m = loop.converge(t.spark, emb.select("vec_id", "embedding"), emb.where(F.col("vec_id") % LOOP_GOLD == 0), "vec_id", "embedding", "id_categoria",
                      macros, "id_macro", buckets=LOOP_BUCKETS, refresh_every=LOOP_REFRESH, macro_auto=vectors_q.HIER_MACRO,
                      category_auto=vectors_q.HIER_CAT, cat_bounds=LOOP_BOUNDS, seed=LOOP_SEED)
    return m.select("iteration", "batch_size", "auto_assigned", "review_queue", "threshold")


# ---------------------------------------------------------------------------------------------
# Review queue

QBASE = with_(CATALOG_PRODUCTS, CATEGORIES_SQL, STAGED_SQL, QUEUE_SQL)


@register("review_inspect", QBASE + """
SELECT llm_sugerencia, es_categoria_nueva, count(*) AS n, list(producto ORDER BY producto, id_producto)[1:5] AS ejemplos
FROM queue WHERE estado = 'pendiente' GROUP BY llm_sugerencia, es_categoria_nueva""", ids="PIP-32 AGG-12")
def review_inspect(t):
    return review.inspect(_queue(t), 5)


APPROVE_SUGGESTION, APPROVE_CATEGORY, REJECT_SUGGESTION = "gears", 4, "otros"


@register("review_approve", QBASE + f"""
SELECT id_producto, llm_sugerencia,
       CASE WHEN estado = 'pendiente' AND llm_sugerencia = '{APPROVE_SUGGESTION}' THEN 'aprobado'
            WHEN estado = 'pendiente' AND llm_sugerencia = '{REJECT_SUGGESTION}' THEN 'rechazado'
            ELSE estado END AS estado
FROM queue""", ids="PIP-33 DML-11 JN-7 SNK-3")
def review_approve(t):
    q = _queue(t)
    q2, _ = review.approve(q, _seed_mapping(t), review.pending_ids(q, APPROVE_SUGGESTION), APPROVE_CATEGORY)
    q3 = review.set_status(q2, review.pending_ids(q, REJECT_SUGGESTION), review.REJECTED)
    return q3.select("id_producto", "llm_sugerencia", "estado")


@register("review_new_categories", QBASE + """
, names AS (SELECT DISTINCT llm_sugerencia AS nombre FROM queue WHERE es_categoria_nueva AND llm_sugerencia IS NOT NULL
           AND llm_sugerencia NOT IN (SELECT nombre FROM categories))
SELECT CAST((SELECT max(id_categoria) FROM categories) + row_number() OVER (ORDER BY nombre) AS BIGINT) AS id_categoria,
       nombre, 1 AS nivel FROM names""", ids="PIP-33 DML-9 JN-5")
def review_new_categories(t):
    return review.new_categories(_queue(t), S.categories_df(t.spark))


@register("review_progress", QBASE + """
SELECT estado, n, sugerencias, round(n * 100.0 / sum(n) OVER (), 6) AS pct FROM (
  SELECT estado, count(*) AS n, count(DISTINCT llm_sugerencia) AS sugerencias FROM queue GROUP BY estado)""",
          ids="PIP-34 AGG-13 AGG-2")
def review_progress(t):
    return review.progress(_queue(t))


def _band_sql():
    cases = []
    for lo, hi in zip(BANDS, BANDS[1:] + [None]):
        if hi is None:
            cases.append(f"WHEN similitud >= {lo} THEN '>={lo}'")
        else:
            cases.append(f"WHEN similitud >= {lo} AND similitud < {hi} THEN '{lo}-{hi}'")
    return "CASE " + " ".join(cases) + f" ELSE '<{BANDS[0]}' END"


@register("review_diagnostics", QBASE + f"""
SELECT 'razon' AS dimension, razon AS bucket, count(*) AS n FROM queue GROUP BY razon
UNION ALL SELECT 'banda', {_band_sql()}, count(*) FROM queue GROUP BY 2
UNION ALL SELECT 'macro', CAST(top_macro AS VARCHAR), count(*) FROM queue GROUP BY 2
UNION ALL SELECT 'near_miss', top_categoria, count(*) FROM queue WHERE similitud BETWEEN {NEAR[0]} AND {NEAR[1]}
          GROUP BY 2""", ids="PIP-35 AGG-20 AGG-24 SET-1")
def review_diagnostics(t):
    return review.diagnostics(_queue(t), BANDS, NEAR)


# ---------------------------------------------------------------------------------------------
# Model answers, prompts, suggestions

def _answers(t):
    k = F.get_json_object("props", "$.k").cast("long") % 100
    conf_txt = F.concat(F.lit("0."), F.lpad(k.cast("string"), 2, "0"))
    macro_name = (F.when(k % 4 == 0, "ninguna").when(k % 4 == 1, "hardware").when(k % 4 == 2, "machinery")
                  .otherwise("misc"))
    cat_arr = F.array(F.lit("ninguna"), *[F.lit(n) for _, n, lv, _, _ in S.CATEGORY_ROWS[:9]])
    cat_name = F.element_at(cat_arr, (k % 10 + 1).cast("int"))
    macro_json = F.concat(F.lit('{"macro": "'), macro_name, F.lit('", "confianza": '), conf_txt, F.lit("}"))
    cat_json = F.concat(F.lit('{"categoria": "'), cat_name, F.lit('", "confianza": '), conf_txt, F.lit("}"))
    txt = (F.when(F.col("event_type") == "error", F.lit("respuesta no valida"))
           .when(F.col("event_type") == "view", macro_json)
           .when(F.col("event_type") == "signup", F.concat(F.lit("```json\n"), macro_json, F.lit("\n```")))
           .when(F.col("event_type") == "click", cat_json)
           .otherwise(F.lit('{"categoria": "desconocida", "confianza": 0.90}')))
    tipo = F.when(F.col("event_type").isin("view", "signup"), "macro").otherwise("categoria")
    return t.events.select(F.col("event_id").alias("id"), tipo.alias("tipo"), txt.alias("respuesta"),
                           (F.col("value") / 100.0).alias("cat_sim"))


_CAT_NAMES_SQL = "['ninguna', " + ", ".join(_q(n) for _, n, _, _, _ in S.CATEGORY_ROWS[:9]) + "]"


@register("resolve_answers", with_(CATEGORIES_SQL, MACROS_SQL, f"""
a0 AS (SELECT event_id AS id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) % 100 AS k,
              value / 100.0 AS cat_sim FROM events)""", f"""
a1 AS (SELECT id, cat_sim, CASE WHEN event_type IN ('view', 'signup') THEN 'macro' ELSE 'categoria' END AS tipo,
              '0.' || lpad(CAST(k AS VARCHAR), 2, '0') AS conf_txt,
              CASE k % 4 WHEN 0 THEN 'ninguna' WHEN 1 THEN 'hardware' WHEN 2 THEN 'machinery' ELSE 'misc' END AS mname,
              {_CAT_NAMES_SQL}[k % 10 + 1] AS cname, event_type FROM a0)""", """
a2 AS (SELECT id, tipo, cat_sim,
              CASE WHEN event_type = 'error' THEN 'respuesta no valida'
                   WHEN event_type IN ('view', 'signup') THEN '{"macro": "' || mname || '", "confianza": ' || conf_txt || '}'
                   WHEN event_type = 'click' THEN '{"categoria": "' || cname || '", "confianza": ' || conf_txt || '}'
                   ELSE '{"categoria": "desconocida", "confianza": 0.90}' END AS txt FROM a1)""", """
a3 AS (SELECT *, CASE WHEN json_valid(txt) THEN json_extract_string(txt, '$.macro') END AS jm,
              CASE WHEN json_valid(txt) THEN json_extract_string(txt, '$.categoria') END AS jc,
              CASE WHEN json_valid(txt) THEN CAST(json_extract_string(txt, '$.confianza') AS DOUBLE) END AS conf
       FROM a2)""", """
a4 AS (SELECT a3.*, m.id_macro AS mid, c.id_categoria AS cid FROM a3
       LEFT JOIN macros m ON lower(a3.jm) = lower(m.nombre) LEFT JOIN categories c ON lower(a3.jc) = lower(c.nombre))""",
          """
a5 AS (SELECT *, CASE
         WHEN (tipo = 'macro' AND jm IS NULL) OR (tipo <> 'macro' AND jc IS NULL) THEN 'llm_json_parse_error'
         WHEN tipo = 'macro' AND (lower(jm) = 'ninguna' OR coalesce(conf < 0.7, true)) THEN 'llm_macro_low_confidence'
         WHEN tipo = 'macro' AND mid IS NULL THEN 'llm_macro_not_found'
         WHEN tipo = 'macro' AND coalesce(cat_sim < 0.6, true) THEN 'llm_macro_ok_but_low_category'
         WHEN tipo <> 'macro' AND (lower(jc) = 'ninguna' OR coalesce(conf < 0.7, true)) THEN 'llm_category_low_confidence'
         WHEN tipo <> 'macro' AND cid IS NULL THEN 'llm_category_not_found' END AS razon FROM a4)""") + """
SELECT id, tipo, CASE WHEN razon IS NULL THEN 'auto' ELSE 'review' END AS decision, razon,
       CAST(mid AS BIGINT) AS id_macro, CAST(cid AS BIGINT) AS id_categoria,
       CASE WHEN razon IS NULL THEN round(CASE WHEN tipo = 'macro' THEN (conf + cat_sim) / 2 ELSE conf END, 6) END
         AS confianza
FROM a5""", ids="PIP-23 SCA-24 JN-14")
def resolve_answers(t):
    # json strings written with a literal newline inside the fence: strip_fences handles both
    ans = _answers(t)
    return asks.resolve_answers(ans, S.macros_df(t.spark), S.categories_df(t.spark))


def _prompts_sql():
    tp = REGISTRY["classify_three_path"].sql
    nl = "chr(10)"
    fmt = (f"'Producto: %s' || {nl} || 'Candidatas:' || {nl} || '%s' || {nl} || "
           "'Responde JSON {\"categoria\": ..., \"confianza\": ...}'")
    return f"WITH tp AS ({tp})\n" + f"""
SELECT vec_id, printf({fmt}, 'vector ' || CAST(vec_id AS VARCHAR),
                      array_to_string(list_transform(candidates, lambda x: '- categoria_' || CAST(x AS VARCHAR)), {nl}))
         AS prompt, CAST(len(candidates) AS INTEGER) AS n_candidatas
FROM tp WHERE path = 'ask_category'"""


@register("build_prompts", _prompts_sql(), ids="PIP-24")
def build_prompts(t):
    tp = V.classify_three_path(t.embeddings.select("vec_id", "embedding", "label"), ["vec_id"], "embedding",
                               vectors_q._macro_centroids(t), "id_macro", vectors_q._cat_centroids(t), "id_categoria",
                               "id_macro", vectors_q.TP_MIN, vectors_q.TP_MAX, vectors_q.TP_CAT)
    rows = (tp.filter(F.col("path") == "ask_category")
            .select("vec_id", F.concat(F.lit("vector "), F.col("vec_id").cast("string")).alias("producto"),
                    F.transform("candidates", lambda x: F.concat(F.lit("categoria_"), x.cast("string"))).alias("c")))
    return asks.build_prompts(rows, "vec_id", "producto", "c")


def _suggest_sql():
    coh = REGISTRY["cluster_coherence"].sql
    return f"WITH coh AS ({coh}),\n" + """
smp AS (SELECT source, list(doc_id ORDER BY doc_id)[1:5] AS sample_products FROM documents GROUP BY source)
SELECT coh.source, coh.n_docs AS cluster_size, smp.sample_products, coh.top_word AS suggested_category,
       coh.coverage AS confidence, (coh.n_docs < 10 OR coh.coverage < 0.6) AS review_required
FROM coh JOIN smp ON coh.source = smp.source"""


@register("suggestion_table", _suggest_sql(), ids="PIP-51 AGG-12")
def suggestion_table(t):
    d = t.documents
    coh = cluster_coherence(d, "source", "text", seeds.COHERENCE_STOPWORDS, 0.60, 5)
    return asks.suggestion_table(d, "source", "doc_id", coh, samples=5, min_size=10, min_coverage=0.6)

