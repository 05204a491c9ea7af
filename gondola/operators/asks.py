"""Model questions and answers as tables (PIP-23, PIP-24, PIP-51).

The reference called a remote model inside a driver loop; here prompts are a column built from
data (``concat_ws``/``format_string`` over bounded candidate lists) and answers arrive as a table
that is parsed with ``from_json`` and resolved with joins — no remote calls inside Spark tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ANSWER_SCHEMA = "struct<macro:string,categoria:string,confianza:double>"
NONE = "ninguna"


def strip_fences(text: F.Column) -> F.Column:
    """Remove ```json … ``` fences around a model answer."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"^\s*```(json)?", ""), r"```\s*$", ""))


def resolve_answers(answers: DataFrame, macros: DataFrame, categories: DataFrame,
                    min_conf: float = 0.7, min_cat_sim: float = 0.60) -> DataFrame:
    """PIP-23: answers ``(id, tipo ∈ {macro, categoria}, respuesta, cat_sim)`` -> decision + reason.

    Reasons: llm_json_parse_error, llm_macro_low_confidence, llm_macro_not_found,
    llm_macro_ok_but_low_category (category similarity < ``min_cat_sim`` on the macro path),
    llm_category_low_confidence, llm_category_not_found; accepted rows carry the id found.
    The answer of each question is matched by id (pin D28), never by position."""
    parsed = answers.withColumn("_j", F.from_json(strip_fences(F.col("respuesta")), ANSWER_SCHEMA))
    m = F.broadcast(macros.select(F.lower("nombre").alias("_mname"), F.col("id_macro").alias("_mid")))
    c = F.broadcast(categories.select(F.lower("nombre").alias("_cname"), F.col("id_categoria").alias("_cid")))
    x = (parsed.join(m, F.lower(F.col("_j.macro")) == F.col("_mname"), "left")
         .join(c, F.lower(F.col("_j.categoria")) == F.col("_cname"), "left"))
    conf = F.col("_j.confianza")
    is_macro = F.col("tipo") == "macro"
    bad_json = F.col("_j").isNull() | (is_macro & F.col("_j.macro").isNull()) | (
        ~is_macro & F.col("_j.categoria").isNull())
    unsure_m = F.lower(F.col("_j.macro")) == NONE
    unsure_c = F.lower(F.col("_j.categoria")) == NONE
    razon = (F.when(bad_json, "llm_json_parse_error")
             .when(is_macro & (unsure_m | F.coalesce(conf < min_conf, F.lit(True))), "llm_macro_low_confidence")
             .when(is_macro & F.col("_mid").isNull(), "llm_macro_not_found")
             .when(is_macro & F.coalesce(F.col("cat_sim") < min_cat_sim, F.lit(True)), "llm_macro_ok_but_low_category")
             .when(~is_macro & (unsure_c | F.coalesce(conf < min_conf, F.lit(True))), "llm_category_low_confidence")
             .when(~is_macro & F.col("_cid").isNull(), "llm_category_not_found"))
    conf_out = F.when(is_macro, (conf + F.col("cat_sim")) / 2).otherwise(conf)
    return x.select("id", "tipo", F.when(razon.isNull(), "auto").otherwise("review").alias("decision"),
                    razon.alias("razon"), F.col("_mid").cast("long").alias("id_macro"),
                    F.col("_cid").cast("long").alias("id_categoria"),
                    F.when(razon.isNull(), F.round(conf_out, 6)).alias("confianza"))


def build_prompts(rows: DataFrame, id_col: str, text_col: str, cands_col: str) -> DataFrame:
    """PIP-24: one prompt per row from its (bounded) candidate list."""
    listing = F.array_join(F.transform(F.col(cands_col), lambda x: F.concat(F.lit("- "), x)), "\n")
    prompt = F.format_string("Producto: %s\nCandidatas:\n%s\nResponde JSON {\"categoria\": ..., \"confianza\": ...}",
                             F.col(text_col), listing)
    return rows.select(id_col, prompt.alias("prompt"), F.size(cands_col).alias("n_candidatas"))


def suggestion_table(members: DataFrame, cluster_col: str, name_col: str, coherence: DataFrame,
                     samples: int = 5, min_size: int = 10, min_coverage: float = 0.6) -> DataFrame:
    """PIP-51: per cluster — size, first sample names, suggested name (top word) and review flag."""
    w = Window.partitionBy(cluster_col).orderBy(name_col)
    smp = (members.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= samples)
           .groupBy(cluster_col).agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", name_col))),
                                                 lambda s: s[name_col]).alias("sample_products")))
    return (coherence.join(smp, cluster_col)
            .select(cluster_col, F.col("n_docs").alias("cluster_size"), "sample_products",
                    F.col("top_word").alias("suggested_category"), F.col("coverage").alias("confidence"),
                    ((F.col("n_docs") < min_size) | (F.col("coverage") < min_coverage)).alias("review_required")))
