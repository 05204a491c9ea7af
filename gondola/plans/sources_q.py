"""Query keys for semi-structured sources: JSON answers, VARIANT documents, HTML links, parse status,
e-mail shape."""

from __future__ import annotations

from pyspark.sql import functions as F

from gondola.operators import receipts
from gondola.sources import formats
from gondola.sources.standins import barcode_of, catalog_prices, unit_cents
from gondola.plans.registry import register


@register("json_items", """
SELECT event_id, user_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, value FROM events""",
          ids="SCA-24 SRC-9")
def json_items(t):
    e = formats.json_fields(t.events, "props", "struct<k:bigint>")
    return e.select("event_id", "user_id", "event_type", F.col("_j.k").alias("k"), "value")


def _receipt_answers(t):
    """One model-style JSON answer per order, built from orders ⋈ lineitem ⋈ part (bounded: the
    lines of one order)."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount")
    p = t.part.select("p_partkey", "p_name")
    item = F.struct(
        F.col("l_linenumber").alias("_ord"), F.col("p_name").alias("producto"), F.col("l_quantity").alias("cantidad"),
        F.lit("un").alias("unidad"), (unit_cents() / 100.0).alias("precio_unitario"),
        F.col("l_extendedprice").alias("precio_final"),
        (F.round(F.col("l_extendedprice") * F.col("l_discount") * 100) / 100.0).alias("descuento"),
        barcode_of(F.col("l_partkey")).alias("barcode"))
    lines = li.join(p, li.l_partkey == p.p_partkey).join(o, li.l_orderkey == o.o_orderkey)
    return (lines.groupBy("o_orderkey", "o_custkey", "o_orderdate")
            .agg(F.array_sort(F.collect_list(item)).alias("productos"))
            .select(F.col("o_orderkey").alias("ticket_id"), F.to_json(F.struct(
                F.date_format("o_orderdate", "yyyy-MM-dd").alias("fecha"),
                F.concat(F.lit("cadena "), (F.col("o_custkey") % 5).cast("string")).alias("comercio"),
                "productos")).alias("answer")))


@register("receipt_json_items", """
SELECT o.o_orderkey AS ticket_id, strftime(o.o_orderdate, '%Y-%m-%d') AS fecha,
       'cadena ' || CAST(o.o_custkey % 5 AS VARCHAR) AS comercio,
       CAST(row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, p.p_name, l.l_quantity,
         CAST(round(l.l_extendedprice * 100) AS BIGINT) // CAST(l.l_quantity AS BIGINT), l.l_extendedprice,
         round(l.l_extendedprice * l.l_discount * 100), l.l_partkey) - 1 AS INTEGER) AS item_pos,
       p.p_name AS producto, l.l_quantity AS cantidad, 'un' AS unidad,
       (CAST(round(l.l_extendedprice * 100) AS BIGINT) // CAST(l.l_quantity AS BIGINT)) / 100.0 AS precio_unitario,
       l.l_extendedprice AS precio_final, round(l.l_extendedprice * l.l_discount * 100) / 100.0 AS descuento,
       '779' || lpad(CAST(l.l_partkey AS VARCHAR), 10, '0') AS barcode
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON l.l_orderkey = o.o_orderkey""",
          ids="PIP-37 SCA-24 SRC-9 SCA-23")
def receipt_json_items(t):
    return formats.receipt_items_from_json(_receipt_answers(t), "ticket_id", "answer")


@register("purchases_parsed", """
WITH x AS (SELECT o.o_orderkey, o.o_orderdate, o.o_custkey, l.*, p.p_name,
                  CAST(l.l_extendedprice AS DECIMAL(12,2)) AS paid,
                  CAST(round(l.l_extendedprice * l.l_discount * 100) / 100.0 AS DECIMAL(12,2)) AS disc
           FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT o_orderkey AS ticket_id, CAST(o_orderdate AS DATE) AS fecha, '779' || lpad(CAST(l_partkey AS VARCHAR), 10, '0') AS id_producto,
       p_name AS producto, CAST(l_quantity AS DECIMAL(12,3)) AS cantidad, 'un' AS unidad,
       CAST((CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT)) / 100.0 AS DECIMAL(12,2)) AS precio_unitario,
       paid AS precio_pagado, CAST(paid + disc AS DECIMAL(12,2)) AS precio_base, disc AS descuento,
       '779' || lpad(CAST(l_partkey AS VARCHAR), 10, '0') AS barcode_ean13, 'cadena ' || CAST(o_custkey % 5 AS VARCHAR) AS id_comercio,
       CAST(0.90 AS DECIMAL(3,2)) AS confidence
FROM x""", ids="PIP-42 SCA-19 JN-3 PRJ-13")
def purchases_parsed(t):
    """Purchases of the parsed JSON answers, with quantity, unit, unit price and store."""
    items = formats.receipt_items_from_json(_receipt_answers(t), "ticket_id", "answer")
    return receipts.load_parsed_purchases(items, catalog_prices(t.part))


@register("variant_elements", """
SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS pos,
       role AS element_type, text AS content FROM conversations""", ids="SCA-25 PIP-36 SCA-23")
def variant_elements(t):
    c = t.conversations
    docs = (c.groupBy("conv_id")
            .agg(F.array_sort(F.collect_list(F.struct("turn", F.col("role").alias("type"),
                                                      F.col("text").alias("content")))).alias("els"))
            .select("conv_id", F.parse_json(F.to_json(F.struct(F.struct(F.col("els").alias("elements"))
                                                              .alias("document")))).alias("doc")))
    return formats.variant_elements(docs, "conv_id", "doc")


@register("parse_status", """
SELECT user_id, CASE WHEN err IS NULL THEN 'OK' ELSE 'ERROR' END AS status, err AS error_status, n_events
FROM (SELECT user_id, count(*) AS n_events, arg_min(props, ts) FILTER (WHERE event_type = 'error') AS err
      FROM events GROUP BY user_id)""", ids="PIP-57 PRJ-4")
def parse_status(t):
    per_user = (t.events.groupBy("user_id")
                .agg(F.count(F.lit(1)).alias("n_events"),
                     F.min_by(F.when(F.col("event_type") == "error", F.col("props")),
                              F.when(F.col("event_type") == "error", F.col("ts"))).alias("err")))
    return formats.parse_status(per_user, "user_id", "err").join(per_user.select("user_id", "n_events"), "user_id")


@register("html_links", r"""
SELECT page_id, link_pos, substr(q, 2, length(q) - 2) AS href
FROM (SELECT page_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS link_pos, unnest(l) AS q
      FROM (SELECT page_id, regexp_extract_all(html, '(?i)href\s*=\s*("[^"]*"|''[^'']*'')', 1) AS l FROM pages))""", ids="SRC-7 SCA-6")
def html_links(t):
    return formats.html_links(t.pages)


@register("html_block_links", r"""
WITH p AS (SELECT page_id, regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'g') AS h
           FROM pages),
b AS (SELECT page_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS block, unnest(l) AS body
      FROM (SELECT page_id, regexp_extract_all(h, '(?is)<nav[^>]*>(.*?)</nav>', 1) AS l FROM p)),
x AS (SELECT page_id, block, trim(regexp_extract('>' || body, '>\s*([^<\s][^<]*)', 1)) AS heading,
             list_filter(regexp_extract_all(body, '(?i)<a\b[^>]*?\shref\s*=\s*("[^"]*"|''[^'']*'')', 1),
                         lambda q: contains(q, '/t'))[1] AS q FROM b)
SELECT page_id, block, nullif(heading, '') AS heading, substr(q, 2, length(q) - 2) AS link FROM x WHERE q IS NOT NULL""", ids="SRC-7")
def html_block_links(t):
    """First text and first link with /t of every navigation block."""
    return formats.block_links(t.pages, "nav", None, None, "/t")


_EMAIL_SQL = """
SELECT c_custkey, email, coalesce(regexp_full_match(email, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}$'), false)
       AS is_valid
FROM (SELECT c_custkey,
             CASE WHEN c_custkey % 3 = 0 THEN lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.com'
                  WHEN c_custkey % 3 = 1 THEN lower(c_name) || '@example'
                  ELSE replace(c_name, '#', '') END AS email
      FROM customer)"""


@register("email_check", _EMAIL_SQL.replace("\\\\", "\\"), ids="SCA-30 UDF-2")
def email_check(t):
    c = t.customer
    email = (F.when(F.col("c_custkey") % 3 == 0,
                    F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@"),
                             F.lower("c_mktsegment"), F.lit(".com")))
             .when(F.col("c_custkey") % 3 == 1, F.concat(F.lower("c_name"), F.lit("@example")))
             .otherwise(F.replace("c_name", F.lit("#"), F.lit(""))))
    return formats.email_check(c.select("c_custkey", email.alias("email")), "email")
