"""Query keys for receipts and barcode repair (stand-in: ticket lines built from orders ⋈ lineitem ⋈ part)."""

from __future__ import annotations

from pyspark.sql import functions as F

from gondola.operators import barcodes as B
from gondola.operators import receipts as R
from gondola.plans.registry import register
from gondola.sources import standins

WEIGHT_TYPES = ["LARGE"]          # part types sold by weight in the stand-in (rule table)
OCR_GAP_US = 6 * 3600 * 1_000_000  # gap rule on event time (microseconds) for fragment grouping


def _money_sql(x: str) -> str:
    return f"CAST(({x}) // 100 AS VARCHAR) || ',' || lpad(CAST(({x}) % 100 AS VARCHAR), 2, '0')"


LINES_SQL = f"""
it AS (SELECT l.l_orderkey, l.l_partkey, l.l_linenumber, l.l_quantity, l.l_extendedprice, l.l_discount, p.p_name,
              row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_extendedprice) AS k,
              lpad(CAST(l.l_partkey AS VARCHAR), 10, '0') AS code10,
              CAST(round(l.l_extendedprice * 100) AS BIGINT) AS tot,
              CAST(round(l.l_extendedprice * l.l_discount * 100) AS BIGINT) AS disc,
              (l.l_orderkey + l.l_linenumber) % 7 AS r
       FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
it2 AS (SELECT *, 'ticket_' || CAST(l_orderkey AS VARCHAR) || '.jpg' AS file,
               CASE WHEN r = 0 THEN substr('779' || code10, 1, 3) || '8' || substr('779' || code10, 5, 9)
                    WHEN r = 3 THEN '0' || substr('779' || code10, 2, 12)
                    WHEN r = 5 THEN '0' || '779' || code10 ELSE '779' || code10 END AS noisy FROM it),
lines AS (
  SELECT 'ticket_' || CAST(o_orderkey AS VARCHAR) || '.jpg' AS file, 0 AS pos, 'TICKET ' || CAST(o_orderkey AS VARCHAR) AS line_text
  FROM orders
  UNION ALL
  SELECT 'ticket_' || CAST(o_orderkey AS VARCHAR) || '.jpg', 1, 'FECHA ' || strftime(o_orderdate, '%Y-%m-%d') FROM orders
  UNION ALL
  SELECT file, CAST(2 * k AS INTEGER), concat_ws(' ', upper(p_name), code10, noisy,
                                                CASE WHEN l_linenumber % 4 <> 2 THEN {_money_sql('tot')} END) FROM it2
  UNION ALL
  SELECT file, CAST(2 * k + 1 AS INTEGER),
         CASE WHEN l_linenumber % 4 = 2 THEN 'SUBTOTAL ' || {_money_sql('tot')}
              WHEN l_discount >= 0.05 THEN 'PROMO OFF -' || {_money_sql('disc')}
              ELSE 'CANT ' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ' UN' END FROM it2)"""

CATALOG_SQL = """
catalog AS (SELECT '779' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS id_producto, p_name AS producto,
                   p_retailprice AS precio FROM part)"""

ITEMS_SQL = r"""
ctx AS (SELECT *, regexp_extract_all(line_text, '(-?[0-9]+[,.][0-9]{2})', 1) AS prices,
               coalesce(line_text LIKE '%OFF%' OR line_text LIKE '%PROMO%', false) AS promo FROM lines),
ctx2 AS (SELECT *, lead(line_text, 1) OVER (PARTITION BY file ORDER BY pos) AS next_line_1,
                first_value(CASE WHEN NOT promo AND len(prices) > 0 THEN prices[1] END IGNORE NULLS)
                  OVER (PARTITION BY file ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING) AS ahead
         FROM ctx),
it0 AS (SELECT file, pos, trim(regexp_extract(line_text, '^([^0-9]*)', 1)) AS producto,
               nullif(regexp_extract(line_text, '(^|[^0-9])([0-9]{10})([^0-9]|$)', 2), '') AS product_id,
               nullif(regexp_extract(line_text, '(^|[^0-9])([0-9]{13,14})([^0-9]|$)', 2), '') AS barcode,
               try_cast(replace(prices[-1], ',', '.') AS DOUBLE) AS extracted,
               try_cast(replace(ahead, ',', '.') AS DOUBLE) AS ahead_p,
               coalesce(next_line_1 LIKE '%OFF%' OR next_line_1 LIKE '%PROMO%', false) AS next_line_is_promo,
               next_line_1
        FROM ctx2
        WHERE regexp_matches(line_text, '(^|[^0-9])[0-9]{10}([^0-9]|$)')
          AND regexp_matches(line_text, '(^|[^0-9])[0-9]{13,14}([^0-9]|$)')),
it1 AS (SELECT it0.*, c.precio AS cat_p,
               CASE WHEN next_line_is_promo THEN
                 try_cast(replace(regexp_extract(next_line_1, '-([0-9]+[,.][0-9]{2})', 1), ',', '.') AS DOUBLE) END AS disc
        FROM it0 LEFT JOIN (SELECT regexp_replace(id_producto, '^0+', '') AS k, precio FROM catalog) c
          ON regexp_replace(it0.barcode, '^0+', '') = c.k),
items AS (SELECT file, pos, producto, product_id, barcode, next_line_is_promo,
                 coalesce(extracted, ahead_p, cat_p) AS precio_pagado, coalesce(disc, 0.0) AS descuento,
                 coalesce(extracted, ahead_p, cat_p) + coalesce(disc, 0.0) AS precio_base,
                 CASE WHEN extracted IS NOT NULL THEN 'extracted' WHEN ahead_p IS NOT NULL THEN 'lookahead'
                      WHEN cat_p IS NOT NULL THEN 'catalog' END AS price_source
          FROM it1),
dates AS (SELECT file, max(try_strptime(regexp_extract(line_text, 'FECHA ([0-9]{4}-[0-9]{2}-[0-9]{2})', 1), '%Y-%m-%d')
                           ::DATE) AS fecha FROM lines GROUP BY file),
purchases AS (SELECT md5(i.file) AS ticket_id, d.fecha, c.id_producto, i.producto, i.precio_pagado, i.precio_base,
                     i.descuento, i.barcode AS barcode_ean13, i.file AS source_file, CAST(0.9 AS DOUBLE) AS confidence
              FROM items i LEFT JOIN dates d ON i.file = d.file LEFT JOIN catalog c ON i.barcode = c.id_producto
              WHERE i.producto IS NOT NULL AND i.producto <> '' AND i.precio_pagado IS NOT NULL)"""

BASE = "WITH " + ",\n".join(s.strip() for s in [LINES_SQL, CATALOG_SQL, ITEMS_SQL]) + "\n"


def _lines(t):
    return standins.ticket_lines(t.orders, t.lineitem, t.part)


def _items(t):
    return R.items_from_lines(_lines(t), standins.catalog_prices(t.part))


def _purchases(t):
    lines = _lines(t)
    items = R.items_from_lines(lines, standins.catalog_prices(t.part))
    return R.load_purchases(items, R.ticket_dates(lines), standins.catalog_prices(t.part))


@register("receipt_lines", BASE + """
SELECT file, count(*) AS n_lines,
       count(*) FILTER (WHERE regexp_matches(line_text, '(^|[^0-9])[0-9]{10}([^0-9]|$)')
                          AND regexp_matches(line_text, '(^|[^0-9])[0-9]{13,14}([^0-9]|$)')) AS item_lines,
       count(*) FILTER (WHERE coalesce(line_text LIKE '%OFF%' OR line_text LIKE '%PROMO%', false)) AS promo_lines,
       CAST(sum(length(line_text)) AS BIGINT) AS text_length
FROM lines GROUP BY file""", ids="PIP-36 AGG-23 PRJ-8 SCA-8")
def receipt_lines(t):
    lt = F.col("line_text")
    return _lines(t).groupBy("file").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(lt.rlike(R.CODE10_RE) & lt.rlike(R.CODE13_RE)).alias("item_lines"),
        F.count_if(F.coalesce(lt.like("%OFF%") | lt.like("%PROMO%"), F.lit(False))).alias("promo_lines"),
        F.sum(F.length(lt)).cast("long").alias("text_length"))


@register("receipt_items", BASE + "SELECT * FROM items",
          ids="PIP-38 PIP-39 PIP-40 WIN-7 WIN-8 JN-10 JN-12 SCA-5 SCA-6 SCA-22 PRJ-5 PRJ-8")
def receipt_items(t):
    return _items(t)


@register("purchases_load", BASE + "SELECT * FROM purchases", ids="PIP-42 JN-3 SCA-10 SCA-16 PRJ-13")
def purchases_load(t):
    return _purchases(t)


@register("ticket_summary", BASE + """
SELECT fecha, ticket_id, source_file, count(*) AS items,
       sum(CAST(round(precio_pagado * 100) AS BIGINT)) / 100.0 AS total_pagado,
       sum(CAST(round(descuento * 100) AS BIGINT)) / 100.0 AS ahorro,
       round(CAST(sum(CAST(round(descuento * 100) AS BIGINT)) AS DOUBLE) * 10000.0
             / CAST(nullif(sum(CAST(round(precio_pagado * 100) AS BIGINT)) + sum(CAST(round(descuento * 100) AS BIGINT)), 0)
                    AS DOUBLE)) / 100.0 AS ahorro_pct,
       count(id_producto) AS matched
FROM purchases GROUP BY fecha, ticket_id, source_file""", ids="PIP-47 AGG-3 AGG-6 AGG-21")
def ticket_summary(t):
    return R.ticket_summary(_purchases(t))


@register("receipt_discounts", BASE + f"""
, dl AS (SELECT file, code10 AS product_id, sum(disc) AS dc FROM it2 WHERE l_discount >= 0.05 GROUP BY file, code10)
SELECT i.file, i.pos, i.producto, i.product_id, i.barcode, i.next_line_is_promo, i.precio_pagado,
       coalesce(d.dc / 100.0, 0.0) AS descuento, i.precio_pagado + coalesce(d.dc / 100.0, 0.0) AS precio_base, i.price_source
FROM items i LEFT JOIN dl d ON i.file = d.file AND i.product_id = d.product_id""", ids="PIP-39 JN-13")
def receipt_discounts(t):
    """Items with the discount of their internal code, from discount lines ``DTO code10 -amount``."""
    li = t.lineitem.filter("l_discount >= 0.05")
    cents = F.round(F.col("l_extendedprice") * F.col("l_discount") * 100).cast("long")
    text = F.concat(F.lit("DTO "), F.lpad(F.col("l_partkey").cast("string"), 10, "0"), F.lit(" -"), standins.money_text(cents))
    lines = li.select(F.concat(F.lit("ticket_"), F.col("l_orderkey").cast("string"), F.lit(".jpg")).alias("file"), text.alias("line_text"))
    return R.attach_discounts_by_code(_items(t), lines).select(
        "file", "pos", "producto", "product_id", "barcode", "next_line_is_promo", "precio_pagado", "descuento", "precio_base", "price_source")


@register("barcode_prefix", BASE + """
SELECT ticket_id, source_file, barcode_ean13,
       CASE WHEN length(barcode_ean13) = 14 AND starts_with(barcode_ean13, '0') THEN substr(barcode_ean13, 2, 13)
            WHEN starts_with(barcode_ean13, '02') THEN '2' || substr(barcode_ean13, 2, 12)
            WHEN starts_with(barcode_ean13, '07') THEN '7' || substr(barcode_ean13, 2, 12)
            WHEN starts_with(barcode_ean13, '0') THEN '7' || substr(barcode_ean13, 2, 12)
            ELSE barcode_ean13 END AS repaired_barcode
FROM purchases""", ids="PIP-45 PRJ-3")
def barcode_prefix(t):
    p = _purchases(t)
    return p.select("ticket_id", "source_file", "barcode_ean13",
                    B.repair_prefix(F.col("barcode_ean13")).alias("repaired_barcode"))


CAND_SQL = """
, pur AS (SELECT producto AS purchase_name, barcode_ean13 AS purchase_barcode, precio_pagado AS purchase_price,
                 count(*) AS affected_count, nullif(regexp_extract(upper(producto), '([A-Z]{4,})', 1), '') AS blk
          FROM purchases WHERE barcode_ean13 IS NOT NULL GROUP BY producto, barcode_ean13, precio_pagado),
sepa AS (SELECT upper(producto) AS sepa_name, id_producto AS sepa_barcode, precio AS sepa_price,
                nullif(regexp_extract(upper(producto), '([A-Z]{4,})', 1), '') AS blk FROM catalog),
pur2 AS (SELECT * FROM pur WHERE purchase_barcode NOT IN (SELECT sepa_barcode FROM sepa WHERE sepa_barcode IS NOT NULL)),
cm AS (SELECT p.*, s.sepa_name, s.sepa_barcode, s.sepa_price,
              len(list_intersect(string_split(upper(p.purchase_name), ' '), string_split(upper(s.sepa_name), ' '))) AS common_words,
              len(string_split(upper(p.purchase_name), ' ')) AS words,
              levenshtein(p.purchase_barcode, s.sepa_barcode) AS barcode_distance
       FROM pur2 p JOIN sepa s ON p.blk = s.blk WHERE p.purchase_barcode <> s.sepa_barcode),
rk AS (SELECT *, row_number() OVER (PARTITION BY purchase_barcode ORDER BY common_words DESC, barcode_distance ASC,
                                    sepa_barcode ASC, purchase_price ASC, purchase_name ASC) AS r
       FROM cm WHERE common_words >= 2 AND barcode_distance <= 3),
best AS (SELECT purchase_barcode, sepa_barcode AS corrected_barcode, purchase_name, sepa_name,
                round(common_words / words * 100) / 100.0 AS name_match_score, barcode_distance,
                CASE WHEN common_words / words >= 0.6 AND barcode_distance <= 2 THEN 'HIGH'
                     WHEN common_words / words >= 0.5 AND barcode_distance <= 2 THEN 'MEDIUM' ELSE 'LOW' END AS confidence,
                sepa_price, purchase_price, affected_count, 'PENDING' AS status
         FROM rk WHERE r = 1)"""


def _sepa(t):
    c = standins.catalog_prices(t.part)
    return c.select(F.upper("producto").alias("sepa_name"), F.col("id_producto").alias("sepa_barcode"),
                    F.col("precio").alias("sepa_price"))


def _candidates(t, min_common=2):
    p = _purchases(t).select(F.col("producto").alias("purchase_name"),
                             F.col("barcode_ean13").alias("purchase_barcode"),
                             F.col("precio_pagado").alias("purchase_price"))
    return B.barcode_candidates(p, _sepa(t), min_common=min_common)


@register("barcode_candidates", BASE + CAND_SQL + """
SELECT purchase_barcode, corrected_barcode, purchase_name, sepa_name, name_match_score,
       CAST(barcode_distance AS INTEGER) AS barcode_distance, confidence, sepa_price, purchase_price, affected_count, status
FROM best""", ids="PIP-43 JN-16 JN-9 WIN-4 SCA-9 SCA-22 PRJ-4")
def barcode_candidates(t):
    return _candidates(t)


@register("barcode_apply", BASE + CAND_SQL + """
SELECT p.ticket_id, p.fecha, p.id_producto, p.producto, p.precio_pagado, p.precio_base, p.descuento,
       coalesce(b.corrected_barcode, p.barcode_ean13) AS barcode_ean13, p.source_file, p.confidence,
       b.corrected_barcode IS NOT NULL AS barcode_corrected
FROM purchases p LEFT JOIN (SELECT * FROM best WHERE confidence = 'HIGH' AND status = 'PENDING') b
  ON p.barcode_ean13 = b.purchase_barcode""", ids="PIP-44 DML-1 DML-11")
def barcode_apply(t):
    return B.apply_corrections(_purchases(t), _candidates(t))


_TIER_SQL = "CASE confidence WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 ELSE 1 END"


@register("barcode_summary", BASE + CAND_SQL.replace("common_words >= 2", "common_words >= 1") + f"""
, marked AS (SELECT confidence, CASE WHEN confidence = 'HIGH' AND status = 'PENDING' THEN 'APPLIED' ELSE status END AS status,
                    affected_count FROM best)
SELECT confidence, status, count(*) AS n, CAST(sum(affected_count) AS BIGINT) AS affected, {_TIER_SQL} AS tier_rank
FROM marked GROUP BY confidence, status""", ids="PIP-44 DML-11 AGG-1 SCA-26")
def barcode_summary(t):
    """Corrections by tier and status once the HIGH ones are marked as applied."""
    return B.correction_summary(B.mark_applied(_candidates(t, 1)))


@register("barcode_marked", BASE + CAND_SQL + """
, clock AS (SELECT CAST(max(o_orderdate) AS TIMESTAMP) AS now FROM orders)
SELECT purchase_barcode, corrected_barcode, confidence, CASE WHEN confidence = 'HIGH' THEN 'APPLIED' ELSE status END AS status,
       CASE WHEN confidence = 'HIGH' THEN now END AS applied_at FROM best, clock""", ids="DML-11 SCA-17")
def barcode_marked(t):
    """Corrections with their status once the HIGH ones are applied; the clock is the last order's date."""
    now = t.orders.agg(F.max("o_orderdate").cast("timestamp").alias("now")).scalar()
    return B.mark_applied(_candidates(t), now).select("purchase_barcode", "corrected_barcode", "confidence", "status", "applied_at")


@register("barcode_review", BASE + CAND_SQL.replace("common_words >= 2", "common_words >= 1") + f"""
SELECT purchase_barcode, corrected_barcode, purchase_name, sepa_name, name_match_score,
       CAST(barcode_distance AS INTEGER) AS barcode_distance, confidence, sepa_price, purchase_price, affected_count, status,
       {_TIER_SQL} AS tier_rank
FROM best WHERE confidence <> 'HIGH' AND status = 'PENDING'""", ids="PIP-44")
def barcode_review(t):
    """Corrections left for review after the HIGH ones were applied; names may share one word only."""
    return B.review_list(B.mark_applied(_candidates(t, 1)))


@register("receipt_profile", """
WITH e AS (SELECT role AS element_type, text AS content FROM conversations),
s AS (SELECT element_type, s, row_number() OVER (PARTITION BY element_type ORDER BY s) AS r
      FROM (SELECT DISTINCT element_type, substr(content, 1, 100) AS s FROM e WHERE content IS NOT NULL)),
t AS (SELECT element_type, list(s ORDER BY s) AS samples FROM s WHERE r <= 5 GROUP BY element_type)
SELECT e.element_type, count(*) AS n, CAST(sum(coalesce(length(content), 0)) AS BIGINT) AS chars,
       max(coalesce(length(content), 0)) AS longest, any_value(coalesce(t.samples, [])) AS samples
FROM e LEFT JOIN t ON e.element_type IS NOT DISTINCT FROM t.element_type GROUP BY e.element_type""", ids="AGG-23 PIP-36")
def receipt_profile(t):
    """Profile of element types over the turns of all conversations (type = role)."""
    c = t.conversations.select(F.col("role").alias("element_type"), F.col("text").alias("content"))
    return R.element_profile(c, "element_type", "content")


@register("receipt_text", """
SELECT conv_id, count(*) AS elements, coalesce(string_agg(text, chr(10) ORDER BY turn, text), '') AS full_text,
       CAST(length(coalesce(string_agg(text, chr(10) ORDER BY turn, text), '')) AS BIGINT) AS text_length
FROM conversations WHERE role = 'user' GROUP BY conv_id""", ids="PIP-36")
def receipt_text(t):
    """Full text and length per document of its elements of one type."""
    return R.full_texts(t.conversations, "conv_id", "turn", "role", "text", kind="user")


@register("receipt_weight_fix", f"""
WITH it AS (
  SELECT l.l_orderkey AS ticket_id, l.l_linenumber, l.l_partkey, p.p_name AS producto,
         p.p_type IN ({", ".join("'" + x + "'" for x in WEIGHT_TYPES)}) AS is_weight,
         CASE WHEN p.p_type IN ({", ".join("'" + x + "'" for x in WEIGHT_TYPES)}) THEN l.l_quantity / 20.0
              ELSE l.l_quantity END AS cantidad,
         CASE WHEN p.p_type IN ({", ".join("'" + x + "'" for x in WEIGHT_TYPES)})
              THEN round(l.l_extendedprice * 2000 / l.l_quantity) / 100.0 ELSE l.l_extendedprice END AS precio,
         round(l.l_extendedprice * l.l_discount * 100) / 100.0 AS descuento
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)
SELECT *, CASE WHEN is_weight AND precio > 20000 THEN round(cantidad * precio * 100) / 100.0 ELSE precio END AS precio_pagado,
       is_weight AND precio > 20000 AS weight_fixed,
       CAST(CASE WHEN is_weight AND precio > 20000 THEN 0.85 ELSE 0.95 END AS DOUBLE) AS confidence,
       CASE WHEN is_weight AND precio > 20000 THEN round(cantidad * precio * 100) / 100.0 ELSE precio END + descuento
         AS precio_base
FROM it""", ids="PIP-41")
def receipt_weight_fix(t):
    li, p = t.lineitem, t.part
    isw = F.col("p_type").isin(WEIGHT_TYPES)
    items = li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("l_orderkey").alias("ticket_id"), "l_linenumber", "l_partkey", F.col("p_name").alias("producto"),
        isw.alias("is_weight"),
        F.when(isw, F.col("l_quantity") / 20.0).otherwise(F.col("l_quantity")).alias("cantidad"),
        F.when(isw, F.round(F.col("l_extendedprice") * 2000 / F.col("l_quantity")) / 100.0)
        .otherwise(F.col("l_extendedprice")).alias("precio"),
        (F.round(F.col("l_extendedprice") * F.col("l_discount") * 100) / 100.0).alias("descuento"))
    return R.weight_fix(items)


@register("ocr_line_groups", f"""
WITH f AS (SELECT user_id, epoch_us(ts) AS y, event_type AS text, value AS conf FROM events),
g AS (SELECT *, CASE WHEN y - lag(y) OVER (PARTITION BY user_id ORDER BY y, text) > {OCR_GAP_US} THEN 1 ELSE 0 END AS nw
      FROM f),
l AS (SELECT *, CAST(sum(nw) OVER (PARTITION BY user_id ORDER BY y, text ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                     AS INTEGER) AS line_no FROM g)
SELECT user_id, line_no, string_agg(text, ' ' ORDER BY y, text) AS text, round(avg(conf), 6) AS confidence,
       count(*) AS fragments
FROM l GROUP BY user_id, line_no""", ids="PIP-48 WIN-6")
def ocr_line_groups(t):
    frags = t.events.select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("y"), F.col("event_type").alias("text"),
                            F.col("value").alias("conf"))
    out = R.group_ocr_fragments(frags, "user_id", "y", "text", "conf", OCR_GAP_US)
    return out.withColumn("confidence", F.round("confidence", 6))
