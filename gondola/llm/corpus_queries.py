"""Registered queries of the prefix trie, the filter audit and the license scan, with their DuckDB SQL."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.llm import license_scan
from gondola.llm.common import table
from gondola.llm.filter_audit import audit, failure_counts
from gondola.llm.prefix_trie import end_digests, prefix_trie, rebuild, turn_rows


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    trie = prefix_trie(rebuild(turn_rows(table(spark, sf_dir, "conversations"))))
    none = F.sha2(F.lit(""), 256)
    return trie.nodes.join(end_digests(trie.ends), "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"))


OP11_SQL = """
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS n,
             coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT conv_id FROM t),
-- CRC-32, bit by bit: a byte of the decimal id, then eight shifts (-1)
crc AS (SELECT conv_id, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(conv_id::VARCHAR, ''),
          lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
          lambda acc, x: CASE WHEN x >= 0 THEN xor(acc, x) ELSE xor(acc >> 1, 3988292384 * (acc & 1)) END) AS c FROM ids),
c AS (SELECT conv_id, xor(c, 4294967295) % 6 AS h, conv_id - conv_id % 100 AS base FROM crc),
r AS (SELECT c.conv_id, 0 AS own, n, role, text FROM c JOIN t ON t.conv_id = c.base AND n <= h
      UNION ALL SELECT c.conv_id, 1, n, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND n > h),
s AS (SELECT ids.conv_id, coalesce(q, []) AS q FROM ids LEFT JOIN
      (SELECT conv_id, list({'role': role, 'text': text} ORDER BY own, n) AS q FROM r GROUP BY conv_id) USING (conv_id)),
p AS (SELECT conv_id, d, len(q) AS l, q[1:d] AS k, CASE WHEN d > 0 THEN length(q[d].text) ELSE 0 END AS cp
      FROM (SELECT *, unnest(range(len(q) + 1)) AS d FROM s)),
nodes AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, max(l) > d AS inner_, any_value(cp) AS cp,
          string_agg(CASE WHEN l = d THEN conv_id::VARCHAR END, ',' ORDER BY conv_id) AS ends FROM p GROUP BY k, d),
below AS (SELECT a.k AS k, sum(CASE WHEN b.inner_ THEN 0 ELSE 1 END)::BIGINT AS n_leaves, sum((b.n_convs - 1) * b.cp)::BIGINT AS saved
          FROM nodes b, LATERAL (SELECT unnest(range(b.d + 1)) AS u) x JOIN nodes a ON a.k = b.k[1:u] AND a.d = u GROUP BY a.k),
kids AS (SELECT k[1:d - 1] AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1)
SELECT nodes.conv_id, nodes.d AS depth, up.conv_id AS parent_conv_id, nodes.n_convs, coalesce(kids.n, 0) AS n_children, n_leaves,
       saved AS saved_tokens, sha256(coalesce(nodes.ends, '')) AS ends_sha256
FROM nodes JOIN below ON below.k = nodes.k LEFT JOIN kids ON kids.k = nodes.k LEFT JOIN nodes up ON nodes.d > 0 AND up.k = nodes.k[1:nodes.d - 1]"""


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interactions of the five filters per source."""
    counts, names = failure_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.col("source"))
    return audit(counts, names)


def _audit_sql() -> str:
    letters, steps = "ABCDE", range(1, 6)
    fails = {"A": "len(ws) < 50", "B": "100 * len(list_distinct(ws)) < 65 * len(ws)",
             "C": "100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text)", "D": "regexp_matches(text, '[#$%&*|]')",
             "E": "coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)"}
    rank = "least(" + ", ".join(f"CASE WHEN {f} THEN strpos(filter_order, '{f}') ELSE 6 END" for f in letters) + ")"
    here = "CASE f " + " ".join(f"WHEN '{f}' THEN {f}" for f in letters) + " END"
    perms = ", ".join(f"(VALUES {', '.join(repr(x).join('()') for x in letters)}) p{i}(l{i})" for i in steps)
    apart = " AND ".join(f"l{i} <> l{j}" for i in steps for j in steps if i < j)
    return rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
m AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
x AS (SELECT doc_id, part, {", ".join(f"{e} AS {f}" for f, e in fails.items())} FROM d),
w AS (SELECT part, A, B, C, D, E, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
      FROM x LEFT JOIN m ON m.doc_id = x.doc_id GROUP BY ALL),
o AS (SELECT {" || ".join(f"l{i}" for i in steps)} AS filter_order FROM {perms} WHERE {apart}),
r AS (SELECT w.*, filter_order, {rank} AS gone FROM w, o),
s AS (SELECT part, filter_order, step, substr(filter_order, step, 1) AS f, sum(CASE WHEN gone > step THEN n ELSE 0 END)::BIGINT AS kept,
        sum(CASE WHEN gone = step THEN n ELSE 0 END)::BIGINT AS removed, sum(CASE WHEN {here} AND gone < step THEN n ELSE 0 END)::BIGINT AS redundant,
        sum(CASE WHEN {here} AND A::INT + B::INT + C::INT + D::INT + E::INT = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
        sum(CASE WHEN gone = step THEN good ELSE 0 END)::BIGINT AS good_lost, sum(CASE WHEN gone = step THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
      FROM (SELECT *, substr(filter_order, step, 1) AS f FROM (SELECT *, unnest([1, 2, 3, 4, 5]) AS step FROM r)) GROUP BY part, filter_order, step)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, f)::BIGINT AS shapley FROM s"""


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in all documents."""
    out = license_scan.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
                      F.array_join("labels", ",").alias("labels"), "score")


def _license_sql() -> str:
    given = [(p.split(), lab, True) for p, lab in license_scan.PHRASES] + [(p.split(), lab, False) for p, lab in license_scan.NOTICES]
    text = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]"
    rows = ", ".join(f"({text(ws)}, {text(sorted(set(ws)))}, '{lab}', {str(base).lower()}, "
                     f"{len(set(ws)) if base else math.ceil(license_scan.THRESHOLD * len(set(ws)) - 1e-9)})" for ws, lab, base in given)
    return rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{license_scan.UPPER}', '{license_scan.LOWER}'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
t(phrase, words, label, base, need) AS (VALUES {rows}),
b AS (SELECT doc_id, st, ws[st + 1:st + {license_scan.BLOCK}] AS blk FROM (SELECT *, unnest(range(0, greatest(len(ws), 1), {license_scan.STEP})) AS st FROM d)),
m AS (SELECT doc_id, st, blk, t.*, len(list_intersect(words, blk)) AS shared FROM b, t WHERE len(list_intersect(words, blk)) >= need),
h AS (SELECT *, CASE WHEN base THEN list_filter(range({license_scan.STEP}), lambda k: blk[k + 1:k + len(phrase)] = phrase) END AS places FROM m),
g AS (SELECT doc_id, sum(len(places))::BIGINT AS n_base, min(st + list_min(places))::BIGINT AS first_word, max(st + list_max(places))::BIGINT AS last_word,
        list_sort(list_distinct(list(label) FILTER (WHERE base))) AS bl, list_sort(list_distinct(list(label))) AS al, max(shared / len(words)) AS score
      FROM h WHERE NOT base OR len(places) > 0 GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(array_to_string(bl, ','), '') AS base_labels,
       coalesce(array_to_string(al, ','), '') AS labels, coalesce(score, 0)::DOUBLE AS score FROM d LEFT JOIN g ON g.doc_id = d.doc_id"""


QUERIES = {"op11_prefix_trie": op11_prefix_trie, "op12_filter_audit": op12_filter_audit, "op13_license_scan": op13_license_scan}
ORACLES = {"op11_prefix_trie": OP11_SQL, "op12_filter_audit": _audit_sql(), "op13_license_scan": _license_sql()}
