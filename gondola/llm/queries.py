"""Registered queries of the training-data operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.llm import corpus_queries, url_filter
from gondola.llm.bpe import bpe_round_trip
from gondola.llm.common import table
from gondola.llm.embed_dedup import embedding_dedup
from gondola.llm.exact_dedup import exact_dedup
from gondola.llm.html_extract import extract_main
from gondola.llm.katz import katz_scores
from gondola.llm.minhash import near_dedup
from gondola.llm.mixing import mix_sources
from gondola.llm.quality import classify
from gondola.llm.substrings import substring_dedup


def op1_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Katz scores of all documents; those whose crc32(doc_id) mod 5 is 1 are held out."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    return katz_scores(table(spark, sf_dir, "documents").select("doc_id", "text"), held_out).withColumnRenamed("id", "doc_id")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of equal texts over all documents."""
    out = exact_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(F.col("row.doc_id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


OP2_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))"""


def trusted_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("trusted"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity and verdict of every document; trusted are those labelled of quality 1."""
    out = classify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), trusted_labels(spark, sf_dir))
    return out.drop("fp").withColumnRenamed("id", "doc_id")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the words of 20-word windows that start earlier elsewhere."""
    out = substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, s, md5(list_aggregate(ws[s:s + 19], 'string_agg', ' ')) AS k
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS s FROM w WHERE len(ws) >= 20)),
late AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS n FROM win) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM late),
pos AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
kept AS (SELECT pos.doc_id, string_agg(word, ' ' ORDER BY pos.i) AS t, count(*) AS n FROM pos ANTI JOIN gone ON pos.doc_id = gone.doc_id AND pos.i = gone.i GROUP BY 1)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(kept.n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id"""


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of cosine 0.9 or more between all embeddings."""
    return embedding_dedup(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


OP5_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
          WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
comp AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = comp.vec_id) AS n_links, component_id,
       vec_id = component_id AS kept FROM comp"""


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict for every page's url; a url is labelled bad where the document it leads to is of quality 0 or toxic."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("key"), F.expr("cast(quality = 0 or toxic = 1 as int)").alias("bad"))
    out = url_filter.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), labels)
    return out.withColumnRenamed("id", "page_id")


def _url_sql() -> str:
    """The template tree in SQL, level by level."""
    levels = range(1, url_filter.LEVELS + 1)

    def cls(x: str) -> str:
        return (f"CASE WHEN {x} IS NULL THEN '' WHEN regexp_full_match({x}, '[0-9]+') THEN '{{n}}' "
                f"WHEN regexp_full_match({x}, '[0-9]+\\.[A-Za-z]+') THEN '{{n}}.' || regexp_extract({x}, '\\.([A-Za-z]+)$', 1) "
                f"WHEN regexp_full_match({x}, '[0-9]+(-[0-9]+)+') THEN '{{d}}' "
                f"WHEN regexp_full_match({x}, '[0-9a-fA-F]{{8,}}(-[0-9a-fA-F]+)*') THEN '{{h}}' ELSE {x} END")

    ss = ", ".join(f"s{i}" for i in levels)
    ctes = ["""
u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
hp AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
       regexp_extract(substr(rest, length(regexp_extract(rest, '^([^/?#]*)', 1)) + 1), '^([^?#]*)', 1) AS path
       FROM (SELECT page_id, coalesce(rest, '') AS rest FROM u)),
m AS (SELECT doc_id::VARCHAR AS key, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END)::BIGINT AS bad FROM labels GROUP BY doc_id),
sg AS (SELECT hp.*, list_filter(string_split(path, '/'), lambda x: x <> '') AS segs, (m.bad IS NOT NULL)::BIGINT AS lab, coalesce(m.bad, 0) AS bad
       FROM hp LEFT JOIN m ON m.key = regexp_replace(regexp_extract(path, '([0-9]+)[^0-9]*$', 1), '^0+([0-9])', '\\1'))""",
            f"""
r AS (SELECT page_id, host, path, lab, bad, {", ".join(f"{cls(f'segs[{i}]')} AS s{i}" for i in levels)},
      CASE WHEN len(segs) > {url_filter.LEVELS} THEN '/**' ELSE '' END AS more FROM sg),
w0 AS (SELECT host, {ss}, more, count(*) AS n, sum(lab) AS lab, sum(bad) AS bad, {", ".join(f"s{i} AS t{i}" for i in levels)} FROM r GROUP BY host, {ss}, more)"""]
    for i in levels:
        up = ", ".join(["host", *[f"t{j}" for j in range(1, i)]])
        ctes.append(f"""
k{i} AS (SELECT {up}, t{i}, sum(n) AS n FROM w{i - 1} WHERE t{i} <> '' AND t{i} NOT LIKE '{{%' GROUP BY ALL),
x{i} AS (SELECT {up} FROM k{i} GROUP BY {up} HAVING count(*) > {url_filter.MANY} AND sum(n) < {url_filter.FEW} * count(*)),
w{i} AS (SELECT * REPLACE (CASE WHEN ({up}) IN (SELECT ({up}) FROM x{i}) AND t{i} <> '' AND t{i} NOT LIKE '{{%' THEN '*' ELSE t{i} END AS t{i}) FROM w{i - 1})""")
    last = url_filter.LEVELS
    ctes.append(f"""
v0 AS (SELECT *, {", ".join(f"t{i} AS b{i}" for i in levels)} FROM w{last})""")
    for i in levels:
        up = ", ".join(["host", *[f"b{j}" for j in range(1, i)]])
        ctes.append(f"""
n{i} AS (SELECT {up}, b{i}, sum(lab) AS nl, sum(bad) AS nb, sum(sum(lab)) OVER (PARTITION BY {up}) AS pl, sum(sum(bad)) OVER (PARTITION BY {up}) AS pb
         FROM v{i - 1} GROUP BY {up}, b{i}),
v{i} AS (SELECT v.* REPLACE (CASE WHEN (CASE WHEN pl = 0 OR pb = 0 OR pb = pl THEN true ELSE power((nb * pl - nl * pb)::DOUBLE, 2)
         <= {url_filter.Z * url_filter.Z} * (nl * pb * (pl - pb))::DOUBLE END) AND b{i} <> '' THEN '~' ELSE b{i} END AS b{i})
         FROM v{i - 1} v JOIN n{i} USING ({up}, b{i}))""")
    bs = ", ".join(f"b{i}" for i in levels)
    ctes.append(f"""
lf AS (SELECT host, {bs}, more, sum(lab)::BIGINT AS labelled, sum(bad)::BIGINT AS badn FROM v{last} GROUP BY ALL),
pr AS (SELECT *, round((badn + {url_filter.WEIGHT}::DOUBLE * ((sum(badn) OVER h + {url_filter.WEIGHT}::DOUBLE * coalesce((SELECT sum(badn)::DOUBLE / nullif(sum(labelled), 0) FROM lf), 0))
         / (sum(labelled) OVER h + {url_filter.WEIGHT}::DOUBLE))) / (labelled + {url_filter.WEIGHT}::DOUBLE), 9) AS purity FROM lf WINDOW h AS (PARTITION BY host)),
j AS (SELECT v.host, {", ".join(f"v.s{i}" for i in levels)}, v.more, {" || ".join(f"CASE WHEN pr.b{i} = '' THEN '' ELSE '/' || pr.b{i} END" for i in levels)} || more AS template,
      labelled, badn, purity FROM v{last} v JOIN pr USING (host, {bs}, more)),
ru AS (SELECT *, CASE WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
      WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
      WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
      WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule FROM r JOIN j USING (host, {ss}, more))
SELECT page_id, host, path, rule, template, labelled, badn AS bad, purity,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' WHEN purity >= {url_filter.REJECT} THEN 'block' ELSE 'allow' END AS verdict FROM ru""")
    return "WITH" + ",".join(ctes)


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    out = extract_main(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_bpe(spark: SparkSession, sf_dir: str, ranks_path: str | None = None) -> DataFrame:
    """Byte-level BPE round trip of every document."""
    import public_tokenizers

    out = bpe_round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"),
                         ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.withColumnRenamed("id", "doc_id")


def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=4).withColumnRenamed("id", "doc_id")


OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 4 THEN list_aggregate(ws, 'string_agg', ' ')
        ELSE list_aggregate(ws[i:i + 3], 'string_agg', ' ') END AS g
      FROM w, LATERAL (SELECT unnest(range(1, greatest(len(ws) - 2, 2))) AS i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
          WHERE 100 * common >= 80 * (x.n + y.n - common)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT comp.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, comp.doc_id = component_id AS kept
FROM comp LEFT JOIN n ON n.doc_id = comp.doc_id"""

#: Production mix: four domains by the source's number, Spanish lifted, half of all tokens, up to two epochs.
MIX_WEIGHTS = {"domain": {"d0": 3, "d1": 2, "d2": 2, "d3": 1}, "language": {"en": 8, "de": 4, "fr": 4, "es": 4}}
MIX_FRACTION, MIX_EPOCHS, MIX_SEED = (1, 2), 2, 7
TOKENS = r"regexp_count(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"


def mix_levels() -> dict:
    """Tree levels of ``documents``: domain (source number modulo 4), language, source."""
    return {"domain": F.expr("concat('d', cast(try_cast(regexp_extract(source, '([0-9]+)$', 1) as bigint) % 4 as string))"),
            "language": F.col("lang"), "origin": F.col("source")}


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Selected copies of documents under the production mix."""
    out = mix_sources(table(spark, sf_dir, "documents"), mix_levels(), F.expr(TOKENS), MIX_WEIGHTS, MIX_FRACTION, MIX_EPOCHS, MIX_SEED)
    return out.select("row.doc_id", "domain", "language", "origin", "n_tokens", "epoch", "leaf_tokens", "leaf_budget")


def _mix_sql() -> str:
    """The same water-filling and prefix rule in SQL, one block of CTEs per tree level."""
    def case(level: str) -> str:
        given = MIX_WEIGHTS.get(level, {})
        return "CASE " + " ".join(f"WHEN {level} = '{k}' THEN {x}" for k, x in given.items()) + " ELSE 1 END" if given else "1"

    levels = ["domain", "language", "origin"]
    num, den = MIX_FRACTION
    ctes = [rf"""
d AS (SELECT doc_id, coalesce('d' || CAST(TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) % 4 AS VARCHAR), '?') AS domain,
        coalesce(lang, '?') AS language, coalesce(source, '?') AS origin,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens FROM documents)""",
            f"""
l0 AS (SELECT domain, language, origin, sum(n_tokens)::BIGINT AS tokens, sum(n_tokens)::BIGINT * {MIX_EPOCHS} AS capacity,
         ((SELECT sum(n_tokens)::BIGINT FROM d) * {num}) // {den} AS pb FROM d GROUP BY ALL)"""]
    for i, level in enumerate(levels):
        node, up = ", ".join(levels[:i + 1]), ", ".join(levels[:i])
        part = f"PARTITION BY {up}" if up else ""
        ctes.append(f"""
a{i} AS (SELECT {node}, sum(capacity)::BIGINT AS cap, max(pb) AS b, {case(level)} AS w FROM l{i} GROUP BY {node}),
b{i} AS (SELECT *, sum(w) OVER ({part}) - coalesce(sum(w) OVER o, 0) AS wl, b - coalesce(sum(cap) OVER o, 0) AS bl
         FROM a{i} WINDOW o AS ({part} ORDER BY cap / w, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c{i} AS (SELECT *, min(CASE WHEN cap * wl <= bl * w THEN 1 ELSE 0 END) OVER ({part} ORDER BY cap / w, {level}
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ful FROM b{i}),
e{i} AS (SELECT *, b - sum(cap * ful) OVER ({part}) AS br, sum(w * (1 - ful)) OVER ({part}) AS wr FROM c{i}),
l{i + 1} AS (SELECT l{i}.* EXCLUDE (pb), CASE WHEN ful = 1 THEN cap ELSE (br * w) // wr END::BIGINT AS pb
         FROM l{i} JOIN e{i} USING ({node}))""")
    ctes.append(f"""
plan AS (SELECT domain, language, origin, tokens, pb AS budget, CASE WHEN tokens = 0 THEN 0 ELSE pb // tokens END AS whole FROM l3),
h AS (SELECT d.*, tokens, budget, whole, budget - whole * tokens AS rest, md5('{MIX_SEED}:' || whole || ':' || coalesce(doc_id::VARCHAR, 'null')) AS h
      FROM d JOIN plan USING (domain, language, origin)),
k AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, language, origin ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM h),
f AS (SELECT *, whole + CASE WHEN whole < {MIX_EPOCHS} AND rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS copies FROM k)
SELECT doc_id, domain, language, origin, n_tokens::BIGINT AS n_tokens, unnest(range(copies)) AS epoch, tokens AS leaf_tokens, budget AS leaf_budget FROM f""")
    return "WITH" + ",".join(ctes)


QUERIES = {"op1_katz_scores": op1_katz_scores, "op2_exact_dedup": op2_exact_dedup, "op3_quality_classifier": op3_quality_classifier,
           "op4_substring_dedup": op4_substring_dedup, "op5_embedding_dedup": op5_embedding_dedup, "op6_url_filter": op6_url_filter,
           "op7_html_extract": op7_html_extract, "op8_bpe": op8_bpe, "op9_minhash_dedup": op9_minhash_dedup,
           "op10_mix_sources": op10_mix_sources, **corpus_queries.QUERIES}
ORACLES = {"op2_exact_dedup": OP2_SQL, "op4_substring_dedup": OP4_SQL, "op5_embedding_dedup": OP5_SQL, "op6_url_filter": _url_sql(),
           "op9_minhash_dedup": OP9_SQL, "op10_mix_sources": _mix_sql(), **corpus_queries.ORACLES}
