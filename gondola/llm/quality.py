"""Quality classifier: interpolated modified Kneser-Ney over bytes, trained on trusted text.

Tokens are the UTF-8 bytes of a text and one end; an n-gram of five packs into one integer. Counts,
continuation counts and context sums of all orders are Spark aggregates sharded by n-gram. To score,
documents are dealt into blocks; each block asks once for each of its distinct 5-grams, the asked
5-grams join the count tables order by order, and the answers meet the block's documents again. A
document is rejected when its cross-entropy exceeds a quantile of its language's trusted documents
that took no part in training.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm.blocks import deal, unpack_texts
from gondola.llm.common import spread_scan, text_or_empty, written
from gondola.llm.words import pieces, utf8

ORDER = 5
START, END = 0xFF, 0xFE  # bytes that UTF-8 never uses
SYMBOLS = 257
#: Trusted documents the model is fitted on, at most about this many, chosen by hash of their id.
TRAIN_DOCS = 20_000
#: Every HELD-th trusted document (by hash) is left out of training and sets the thresholds.
HELD = 5
#: Quantile of a language's held-out trusted documents, and the slack on top of it (bits per byte).
QUANTILE, SLACK = 0.99, 0.15
#: Tokens of the language's median entropy that every text is judged with.
STEADY = 64
#: Languages with fewer held-out trusted documents use the quantile over all languages.
LEAST_HELD = 30
#: Above so many languages their quantiles are joined by shuffle instead of broadcast.
BROADCAST_LANGS = 10_000
#: Bytes of text in a block, about.
BLOCK_BYTES = 32 << 20


def grams(data: np.ndarray, offsets: np.ndarray):
    """(5-grams of all rows as packed integers, first): row i has grams first[i] to first[i+1],
    one for each byte and one for the end."""
    n = len(offsets) - 1
    pad = ORDER - 1
    sizes = np.diff(offsets)
    at = offsets[:-1] + np.arange(n) * (pad + 1)
    flat = np.full(int(offsets[-1]) + n * (pad + 1) + pad, START, np.uint64)
    keep = np.zeros(len(flat), bool)
    place = np.arange(len(data)) + np.repeat(np.arange(n) * (pad + 1) + pad, sizes)
    flat[place] = data
    end = at + pad + sizes
    flat[end] = END
    keep[place] = True
    keep[end] = True
    packed = np.zeros(len(flat), np.uint64)
    for j in range(ORDER):
        packed[pad:] |= flat[pad - j:len(flat) - j] << np.uint64(8 * j)
    first = np.concatenate([[0], np.cumsum(sizes + 1)])
    return packed[keep].astype(np.int64), first


def _count(batches):
    for batch in batches:
        data, offsets = utf8(batch.column(0))
        for i, j in pieces(offsets):
            at = offsets[i:j + 1]
            g, n = np.unique(grams(data[at[0]:at[-1]], at - at[0])[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(n.astype(np.int64))], names=["gram", "n"])


def train(texts: DataFrame) -> dict:
    """Count tables of the Kneser-Ney model: for each order the counts (key, c), for each higher order the
    contexts (key, total, back) with their backoff mass, and the discounts."""
    top = written(spread_scan(texts).mapInArrow(_count, "gram long, n long").groupBy(F.col("gram").alias("key")).agg(F.sum("n").alias("c")), "kn-5")
    counts = {ORDER: top}
    for n in range(ORDER - 1, 0, -1):
        # how many different symbols stand before an n-gram
        counts[n] = written(counts[n + 1].groupBy(F.col("key").bitwiseAND((1 << 8 * n) - 1).alias("key")).agg(F.count(F.lit(1)).alias("c")), f"kn-{n}")
    model = {"counts": counts, "contexts": {}, "discounts": {}}
    for n in range(1, ORDER + 1):
        r = counts[n].agg(*[F.count_if(F.col("c") == k).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
        y = r.n1 / (r.n1 + 2 * r.n2) if r.n1 and r.n2 else 0.5
        d = [k - (k + 1) * y * a / b if a and b else 0.5 for k, a, b in ((1, r.n2, r.n1), (2, r.n3, r.n2), (3, r.n4, r.n3))]
        model["discounts"][n] = [min(max(x, 0.05), k) for k, x in zip((1, 2, 3), d)]
        d1, d2, d3 = model["discounts"][n]
        lost = F.when(F.col("c") == 1, F.lit(d1)).when(F.col("c") == 2, F.lit(d2)).otherwise(F.lit(d3))
        sums = counts[n].groupBy(F.shiftright("key", 8).alias("key")).agg(F.sum("c").alias("total"), (F.sum(lost) / F.sum("c")).alias("back"))
        if n == 1:
            row = sums.first()
            model["root"] = (row.total, row.back) if row else (0, 1.0)
        else:
            model["contexts"][n] = written(sums, f"kn-context-{n}")
    return model


def gram_logs(asked: DataFrame, model: dict) -> DataFrame:
    """(gram, bits): minus log2 of the model's probability of each asked 5-gram's last symbol."""
    total, back = model["root"]
    out = asked.withColumn("p", F.lit(1.0 / SYMBOLS))
    for n in range(1, ORDER + 1):
        d1, d2, d3 = model["discounts"][n]
        out = out.withColumn("key", F.col("gram").bitwiseAND((1 << 8 * n) - 1)).join(model["counts"][n], "key", "left")
        c = F.coalesce("c", F.lit(0))
        own = F.when(c == 0, 0.0).when(c == 1, c - d1).when(c == 2, c - d2).otherwise(c - d3)
        if n == 1:
            p = F.lit(0.0) if not total else own / F.lit(float(total))
            out = out.withColumn("p", p + F.lit(back) * F.col("p")).drop("key", "c")
        else:
            out = out.withColumn("key", F.shiftright("key", 8)).join(model["contexts"][n], "key", "left")
            out = out.withColumn("p", F.when(F.col("total").isNull(), F.col("p")).otherwise(own / F.col("total") + F.col("back") * F.col("p")))
            out = out.drop("key", "c", "total", "back")
    return out.select("gram", (-F.log2("p")).alias("bits"))


def _ask(table: pa.Table) -> pa.Table:
    met = [np.zeros(0, np.int64)]
    for at in range(0, len(table), 256):
        data, offsets = unpack_texts(table["z"], at, 256)
        for i, j in pieces(offsets):
            own = offsets[i:j + 1]
            met.append(np.unique(grams(data[own[0]:own[-1]], own - own[0])[0]))
        if len(met) > 16:
            met = [np.unique(np.concatenate(met))]
    g = np.unique(np.concatenate(met))
    return pa.table({"block": pa.array(np.full(len(g), table["block"][0].as_py()), pa.int64()), "gram": pa.array(g)})


def _score(docs: pa.Table, answers: pa.Table) -> pa.Table:
    key = answers["gram"].to_numpy()
    order = np.argsort(key)
    key, bits = key[order], answers["bits"].to_numpy()[order]
    n, total = [], []
    for at in range(0, len(docs), 256):
        data, offsets = unpack_texts(docs["z"], at, 256)
        for i, j in pieces(offsets):
            own = offsets[i:j + 1]
            g, first = grams(data[own[0]:own[-1]], own - own[0])
            total += np.add.reduceat(bits[np.searchsorted(key, g)], first[:-1]).tolist()
            n += np.diff(first).tolist()
    return pa.table({"id": docs["id"], "lang": docs["lang"], "fp": docs["fp"], "n_tokens": pa.array(n, pa.int64()), "bits": pa.array(total, pa.float64())})


def perplexity(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: ``id``, ``lang``, ``fp`` (hash of the text), ``n_tokens`` and ``bits`` (cross-entropy of the
    whole text in all, not per token)."""
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(lang_col).cast("string"), F.lit("?")).alias("lang"),
                      F.xxhash64(text_or_empty(text_col)).alias("fp"), text_or_empty(text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    dealt = deal(src, ["id", "fp"], BLOCK_BYTES)
    asked = dealt.groupBy("block").applyInArrow(_ask, "block long, gram long")
    logs = gram_logs(asked.select("gram").distinct(), model)
    answers = asked.join(logs, "gram")
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _score, f"id {kind}, lang string, fp long, n_tokens long, bits double")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             train_docs: int = TRAIN_DOCS, quantile: float = QUANTILE, slack: float = SLACK) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``lang``, ``fp`` (hash of the text), ``n_tokens`` (bytes and one end),
    ``entropy`` (bits per token), ``perplexity`` (2 to it), ``judged`` (the entropy with STEADY tokens of its
    language's median entropy added, so that a text of a few tokens isn't rejected for chance), ``threshold``
    and ``kept`` (judged <= threshold).

    ``labels`` (id, trusted 0/1): a document is trusted when all its labels say so. Null texts count as
    empty; a null language is one of its own, named ``?``; a row without an id is scored but never trusted; rows
    that repeat are scored each. Without any trusted document nothing is rejected (threshold null). Empty tables give
    an empty result; extra columns are ignored.
    """
    trusted = written(labels.where("id is not null and trusted is not null").groupBy("id").agg(F.min("trusted").alias("t")).where("t = 1").select(
        "id", F.pmod(F.xxhash64("id"), F.lit(1_000_000)).alias("h")), "kn-trusted")
    n = trusted.count()
    part = min(1.0, train_docs / max(1, n))
    sample = trusted.where((F.col("h") % HELD != 0) & (F.floor(F.col("h") / HELD) < int(part * 1_000_000 / HELD)))
    # the sample's size is bounded by train_docs, so its ids may be broadcast
    texts = docs.join(F.broadcast(sample.select(F.col("id").alias(id_col))), id_col, "left_semi").select(text_or_empty(text_col).alias("text"))
    model = train(texts)
    scored = written(perplexity(docs, model, id_col, text_col, lang_col).withColumn("entropy", F.col("bits") / F.col("n_tokens")), "kn-scores")
    held = scored.join(trusted.where(F.col("h") % HELD == 0).select("id"), "id").select("lang", "bits", "n_tokens", "entropy")

    def by_language(rows: DataFrame, column: str, q: float, name: str):
        """Quantile of each language with enough rows, and of all rows."""
        own = rows.groupBy("lang").agg(F.percentile_approx(column, q, 10_000).alias(name), F.count(F.lit(1)).alias("m"))
        own = written(own.where(F.col("m") >= LEAST_HELD).select("lang", name), f"kn-{name.replace('_', '-')}")
        small = own.count() <= BROADCAST_LANGS
        return F.broadcast(own) if small else own, rows.agg(F.percentile_approx(column, q, 10_000)).first()[0]

    centers, center = by_language(held, "entropy", 0.5, "own_center")

    def judged(rows: DataFrame) -> DataFrame:
        c = F.coalesce("own_center", F.lit(center).cast("double"))
        return rows.join(centers, "lang", "left").withColumn("judged", (F.col("bits") + STEADY * c) / (F.col("n_tokens") + STEADY)).drop("own_center")

    limits, limit_all = by_language(judged(held), "judged", quantile, "own_limit")
    limit = F.coalesce("own_limit", F.lit(limit_all).cast("double")) + slack
    out = judged(scored).join(limits, "lang", "left")
    return out.select("id", "lang", "fp", "n_tokens", "entropy", F.pow(F.lit(2.0), "entropy").alias("perplexity"), "judged", limit.alias("threshold"),
                      F.coalesce(F.col("judged") <= limit, F.lit(True)).alias("kept"))
