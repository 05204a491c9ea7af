"""LM scoring by Katz backoff over words.

Counts are discounted after Good-Turing, and what the discounts free is handed to the lower order by
backoff weights that make every context sum to one exactly: over the words seen after the context
and, through the unigrams, over the whole vocabulary with one symbol for unknown words. A distribution none of
whose counts is discounted (all above K) is given half a count more, which goes to the unseen. The model lies in
tables partitioned by context. Documents are scored in blocks: a block sends each of its distinct
bigrams once, packed, to the shard of the bigram's context, where training counts of all blocks are
added up; the sums come back, and the block evaluates its tokens recursively, bigram to unigram.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.llm.blocks import deal, pack, unpack, unpack_texts
from gondola.llm.common import spread_scan, text_or_empty, written
from gondola.llm.words import _STEP, mix, pieces, utf8, words

#: Counts above K are reliable and stay undiscounted.
K = 5
#: Counts that the unseen get where nothing is discounted.
RESERVE = 0.5
#: Bytes of text in a block, and bytes of text for each shard of the bigram table, about.
BLOCK_BYTES, SHARD_BYTES = 12 << 20, 12 << 20
#: A context that holds over 1/HOT of all tokens (at most HOT of them) is split over shards by the next word.
HOT = 2000
#: Fingerprints of the start of a text (a context only) and of its end (a token).
START, END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)


def discounts(of: list[int]) -> list[float]:
    """Factors d[0..K] for counts r from the number of types seen r times, of[r]: Good-Turing with Katz's
    rescaling; counts too sparse for it get (r - 0.5) / r."""
    d = [1.0] + [(r - 0.5) / r for r in range(1, K + 1)]
    if all(of[r] for r in range(1, K + 2)):
        common = (K + 1) * of[K + 1] / of[1]
        if common < 1:
            good = [((r + 1) * of[r + 1] / (r * of[r]) - common) / (1 - common) for r in range(1, K + 1)]
            d[1:] = [g if 0 < g < 1 else x for g, x in zip(good, d[1:])]
    return d


def factor(c: np.ndarray, d: list[float]) -> np.ndarray:
    return np.where(c > K, 1.0, np.array(d)[np.minimum(c, K).astype(np.int64)])


def _tokens(data, offsets):
    """Fingerprints of contexts and tokens of all rows: words and one end, and the first token of each row."""
    h, _, _, first = words(data, offsets, fold=True)
    n = len(offsets) - 1
    token = np.insert(h, first[1:], END)
    first = first + np.arange(n + 1)
    context = np.empty_like(token)
    context[1:] = token[:-1]
    context[first[:-1]] = START
    return context, token, first


def _count(batches):
    for batch in batches:
        data, offsets = utf8(batch.column(0))
        met: list = []

        def flush():
            w, n = np.unique(np.concatenate(met), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(n.astype(np.int64))], names=["w", "n"])

        for i, j in pieces(offsets):
            own = offsets[i:j + 1]
            met.append(_tokens(data[own[0]:own[-1]], own - own[0])[1])
            if sum(map(len, met)) > 2_000_000:
                yield flush()
                met = []
        if met:
            yield flush()


def _block_tokens(table: pa.Table):
    """Contexts, tokens and first token of each row of a whole block."""
    c, t, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for at in range(0, len(table), 256):
        data, offsets = unpack_texts(table["z"], at, 256)
        for i, j in pieces(offsets):
            own = offsets[i:j + 1]
            context, token, first = _tokens(data[own[0]:own[-1]], own - own[0])
            c.append(context)
            t.append(token)
            sizes.append(np.diff(first))
    return np.concatenate(c), np.concatenate(t), np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int64)


def _split(keys: np.ndarray, shards: int):
    """The order of sorted keys by shard (the signed key modulo shards), and each shard's range in it."""
    shard = keys.view(np.int64) % shards
    order = np.argsort(shard, kind="stable")
    return order, np.searchsorted(shard[order], np.arange(shards + 1))


def _words_of(shards: int):
    """A block's distinct words, packed, one row per shard."""

    def run(table: pa.Table) -> pa.Table:
        met = [np.array([START, END])]
        for at in range(0, len(table), 256):
            data, offsets = unpack_texts(table["z"], at, 256)
            for i, j in pieces(offsets):
                own = offsets[i:j + 1]
                met.append(np.unique(words(data[own[0]:own[-1]], own - own[0], fold=True)[0]))
        keys = np.unique(np.concatenate(met))
        order, at = _split(keys, shards)
        z = [pack(keys[order[at[s]:at[s + 1]]]) for s in range(shards)]
        return pa.table({"shard": pa.array(range(shards), pa.int64()), "block": pa.array([table["block"][0].as_py()] * shards, pa.int64()), "z": pa.array(z, pa.binary())})

    return run


def _answer(asked: pa.Table, known: pa.Table) -> pa.Table:
    """Counts and backoff weights of asked words, in the order asked; an unknown word has count 0 and weight 1."""
    key = np.append(known["w"].to_numpy().view(np.uint64), np.uint64(0))
    order = np.argsort(key)
    key, c, alpha = key[order], np.append(known["c"].to_numpy(), 0)[order], np.append(known["alpha"].to_numpy(), 1.0)[order]
    out = []
    for z in asked["z"].to_pylist():
        w = unpack(z)[0]
        at = np.minimum(np.searchsorted(key, w), len(key) - 1)
        hit = key[at] == w
        out.append(pack(np.where(hit, c[at], 0), np.where(hit, alpha[at], 1.0).view(np.uint64)))
    return pa.table({"block": asked["block"], "shard": asked["shard"], "z": pa.array(out, pa.binary())})


def _lookup(context, token, answers: pa.Table, shards: int):
    """(words of the block, counts, backoff weights), from the packed answers of all shards."""
    key = np.unique(np.concatenate([[START, END], token]))
    order, _ = _split(key, shards)
    got = [unpack(z) for z in answers.sort_by("shard")["z"].to_pylist()]
    c, alpha = np.empty(len(key), np.int64), np.empty(len(key))
    c[order] = np.concatenate([g[0] for g in got]).astype(np.int64)
    alpha[order] = np.concatenate([g[1] for g in got]).view(np.float64)
    return key, c, alpha


def _bigrams(context, token):
    """Distinct bigrams in a fixed order: (context, token, index of each token's bigram)."""
    print_ = mix(context * _STEP + token)
    _, at, inverse = np.unique(print_, return_index=True, return_inverse=True)
    return context[at], token[at], inverse


def _shards(context, token, count_of_context, total: int, shards: int):
    hot = count_of_context * HOT > total
    return (mix(np.where(hot, mix(context + token), context)) % np.uint64(shards)).astype(np.int64)


def _request(total: int, shards: int):
    """Each block's distinct bigrams with their training counts, one packed row per shard."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        context, token, first = _block_tokens(docs)
        key, c, _ = _lookup(context, token, answers, shards)
        left, right, inverse = _bigrams(context, token)
        learn = np.repeat(~docs["held_out"].to_numpy(zero_copy_only=False).astype(bool), np.diff(first))
        seen = np.bincount(inverse[learn], minlength=len(left))
        shard = _shards(left, right, c[np.searchsorted(key, left)], total, shards)
        out = []
        order = np.argsort(shard, kind="stable")
        edges = np.searchsorted(shard[order], np.arange(shards + 1))
        for s in range(shards):
            at = order[edges[s]:edges[s + 1]]
            if len(at):
                lw, li = np.unique(left[at], return_inverse=True)
                rw, ri = np.unique(right[at], return_inverse=True)
                out.append((s, pack(lw, li, rw, ri, c[np.searchsorted(key, rw)], seen[at])))
        return pa.table({"shard": pa.array([s for s, _ in out], pa.int64()), "block": pa.array([docs["block"][0].as_py()] * len(out), pa.int64()),
                         "z": pa.array([z for _, z in out], pa.binary())})

    return run


def _merge(norm: float, d1: list[float]):
    """Adds up a shard's bigrams. Rows: a block's counts (kind 0), a context's sums (kind 1), types seen r times (kind 2)."""

    def run(table: pa.Table) -> pa.Table:
        prints, lefts, p1, seen, sizes = [], [], [], [], []
        for z in table["z"].to_pylist():
            lw, li, rw, ri, c, n = unpack(z)
            li, ri = li.astype(np.int64), ri.astype(np.int64)
            prints.append(mix(lw[li] * _STEP + rw[ri]))
            lefts.append(lw[li])
            p1.append((factor(c, d1) * c / norm)[ri])
            seen.append(n.astype(np.int64))
            sizes.append(len(li))
        _, at, inverse = np.unique(np.concatenate(prints), return_index=True, return_inverse=True)
        counts = np.bincount(inverse, weights=np.concatenate(seen)).astype(np.int64)
        kinds, keys, values, sums = [], [], [], []
        ends = np.cumsum(sizes)
        for block, end, size in zip(table["block"].to_pylist(), ends.tolist(), sizes):
            kinds.append(0)
            keys.append(block)
            values.append(pack(counts[inverse[end - size:end]].astype(np.uint64)))
            sums.append(None)
        known = np.flatnonzero(counts)
        c, left, low = counts[known], np.concatenate(lefts)[at][known], np.concatenate(p1)[at][known]
        if len(known):
            for r, n in enumerate(np.bincount(c[c <= K + 1], minlength=K + 2).tolist()):
                kinds.append(2)
                keys.append(r)
                values.append(None)
                sums.append([float(n)])
        h, of = np.unique(left, return_inverse=True)
        parts = [np.bincount(of, weights=np.where(c == r, r, 0), minlength=len(h)) for r in range(1, K + 1)]
        parts += [np.bincount(of, weights=np.where(c > K, c, 0), minlength=len(h)), np.bincount(of, weights=low, minlength=len(h))]
        whole = pa.table({"kind": pa.array(kinds, pa.int32()), "key": pa.array(keys, pa.int64()), "shard": pa.array([table["shard"][0].as_py()] * len(kinds), pa.int64()),
                          "z": pa.array(values, pa.binary()), "sums": pa.array(sums, pa.list_(pa.float64()))})
        context = pa.table({"kind": pa.array(np.ones(len(h), np.int32)), "key": pa.array(h.view(np.int64)), "shard": pa.array(np.full(len(h), table["shard"][0].as_py())),
                            "z": pa.nulls(len(h), pa.binary()),
                            "sums": pa.array(list(np.stack(parts, 1)) if len(h) else [], pa.list_(pa.float64()))})
        return pa.concat_tables([whole, context])

    return run


def _evaluate(total: int, norm: float, types: int, d1: list[float], d2: list[float], unknown: float, shards: int):
    """Scores of a block's documents from its words' unigram counts and backoff weights and its bigrams' counts."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        context, token, first = _block_tokens(docs)
        is_word = pa.compute.equal(answers["kind"], 1)
        key, c, alpha = _lookup(context, token, answers.filter(is_word), shards)
        left, right, inverse = _bigrams(context, token)
        at_left, at_right = np.searchsorted(key, left), np.searchsorted(key, right)
        order = np.argsort(_shards(left, right, c[at_left], total, shards), kind="stable")
        packed = answers.filter(pa.compute.invert(is_word)).sort_by("shard")
        n2 = np.zeros(len(left), np.int64)
        n2[order] = np.concatenate([unpack(z)[0] for z in packed["z"].to_pylist()] + [np.zeros(0, np.uint64)]).astype(np.int64)
        c1 = c[at_right]
        p1 = np.where(c1 > 0, factor(c1, d1) * c1 / norm, unknown)
        weight = alpha[at_left]
        ch = np.maximum(c[at_left], 1) + np.where(weight < 0, RESERVE, 0)
        p2 = np.where(n2 > 0, factor(n2, d2) * n2 / ch, np.abs(weight) * p1)
        log2, base = np.log10(p2)[inverse], np.log10((c1 + 0.5) / (total + 0.5 * (types + 1)))[inverse]
        n = np.diff(first)
        return pa.table({"id": docs["id"], "held_out": docs["held_out"], "n_tokens": pa.array(n, pa.int64()),
                         "n_known": pa.array(np.add.reduceat((c1 > 0).astype(np.int64)[inverse], first[:-1])),
                         "base_score": pa.array(np.add.reduceat(base, first[:-1])), "score": pa.array(np.add.reduceat(log2, first[:-1]))})

    return run


def katz_scores(df: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: ``id``, ``held_out``, ``n_tokens`` (words, lower-cased A-Z, and one end), ``n_known`` (those that occur in training),
    ``train_tokens``, ``base_score`` (add-half unigrams) and ``score`` (log10 probability of the text under the model).

    The model learns from the rows where ``held_out`` is not true; null counts as not. A null or empty text
    is one end token. Rows that repeat are learnt from and scored each; null ids are allowed. Without training
    rows the only symbol is the unknown one, of probability 1 (score 0). An empty table gives an empty result; extra
    columns are ignored.
    """
    spark = df.sparkSession
    src = df.select(F.col(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.xxhash64(text_or_empty(text_col)).alias("fp"),
                    text_or_empty(text_col).alias("text"))
    learn = src.where(~F.col("held_out")).select("text")
    unigrams = written(spread_scan(learn).mapInArrow(_count, "w long, n long").groupBy("w").agg(F.sum("n").alias("c")), "katz-unigrams")
    stat = unigrams.agg(F.sum("c").alias("total"), F.count(F.lit(1)).alias("types"), *[F.count_if(F.col("c") == r).alias(f"n{r}") for r in range(1, K + 2)],
                        F.sum(F.when(F.col("w") == int(END.view(np.int64)), F.col("c"))).alias("texts")).first()
    total, types, texts = stat.total or 0, stat.types, stat.texts or 0
    d1 = discounts([0] + [stat[f"n{r}"] for r in range(1, K + 2)])
    seen = unigrams.agg(F.sum(_discounted(F.col("c"), d1))).first()[0] or 0.0
    # where no count is discounted, the unseen get a reserved part of a count
    norm = (total + RESERVE if seen >= total else float(total)) if total else 1.0
    unknown = (norm - seen) / norm
    start = spark.range(1).select(F.lit(int(START.view(np.int64))).alias("w"), F.lit(texts).cast("long").alias("c"))

    dealt = deal(src, ["id", "fp"], BLOCK_BYTES)
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(spark.sparkContext.defaultParallelism, -(-size // SHARD_BYTES))
    asked = dealt.groupBy("block").applyInArrow(_words_of(shards), "shard long, block long, z binary")
    known = unigrams.union(start)

    def answered(words_: DataFrame) -> DataFrame:
        by = words_.withColumn("shard", F.pmod("w", F.lit(shards)))
        return asked.repartition(shards, "shard").groupBy("shard").cogroup(by.repartition(shards, "shard").groupBy("shard")).applyInArrow(
            _answer, "block long, shard long, z binary")

    requests = dealt.groupBy("block").cogroup(answered(known.withColumn("alpha", F.lit(1.0))).groupBy("block")).applyInArrow(
        _request(max(total, 1), shards), "shard long, block long, z binary")
    merged = requests.repartition(shards, "shard").groupBy("shard").applyInArrow(
        _merge(norm, d1), "kind int, key long, shard long, z binary, sums array<double>")
    merged = written(merged, "katz-bigrams")
    of = {int(r.key): int(r.n) for r in merged.where("kind = 2").groupBy("key").agg(F.sum(F.col("sums")[0]).alias("n")).collect()}
    d2 = discounts([of.get(r, 0) for r in range(K + 2)])
    # a context's parts may lie in several shards when it was split
    parts = merged.where("kind = 1").select(F.col("key").alias("w"), *[F.col("sums")[i].alias(f"s{i}") for i in range(K + 2)])
    parts = parts.groupBy("w").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(K + 2)])
    used = sum((F.col(f"s{r - 1}") * d2[r] for r in range(1, K + 1)), F.col(f"s{K}"))
    every = sum((F.col(f"s{r}") for r in range(K + 1)), F.lit(0.0))
    # what the context's followers leave of the unigrams: at least the unknown symbol. A context without a discounted
    # follower has RESERVE more counts, which its weight tells by a negative sign.
    rest = F.greatest(1 - F.col(f"s{K + 1}"), F.lit(unknown))
    alpha = F.when(used < every, (1 - used / every) / rest).otherwise(-F.lit(RESERVE) / (every + RESERVE) / rest)
    weights = parts.select("w", alpha.alias("alpha"))
    table = written(known.join(weights, "w", "left").select("w", "c", F.coalesce("alpha", F.lit(1.0)).alias("alpha")), "katz-model")
    words_back = answered(table).withColumn("kind", F.lit(1))
    counts_back = merged.where("kind = 0").select(F.col("key").alias("block"), "shard", "z", F.lit(0).alias("kind"))
    kind = src.schema["id"].dataType.simpleString()
    out = dealt.groupBy("block").cogroup(words_back.union(counts_back).groupBy("block")).applyInArrow(
        _evaluate(max(total, 1), norm, types, d1, d2, unknown, shards), f"id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select("id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def _discounted(c: Column, d: list[float]) -> Column:
    out = c.cast("double")
    for r in range(1, K + 1):
        out = F.when(c == r, F.lit(r * d[r])).otherwise(out)
    return out
