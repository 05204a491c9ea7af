"""Brute force for the Kneser-Ney model, the cells of the vectors, and every stage of the pipeline."""

import base64
import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from conftest import SF_SMALL

from gondola.llm import quality
from gondola.llm import queries as q
from gondola.llm.embed_dedup import embedding_dedup
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def kneser_ney(texts):
    """p(context of four symbols, symbol) of the modified Kneser-Ney model, by its definition over plain dictionaries."""
    seqs = [[255] * 4 + list(t.encode()) + [254] for t in texts]
    counts = {5: Counter(tuple(s[i - 4:i + 1]) for s in seqs for i in range(4, len(s)))}
    for n in (4, 3, 2, 1):
        before = defaultdict(set)
        for g in counts[n + 1]:
            before[g[1:]].add(g[0])
        counts[n] = Counter({g: len(b) for g, b in before.items()})
    cuts, rows = {}, {n: defaultdict(dict) for n in counts}
    for n, table in counts.items():
        of = Counter(table.values())
        y = of[1] / (of[1] + 2 * of[2]) if of[1] and of[2] else 0.5
        d = [k - (k + 1) * y * of[k + 1] / of[k] if of[k] and of[k + 1] else 0.5 for k in (1, 2, 3)]
        cuts[n] = [min(max(x, 0.05), k) for x, k in zip(d, (1, 2, 3))]
        for g, c in table.items():
            rows[n][g[:-1]][g[-1]] = c

    def p(context, symbol, n=5):
        if n == 0:
            return 1 / 257
        lower = p(context[1:], symbol, n - 1)
        seen = rows[n].get(context)
        if not seen:
            return lower
        lost = [cuts[n][min(c, 3) - 1] for c in seen.values()]
        c = seen.get(symbol, 0)
        own = c - cuts[n][min(c, 3) - 1] if c else 0.0
        return (own + sum(lost) * lower) / sum(seen.values())

    return p


def test_perplexity_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join("".join(rng.choice(list("abeñ"), rng.integers(1, 5))) for _ in range(rng.integers(1, 40))) for _ in range(25)]
    asked = texts[:3] + ["", None, "zzz unseen", "abe abe abe", texts[0], "日本 🙂"]
    model = quality.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    docs = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string").withColumn("lang", F.lit("x"))
    got = {r.id: r for r in quality.perplexity(docs, model).collect()}
    p = kneser_ney(texts)
    for i, t in enumerate(asked):
        s = [255] * 4 + list((t or "").encode()) + [254]
        want = -sum(math.log2(p(tuple(s[j - 4:j]), s[j])) for j in range(4, len(s)))
        assert got[i].n_tokens == len(s) - 4 and got[i].bits == pytest.approx(want, rel=1e-9), t
    for context in [(255,) * 4, tuple(texts[0].encode()[:4]), (1, 2, 3, 4)]:
        assert sum(p(context, w) for w in range(257)) == pytest.approx(1.0)


def test_links_of_many_cells(spark):
    """Cells far outnumber the probes: every link that is found is one, and at least 0.9 of them are found."""
    rng = np.random.default_rng(9)
    base = rng.normal(size=(900, 24))
    near = base[rng.integers(0, 900, 1100)] + rng.normal(size=(1100, 24)) * rng.uniform(0.0, 0.6, (1100, 1))
    x = np.concatenate([base, near]).astype(np.float32)
    df = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r.id: r for r in embedding_dedup(df, cell_rows=20).collect()}
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    links = unit @ unit.T >= 0.9
    np.fill_diagonal(links, False)
    true, found = links.sum(1), np.array([got[i].n_links for i in range(len(x))])
    assert (found <= true).all() and found.sum() >= 0.9 * true.sum() and true.sum() > 500


def documents(spark):
    odd = [(-1, None, "en", "s1", 0), (-2, "", None, None, 0), (-3, "", "en", "s1", 0), (-4, "a b c", "en", "s1", 5),
           (-4, "a b c", "en", "s1", 5), (None, "a b c", "en", "s1", 5)]
    given = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    return given.unionByName(spark.createDataFrame(odd, given.schema))


def rows_of(df):
    return Counter((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df.collect())


def test_quality_stage_drops_what_the_classifier_rejects(spark):
    docs = documents(spark)
    verdict = {(r.doc_id, r.kept) for r in q.op3_quality_classifier(spark, SF_SMALL).select("doc_id", "kept").collect()}
    out = corpus_pipeline.quality_classifier(spark, spark.read.parquet(f"{SF_SMALL}/documents.parquet"), SF_SMALL)
    assert {r.doc_id for r in out.collect()} == {d for d, kept in verdict if kept}
    kept = rows_of(corpus_pipeline.quality_classifier(spark, docs, SF_SMALL))
    assert not kept - rows_of(docs) and kept[(-4, "a b c", "en", "s1", 5)] == 2


def test_exact_stage_against_brute_force(spark):
    docs = documents(spark)
    best = {}
    for r in docs.collect():
        text = r.text or ""
        best[text] = max(best.get(text, -10**9), -10**9 if r.doc_id is None else r.doc_id)
    out = corpus_pipeline.exact(spark, docs, SF_SMALL)
    assert out.columns == docs.columns
    assert Counter((r.text or "", r.doc_id) for r in out.collect()) == Counter(best.items())


def test_minhash_stage_against_brute_force(spark):
    docs = documents(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    sets = {}
    for r in docs.collect():
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))
        sets[r.doc_id] = {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    ids = sorted(sets)
    root = {i: i for i in ids}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                i, j = sorted((top(a), top(b)))
                root[j] = i
    out = corpus_pipeline.minhash(spark, docs, SF_SMALL)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [i for i in ids if top(i) == i]


def test_mixing_stage_equals_the_sql_of_the_mix(spark, duck_small):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = corpus_pipeline.mixing(spark, docs, SF_SMALL)
    assert out.columns == docs.columns
    want = duck_small.execute(q.ORACLES["op10_mix_sources"]).fetchdf()
    assert Counter(r.doc_id for r in out.collect()) == Counter(want["doc_id"].tolist())
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.text == texts[r.doc_id] for r in out.collect())


def test_bpe_stage_against_tiktoken(spark):
    import public_tokenizers as P
    import tiktoken

    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = documents(spark)
    want = Counter()
    for r in docs.collect():
        ids = enc.encode_ordinary(r.text or "")
        want[r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256((r.text or "").encode()).hexdigest()] += 1
    got = corpus_pipeline.bpe(spark, docs, SF_SMALL).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert Counter(map(tuple, got.collect())) == want


def test_budgets_of_more_tokens_than_64_bit_products_hold(spark):
    from gondola.llm.mixing import leaf_budgets

    big = 10**17
    leaves = spark.createDataFrame([("a", 3 * big), ("b", big), ("c", 10 * big)], "s string, tokens long")
    got = {r.s: r.budget for r in leaf_budgets(leaves, ["s"], {"s": {"a": 1000, "b": 999, "c": 1}}, (1, 2), 1).collect()}
    # a and b can't use their shares of 7 * big and are taken whole; c takes what they leave
    assert got == {"a": 3 * big, "b": big, "c": 3 * big}
    got = {r.s: r.budget for r in leaf_budgets(leaves, ["s"], {"s": {"a": 1000, "b": 1000, "c": 1000}}, (1, 2), 1).collect()}
    assert got == {"a": 3 * big, "b": big, "c": 3 * big}


def test_quantiles_by_shuffle_when_languages_are_many(spark, monkeypatch):
    from gondola.llm import quality

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = q.trusted_labels(spark, SF_SMALL)
    want = Counter(map(tuple, quality.classify(docs, labels).select("id", "threshold", "kept").collect()))
    monkeypatch.setattr(quality, "BROADCAST_LANGS", 0)
    assert Counter(map(tuple, quality.classify(docs, labels).select("id", "threshold", "kept").collect())) == want
