"""Training-data operators: oracles on the smallest tables, brute force, round trips, and odd rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from conftest import SF_SMALL
from oracle_check import compare

from gondola.llm import queries as q
from gondola.llm.bpe import bpe_round_trip
from gondola.llm.embed_dedup import embedding_dedup
from gondola.llm.exact_dedup import exact_dedup
from gondola.llm.html_extract import Page, extract_main
from gondola.llm.katz import K, discounts, katz_scores
from gondola.llm.minhash import near_dedup
from gondola.llm.mixing import mix_sources
from gondola.llm.quality import classify
from gondola.llm.substrings import substring_dedup
from gondola.llm.url_filter import filter_urls
from pyspark.sql import functions as F

#: Nulls, empty and blank texts, ties, repeated rows, a long text, and extra columns with names used inside.
ODD = [(1, None, "x", 1), (2, "", None, 2), (3, " \t\n", "x", 3), (4, "a b c", "y", 4), (5, "a b c", "y", 4), (5, "a b c", "y", 4),
       (None, "a b c", "x", 5), (6, "w " * 30_000, "z", 6), (7, "Ünï 日本 🙂 A b", None, None)]
ODD_SCHEMA = "doc_id long, text string, source string, kept long"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, ODD_SCHEMA)


@pytest.mark.parametrize("key", sorted(q.ORACLES))
def test_query_matches_oracle(spark, duck_small, key):
    r = compare(spark, duck_small, key, entry.queries()[key], entry.oracle_sql()[key], SF_SMALL)
    assert r["status"] == "ok", r


def test_katz_equals_brute_force_and_sums_to_one(spark):
    got = {r.doc_id: r for r in q.op1_katz_scores(spark, SF_SMALL).collect()}
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = {r.doc_id: re.findall(r"[^\x20\x09-\x0D]+", (r.text or "").translate(fold)) + [None]
              for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    c1, c2, ch = Counter(), Counter(), Counter()
    for k, ws in tokens.items():
        if zlib.crc32(str(k).encode()) % 5 != 1:
            for h, w in zip(["<s>"] + ws, ws):
                c1[w] += 1
                c2[h, w] += 1
                ch[h] += 1
    d1, d2 = (discounts([0] + [Counter(c.values())[r] for r in range(1, K + 2)]) for c in (c1, c2))
    total = sum(c1.values())
    used = lambda c, d: c if c > K else c * d[c]
    unknown = 1 - sum(used(c, d1) for c in c1.values()) / total
    p1 = lambda w: used(c1[w], d1) / total if w in c1 else unknown
    after = defaultdict(list)
    for (h, w), c in c2.items():
        after[h].append((w, c))
    full = {h: ch[h] + 0.5 * all(c > K for _, c in f) for h, f in after.items()}
    alpha = {h: (1 - sum(used(c, d2) for _, c in f) / full[h]) / (1 - sum(p1(w) for w, _ in f)) for h, f in after.items()}
    p2 = lambda h, w: used(c2[h, w], d2) / full[h] if (h, w) in c2 else alpha.get(h, 1.0) * p1(w)
    for h in list(after)[:20]:
        assert sum(p2(h, w) for w in c1) + alpha[h] * unknown == pytest.approx(1, abs=1e-9)
    for k, ws in tokens.items():
        assert got[k].score == pytest.approx(sum(math.log10(p2(h, w)) for h, w in zip(["<s>"] + ws, ws)), rel=1e-9)
        assert (got[k].n_tokens, got[k].train_tokens) == (len(ws), total)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_exact_dedup_of_a_hot_text_and_a_map_column(spark):
    """A third of all rows equal: the last stage meets one entry per salt, and no list of members."""
    rows = [(i, "hot" if i % 3 == 0 else f"t{i // 2}", {"k": i}) for i in range(900)] + [(897, "hot", {"k": 897})] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, m map<string,int>")
    out = exact_dedup(df, salts=16).collect()
    assert len(out) == 902
    hot = [r for r in out if r.text == "hot"]
    assert len(hot) == 302 and {(r.keep_id, r.group_size) for r in hot} == {(897, 302)} and sum(r.kept for r in hot) == 1
    for text in {r.text for r in out}:
        same = [r for r in out if r.text == text]
        assert sum(r.kept for r in same) == 1 and {r.keep_id for r in same} == {max(r.row.doc_id for r in same)} and {r.group_size for r in same} == {len(same)}
    # the exchange by content carries no members; the table of winners has at most one row per salt and text
    plan = exact_dedup(df, salts=16)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "collect_list" not in plan


def test_one_bad_label_does_not_block_a_host(spark):
    urls = [(0, "http://a.com/x/1")] + [(9, "http://a.com/x/100")] + [(i, f"http://b.com/x/{i}") for i in range(2, 52)]
    out = filter_urls(spark.createDataFrame(urls, "page_id long, url string"),
                      spark.createDataFrame([(1, 1)] + [(i, 0) for i in range(2, 52)], "key long, bad int")).collect()
    host = [r for r in out if r.host == "a.com"]
    prior = (1 + 5 * (1 / 51)) / (1 + 5)
    assert all(r.purity == pytest.approx((1 + 5 * prior) / 6, abs=1e-8) and r.verdict == "allow" for r in host) and len(host) == 2
    zero = filter_urls(spark.createDataFrame([(1, "http://c.com/00")], "page_id long, url string"), spark.createDataFrame([(0, 1)], "key long, bad int")).collect()
    assert zero[0].labelled == 1


def test_katz_of_few_and_repeated_texts(spark):
    """Whole vocabulary after one context, nothing discounted, nothing to learn from."""
    def scores(texts, held):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
        return {r.id: r.score for r in katz_scores(df, F.col("doc_id") >= held).collect()}

    for text, n in (("", 1), ("a a", 3)):
        got = scores([text] * 10, 10)
        assert len(got) == 10 and all(0 >= x > -n for x in got.values())
    got = scores(["a b"] * 10 + ["a zzz"], 10)
    # unigrams: 30 counts and half a one for the unknown; contexts <s> a, a b and b end: 10 counts and half a one each
    seen, unseen, back = 10 / 10.5, 0.5 / 10.5, 1 - 10 / 30.5
    assert got[0] == pytest.approx(3 * math.log10(seen)) and got[10] == pytest.approx(
        math.log10(seen) + math.log10(unseen / back * 0.5 / 30.5) + math.log10(10 / 30.5))
    assert scores(["x y"], 0) == {0: 0.0}


def test_bpe_equals_tiktoken(spark, odd):
    import base64

    import public_tokenizers as P
    import tiktoken

    path = P.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").union(odd.select("doc_id", "text"))
    docs = docs.union(spark.createDataFrame([(90, "ab" * 900 + "<|endoftext|>")], "doc_id long, text string")).collect()
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n", F.monotonically_increasing_id())
    got = bpe_round_trip(df, path, P.PATTERN, id_col="n", with_ids=True).join(df, F.col("id") == df.n).collect()
    assert len(got) == len(docs)
    for r in got:
        text = r["text"] or ""
        assert list(r.ids) == enc.encode_ordinary(text) and bytes(r.decoded) == text.encode()
        assert r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_quality_keeps_clean_and_rejects_junk(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = q.op3_quality_classifier(spark, sf).join(labels, "doc_id").select("quality", "kept").collect()
    clean, junk = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0]
    assert np.mean(clean) >= 0.98 and np.mean(junk) <= 0.4


def test_main_text_of_other_page_shapes():
    page = Page('<body><div id="header">Site</div><div class="cookie-notice">We use</div><div class="content post-12"><h1>T</h1><p>One &amp; two<p>Three '
                '<a href=x>four</a><div class="ad-box">buy</div><form>name</form></div><div id="comments"><p>great post indeed, long comment</div>')
    assert page.text(page.best()) == "T One & two Three four"
    assert Page("").text(None) == "" and Page("just text <b>bold").text(Page("x").best()) == "just text bold"


def test_deep_nesting_is_linear():
    import time

    deep = "".join(f"<div class=c{i % 7}>" + ("<p>some words of text" if i % 100 == 0 else "") for i in range(100_000))
    began = time.process_time()
    page = Page("<body>" + deep)
    assert page.text(page.best(["html>body>div.c#"])).startswith("some words of text some words")
    assert time.process_time() - began < 8  # 2 s on a free core


def test_rare_layout_keeps_its_own_container():
    story = " ".join(f"Long story number {i}." for i in range(30))
    page = Page(f'<body><div class="longread"><p>{story}</div><div class="post">see also</div></body>')
    assert page.text(page.best(["html>body>div.post"])) == story
    article = Page(f'<body><main><div class="a"><p>{story}</div><p>The end.</main></body>')
    assert article.text(article.best(["html>body>main"])) == story + " The end."


def test_weak_marker_words_inside_an_article_need_confirmation():
    text = "A paragraph about the notice that the court gave, which runs to more than eighty characters in all."
    page = Page(f'<article><p class="legal">{text}</p><p class="notice">{text}</p><div class="notice">Short</div><div class="comments">{text}</div></article>')
    assert page.text(page.best()) == f"{text} {text}"


def test_html_of_odd_rows_and_both_joins(spark, monkeypatch):
    from gondola.llm import html_extract

    rows = [(1, "http://h/1", "<p>one", "x"), (1, "http://h/1", "<p>one", "x"), (None, None, None, None), (3, "", "", ""), (4, "http://h/2", " ", "paths"),
            (5, "http://g/2", "<div class=post><p>" + "w " * 100_000, "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, paths string")
    want = sorted([(1, "one"), (1, "one"), (None, ""), (3, ""), (4, ""), (5, ("w " * 100_000).strip())], key=repr)
    assert sorted(((r.id, r.text) for r in extract_main(df).collect()), key=repr) == want
    monkeypatch.setattr(html_extract, "BROADCAST_BYTES", -1)
    assert sorted(((r.id, r.text) for r in extract_main(df).collect()), key=repr) == want
    assert extract_main(df.limit(0)).collect() == []


def test_html_query_equals_document_texts(spark):
    from html import unescape

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    source = {r.page_id: r.html for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    pages = q.op7_html_extract(spark, SF_SMALL).collect()
    seen = 0
    for r in pages:
        k = int(re.search(r"/(\d+)", r.url.split("://")[1])[1])
        if k in docs:
            seen += 1
            heading = unescape(re.search("<h1>(.*?)</h1>", source[r.page_id], re.S)[1])
            whole = [" ".join(t.split()) for t in (heading, docs[k])]
            assert r.text == " ".join(t for t in whole if t) and r.n_chars == len(r.text)
    assert seen


def test_vectors_without_direction_and_copies(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [0.0, 1.0]), (None, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("n", F.lit("clash"))
    got = sorted(((r.id or 0, r.n_links, r.component_id or 0, r.kept) for r in embedding_dedup(df).collect()))
    assert got[0] == (0, 0, 0, True) and got[1][:3] == (1, 2, 1)
    assert [g[1:] for g in got if g[0] in (3, 4, 5, 6)] == [(0, k, True) for k in (3, 4, 5, 6)]


def test_odd_rows_have_defined_results(spark, odd):
    e = exact_dedup(odd).select(F.col("row.doc_id").alias("d"), "keep_id", "group_size", "kept").collect()
    assert len(e) == len(ODD)
    assert sorted((r.d or 0, r.keep_id, r.group_size, r.kept) for r in e if r.group_size == 4) == [
        (0, 5, 4, False), (4, 5, 4, False), (5, 5, 4, False), (5, 5, 4, True)]
    assert [(r.keep_id, r.kept) for r in e if r.d in (1, 2)].count((2, True)) == 1
    m = {r.id: r for r in near_dedup(odd).collect()}
    assert m[5].component_id == 4 and m[4].kept and m[1].n_shingles == 0 and m[1].kept and m[6].n_shingles == 1
    s = {r.id: r for r in substring_dedup(odd).collect()}
    assert (s[6].n_words, s[6].n_removed, s[1].n_words, s[3].text) == (30_000, 29_999, 0, "")
    assert s[4].text == "a b c" and s[7].text == "Ünï 日本 🙂 A b"
    k = katz_scores(odd, F.col("doc_id") == 7).collect()
    assert len(k) == len(ODD) and all(r.score <= 0 for r in k) and {r.n_tokens for r in k if r.id in (1, 2, 3)} == {1}
    x = mix_sources(odd, {"a": F.col("source"), "b": F.col("kept")}, F.expr(q.TOKENS), fraction=(3, 1), max_epochs=2)
    assert Counter((r.row.doc_id, r.epoch) for r in x.where("n_tokens > 0").collect())[(4, 1)] == 1


@pytest.mark.parametrize("name", ["exact", "near", "substring", "katz", "mix", "classify", "bpe", "vectors", "urls", "pages"])
def test_empty_tables(spark, name):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([], "id long, trusted int")
    out = {
        "exact": lambda: exact_dedup(none), "near": lambda: near_dedup(none), "substring": lambda: substring_dedup(none),
        "katz": lambda: katz_scores(none, F.lit(False)), "classify": lambda: classify(none, labels),
        "mix": lambda: mix_sources(none, {"s": F.col("source")}, F.expr(q.TOKENS)),
        "bpe": lambda: bpe_round_trip(none, __import__("public_tokenizers").path("byte_bpe_50k.tiktoken"), __import__("public_tokenizers").PATTERN),
        "vectors": lambda: embedding_dedup(spark.createDataFrame([], "vec_id long, embedding array<float>")),
        "urls": lambda: filter_urls(spark.createDataFrame([], "page_id long, url string"), spark.createDataFrame([], "key long, bad int")),
        "pages": lambda: extract_main(spark.createDataFrame([], "page_id long, url string, html string"))}[name]()
    assert out.count() == 0


def test_pipeline_dedups_by_five_word_shingles(spark):
    words = [f"w{i}" for i in range(200)]
    five = [w + "x" if i in (20, 60, 100, 140, 180) else w for i, w in enumerate(words)]   # 0.816 of 4-word sets, 0.774 of 5-word sets
    two = [w + "x" if i in (20, 60) else w for i, w in enumerate(words)]   # 0.907 of 5-word sets
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(five))], "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.minhash(spark, docs, SF_SMALL).collect()) == [1, 2]
    assert sorted((r.id, r.kept) for r in near_dedup(docs, shingle=4).collect()) == [(1, True), (2, False)]
    close = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(two))], "doc_id long, text string")
    assert [r.doc_id for r in corpus_pipeline.minhash(spark, close, SF_SMALL).collect()] == [1]


def test_main_text_of_several_sections_and_containers():
    own = lambda source: (lambda page: page.text(page.best()))(Page(source))
    long, short = "long words " * 9 + "end", "few words here"
    assert own(f"<body><article><section><div><p>{short}</div></section><section><div><p>{long}</div></section></article>") == f"{short} {long}"
    assert own(f"<body><main><div class=a><p>{long}</div><div class=b><p>{short}</div></main>") == f"{long} {short}"
    assert own(f"<body><div class=a><p>{long}</div><div class=b><p>{short}</div>") == f"{long} {short}"
    assert own(f"<body><article class=a><p>{long}</article><article class=b><p>{short}</article>") == f"{long} {short}"
    assert own(f"<body><div class=top>Site</div><div class=post><p>{long}</div><div class=end><ul><li><a href=x>{short}</a></ul></div>") == long


def test_host_path_takes_all_its_containers(spark):
    one, two = "<body><div class=post><p>{0} one</div>", "<body><div class=post><p>{0} one</div><div class=post><p>{0}</div>"
    rows = [(i, "http://h.org/x", (two if i > 15 else one).format("some words")) for i in range(17)]
    got = {r.id: r.text for r in extract_main(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0] == "some words one" and got[16] == "some words one some words"


def test_slug_ids_and_words_inside_classes_stay_in_the_article():
    own = lambda source: (lambda page: page.text(page.best()))(Page(source))
    body = "words of the article " * 6 + "end"
    kept = (f'<body><article><div class="post-header"><h1>Title</h1></div><h2 id="related-work">Related</h2><section id="search-algorithms"><p>{body}</section>'
            f'<section id="legal-history"><p>{body}</section><div class="banner-years"><p>{body}</div>')
    assert own(kept) == f"Title Related {body} {body} {body}"
    gone = ('<div class="related-posts"><h3>More</h3><ul><li><a href=x>another long story</a></ul></div><div class="ad-box">buy</div>'
            f'<div class="share-social">{body}</div><div class="comments">{body}</div><div id="ad-1">{body}</div><div role="search">{body}</div>')
    assert own(kept + gone) == own(kept)
    assert own(f'<body><div class=post><h2 id="related-work">Related</h2><p>{body}</div><div class="my-sidebar">{body}</div>') == f"Related {body}"


def test_url_branches_below_the_third_segment(spark):
    urls = [(i, f"http://h.org/2024/05/12/{'spam' if i % 2 else 'news'}/a/x{i}") for i in range(60)]
    urls += [(100 + i, f"http://k.org/a/b/c/d/{'e' if i < 30 else 'f'}/g/page-{i}") for i in range(60)]
    labels = [(i, i % 2) for i in range(60)]
    got = {r.id: r for r in filter_urls(spark.createDataFrame(urls, "page_id long, url string"), spark.createDataFrame(labels, "key long, bad int"), rules=[]).collect()}
    assert len(got) == 120 and {r.verdict for i, r in got.items() if i < 60 and i % 2} == {"block"}
    assert {r.verdict for i, r in got.items() if i < 60 and not i % 2} == {"allow"}
    assert "/spam/" in got[1].template and "/news/" in got[2].template and got[1].labelled == 30 == got[1].bad
