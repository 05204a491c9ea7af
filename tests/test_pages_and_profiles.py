"""Block links of nested pages, element profiles with a hot type, full texts, correction states."""

from pyspark.sql import functions as F

from gondola.operators import barcodes as B
from gondola.operators import receipts as R
from gondola.sources.formats import block_links


def _links(spark, html, **kw):
    rows = html if isinstance(html, list) else [html]
    pages = spark.createDataFrame(list(enumerate(rows)), "page_id int, html string")
    return [(r.page_id, r.block, r.heading, r.link) for r in block_links(pages, **kw).orderBy("page_id", "block").collect()]


def test_nested_containers_keep_their_own_texts_and_links(spark):
    html = ("<div><div class=\"x pkg-container\"><h3> Jueves\n</h3><div><br><a HREF='/a/download/1'>one</a></div>"
            "<div class='pkg-container'><h3>Lunes</h3><a href=\"/other\">no</a><a href=\"/b/download/2\">two</a></div>"
            "<a href=\"/a/download/9\">late</a></div><a href=\"/download/outside\">x</a></div>"
            "<div class=pkg-container><h3>Jueves</h3><p><a href=\"/c/download/3\">three</a>")
    assert _links(spark, html) == [(0, 0, "Jueves", "/a/download/1"), (0, 1, "Lunes", "/b/download/2"),
                                   (0, 2, "Jueves", "/c/download/3")]
    assert _links(spark, html, label="Jueves") == [(0, 0, "Jueves", "/a/download/1"), (0, 2, "Jueves", "/c/download/3")]
    assert _links(spark, html, label="late") == [(0, 0, "late", "/a/download/1")]


def test_odd_pages(spark):
    """Null and empty pages, stray closing tags, containers in comments and scripts, none with a link."""
    box = "<div class=\"pkg-container\">%s<a href=\"/download/%d\">go</a></div>"
    pages = [None, "", "</div></div>" + box % ("A", 1) + "</div>" + box % ("B", 2),
             "<!-- " + box % ("C", 3) + " --><script>'" + box % ("D", 4) + "'</script>" + box % ("", 5),
             "<div class=\"pkg-container\">no link</div>", "<div class=\"pkg-containers\"><a href=\"/download/6\">x</a></div>",
             box % ("E", 7) + box % ("E", 7)]
    assert _links(spark, pages) == [(2, 0, "A", "/download/1"), (2, 1, "B", "/download/2"), (3, 0, "go", "/download/5"),
                                    (6, 0, "E", "/download/7"), (6, 1, "E", "/download/7")]


def test_profile_of_a_hot_type(spark):
    """Against plain Python: one type holds nearly all rows over many partitions; nulls, repeats, long contents."""
    rows = [("text", f"line {(i * 7919) % 5000:04d} " + "x" * (i % 200)) for i in range(6000)]
    rows += [("table", None), ("table", "ñandú"), ("table", "ñandú"), (None, "z"), ("", ""), ("null", None)]
    df = spark.createDataFrame(rows, "kind string, body string").repartition(13)
    got = {r.kind: (r.n, r.chars, r.longest, list(r.samples)) for r in R.element_profile(df, "kind", "body", 3, 20).collect()}
    want = {}
    for kind in {k for k, _ in rows}:
        mine = [b for k, b in rows if k == kind]
        texts = [b or "" for b in mine]
        cut = sorted({b[:20] for b in mine if b is not None}, key=str.encode)
        want[kind] = (len(mine), sum(map(len, texts)), max(map(len, texts)), cut[:3])
    assert got == want
    assert R.element_profile(df.limit(0), "kind", "body").count() == 0


def test_profile_is_one_scan_without_window(spark):
    df = spark.createDataFrame([("a", "b")], "kind string, body string")
    plan = R.element_profile(df, "kind", "body")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("Scan ") == 1


def test_full_texts_by_position(spark):
    df = spark.createDataFrame([("f", 2, "text", "b"), ("f", 1, "text", "a"), ("f", 1, "table", "t"), ("f", 3, "text", None),
                                ("g", 1, "table", "t")], "file string, pos int, kind string, body string")
    assert [tuple(r) for r in R.full_texts(df, "file", "pos", "kind", "body").collect()] == [("f", 3, "a\nb", 3)]


def test_corrections_pass_from_pending_to_applied_once(spark):
    """HIGH and PENDING are applied at the given time; rejected ones and other tiers keep their state."""
    rows = [("1", "HIGH", "PENDING", 2), ("2", "HIGH", "REJECTED", 1), ("3", "LOW", "PENDING", 5), ("4", "MEDIUM", "PENDING", 1)]
    df = spark.createDataFrame(rows, "purchase_barcode string, confidence string, status string, affected_count long")
    done = B.mark_applied(df, F.lit("2024-05-01 10:00:00").cast("timestamp"))
    got = {r.purchase_barcode: (r.status, str(r.applied_at)) for r in done.collect()}
    assert got == {"1": ("APPLIED", "2024-05-01 10:00:00"), "2": ("REJECTED", "None"), "3": ("PENDING", "None"), "4": ("PENDING", "None")}
    assert {r.purchase_barcode: r.tier_rank for r in B.review_list(done).collect()} == {"3": 1, "4": 2}
    assert {(r.confidence, r.status, r.n, r.affected, r.tier_rank) for r in B.correction_summary(done).collect()} == {
        ("HIGH", "APPLIED", 1, 2, 3), ("HIGH", "REJECTED", 1, 1, 3), ("LOW", "PENDING", 1, 5, 1), ("MEDIUM", "PENDING", 1, 1, 2)}
