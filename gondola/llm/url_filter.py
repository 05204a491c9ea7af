"""URL filters by a path-template tree per host, as aggregates and joins.

A path is a list of segments. Segments that look like numbers, hashes or dates become wildcards at
once; a literal segment becomes ``*`` where its parent template has many children that each see few
urls. The tree of a host is the set of template prefixes with their labelled counts, built level by
level from the root, down to the deepest segment whose counts can still split a branch. Sibling branches whose share of bad labels can't be told from their parent's by
a two-sided test are merged into one branch; the others stand alone. A branch is rejected when its
smoothed share of bad labels reaches the threshold. Only counts per template are shuffled by host, each
combined before the shuffle, so a host with most of the urls is as cheap as any.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import written

#: Levels that the SQL of op6 spells out, with a last segment ``**`` for what lies deeper; the operator itself takes every level.
LEVELS = 3
#: A parent with more literal children than this, of under FEW urls each on average, has variable children.
MANY, FEW = 20, 3
#: Two-sided 5 % test, pseudo-labels, and the share that rejects. A host's share is smoothed by WEIGHT labels of
#: the share over all hosts, a branch's by WEIGHT labels of its host's smoothed share.
Z, WEIGHT, REJECT = 1.96, 5.0, 0.5

#: (host, path prefix, verdict); a rule fits its host and all subdomains.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z
    lower-cased; then up to ``?``, ``#`` or the end. Both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1, F.length(rest) + 1), r"^([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def segment_class(s: Column) -> Column:
    """Lexical wildcard of a variable segment, else the segment."""
    return (F.when(s.rlike(r"^[0-9]+$"), F.lit("{n}"))
            .when(s.rlike(r"^[0-9]+\.[A-Za-z]+$"), F.concat(F.lit("{n}."), F.regexp_extract(s, r"\.([A-Za-z]+)$", 1)))
            .when(s.rlike(r"^[0-9]+(-[0-9]+)+$"), F.lit("{d}"))
            .when(s.rlike(r"^[0-9a-fA-F]{8,}(-[0-9a-fA-F]+)*$"), F.lit("{h}")).otherwise(s))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits, or nulls."""
    text = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text, verdict = F.when(fits, F.lit(h + p)).otherwise(text), F.when(fits, F.lit(v)).otherwise(verdict)
    return text, verdict


def filter_urls(urls: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """One row per row of ``urls``: ``id``, ``host``, ``path``, ``rule`` (or null), ``template`` (its branch),
    ``labelled`` and ``bad`` (labels of the branch), ``purity`` (smoothed share of bad) and ``verdict``
    (allow or block: the rule's, else block where purity >= REJECT).

    ``labels`` (key, bad 0/1) belongs to urls by the last number in their path; a key that repeats is
    bad if any of its rows is; null keys and values are ignored. Null urls and urls without ``://`` have empty host
    and path and form one tree of their own. Without any label every purity is 0. Empty tables
    give an empty result; extra columns are ignored, and rows that repeat are judged each.
    """
    host, path = split_url(F.col(url_col))
    base = urls.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    marks = labels.where("key is not null and bad is not null").groupBy(F.col("key").cast("string").alias("key")).agg(F.max("bad").cast("long").alias("bad"))
    number = F.regexp_replace(F.regexp_extract("path", r"([0-9]+)[^0-9]*$", 1), r"^0+(?=[0-9])", "")
    rows = base.withColumn("key", F.nullif(number, F.lit(""))).join(marks, "key", "left").drop("key")
    segs = F.filter(F.split("path", "/"), lambda s: s != "")
    rows = rows.withColumn("segs", F.transform(segs, segment_class))
    rows = rows.withColumn("lab", F.col("bad").isNotNull().cast("long")).withColumn("bad", F.coalesce("bad", F.lit(0)))

    # counts per lexical path template; everything below works on these. A path is an array: ``done`` are its
    # segments settled so far, ``segs[i]`` is the one at hand, and a path without it is complete.
    path_cols = ["host", "segs"]
    tree = rows.groupBy(*path_cols).agg(F.count(F.lit(1)).alias("n"), F.sum("lab").alias("lab"), F.sum("bad").alias("bad"))
    tree = written(tree, "url-tree")
    literal = "seg <> '' and seg not like '{%'"

    def level(tree: DataFrame, path: str, i: int, open_when: str) -> DataFrame | None:
        """Rows with ``seg``, their ``path`` at level i ('' past its end), and whether their prefix group is open;
        None when no open group has a path that reaches level i."""
        group = tree.groupBy("host", "done").agg(F.count(F.lit(1)).alias("rows_"), F.sum("lab").alias("pl"), F.sum("bad").alias("pb"),
                                                 F.max(F.size(path)).alias("deep"))
        group = group.where(f"deep > {i} and {open_when}").select("host", "done", "pl", "pb", F.lit(True).alias("is_open"))
        if group.isEmpty():
            return None
        return tree.join(group, ["host", "done"], "left").withColumn("seg", F.coalesce(F.get(path, F.lit(i)), F.lit("")))

    # wildcards: a group of at most MANY paths never has more than MANY children, at no level below
    tree, i = tree.withColumn("done", F.expr("cast(array() as array<string>)")), 0
    while (rows_at := level(tree, "segs", i, f"rows_ > {MANY}")) is not None:
        kids = rows_at.where(f"is_open and {literal}").groupBy("host", "done", "seg").agg(F.sum("n").alias("n"))
        wild = kids.groupBy("host", "done").agg(F.count(F.lit(1)).alias("kids"), F.sum("n").alias("seen")).where(
            f"kids > {MANY} and seen < {FEW} * kids").select("host", "done", F.lit(True).alias("wild"))
        seg = F.expr(f"case when wild and {literal} then '*' else seg end")
        tree = written(rows_at.join(wild, ["host", "done"], "left").select(
            *path_cols, "n", "lab", "bad", F.when(F.size("segs") > i, F.concat("done", F.array(seg))).otherwise(F.col("done")).alias("done")), "url-tree")
        i += 1
    tree = tree.select(*path_cols, "n", "lab", "bad", F.concat("done", F.expr(
        "if(size(segs) > size(done), slice(segs, size(done) + 1, size(segs) - size(done)), cast(array() as array<string>))")).alias("t"))
    # merge siblings, from the root: node against its parent's share. Below a group without labels, or with
    # only good or only bad ones, all segments merge; so they do in a group of one path.
    tree, i = written(tree.withColumn("done", F.expr("cast(array() as array<string>)")), "url-tree"), 0
    while (rows_at := level(tree, "t", i, "rows_ > 1 and pb > 0 and pb < pl")) is not None:
        nodes = rows_at.where("is_open").groupBy("host", "done", "seg").agg(F.sum("lab").alias("nl"), F.sum("bad").alias("nb"), F.first("pl").alias("pl"), F.first("pb").alias("pb"))
        alone = nodes.where(f"not power(nb * pl - nl * pb, 2) <= {Z * Z} * nl * pb * (pl - pb)").select("host", "done", "seg", F.lit(True).alias("alone"))
        seg = F.expr("if(alone, seg, '~')")
        tree = written(rows_at.join(alone, ["host", "done", "seg"], "left").select(
            *path_cols, "n", "lab", "bad", "t", F.when(F.size("t") > i, F.concat("done", F.array(seg))).otherwise(F.col("done")).alias("done")), "url-tree")
        i += 1
    tree = tree.withColumn("branch", F.concat("done", F.expr("array_repeat('~', size(t) - size(done))")))
    branch = ["host", "branch"]
    leaves = tree.groupBy(*branch).agg(F.sum("lab").alias("labelled"), F.sum("bad").alias("bad_n"))
    hosts = leaves.groupBy("host").agg(F.sum("labelled").alias("hl"), F.sum("bad_n").alias("hb"))
    whole = hosts.agg(F.sum("hb").alias("b"), F.sum("hl").alias("l")).first()
    share = whole.b / whole.l if whole.l else 0.0
    leaves = leaves.join(hosts, "host").withColumn("purity", F.round(
        (F.col("bad_n") + WEIGHT * ((F.col("hb") + WEIGHT * F.lit(share)) / (F.col("hl") + WEIGHT))) / (F.col("labelled") + WEIGHT), 9))
    judged = tree.select(*path_cols, "branch").join(leaves.drop("hl", "hb"), branch)
    template = F.concat_ws("", F.transform("branch", lambda x: F.concat(F.lit("/"), x)))
    judged = judged.select(*path_cols, template.alias("template"), "labelled", F.col("bad_n"), "purity")
    text, verdict = rule_of(F.col("host"), F.col("path"), rules)
    out = rows.drop("lab", "bad").join(judged, path_cols)
    return out.select("id", "host", "path", text.alias("rule"), "template", "labelled", F.col("bad_n").alias("bad"), "purity",
                      F.coalesce(verdict, F.when(F.col("purity") >= REJECT, "block").otherwise("allow")).alias("verdict"))
