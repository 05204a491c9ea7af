"""License scans by an exact set-similarity join, in DataFrame operations alone.

A text is cut into blocks of BLOCK words that overlap by half, so that any run of up to BLOCK / 2 + 1
words lies inside one block. A block and a template are sets of words; a block matches when it holds at
least ceil(threshold * size) of the template's distinct words. Words are ordered by their count over all
documents, rarest first, ties by the word. If block and template share k words, the first that they
share lies among the first size - k + 1 of either (prefix filter), the block has at least k words (length
filter), and enough words are left behind it in both (positional filter); only such pairs are compared.

Words of no template can't add to a shared count, so a block is kept as its template words alone, and counts
over the corpus are needed for template words only; both are exact. The templates are a parameter of
bounded size (MOST_WORDS) and travel by broadcast.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import spread_scan, text_or_empty, written

BLOCK = 32
STEP = BLOCK // 2
THRESHOLD = 0.9
#: All templates together may have so many words; beyond it they are no broadcast.
MOST_WORDS = 20_000
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (phrase, label): exact word runs.
PHRASES = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

#: (text, label): notices that are found by the share of their words in a block. At most STEP + 1 words each.
NOTICES = [
    ("released under the mit license", "mit"),
    ("licensed under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    ("under the terms of the gnu general public license as published by the free software foundation", "gpl"),
    ("under the terms of the gnu lesser general public license", "lgpl"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("licensed under a creative commons attribution 4 0 international license", "cc-by-4.0"),
    ("licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa-4.0"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
]


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def _vocabulary(templates) -> list[str]:
    words = sorted({w for words, _, _ in templates for w in words})
    if len(words) > MOST_WORDS:
        raise ValueError(f"templates of {len(words)} words; at most {MOST_WORDS} are broadcast")
    return words


def scan_licenses(docs: DataFrame, phrases=PHRASES, notices=NOTICES, threshold: float = THRESHOLD,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n_words``, ``n_base`` (places of all phrases), ``first_word`` and
    ``last_word`` (smallest and largest start of a place, from 0; null without one), ``base`` and ``labels``
    (sorted arrays of distinct labels: of phrases, and of phrases and notices), ``score`` (the largest share of
    a matching template's words in a block; 1 for a phrase in its place, 0 without a match) and
    ``blocks``: the matching blocks as sorted array of (start, label, share), start counted in words.

    Null texts are empty. Rows that repeat, share an id or have none are scanned each. An empty table gives
    an empty result. Columns besides id and text are not read. Phrases and notices of more than STEP + 1 words
    are refused, as no block need hold them.
    """
    given = [(p.split(), lab, True) for p, lab in phrases] + [(p.split(), lab, False) for p, lab in notices]
    if any(len(words) > STEP + 1 for words, _, _ in given):
        raise ValueError(f"a template has more than {STEP + 1} words")
    vocabulary = _vocabulary(given)
    src = spread_scan(docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")))
    words = src.select("id", words_of(F.col("text")).alias("words"))

    # global order: words by their count over all documents; at most len(vocabulary) rows come back
    counts = words.select(F.explode("words").alias("w")).where(F.col("w").isin(vocabulary)).groupBy("w").count()
    seen = {r["w"]: r["count"] for r in counts.collect()}
    rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (seen.get(w, 0), w)))}
    templates = []
    for at, (ws, label, base) in enumerate(given):
        ordered = sorted(set(ws), key=rank.get)
        need = len(ordered) if base else math.ceil(threshold * len(ordered) - 1e-9)
        templates.append((at, label, base, ordered, len(ordered), need, ws))
    prefixes = sorted({w for t in templates for w in t[3][:t[4] - t[5] + 1]}, key=rank.get)
    order = F.array(*[F.lit(w) for w in sorted(vocabulary, key=rank.get)])

    # one narrow row per document: its blocks that hold a prefix word and enough template words
    starts = F.sequence(F.lit(0), F.greatest(F.floor((F.size("words") - 1) / STEP), F.lit(0)).cast("int"))
    fewest = min(t[5] for t in templates)
    block = F.transform(starts, lambda b: F.slice("words", b * STEP + 1, F.lit(BLOCK)))
    found = F.filter(F.transform(block, lambda ws, b: F.struct(b.alias("block"), ws.alias("words"))), lambda x: F.arrays_overlap(
        x["words"], F.array(*[F.lit(w) for w in prefixes])))
    # array_intersect keeps the order of its first side: the shared words, rarest first
    found = F.transform(found, lambda x: F.struct(x["block"].alias("block"), x["words"].alias("words"), F.array_intersect(order, x["words"]).alias("set")))
    found = F.filter(found, lambda x: F.size(x["set"]) >= fewest)
    table = written(words.select(F.monotonically_increasing_id().alias("row"), "id", F.size("words").cast("long").alias("n_words"),
                                 found.alias("found")), "license-blocks")

    index = docs.sparkSession.createDataFrame(
        [(w, i, at, label, base, ordered, size, need, ws) for at, label, base, ordered, size, need, ws in templates
         for i, w in enumerate(ordered[:size - need + 1])],
        "w string, i int, template int, label string, base boolean, ordered array<string>, size int, need int, phrase array<string>")
    blocks = table.select("row", F.explode("found").alias("b")).select("row", "b.block", "b.words", "b.set")
    probes = blocks.select("*", F.posexplode("set").alias("j", "w"))
    pairs = probes.join(F.broadcast(index), "w")
    left = F.least(F.col("size") - F.col("i"), F.size("set") - F.col("j"))
    # of the words that a pair shares the first one counts, so a pair comes once
    first = ~F.arrays_overlap(F.slice("set", F.lit(1), F.col("j")), "ordered")
    pairs = pairs.where((F.size("set") >= F.col("need")) & (left >= F.col("need"))).where(first)
    shared = F.size(F.array_intersect("set", "ordered"))
    pairs = pairs.withColumn("shared", shared).where("shared >= need")
    # a phrase stands where its words follow one another; a place belongs to the block that its start halves
    places = F.filter(F.sequence(F.lit(0), F.lit(STEP - 1)), lambda k: F.slice("words", k + 1, F.size("phrase")) == F.col("phrase"))
    pairs = pairs.withColumn("places", F.when(F.col("base"), places)).where("not base or size(places) > 0")
    start = F.col("block") * STEP
    hits = pairs.groupBy("row").agg(
        F.sum(F.when(F.col("base"), F.size("places"))).alias("n_base"),
        F.min(F.when(F.col("base"), start + F.array_min("places"))).alias("first_word"),
        F.max(F.when(F.col("base"), start + F.array_max("places"))).alias("last_word"),
        F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))).alias("base"),
        F.array_sort(F.collect_set("label")).alias("labels"), F.max(F.col("shared") / F.col("size")).alias("score"),
        F.array_sort(F.collect_set(F.struct(start.alias("start"), "label", (F.col("shared") / F.col("size")).alias("share")))).alias("blocks"))
    none = F.array().cast("array<string>")
    out = table.select("row", "id", "n_words").join(hits, "row", "left")
    return out.select("id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), F.col("first_word").cast("long").alias("first_word"),
                      F.col("last_word").cast("long").alias("last_word"), F.coalesce("base", none).alias("base"), F.coalesce("labels", none).alias("labels"),
                      F.coalesce("score", F.lit(0.0)).alias("score"), "blocks")
