"""Filter interaction audit: every order of a set of filters at once, by min-plus removal ranks.

Whole texts are read once and become a bit mask of the filters they fail. Documents then count by (part,
mask): at most 2^filters rows a part, whatever the number of documents. For a mask m and an order o the
step that removes its documents is min over filters f of (M[m, f] + P[o, f]), M being 0 where m fails f and
infinite elsewhere, P the inverse permutation (the position of f in o). One such matrix of ranks serves all
parts; it scatters their counts, weighted by the documents, to (order, step).
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import spread_scan, text_or_empty, written

WORD = r"[^\x20\x09-\x0D]+"
#: Parts that one Arrow batch of the result holds at most; each has orders x filters rows.
PARTS_AT_ONCE = 64
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def text_failures(text: Column, words: Column) -> dict[str, Column]:
    """The filters that look at one text (``words``: its words as an array): true where it fails."""
    n = F.size(words)
    return {"A": n < 50, "B": 100 * F.size(F.array_distinct(words)) < 65 * n,
            "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 5 * F.length(text),
            "D": text.rlike("[#$%&*|]")}


def failure_counts(docs: DataFrame, labels: DataFrame, part: Column, copies: str = "E") -> tuple[DataFrame, list[str]]:
    """((part, mask, n, good, toxic), filter names): bit i of ``mask`` is set where filter i is failed.

    The last filter, ``copies``, fails documents whose text is that of a smaller doc_id (same SHA-256). A null
    doc_id is neither smaller nor larger than any and carries no label; rows that repeat a doc_id count each,
    and fail E alike. A document is good (toxic) when any label row of its doc_id says so. Null texts count as empty.

    The copies of a text are never gathered: rows count by (digest, part, mask, labels) with their smallest
    id first, so a text that a third of all rows share is a few rows a part when its smallest id is taken.
    """
    src = spread_scan(docs).select(F.col("doc_id"), F.coalesce(part.cast("string"), F.lit("")).alias("part"), text_or_empty("text").alias("text"))
    src = src.select("*", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"))
    tests = text_failures(F.col("text"), F.col("words"))
    mask = sum((F.when(t, 1 << i).otherwise(0) for i, t in enumerate(tests.values())), F.lit(0))
    rows = written(src.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest")), "audit-masks")
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = rows.join(marks, F.col("doc_id") == F.col("id"), "left").drop("id").fillna({"good": 0, "toxic": 0})
    what = ["digest", "part", "mask", "good", "toxic"]
    by_id = rows.groupBy("doc_id", *what).agg(F.count(F.lit(1)).alias("n"))  # dealt by doc_id already
    groups = by_id.groupBy(*what).agg(F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))).alias("no_id"),
                                      F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("low"))
    groups = written(groups, "audit-groups")
    first = groups.groupBy("digest").agg(F.min("low.doc_id").alias("first"), F.count(F.lit(1)).alias("groups"))
    # a text in one group needs no comparison with others
    alone = groups.join(first.where("groups > 1").drop("groups"), "digest", "left")
    keeps = F.when(F.col("first").isNull() | (F.col("low.doc_id") == F.col("first")), F.col("low.n"))
    kept = F.coalesce(keeps, F.lit(0)) + F.coalesce("no_id", F.lit(0))
    bit = 1 << len(tests)
    split = alone.select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("mask"), kept.alias("n")), F.struct((F.col("mask") + bit).alias("mask"), (F.col("n") - kept).alias("n")))).alias("s"))
    counts = split.groupBy("part", F.col("s.mask").alias("mask")).agg(
        F.sum("s.n").alias("n"), F.sum(F.col("s.n") * F.col("good")).alias("good"), F.sum(F.col("s.n") * F.col("toxic")).alias("toxic"))
    return counts, [*tests, copies]


def removal_ranks(n: int) -> tuple[np.ndarray, np.ndarray]:
    """(orders, ranks): all permutations of n filters, and per mask and order the step (from 0) that removes
    the mask's documents, or n where no filter does."""
    orders = np.array(list(permutations(range(n))), dtype=np.int64).reshape(-1, n)
    position = np.argsort(orders, axis=1)
    fails = (np.arange(1 << n)[:, None] >> np.arange(n)) & 1
    cost = np.where(fails == 1, 0, n)
    ranks = np.minimum((cost[:, None, :] + position[None, :, :]).min(axis=2, initial=n), n)
    return orders, ranks


def _reports(names: list[str]):
    n = len(names)
    orders, ranks = removal_ranks(n)
    width = len(orders)
    labels = ["".join(names[f] for f in o) for o in orders]
    masks = np.arange(1 << n)
    fails = (masks[:, None] >> np.arange(n)) & 1
    hit = fails[:, orders.reshape(-1)].reshape(len(masks), width, n)      # mask fails the filter at this step
    gone = ranks[:, :, None] == np.arange(n)                              # and is removed by it
    late = (hit == 1) & (ranks[:, :, None] < np.arange(n))                # or was removed earlier
    only = (masks[:, None, None] == (1 << orders)[None])

    def report(parts: list, tables: np.ndarray) -> pa.RecordBatch:
        """tables: (parts, 3, masks) documents, good and toxic ones."""
        docs, good, toxic = (tables[:, i] for i in range(3))
        scatter = lambda w, m: np.tensordot(w, m.astype(np.int64), axes=1)
        removed = scatter(docs, gone)
        total = docs.sum(axis=1)[:, None, None]
        share = np.zeros((len(parts), n), np.int64)
        for f in range(n):
            share[:, f] = removed[:, orders == f].sum(axis=1)
        shapley = share[:, orders.reshape(-1)].reshape(len(parts), width, n)
        columns = [total - np.cumsum(removed, axis=2), removed, scatter(docs, late), scatter(docs, only), scatter(good, gone), scatter(toxic, gone), shapley]
        size = len(parts) * width * n
        steps = np.tile(np.arange(1, n + 1, dtype=np.int32), size // n)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.array(parts, dtype=object), width * n), pa.string()), pa.array(np.tile(np.repeat(labels, n), len(parts)), pa.string()),
             pa.array(steps), *[pa.array(c.reshape(-1)) for c in columns]], names=["part", "filter_order", "step", *COUNTS])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, PARTS_AT_ONCE):
                rows = batch.slice(at, PARTS_AT_ONCE)
                tables = np.zeros((rows.num_rows, 3, 1 << n), np.int64)
                cells = rows.column("cells").to_pylist()
                for i, part in enumerate(cells):
                    for c in part:
                        tables[i, :, c["mask"]] = c["n"], c["good"], c["toxic"]
                yield report(rows.column("part").to_pylist(), tables)
    return run


def audit(counts: DataFrame, names: list[str]) -> DataFrame:
    """One row per part, order of the filters (``filter_order``) and ``step`` (from 1): documents ``kept`` after
    the step, ``removed`` by it, ``redundant`` (failing its filter, removed earlier), ``unique_fails`` (failing
    its filter alone), ``good_lost``, ``toxic_lost`` (removed here), and ``shapley`` (removed by its filter,
    summed over all orders). ``counts`` (part, mask, n, good, toxic) has a row per part and mask; masks that
    are absent count 0. Without counts there are no rows. For n filters a part has n! * n rows.
    """
    cells = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    return cells.mapInArrow(_reports(names), "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS))
