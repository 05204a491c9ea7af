"""Exact dedup by skew-safe combining, in DataFrame operations alone.

Copies are combined three times, each time on the full content beside its digest: inside each scan
task (partial aggregation), then inside (digest, salt) groups, then over the salt winners of a
digest. The salt comes from the row and not from the text, so a text that holds a third of all rows
is spread over all salts, while a text without copies costs one row whatever the number of salts.
With about sqrt(rows) salts neither a salted group nor the winners of one text exceed about
sqrt(rows) entries: the last stage sees one count and one best row per salt, never the copies, and its
result goes back to the salted groups by (digest, salt), with the text compared.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import written


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int | None = None,
                normalise=None) -> DataFrame:
    """One row per row of ``df``: ``row`` (struct of all its columns but the text), ``text`` (as it
    was compared), ``digest`` (SHA-256, lowercase hex, of the UTF-8), ``keep_id``, ``group_size`` and
    ``kept``.

    Of equal texts the row with the largest id stays; of rows with the same id too, the one with the
    larger hash of its other columns, and of rows equal in everything, one. A null text counts as
    empty; a null id is smaller than any other, and ``keep_id`` is null when no copy has an id. An
    empty table gives an empty result. Extra columns keep their names inside ``row``; they may be maps too.

    ``normalise`` maps the text column before the comparison (default: no change).
    """
    rest = [c for c in df.columns if c != text_col]
    if salts is None:
        salts = max(16, math.isqrt(df.count()))
    text: Column = F.coalesce(F.col(text_col), F.lit(""))
    if normalise is not None:
        text = normalise(text)
    kinds = dict(df.dtypes)
    tie = F.xxhash64(*[F.array_sort(F.map_entries(F.col(c))) if kinds[c].startswith("map<") else F.col(c) for c in rest])
    src = df.select(
        F.struct(F.col(id_col).alias("id"), tie.alias("tie"), F.struct(*rest).alias("row")).alias("member"),
        text.alias("text"))
    src = src.select("member", "text", F.sha2("text", 256).alias("digest"),
                     F.pmod(F.col("member.tie"), F.lit(salts)).alias("salt"))
    salted = written(src.groupBy("digest", "salt", "text").agg(
        F.collect_list("member").alias("members"), F.count(F.lit(1)).alias("n"),
        F.max(F.struct("member.id", "member.tie")).alias("best")), "exact-salted")
    # one entry per salt meets the others; a text in one salted group has nobody to meet
    winners = salted.groupBy("digest", "text").agg(
        F.max("best").alias("top"), F.sum("n").alias("group_size"), F.collect_list("salt").alias("salts")).where(F.size("salts") > 1)
    winners = written(winners.select("digest", "text", "top", "group_size", F.explode("salts").alias("salt")), "exact-winners")
    out = salted.join(winners, ["digest", "salt", "text"], "left").select(
        "digest", "text", "members", "best", F.coalesce("top", "best").alias("top"), F.coalesce("group_size", "n").alias("group_size"))
    # rows equal to the top one share a salt; the first of them stays
    key = F.transform("members", lambda m: F.struct(m["id"].alias("id"), m["tie"].alias("tie")))
    out = out.select("digest", "text", "top", "group_size", F.when(F.col("best") == F.col("top"), F.array_position(key, F.col("top")) - 1).alias("first"),
                     F.posexplode("members").alias("at", "member"))
    return out.select(F.col("member.row").alias("row"), "text", "digest", F.col("top.id").alias("keep_id"),
                      "group_size", F.coalesce(F.col("at") == F.col("first"), F.lit(False)).alias("kept"))
