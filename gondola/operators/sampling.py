"""Deterministic sampling and rank slices (ORD-3, ORD-4, ORD-5, ORD-6, SCA-27; pin D7).

Random order is a seeded hash of the key — the same rows on every run, every engine and after
any executor loss (``rand()`` would reshuffle on recomputation). ``limit`` here is the feature
(a sample of n), planned as a top-k (TakeOrderedAndProject), not a global sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hash_order(key: str, seed: int = 42) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed))))


def sample_n(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """ORD-4 / ORD-6: fixed-n seeded sample."""
    return df.orderBy(hash_order(key, seed)).limit(n)


def sample_fraction(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """ORD-5: Bernoulli-like fraction by hash bucket (first 32 bits of the md5 as an integer)."""
    bucket = F.conv(F.substring(hash_order(key, seed), 1, 8), 16, 10).cast("long")
    return df.filter(bucket < F.lit(int(fraction * 2 ** 32)))


def rank_slice(df: DataFrame, order: Sequence[Column], first: int, last: int) -> DataFrame:
    """ORD-3: rows ranked ``first`` to ``last`` of the given total order, with their ``rank``. The top ``last``
    rows are found per partition first (top-k), so the window sees ``last`` rows."""
    top = df.orderBy(*order).limit(last)
    ranked = top.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("int"))
    return ranked.filter(F.col("rank") >= first)
