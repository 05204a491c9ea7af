"""Running counts and sums per key by a prefix scan over range partitions.

A window over a key puts all rows of that key into one task. Here the rows are dealt into ranges of
(key, order); each range is scanned alone, the totals of a key's ranges are added up (at most one row
per range), and the carry is joined back. A key that holds most of the table is spread over as many
tasks as its rows fill ranges.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gondola.session import scratch_path


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared checkpoint folder and read again: cuts the lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def range_parts(df: DataFrame) -> int:
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def running(df: DataFrame, keys: list[str], order: list, sums: dict[str, Column] | None = None,
            count: str | None = None, previous: dict[str, str] | None = None, parts: int | None = None) -> DataFrame:
    """``df`` with, per key and in ``order``, the running row number ``count`` (1-based), the running
    total of each column in ``sums``, the row itself included, and for each column in ``previous`` its value in
    the row before (null for the first one); ``previous`` maps new names to columns.

    ``keys`` may be empty: one sequence over the whole table. Null keys form a key of their own; a null
    summand adds nothing, and the sum before any summand is null. With ``previous``, ``order`` ascends. Rows equal in keys and order lie in one
    range and are numbered in no fixed order. An empty table stays empty.
    """
    sums, previous = sums or {}, previous or {}
    cols = [F.col(f"`{c}`") for c in df.columns]
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    by = [F.col(f"`{k}`") for k in keys]
    src = df.select(*cols, *[c.alias(f"add__{i}") for i, c in enumerate(sums.values())])
    dealt = shared_table(src.repartitionByRange(parts or range_parts(df), *by, *order)
                         .withColumn("range__", F.spark_partition_id()), "scan")
    names = [*([count] if count else []), *sums]
    in_range = Window.partitionBy(*by, F.col("range__")).orderBy(*order)
    local = in_range.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = [F.row_number().over(in_range).cast("long")] if count else []
    here += [F.sum(f"add__{i}").over(local) for i in range(len(sums))]
    first = [(F.row_number().over(in_range) == 1).alias("first__")] if previous else []
    scanned = dealt.select(*cols, "range__", *[c.alias(f"here__{i}") for i, c in enumerate(here)], *first,
                           *[F.lag(c).over(in_range).alias(f"prev__{i}") for i, c in enumerate(previous.values())])
    whole = [F.count(F.lit(1))] if count else []
    whole += [F.sum(f"add__{i}") for i in range(len(sums))]
    totals = dealt.groupBy(*[c.alias(f"key__{i}") for i, c in enumerate(by)], F.col("range__").alias("at__")).agg(
        F.count(F.lit(1)).alias("rows__"), *[c.alias(f"total__{i}") for i, c in enumerate(whole)],
        *[F.max(F.struct(*order, F.col(f"`{c}`").alias("value__"))).getField("value__").alias(f"last__{i}") for i, c in enumerate(previous.values())])
    ranges = Window.partitionBy(*[f"key__{i}" for i in range(len(keys))]).orderBy("at__")
    earlier = ranges.rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*[f"key__{i}" for i in range(len(keys))], "at__",
                          *[F.sum(f"total__{i}").over(earlier).alias(f"carry__{i}") for i in range(len(names))],
                          *[F.lag(f"last__{i}").over(ranges).alias(f"before__{i}") for i in range(len(previous))])
    same = F.col("range__") == F.col("at__")
    for i, c in enumerate(by):
        same = same & c.eqNullSafe(F.col(f"key__{i}"))
    out = scanned.join(carry, same)
    both = [F.coalesce(F.col(f"here__{i}") + F.col(f"carry__{i}"), F.col(f"here__{i}"), F.col(f"carry__{i}")) for i in range(len(names))]
    return out.select(*cols, *[c.alias(n) for c, n in zip(both, names)],
                      *[F.when(F.col("first__"), F.col(f"before__{i}")).otherwise(F.col(f"prev__{i}")).alias(n) for i, n in enumerate(previous)])


def numbered(df: DataFrame, order: list, name: str = "rank", parts: int | None = None) -> DataFrame:
    """``df`` with its 1-based row number in ``order`` over the whole table, without an ordered pass of one task."""
    return running(df, [], order, count=name, parts=parts)


def exact_percentiles(df: DataFrame, keys: list[str], value: str, qs: list[float], parts: int | None = None) -> DataFrame:
    """Per key: ``n`` (values that aren't null), and for each q ``p<q>_nearest`` (the value of rank
    ``floor(n * q)`` from 0) and ``p<q>_interp`` (linear between the ranks around ``(n - 1) * q``).

    Distributed selection: equal values are counted by partial aggregation, the counts are added up over
    ranges of (key, value), and the ranks asked for are read off the rows that hold them. No group is sorted, buffered
    or windowed in one task. Groups without values have no row. ``keys`` may be empty.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("v__")).agg(F.count(F.lit(1)).alias("c__"))
    upto = running(counts, keys, ["v__"], sums={"upto__": F.col("c__")}, parts=parts)
    upto = upto.select(*keys, "v__", "c__", "upto__", (F.col("upto__") - F.col("c__")).alias("from__"))
    sizes = counts.groupBy(*[F.col(k).alias(f"size_key__{i}") for i, k in enumerate(keys)]).agg(F.sum("c__").alias("n"))
    if keys:
        same = F.lit(True)
        for i, k in enumerate(keys):
            same = same & F.col(k).eqNullSafe(F.col(f"size_key__{i}"))
        upto = upto.join(sizes, same)
    else:
        upto = upto.withColumn("n", F.lit(sizes.first()["n"]).cast("long"))

    def at(rank):
        return F.max(F.when((F.col("from__") <= rank) & (rank < F.col("upto__")), F.col("v__")))

    out = []
    for q in qs:
        tag, place = f"{round(q * 100):02d}", (F.col("n") - 1) * F.lit(float(q))
        low, high = F.floor(place), F.ceil(place)
        out.append(at(F.least(F.floor(F.col("n") * F.lit(float(q))), F.col("n") - 1)).alias(f"p{tag}_nearest"))
        out += [at(low).alias(f"low__{tag}"), at(high).alias(f"high__{tag}")]
    got = upto.groupBy(*keys).agg(F.max("n").alias("n"), *out)
    columns = []
    for q in qs:
        tag, place = f"{round(q * 100):02d}", (F.col("n") - 1) * F.lit(float(q))
        share = place - F.floor(place)
        columns += [F.col(f"p{tag}_nearest"), (F.col(f"low__{tag}") * (1 - share) + F.col(f"high__{tag}") * share).alias(f"p{tag}_interp")]
    return got.select(*keys, "n", *columns)
