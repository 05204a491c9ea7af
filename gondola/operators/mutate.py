"""Table mutations as pure functions returning the new version of a table (DML-1 … DML-12).

Parquet tables take no MERGE/UPDATE, so each mutation is a join/projection whose result is written
to a *new* path (or a new partition) and then switched in; the path being read is never
overwritten. Source sides are de-duplicated on the key first so a merge can never fan out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gondola.operators.scan import numbered


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def merge_update(target: DataFrame, source: DataFrame, key: str | Sequence[str],
                 columns: Sequence[str], fill_only: bool = False,
                 order_by: Sequence[Column] | None = None) -> DataFrame:
    """DML-1 / DML-2: ``MERGE … WHEN MATCHED [AND target.c IS NULL] THEN UPDATE SET c = source.c``.

    ``source`` must be unique on ``key``; when ``order_by`` is given the first row per key wins,
    otherwise the caller guarantees uniqueness. ``fill_only`` updates only NULL target values.
    """
    keys = _keys(key)
    if order_by is not None:
        w = Window.partitionBy(*keys).orderBy(*order_by)
        source = source.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    src = source.select(*keys, *[F.col(c).alias(f"_src_{c}") for c in columns],
                        F.lit(True).alias("_matched"))
    out = target.join(src, keys, "left")
    for c in columns:
        cond = F.col("_matched").isNotNull()
        if fill_only:
            cond = cond & F.col(c).isNull()
        out = out.withColumn(c, F.when(cond, F.col(f"_src_{c}")).otherwise(F.col(c)))
    return out.select(*target.columns)


def update_where_in(target: DataFrame, ids: DataFrame, key: str, assignments: dict[str, Column]) -> DataFrame:
    """DML-4: ``UPDATE t SET … WHERE key IN (subquery)`` as a flag join (no literal IN-lists)."""
    flag = ids.select(key).distinct().withColumn("_hit", F.lit(True))
    out = target.join(flag, key, "left")
    for c, v in assignments.items():
        out = out.withColumn(c, F.when(F.col("_hit").isNotNull(), v).otherwise(F.col(c)))
    return out.select(*target.columns)


def delete_where(target: DataFrame, pred: Column) -> DataFrame:
    """DML-6: keep rows where the predicate is not true (NULL counts as not deleting)."""
    return target.filter(~F.coalesce(pred, F.lit(False)))


def add_column(target: DataFrame, name: str, dtype: str, backfill: Column | None = None) -> DataFrame:
    """DML-7: ``ADD COLUMNS`` then back-fill where NULL."""
    if name not in target.columns:
        target = target.withColumn(name, F.lit(None).cast(dtype))
    if backfill is not None:
        target = target.withColumn(name, F.coalesce(F.col(name), backfill.cast(dtype)))
    return target


def upsert_keep_last(current: DataFrame, incoming: DataFrame, key: str | Sequence[str],
                     version_col: str = "_version") -> DataFrame:
    """DML-12: concat old + new and keep the newest row per key (promote). Idempotent: applying the
    same ``incoming`` twice gives the same table."""
    keys = _keys(key)
    both = (current.withColumn(version_col, F.lit(0))
            .unionByName(incoming.withColumn(version_col, F.lit(1)), allowMissingColumns=True))
    w = Window.partitionBy(*keys).orderBy(F.col(version_col).desc())
    return (both.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
            .drop("_rn", version_col))


def next_ids(existing: DataFrame, id_col: str, new_rows: DataFrame, order_col: str) -> DataFrame:
    """DML-9: surrogate ids ``MAX(id) + row_number()`` over the new rows in ``order_col``.

    The base is a scalar subquery (JN-11); the numbers come from a distributed rank (range partition,
    count per range, offsets joined back), so the number of new rows has no bound.
    """
    base = existing.select(F.coalesce(F.max(id_col), F.lit(0))).scalar()
    ranked = numbered(new_rows, [order_col], name="_rank")
    return ranked.withColumn(id_col, (base + F.col("_rank")).cast("long")).drop("_rank")


def remap_values(target: DataFrame, col: str, mapping: DataFrame, old: str = "old_id",
                 new: str = "new_id") -> DataFrame:
    """DML-3 / DML-10: ``UPDATE … SET c = k WHERE c = j`` for many (j, k) pairs as one join with a
    small mapping table (seed-sized, broadcast)."""
    m = F.broadcast(mapping.select(F.col(old).alias("_old"), F.col(new).alias("_new")))
    return (target.join(m, F.col(col) == F.col("_old"), "left")
            .withColumn(col, F.coalesce(F.col("_new"), F.col(col)))
            .select(*target.columns))


def merge_by_priority(sources: Sequence[DataFrame], key: str, order: Sequence[Column]) -> DataFrame:
    """PIP-50: one row per key out of several mappings with the same columns: an earlier source wins, within
    a source the first row by ``order``. Rows with a null key form one group."""
    tagged = [d.withColumn("_source", F.lit(i)) for i, d in enumerate(sources)]
    every = tagged[0]
    for d in tagged[1:]:
        every = every.unionByName(d)
    w = Window.partitionBy(key).orderBy("_source", *order)
    return every.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn", "_source")
