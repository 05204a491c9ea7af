"""Mixing sources to target weights by hierarchical budgeting, in DataFrame operations alone.

The tree is given by its level columns (domain, language, source). A budget of tokens flows down:
each node's children share it by weight; a child that can't use its share (its tokens times the
allowed epochs) takes what it can, and the shortage goes to its siblings by weight. What a whole
subtree can't use was already left to the subtree's own siblings one level higher, so ancestors are
asked only after siblings. A leaf then takes whole seeded epochs and, of the next one, the longest
prefix of its seeded order that fits the rest of its budget.

The prefix needs no global sort: hashes are counted in 65,536 ranges per leaf, and only the range
in which a leaf's budget ends is ordered row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gondola.llm.common import written

#: Above so many leaves the plan table is joined by shuffle instead of broadcast.
BROADCAST_LEAVES = 50_000


def _exact(name: str) -> str:
    """A whole number wide enough for products with a weight: 64 bits overflow near 4e13 tokens."""
    return f"cast({name} as decimal(19,0))"


def _order_key(seed: int, epoch: Column, id_: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(id_.cast("string"), F.lit("null"))))


def leaf_budgets(leaves: DataFrame, levels: list[str], weights: dict[str, dict[str, int]], fraction: tuple[int, int],
                 max_epochs: int) -> DataFrame:
    """``leaves`` (levels, tokens) with ``budget``: whole tokens for each leaf, shares rounded down.

    weights[level][value] is a whole number up to 1,000; a value without an entry weighs 1.
    """
    num, den = fraction
    out = leaves.withColumn("capacity", F.col("tokens") * max_epochs).withColumn(
        "parent_budget", F.expr(f"({_exact('sum(tokens) over ()')} * {num}) div {den}"))
    for depth in range(len(levels)):
        node, level = levels[:depth + 1], levels[depth]
        given = weights.get(level, {})
        weight = F.lit(1).cast("long")
        for value, x in given.items():
            weight = F.when(F.col(level) == value, F.lit(int(x)).cast("long")).otherwise(weight)
        nodes = out.groupBy(*node).agg(F.sum("capacity").alias("cap"), F.max("parent_budget").alias("b"))
        nodes = nodes.withColumn("w", weight)
        parent = Window.partitionBy(*node[:-1])
        ordered = parent.orderBy((F.col("cap") / F.col("w")).asc(), F.col(level).asc())
        before = ordered.rowsBetween(Window.unboundedPreceding, -1)
        nodes = nodes.withColumn("w_left", F.sum("w").over(parent) - F.coalesce(F.sum("w").over(before), F.lit(0)))
        nodes = nodes.withColumn("b_left", F.col("b") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        nodes = nodes.withColumn("full", F.expr(f"cast({_exact('cap')} * w_left <= {_exact('b_left')} * w as int)"))
        nodes = nodes.withColumn("full", F.min("full").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
        nodes = nodes.withColumn("b_rest", F.col("b") - F.sum(F.col("cap") * F.col("full")).over(parent))
        nodes = nodes.withColumn("w_rest", F.sum(F.col("w") * (1 - F.col("full"))).over(parent))
        nodes = nodes.withColumn("budget", F.expr(f"case when full = 1 then cap else ({_exact('b_rest')} * w) div w_rest end"))
        out = out.join(nodes.select(*node, "budget"), node).drop("parent_budget").withColumnRenamed("budget", "parent_budget")
    return out.withColumnRenamed("parent_budget", "budget").drop("capacity")


def mix_sources(df: DataFrame, levels: dict[str, Column], tokens: Column, weights: dict[str, dict[str, int]] | None = None,
                fraction: tuple[int, int] = (1, 2), max_epochs: int = 2, seed: int = 7, id_col: str = "doc_id") -> DataFrame:
    """One row per selected copy of a row: ``row`` (struct of all its columns), the levels, ``n_tokens``
    of the row, ``epoch`` (0-based) and the leaf's ``leaf_tokens`` and ``leaf_budget``.

    The whole budget is ``fraction`` (numerator, denominator) of all tokens. Null levels form a leaf of
    their own, named ``?``; null text has no tokens. Rows that share an id (or have none) are taken or
    left together. Rows without tokens cost nothing: they come with every whole epoch, and with a
    prefix when their place in the order lies before its end. An empty table gives an empty result.
    """
    given = list(levels)
    names = [f"level_{i}" for i in range(len(given))]  # the caller's names might clash with columns below
    weights = {n: (weights or {}).get(g, {}) for n, g in zip(names, given)}
    row = F.struct(*[F.col(c) for c in df.columns]).alias("row")
    keyed = df.select(row, *[F.coalesce(c.cast("string"), F.lit("?")).alias(k) for k, c in zip(names, levels.values())],
                      F.coalesce(tokens, F.lit(0)).cast("long").alias("n_tokens"), F.col(id_col).alias("key"))
    # the texts are read once for their lengths; everything up to the leaf plan works on this narrow table
    narrow = written(keyed.select(*names, "n_tokens", "key"), "mix-lengths")
    leaves = narrow.groupBy(*names).agg(F.sum("n_tokens").alias("tokens"))
    plan = leaf_budgets(leaves, names, weights, fraction, max_epochs)
    plan = plan.withColumn("whole", F.expr("case when tokens = 0 then 0 else budget div tokens end"))
    plan = written(plan.withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens")), "mix-budgets")
    small = plan.count() <= BROADCAST_LEAVES

    def with_plan(rows: DataFrame, p: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(p) if small else p, names)

    hashed = with_plan(narrow, plan.select(*names, "whole", "rest")).withColumn(
        "h", _order_key(seed, F.col("whole"), F.col("key"))).withColumn("part", F.substring("h", 1, 4))
    by_leaf = Window.partitionBy(*names)
    parts = hashed.groupBy(*names, "part", "rest").agg(F.sum("n_tokens").alias("t")).withColumn(
        "upto", F.sum("t").over(by_leaf.orderBy("part")))
    # the first range that doesn't fit whole; a leaf whose every range fits has none
    cut = parts.where(F.col("upto") > F.col("rest")).groupBy(*names).agg(
        F.min(F.struct("part", (F.col("upto") - F.col("t")).alias("before"))).alias("cut"))
    cut = cut.select(*names, F.col("cut.part").alias("cut_part"), F.col("cut.before").alias("before"))
    inside = with_plan(hashed, cut).where(F.col("part") == F.col("cut_part")).groupBy(*names, "h", "before", "rest").agg(
        F.sum("n_tokens").alias("t")).withColumn("upto", F.col("before") + F.sum("t").over(by_leaf.orderBy("h")))
    # the order's first key that no longer fits ends the prefix
    end = inside.where(F.col("upto") > F.col("rest")).groupBy(*names).agg(F.min("h").alias("end_h"))
    plan = written(plan.join(end, names, "left"), "mix-plan")
    h = _order_key(seed, F.col("whole"), F.col("key"))
    more = (F.col("whole") < max_epochs) & (F.col("rest") > 0) & (F.col("end_h").isNull() | (h < F.col("end_h")))
    chosen = with_plan(keyed, plan).withColumn("copies", F.col("whole") + more.cast("long"))
    return chosen.where("copies > 0").select(
        "row", *[F.col(n).alias(g) for n, g in zip(names, given)], "n_tokens", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("epoch"),
        F.col("tokens").alias("leaf_tokens"), F.col("budget").alias("leaf_budget"))
