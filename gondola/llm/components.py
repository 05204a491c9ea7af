"""Connected components of a link table by hooking and pointer jumping, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import written


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, comp) for every node of ``edges`` (a, b): comp is the smallest node reachable.

    Each round gives a node the smallest label among its neighbours' labels, then follows the label
    of its label; rounds grow with the logarithm of a component's diameter in common cases, and the
    loop ends when no label changed. A hub with very many links is a skewed key of the join (Spark splits
    it) and is combined before the shuffle by the aggregation.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "cc-edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("comp")), "cc-labels")
    for _ in range(max_rounds):
        near = both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        hooked = labels.join(near, "node").select("node", "comp", F.least("comp", "near").alias("low"))
        # also the old label's node hooks to the new label, so a whole tree moves at once
        pulled = hooked.groupBy(F.col("comp").alias("node")).agg(F.min("low").alias("pull"))
        step = hooked.join(pulled, "node", "left").select(
            "node", "comp", F.least(F.col("low"), F.coalesce("pull", "low")).alias("low"))
        up = step.select(F.col("node").alias("low"), F.col("low").alias("higher"))
        step = written(step.join(up, "low", "left").select(
            "node", F.least("low", F.coalesce("higher", "low")).alias("comp"),
            (F.col("comp") != F.least("low", F.coalesce("higher", "low"))).alias("moved")), "cc-labels")
        labels = step.select("node", "comp")
        if step.where("moved").isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
