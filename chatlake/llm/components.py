"""Connected components of an edge list by minimum labels and pointer jumping."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatlake.session import checkpointed


def components(edges: DataFrame, max_rounds: int = 100, cut: Callable[[DataFrame], DataFrame] = checkpointed) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the component's smallest node.

    A round takes the smallest label among the neighbours and then the label of that label, so long
    chains shrink by doubling.  Rounds are cut off by ``cut``, a checkpoint; only the number of changes reaches the
    driver.  Minima are combined before the shuffle, so a node with many edges is no hot spot.
    """
    both = cut(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root")))
    for _ in range(max_rounds):
        near = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        step = labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("next"))
        step = cut(step.join(jump, "root", "left").select("node", "old", F.least("root", F.coalesce("next", "root")).alias("root")))
        changed = step.filter(F.col("old") != F.col("root")).limit(1).count()
        labels = step.select("node", "root")
        if not changed:
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
