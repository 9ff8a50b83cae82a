"""Connected components over links, as joins and grouped minima on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideglass.llm.common import drop_written, written


def components(links: DataFrame, rounds: int = 64) -> DataFrame:
    """(node, label) for every node of links (src, dst, both long): label is the least node that it reaches.

    Each round hooks a node's parent, and the node itself, under the least grandparent among its neighbours, then
    shortens paths; the number of rounds grows with the logarithm of the longest chain. State is a table on the shared
    folder, written once a round, so that lineage stays short and both sides of each join are scans: Spark can then
    split a parent that many nodes share. An empty table gives an empty result.
    """
    both = links.select("src", "dst").union(links.select(F.col("dst"), F.col("src"))).filter("src <> dst").distinct()
    edges = written(both, "edges")
    state = written(edges.groupBy(F.col("src").alias("node")).agg(F.least("node", F.min("dst")).alias("parent")), "labels")
    for _ in range(rounds):
        up = state.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        now = written(state.join(up, "parent"), "grand")
        seen = edges.join(now.select(F.col("node").alias("src"), "grand"), "src").groupBy(F.col("dst").alias("node")).agg(F.min("grand").alias("low"))
        heard = now.join(seen, "node")
        hooks = heard.select("node", F.least("parent", "grand", "low").alias("label"), F.col("parent").alias("was"))
        roots = heard.select(F.col("parent").alias("node"), F.col("low").alias("label"), F.lit(None).cast("long").alias("was"))
        following = written(hooks.union(roots).groupBy("node").agg(F.min("label").alias("parent"), F.max("was").alias("was")), "labels")
        moved = not following.filter("parent <> was").isEmpty()
        drop_written(now)
        drop_written(state)
        state = following.select("node", "parent")
        if not moved:
            break
    else:
        raise RuntimeError("components did not settle")
    return state.select("node", F.col("parent").alias("label"))
