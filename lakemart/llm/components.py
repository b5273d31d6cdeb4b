"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import stored

LINKS_PER_FILE = 500_000


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); nodes of a component share their root.

    Rounds of contraction: each node moves to the neighbour, or itself, with the smallest hash of
    that round, and links between nodes that have met go. A new hash each round leaves no shape of
    graph slow: a constant share of the nodes goes per round, on average. Each round is written, so
    the plan stays short; minima are combined before their shuffle, so a node may have any number
    of links.
    """
    links = stored(links.select("a", "b").where("a <> b").distinct(), "links")
    moved, step, total = None, 0, 1
    while left := links.count():
        step += 1
        # As many files as the graph that is left asks for.
        files = 1 + left // LINKS_PER_FILE
        ends = links.union(links.select(F.col("b"), F.col("a")))
        rank = F.struct(F.xxhash64("b", F.lit(step)).alias("rank"), F.col("b").alias("to"))
        own = F.struct(F.xxhash64("node", F.lit(step)).alias("rank"), F.col("node").alias("to"))
        best = ends.groupBy(F.col("a").alias("node")).agg(F.min(rank).alias("best"))
        move = best.select("node", F.least("best", own)["to"].alias("to"))
        move = stored(move.coalesce(files), "moves")
        moved = (
            move.select("node", F.col("to").alias("root"))
            if moved is None
            else moved.join(move.withColumnRenamed("node", "root"), "root", "left").select(
                "node", F.coalesce("to", "root").alias("root")
            )
        )
        one = move.select(F.col("node").alias("a"), F.col("to").alias("x"))
        other = move.select(F.col("node").alias("b"), F.col("to").alias("y"))
        links = links.join(one, "a").join(other, "b")
        links = links.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        links = stored(links.where("a <> b").distinct().coalesce(files), "links")
        total = max(total, files)
    if moved is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stored(moved.coalesce(total), "components")
