"""Connected components of an undirected graph that is far too large for one machine, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewloom.llm.common import stored

MAX_ROUNDS = 200


def components(edges: DataFrame, folder: str) -> DataFrame:
    """(node, root) for every node of `edges` (a, b: bigint); nodes share a root if they are connected.

    Random contraction: in each round every node steps to the node of least random rank among itself and its neighbours,
    and the edges are redrawn between those. That removes a constant share of the nodes whatever the graph's shape, so a
    long chain takes a few rounds. No neighbour list is ever gathered, and every round is written out.
    """
    spark = edges.sparkSession
    left = stored(edges.where(F.col("a") != F.col("b")).select("a", "b").distinct(), f"{folder}/edges")
    roots = None
    for turn in range(MAX_ROUNDS):
        if left.isEmpty():
            break
        rank = lambda node, turn=turn: F.struct(F.xxhash64(F.lit(turn), node).alias("rank"), node.alias("to"))
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        steps = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min(rank(F.col("b"))), rank(F.first("a"))).getField("to").alias("to"))
        steps = stored(steps, f"{folder}/steps{turn}")
        if roots is None:
            roots = steps.select("node", F.col("to").alias("root"))
        else:
            moved = roots.join(steps.select(F.col("node").alias("root"), "to"), "root", "left")
            roots = moved.select("node", F.coalesce("to", "root").alias("root"))
        roots = stored(roots, f"{folder}/roots{turn}")
        first, second = steps.select(F.col("node").alias("a"), F.col("to").alias("x")), steps.select(F.col("node").alias("b"), F.col("to").alias("y"))
        redrawn = left.join(first, "a").join(second, "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        left = stored(redrawn.where("a != b").distinct(), f"{folder}/edges{turn}")
    else:
        raise RuntimeError(f"no end after {MAX_ROUNDS} rounds")
    if roots is None:
        return spark.createDataFrame([], "node bigint, root bigint")
    return roots
