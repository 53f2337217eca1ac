"""Connected components by contraction, for graphs of any size and shape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``a, b``, longs): one root for each component.

    Each round moves every node to its least neighbour, by hashed order, if that is less than itself, and keeps the
    edges between the images. A fixed share of the nodes goes in each round, in chains as in stars, so the rounds grow
    with the logarithm of the nodes; each is staged. Nothing is gathered by node but a minimum, which tasks combine
    before the shuffle; a hub only makes a join key frequent, and AQE splits that side.
    """
    spark = edges.sparkSession
    left = stage(edges.where("a <> b").select("a", "b").distinct(), "edges")
    moves = []
    while not left.isEmpty():
        ends = left.select("a", "b").unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(F.lit(len(moves)), F.col(c)).alias("h"), F.col(c).alias("node"))  # noqa: B023, E731
        least = ends.groupBy("a").agg(F.least(F.min(rank("b")), F.min(rank("a"))).alias("least"))
        step = stage(least.select(F.col("a").alias("node"), F.col("least").getField("node").alias("to")), "step")
        moves.append(step)
        moved = left.join(step.select(F.col("node").alias("a"), F.col("to").alias("to_a")), "a")
        moved = moved.join(step.select(F.col("node").alias("b"), F.col("to").alias("to_b")), "b")
        left = stage(moved.where("to_a <> to_b").select(F.col("to_a").alias("a"), F.col("to_b").alias("b")).distinct(), "edges")
    if not moves:
        return spark.createDataFrame([], "node long, root long")
    root = moves[-1].select("node", F.col("to").alias("root"))
    for step in reversed(moves[:-1]):
        later = root.select(F.col("node").alias("to"), "root")
        root = stage(step.join(later, "to", "left").select("node", F.coalesce("root", "to").alias("root")), "roots")
    return root
