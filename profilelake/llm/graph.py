"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profilelake.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest of its closed neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.where("v > u").join(lowest, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where("u <> v").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang the smaller neighbours of a node, and the node, on the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    lowest = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = (
        down.join(lowest, "u").where("v <> m")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    )
    return moved.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, root)`` for every node of ``edges (u, v)``; root is the least node reachable.

    Alternates the large-star and small-star steps until nothing changes, which takes a number
    of rounds that grows with the logarithm of the node count. Each step is an aggregate that
    combines in the tasks first and a join on it, so a node with very many edges is split like
    any skewed join. Rounds are written to the shared folder; nodes never reach the driver.
    Loops and repeated edges do no harm; an empty list gives no rows. Nodes must not be null.
    """
    def mark(df):
        return df.agg(
            F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")
        ).first()

    edges = stored(edges.where("u <> v").select("u", "v").distinct(), name)
    before = None
    while (now := mark(edges)) != before:
        before = now
        edges = stored(_small_star(_large_star(edges)), name)
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )
