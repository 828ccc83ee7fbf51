"""Connected components of a graph given as edges, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laminar.llm.common import pinned


def connected_components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) -> (node, root): one root per component, for every node with an edge.

    Each round gives every node a random rank (a hash of node and round) and merges it into
    its lowest neighbour if that ranks below itself; edges are renamed, loops and doubles
    go. A constant share of the nodes goes each round, on long chains as on stars, so
    rounds grow with the logarithm of the edges. Minima are partially aggregated, so a node
    with very many edges costs a row per task; every round is written to the shared folder.
    """
    left = pinned(
        edges.where("a != b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    parents: list[DataFrame] = []
    while not left.isEmpty():
        rank = lambda c: F.xxhash64(F.col(c), F.lit(len(parents)))  # noqa: B023, E731
        both = left.union(left.select("b", "a"))
        low = both.groupBy("a").agg(F.min(F.struct(rank("b").alias("rank"), F.col("b").alias("node"))).alias("low"))
        up = pinned(
            low.select(
                F.col("a").alias("node"),
                F.when(F.col("low.rank") < rank("a"), F.col("low.node")).otherwise(F.col("a")).alias("up"),
            )
        )
        parents.append(up)
        of_a = up.select(F.col("node").alias("a"), F.col("up").alias("ua"))
        of_b = up.select(F.col("node").alias("b"), F.col("up").alias("ub"))
        renamed = left.join(of_a, "a").join(of_b, "b").where("ua != ub")
        left = pinned(
            renamed.select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).distinct()
        )
    if not parents:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = parents[-1].select("node", F.col("up").alias("root"))
    for up in reversed(parents[:-1]):
        above = roots.select(F.col("node").alias("up"), "root")
        roots = up.join(above, "up", "left").select("node", F.coalesce("root", "up").alias("root"))
    return roots
