"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage_table


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: bigint); the component is its smallest node.

    Alternates large-star and small-star steps: nodes are linked to the smallest
    node among their neighbours until every component is a star around its
    smallest node.  Minima are aggregated before they are joined back, so a node
    with very many edges is only a large side of a join.  Each round is written
    to the shared folder.  Loops, repeated edges and either direction are fine.
    """
    now = stage_table(
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components/edges"
    )
    for _ in range(rounds):
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = stage_table(both.groupBy("u").agg(F.min("v").alias("m")), "components/least")
        large = stage_table(
            both.join(least.select("u", F.least("u", "m").alias("m")), "u").filter("v > u")
            .select(F.col("v").alias("a"), F.col("m").alias("b")), "components/large")
        least = stage_table(large.groupBy("a").agg(F.min("b").alias("m")), "components/least")
        linked = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stage_table(linked.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "components/edges")
        # done when all are stars: nobody's parent has a parent
        if now.select("a").join(now.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
