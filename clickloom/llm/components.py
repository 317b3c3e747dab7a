"""Connected components of a distributed edge list: large-star and small-star steps until nothing moves.

Every step is a partial aggregate (least neighbour of each node) stored and joined back, so a node with very many
edges neither gathers in one task nor holds up a join: both join sides are stored tables, which adaptive execution
splits. Nodes and links stay in Spark; the driver sees one row of counts per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.sources.stage import stage


def connected_components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, component) for every node with an edge to another: ``component`` is the least node it can reach.

    ``edges`` has long columns ``u`` and ``v`` in any direction, repeated or not; loops and nulls are ignored. No
    edges give no rows. Raises if ``rounds`` do not suffice, which would take more than 2^rounds nodes in a chain.
    """
    pairs = stage(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-edges"
    )
    seen = mark(pairs)
    for _ in range(rounds):
        if seen[0] == 0:
            break
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).withColumnRenamed("u", "n"), "cc-large")
        large = both.where("v > u").join(least, F.col("u") == F.col("n")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.where("u <> v").distinct(), "cc-edges")
        least = stage(large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "n"), "cc-small")
        small = large.join(least, F.col("u") == F.col("n")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = least.select(F.col("n").alias("u"), F.col("m").alias("v"))
        pairs = stage(small.unionByName(own).distinct(), "cc-edges")
        now = mark(pairs)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = pairs.select(F.col("v").alias("u"), "v").distinct()
    return pairs.unionByName(roots).select(F.col("u").alias("node"), F.col("v").alias("component"))


def mark(pairs: DataFrame) -> tuple:
    """Count and hash sums that tell whether an edge list has changed."""
    h = F.xxhash64("u", "v")
    row = pairs.agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x"), F.sum(h.cast("decimal(38,0)")).alias("s")).first()
    return tuple(row)
