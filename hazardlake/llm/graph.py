"""Connected components by repeated contraction, with nothing but joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hazardlake.llm.common import settle


def components(edges: DataFrame) -> DataFrame:
    """Each node of the edges (a, b) with the ``root`` its component shares.

    A round gives every node the least of itself and its neighbours in an order that changes from
    round to round, and contracts it into that one, so a constant share of the nodes goes
    in each round, also on long chains. Minima combine before the shuffle, so a node with very
    many neighbours is no burden. Every round is written to the shared folder.
    """
    left = settle(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
                  "edges")
    hops: list[DataFrame] = []
    while not left.isEmpty():
        order = F.xxhash64(F.col("b"), F.lit(len(hops)))
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.withColumn("o", order).groupBy("a").agg(F.min("o").alias("o"), F.min_by("b", "o").alias("b"))
        own = F.xxhash64(F.col("a"), F.lit(len(hops)))
        hop = settle(nearest.select(F.col("a").alias("node"), F.when(F.col("o") < own, F.col("b"))
                                    .otherwise(F.col("a")).alias("parent")), "hops")
        hops.append(hop)
        first = hop.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        second = hop.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        moved = left.join(first, "a").join(second, "b").filter("pa <> pb")
        left = settle(moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
    if not hops:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = hops[-1].select("node", F.col("parent").alias("root"))
    for hop in reversed(hops[:-1]):
        later = roots.select(F.col("node").alias("parent"), "root")
        roots = hop.join(later, "parent", "left").select("node", F.coalesce("root", "parent").alias("root"))
    return settle(roots, "roots")
