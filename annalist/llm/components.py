"""Connected components of a graph given as pairs, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.llm.frames import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours its least neighbour."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node ties its smaller neighbours, and itself, to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return down.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*")


def components(pairs: DataFrame, name: str = "components") -> DataFrame:
    """``a, b``: each node but the least of a component, and that least node.

    ``pairs`` has columns ``a, b`` of one orderable type; pairs of a node with
    itself and repeated pairs change nothing. Each round halves distances at least; rounds end when the pairs
    no longer change, which a count and a sum of hashes tell.
    """
    edges, before = stage(pairs.where("a <> b").distinct(), name), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return edges
        before = state
        edges = stage(_small_star(_large_star(edges).where("a <> b").distinct()).where("a <> b").distinct(), name)
