"""Connected components of links between 64-bit numbers, in rounds over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigia.durable import Workspace
from vigia.operators.lookup import lookup


def _state(edges: DataFrame) -> tuple:
    """Number of edges and two sums of their digests: equal for equal sets of edges."""
    digest = [F.coalesce(F.sum(F.xxhash64(F.lit(seed), "a", "b").cast("decimal(20,0)")), F.lit(0)) for seed in (1, 2)]
    return tuple(edges.agg(F.count("*"), *digest).head())


def components(links: DataFrame, most_rounds: int = 40) -> DataFrame:
    """node, root for every node of the links (a, b) that is not the least of its component.

    A round hangs every larger neighbour of a node on the node's least neighbour (large star) and then a
    node's smaller neighbours, with the node, on the least of them (small star), until nothing changes. A
    node's neighbours are reduced to a minimum by partial aggregation, and neighbours are counted, so that
    the lookup of the minimum takes nodes of high degree apart.
    """
    with Workspace(links.sparkSession) as work:
        pairs = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
        edges = work.stored(pairs.distinct(), "links")
        state = _state(edges)
        for _ in range(most_rounds):
            if not state[0]:
                break
            both = work.stored(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "neighbours", (edges,))
            least = work.stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("n")), "least")
            large = lookup(both, least, ["a"], "n").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
            large = work.stored(large, "large-star", (both, least))
            least = work.stored(large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")), "least")
            hung = F.inline(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
            small = lookup(large, least, ["a"], "n").select(hung).where("a <> b").distinct()
            edges = work.stored(small, "small-star", (large, least))
            before, state = state, _state(edges)
            if state == before:
                break
        else:
            raise RuntimeError(f"components did not settle in {most_rounds} rounds")
        return work.kept(edges.select(F.col("a").alias("node"), F.col("b").alias("root")), "components")
