"""Connected components of a link table by alternating star contractions.

Each round replaces the links of every node by links to its smallest neighbour: first for its larger
neighbours, then for its smaller ones. Both halves are a grouped minimum (combined before the shuffle) and a
join of the links with it, so a node with very many links is a skewed join that Spark splits, never one
list. Rounds are stored in the shared folder; the number of rounds grows with the logarithm of the graph.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm._common import stored


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _hook(pairs: DataFrame, smallest: DataFrame) -> DataFrame:
    """Replace the first end of each (a, b) by the smallest neighbour of a, and drop loops."""
    out = pairs.join(smallest, "a").select(F.col("b").alias("x"), F.col("low").alias("y"))
    return out.where("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``links`` (a, b): long ids. Returns (node, component): component is the smallest id reachable.

    Nodes without links to other nodes do not appear. An empty table gives an empty result.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .distinct(), "links")
    before = None
    for _ in range(max_rounds):
        both = _both_ways(edges)
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        larger = _hook(both.where("b > a"), low).union(
            low.where("low < a").select("a", F.col("low").alias("b"))).distinct()
        down = stored(larger, "links")
        low = down.groupBy("a").agg(F.min("b").alias("low"))
        edges = stored(_hook(down, low).union(low.select("a", F.col("low").alias("b"))).distinct(), "links")
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = now
    raise RuntimeError("the components did not settle")
