"""Connected components of a link table by alternating large-star and small-star rounds.

Every round is two grouped minima and two joins over the links; no group is collected anywhere.
Each round is written to the shared scratch folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``links(a, b)`` -> ``(node, component)``: every node that has a link, with its smallest reachable node.

    Self links, repeated links and both directions are fine. An empty table gives an empty table.
    Ends when a round changes nothing (the rounds grow with the logarithm of the longest chain);
    raises if ``max_rounds`` was not enough instead of giving partial labels.
    """
    edges = stage(links.where("a <> b")
                  .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    before = _fingerprint(edges)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.join(low, "a").where("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        # large holds a > b; each node keeps its smallest neighbour and hangs the others below it
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a")
                 .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                           F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                 .select("e.a", "e.b").where("a <> b").distinct())
        edges = stage(small, "cc")
        after = _fingerprint(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
