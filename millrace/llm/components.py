"""Connected components of a graph that does not fit on one machine.

Edges are contracted in rounds of two steps: every node points its larger
neighbours to the smallest node it knows, then its smaller ones. Each step is a
combinable minimum per node and a join, so a node with a third of all edges is
a key that Spark can split. A round at least halves the longest paths; the
edges end up as one star per component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import prepared

MAX_ROUNDS = 60


def _centred(edges: DataFrame, both_ways: DataFrame, larger: bool) -> DataFrame:
    """Edges from neighbours to the least node of each neighbourhood."""
    least = both_ways.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = both_ways.join(least, "a")
    if larger:
        return joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(own)


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (columns ``a, b``); a component
    is named by its least node. Self-loops give a component of their own; edges
    with a NULL end are ignored."""
    prepared(edges.sparkSession)
    edges = edges.select("a", "b").filter(F.col("a").isNotNull() & F.col("b").isNotNull())
    loops = edges.filter(F.col("a") == F.col("b")).select("a", "b")
    links = edges.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    links = links.distinct().checkpoint()
    state = None
    for _ in range(MAX_ROUNDS):
        ways = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _centred(links, ways, larger=True).filter(F.col("a") != F.col("b")).distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        links = _centred(down, down, larger=False).filter(F.col("a") != F.col("b")).distinct().checkpoint()
        # Stars alone: no node is both a leaf and a centre. Counts and a sum of hashes tell whether anything moved.
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    leaves = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    centres = links.select(F.col("b").alias("node"), F.col("b").alias("component"))
    alone = loops.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.unionByName(centres).unionByName(alone).groupBy("node").agg(F.min("component").alias("component"))
