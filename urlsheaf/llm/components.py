"""Connected components of an edge table, by alternating stars.

Each round hangs every node's larger neighbours below its smallest neighbour (large star), then joins the smaller
neighbours of a node to the smallest one (small star).  Minima are pre-aggregated before they are shuffled, and the
join that hands them back may be split by AQE at a hub, so no neighbour list is ever gathered in one place.  The
number of rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urlsheaf.llm.common import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` point from a node to a smaller one."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return least.select("a", F.col("m").alias("b")).union(moved).distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, component)`` for every node of ``edges (a, b)``; a component is named by its smallest node.

    Edges in either direction, repeated edges and loops are allowed; edges with a null end are ignored.  Nodes without
    an edge to another node do not appear.  No edges: no rows.
    """
    name = "star-0"
    now = scratch.keep(edges.where("a != b").select("a", "b"), name)
    turn = 0
    while True:
        turn += 1
        after = scratch.keep(_small_star(_large_star(now)), f"star-{turn}")
        scratch.drop(name)
        name, now = f"star-{turn}", after
        # done if every node points to one other, which points nowhere
        twice = now.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a")
        chained = now.join(now.select(F.col("a").alias("b")), "b", "left_semi").select("a")
        if twice.unionByName(chained).isEmpty():
            break
    ends = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return ends.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
