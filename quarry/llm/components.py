"""Connected components by alternating large and small stars.

Each round is a few joins and sums on the two ids of an edge; rounds grow with
the logarithm of a component's diameter.  Every round's edges are written to
the shared folder, so lineage stays short and lost executors cost one round.
Nothing is collected but two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quarry.session import store


def _stored(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges, written, and their number and hash sum from the same job."""
    seen = Observation()
    out = store(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")), "edges")
    return out, (seen.get["n"], seen.get["h"])


def _star(pairs: DataFrame) -> DataFrame:
    """Link each neighbour ``v`` of ``u`` to the least of u and its neighbours."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """Undirected edges (a, b) -> (node, root), root being the least node of
    the component.  Nodes without an edge to another node do not appear."""
    now, mark = _stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    while True:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _star(both).filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        starred = _star(down)
        small = starred.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            starred.select(F.col("u").alias("a"), F.col("m").alias("b"))).filter("a <> b").distinct()
        now, after = _stored(small)
        if after == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        mark = after
