"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm._common import discard, stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the undirected ``edges`` (a long, b long); root is its component's least node.

    Self-loops and repeated edges are fine; a null end is dropped. No edges give no rows. Each
    round keeps at most one edge a node more than it got. Least neighbours are summed up and
    stored before they are joined, so that Spark can split the join at a node of many edges, and
    reads few edges in few tasks; a round's tables are deleted when the next round's edges are
    stored. Rounds grow with the logarithm of the longest path.
    """
    a, b = F.col("a"), F.col("b")
    now = stored(edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "edges")
    state = _digest(now)
    while True:
        both = now.union(now.select("b", "a"))
        least = stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), "least")
        large = both.join(least, "a").where(b > a).select(b.alias("u"), F.col("m").alias("v"))
        floor = stored(large.groupBy("u").agg(F.min("v").alias("m")), "floor")
        small = large.join(floor, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("a"), F.col("m").alias("b"))
        found = stored(small.union(floor.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct(), "edges")
        discard(now, least, floor)
        now = found
        if (new := _digest(now)) == state:
            return now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).unionByName(now.select(b.alias("node"), b.alias("root")).distinct())
        state = new


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
