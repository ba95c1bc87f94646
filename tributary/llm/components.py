"""Connected components by alternating large and small stars.

The star method (Kiveris et al., 2014) needs a logarithmic number of rounds
in practice. A round is two group-and-join steps; its edges are written to the
shared folder, so the plan stays short and a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import written


def _stars(both: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of each node (the larger ones, or the smaller ones
    and the node itself) to the least of its neighbourhood."""
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(low, "u")
    if large:
        new = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        new = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))
        )
    return new.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges``: (u, v) of longs, either way round. Returns (node, component)
    for every node with an edge that is not itself the least one it reaches."""
    now = written(edges.select("u", "v").where("u <> v").distinct(), "edges")
    mark = None
    while True:
        both = now.union(now.select("v", "u"))
        grown = written(_stars(both, True), "large-star")
        # Small star: each edge points from the larger node to the smaller.
        down = grown.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        now = written(_stars(down, False), "small-star")
        seen = now.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if seen == mark:
            break
        mark = seen
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
