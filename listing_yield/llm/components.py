"""Connected components of an edge table by alternating large-star and small-star steps.

Each step sends a node's neighbours to the least of them; the least neighbour is an aggregate that combines on the map
side, and the join back may be split where a node is hot. Every round is written to the shared folder, so a lost
executor costs at most one round. Nothing but counts reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    side = both.where("v > u" if large else "v < u").join(least, "u")
    out = side.select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        out = out.unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component: for each node of an edge (u, v), the least node that it is joined to."""
    now = materialize(edges.select("u", "v").where("u <> v")
                      .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = None
    while True:
        now = materialize(_star(_star(now, large=True), large=False), "edges")
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
