"""Connected components of a graph that is a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeway.llm.common import staged


def _toward_least(links: DataFrame, larger: bool) -> DataFrame:
    """Link the neighbours of every node to the least node of its neighbourhood.

    ``larger``: only neighbours above the node are linked anew (large star), else
    the node and its neighbours below (small star).
    """
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both if larger else links.where("u > v")
    least = near.groupBy("u").agg(F.min("v").alias("m"))
    # written, so that the join has two plain inputs and Spark can split a hub's
    least = staged(least.select("u", F.least("u", "m").alias("m")), "least")
    joined = near.join(least, "u")
    if larger:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.where("u <> v").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """Columns (node, root): the least node reachable from each linked node.

    Alternates large-star and small-star steps until the links no longer change;
    every round is written to the shared folder, so a lost executor costs at most
    one round. Hubs are aggregated map-side and joined, never gathered. Nodes
    without a link to another node do not appear.
    """
    now = staged(
        links.select(
            F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
        ).where("u <> v").distinct(),
        "links",
    )
    before = None
    while True:
        state = now.agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")
        ).first()
        if before == state or not state["n"]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = state
        large = _toward_least(now, larger=True)
        now = staged(_toward_least(large, larger=False), "links")
