"""Connected components of an edge table by alternating large-star and small-star steps.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). Every step is one aggregate
(the smallest neighbour of each node, combined map-side) and one join back; each round is written to
the shared folder, so the lineage stays short and nothing but a row count reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.tables import Scratch


def _star(scratch: Scratch, edges: DataFrame, name: str, large: bool) -> DataFrame:
    """One step over edges (u, v), v < u. Large: hang the greater neighbours of every node on its
    smallest; small: hang the smaller neighbours, and the node itself, on its smallest."""
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # Only nodes whose smallest neighbour is smaller than themselves move anything.
        least = scratch.table(least.where("m < u"), f"{name}-least")
        moved = both.join(least, "u", "left").where("v > u").select(
            F.col("v").alias("u"), F.coalesce("m", "u").alias("v"))
    else:
        least = scratch.table(edges.groupBy("u").agg(F.min("v").alias("m")), f"{name}-least")
        joined = edges.join(least, "u")
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("v < u").union(
            least.select("u", F.col("m").alias("v")))
    return moved.distinct()


def components(scratch: Scratch, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node with an edge to another node; component is the smallest node
    reachable. Nodes are of any one orderable type; null ends and loops are ignored."""
    pairs = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    current, k = scratch.table(pairs, "edges-0"), 0
    while True:
        k += 1
        large = scratch.table(_star(scratch, current, f"large-{k}", True), f"edges-{k}-large")
        nxt = scratch.table(_star(scratch, large, f"small-{k}", False), f"edges-{k}")
        # Done when every node hangs on one parent and no parent hangs on another node.
        parents = nxt.select(F.col("v").alias("p")).distinct()
        open_rows = nxt.groupBy("u").count().where("count > 1").select("u").union(
            nxt.join(parents, nxt.u == parents.p, "left_semi").select("u"))
        done = open_rows.isEmpty()
        scratch.drop(f"edges-{k - 1}", f"edges-{k}-large", f"large-{k}-least", f"small-{k}-least")
        if done:
            break
        current = nxt
    stars = nxt.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(stars.select(F.col("component").alias("node"), "component").distinct())
