"""Connected components over an edge table, by alternating large-star and
small-star steps. Every step is a group minimum with partial sums and one join
on the node; steps are checkpointed, so a lost executor repeats one step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: each greater neighbour of u is linked to the least of u and
    its neighbours. Small star: likewise for u itself and smaller neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    rows = both.join(least, "u")
    if large:
        out = rows.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = rows.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, u: str = "u", v: str = "v", max_rounds: int = 100) -> DataFrame:
    """Rows (node, component) for every node of ``edges``; the component is
    the least node that can be reached. Nodes are integers."""
    e = checkpointed(edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u <> v").distinct())
    last = None
    for _ in range(max_rounds):
        e = checkpointed(_star(_star(e, True), False))
        now = e.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.lit(0)).alias("s")).first()
        if last == (now["n"], now["s"]):
            # a fixed point: every edge leads to the root of its star
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        last = (now["n"], now["s"])
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
