"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.plans import cut_lineage


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """``node, component`` for every node of an edge, component being its smallest reachable node.

    Edges are undirected; null ends, self loops and repeats don't matter. Rounds grow with the
    logarithm of the longest path, each is one grouped shuffle, and lineage is cut after each. A hub
    is never collected: only its minimum is aggregated and joined back.
    """
    e = edges.where(F.col(src).isNotNull() & F.col(dst).isNotNull()).select(F.col(src).alias("u"), F.col(dst).alias("v"))
    loops = e.where("u = v").select("u")
    e = cut_lineage(e.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    nodes = e.select("u").union(e.select("v")).union(loops).distinct()
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: every larger neighbour is hung on the least of the neighbourhood
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
        # small star: all smaller neighbours and the node itself are hung on the least
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("x")).select("x.*").where("u <> v").distinct()
        new = cut_lineage(small)
        changed = new.join(e, ["u", "v"], "left_anti").limit(1).count() + e.join(new, ["u", "v"], "left_anti").limit(1).count()
        e = new
        if not changed:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return nodes.withColumnRenamed("u", "node").join(e.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").select("node", F.coalesce("component", "node").alias("component"))
