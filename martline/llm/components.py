"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to the smallest node it knows."""
    both = edges.select("u", "v").union(edges.select("v", "u")).toDF("u", "v")
    least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least")), "least")
    return (both.where("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("least").alias("v")).where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = stored(down.groupBy("u").agg(F.min("v").alias("least")), "least")
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    own = least.select("u", F.col("least").alias("v"))
    return moved.union(own).where("u <> v").distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")),
                           F.bit_xor(F.xxhash64("v", "u", F.lit(1)))).first())


def roots(edges: DataFrame) -> DataFrame:
    """(node, root) for every linked node; root is the component's smallest node.

    ``edges(u, v)`` are links between different longs, in any order, repeats
    allowed.  Each round is written to the shared scratch folder, so a lost
    executor repeats one round at most.  Minima are combined map-side and written
    before they are joined back: with no aggregate on the join's key beside it, Spark can split
    the partition of a hub.
    """
    edges = stored(edges.where("u <> v").select("u", "v"), "links")
    seen = None
    while True:
        edges = stored(_small_star(_large_star(edges)), "links")
        now = _digest(edges)
        if now == seen or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now
