"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle


def components(links: DataFrame) -> DataFrame:
    """links(a, b): one row (node, root) per linked node; root is the smallest node that it reaches.

    Large-star and small-star steps in turn: every node hangs its neighbours on the smallest one it knows,
    until nothing changes. Each step is two aggregations and joins that split hot nodes; the tables between
    steps are written, so the plan stays short. Links that are stars already, as this function returns them,
    take one step.
    """
    def state_of(edges: DataFrame):
        return edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()

    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = settle(edges, "links")
    seen = state_of(edges)
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        edges = settle(small.where("u <> v").distinct(), "links")
        state = state_of(edges)
        if state == seen:
            break
        seen = state
    tops = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(tops)
