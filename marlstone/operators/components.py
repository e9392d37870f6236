"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import discard, materialise


def _pairs(df: DataFrame) -> DataFrame:
    return df.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _state(df: DataFrame) -> tuple:
    return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """edges: u, v (long).  Returns (node, comp): each node that has an edge, with the smallest node it is connected to.

    Each step costs joins on the edge table only, whatever the shape of the
    components; their number grows with the logarithm of a component's size.
    A node's smallest neighbour is aggregated (partially, before the shuffle)
    and joined back, so that the planner can split the edges of a hub.
    Loops, repeated and reversed edges change nothing; no edges, no rows.
    """
    now = materialise(_pairs(edges), "components")
    state = _state(now)
    while True:
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        before, now = now, materialise(_pairs(small), "components")
        discard(before)
        last, state = state, _state(now)
        if state == last:
            return now.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(now.select(F.col("v").alias("node"), F.col("v").alias("comp"))).distinct()
