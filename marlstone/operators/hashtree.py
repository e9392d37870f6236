"""A fingerprint of a table of any size: a hash tree of fixed fan-out, built level by level, with proofs of single rows.

Row seq (a long from 0) is leaf seq, and node k of a level hashes the nodes
k * fan to k * fan + fan - 1 below it, so no row of any level holds more than
fan hashes, and each level is one aggregation with a fan-th of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAN = 32


def _over(children: Column) -> Column:
    """A node's hash: of its children's places and hashes, in order."""
    parts = F.transform(F.array_sort(children), lambda c: F.concat(c["at"].cast("string"), F.lit(":"), c["h"]))
    return F.sha2(F.array_join(parts, ",").cast("binary"), 256)


def leaves(rows: DataFrame, seq: str, row: Column) -> DataFrame:
    """(node, h) of level 0.  Rows of one seq are one leaf: the sum of their hashes' halves and their number, so repeats and their order need no gathering."""
    h = F.sha2(F.coalesce(row, F.lit("")).cast("binary"), 256)
    part = lambda i: F.conv(F.substring(h, 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)")
    sums = rows.where(F.col(seq).isNotNull()).groupBy(F.col(seq).cast("long").alias("node"))
    sums = sums.agg(*[F.sum(part(i)).cast("string").alias(f"s{i}") for i in range(4)], F.count(F.lit(1)).cast("string").alias("n"))
    return sums.select("node", F.sha2(F.concat_ws(",", "n", "s0", "s1", "s2", "s3").cast("binary"), 256).alias("h"))


def level_above(level: DataFrame, fan: int = FAN) -> DataFrame:
    """(node, h) of the level above."""
    child = F.struct((F.col("node") % fan).alias("at"), "h")
    return level.groupBy(F.floor(F.col("node") / F.lit(fan)).cast("long").alias("node")).agg(_over(F.collect_list(child)).alias("h"))


def tree(rows: DataFrame, seq: str, row: Column, levels: int, fan: int = FAN) -> DataFrame:
    """(level, node, h) of all levels from the leaves, 0, to `levels`, which has one node if all seq are below fan ** levels."""
    now = leaves(rows, seq, row)
    out = now.select(F.lit(0).alias("level"), "node", "h")
    for k in range(1, levels + 1):
        now = level_above(now, fan)
        out = out.unionByName(now.select(F.lit(k).alias("level"), "node", "h"))
    return out


def root(rows: DataFrame, seq: str, row: Column, levels: int, fan: int = FAN) -> DataFrame:
    """(node, h) of the last level: one row, unless a seq is beyond fan ** levels."""
    now = leaves(rows, seq, row)
    for _ in range(levels):
        now = level_above(now, fan)
    return now


def proof(built: DataFrame, seq: int, levels: int, fan: int = FAN) -> DataFrame:
    """(level, at, children): for each level up to the last the hashes that stand beside the row's own, which is at place `at`."""
    mine = F.floor(F.lit(seq) / F.pow(F.lit(fan), F.col("level"))).cast("long")
    beside = built.where(F.col("level") < levels).where(F.floor(F.col("node") / F.lit(fan)) == F.floor(mine / F.lit(fan)))
    child = F.struct((F.col("node") % fan).alias("at"), "h")
    return beside.groupBy("level").agg(F.sort_array(F.collect_list(child)).alias("children")).select("level", (mine % fan).alias("at"), "children")


def proven(steps: list, leaf: str) -> str | None:
    """The root that a proof (rows of proof()) leads to from a leaf's hash; None if the leaf does not stand in it."""
    import hashlib

    now = leaf
    for step in sorted(steps, key=lambda r: r["level"]):
        children = {c["at"]: c["h"] for c in step["children"]}
        if children.get(step["at"]) != now:
            return None
        now = hashlib.sha256(",".join(f"{at}:{h}" for at, h in sorted(children.items())).encode()).hexdigest()
    return now
