"""MinHash-LSH with exact verification, and clusters counted with multiplicities; signatures by numpy on Arrow batches, the rest in built-in functions.

Candidates share a band of their signatures; each is verified on the whole sets,
so no link is wrong, and a pair at the threshold is missed with a chance of
1 - recall at most (`bands` chooses the cut of the signature for it).

A band's bucket may hold a large group of near copies.  Its members are compared
with its smallest one first; only members that are not yet in one component are
then compared with each other, in tiles.  So a group of near copies gives about
one candidate for each member and band, and no link that the bands offer is lost
between components.
"""

from __future__ import annotations

import random
import sys

import numpy as np
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from ..sources.shared import discard, materialise
from .components import components

# Python workers need no copy of the repository.
register_pickle_by_value(sys.modules[__name__])

PERMUTATIONS = 64
RECALL = 0.99
#: Members of a bucket in a tile's side, about.
TILE = 2048
#: Items hashed at a time.
ITEMS = 1 << 18


def bands(threshold: float, permutations: int = PERMUTATIONS, recall: float = RECALL) -> tuple[int, int]:
    """(bands, rows): the longest rows for which two sets of that similarity share a band with the chance recall."""
    for rows in range(permutations, 0, -1):
        n = permutations // rows
        if 1 - (1 - threshold**rows) ** n >= recall:
            return n, rows
    return permutations, 1


def _signed(permutations: int):
    """A function of array columns without empty ones: for each permutation the smallest hash of a row's items."""
    rng = random.Random(permutations)
    factors = [(np.uint64(rng.getrandbits(64) | 1), np.uint64(rng.getrandbits(64))) for _ in range(permutations)]

    def signed(sets: pa.Array) -> pa.Array:
        ends = np.cumsum(sets.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        starts = np.concatenate(([0], ends))[:-1]
        items = sets.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        out, lo = np.empty((len(ends), permutations), np.uint64), 0
        while lo < len(ends):
            hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + ITEMS, "right")))
            x = items[starts[lo] : ends[hi - 1]]
            x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(29)
            for k, (times, plus) in enumerate(factors):
                out[lo:hi, k] = np.minimum.reduceat(x * times + plus, starts[lo:hi] - starts[lo])
            lo = hi
        return pa.ListArray.from_arrays(pa.array(np.arange(len(ends) + 1, dtype=np.int32) * permutations, pa.int32()), pa.array(out.reshape(-1).view(np.int64)))

    # The types are named, as Spark reads a column function's kind from them.
    signed.__annotations__ = {"sets": pa.Array, "return": pa.Array}
    return F.arrow_udf(signed, ArrayType(LongType()))


def signatures(sets: DataFrame, id_: str, items: str, permutations: int = PERMUTATIONS, *others: str) -> DataFrame:
    """(id, sig and the columns named): for each permutation the smallest hash of the set's items (64-bit values); empty sets have none."""
    full = sets.where(F.size(items) > 0)
    return full.select(F.col(id_).alias("id"), _signed(permutations)(F.col(items)).alias("sig"), *others)


def band_keys(sig: Column, group: Column, n: int, rows: int) -> Column:
    """A hash of each band of a signature; different groups share none."""
    return F.array(*[F.xxhash64(group, F.lit(b), F.slice(sig, b * rows + 1, rows)) for b in range(n)])


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(u, v, common, total) of the pairs (u, v) whose sets (id, s) have a Jaccard similarity of threshold or more."""
    met = pairs.join(sets.select(F.col("id").alias("u"), F.col("s").alias("su")), "u").join(sets.select(F.col("id").alias("v"), F.col("s").alias("sv")), "v")
    met = met.select("u", "v", F.size(F.array_intersect("su", "sv")).cast("long").alias("common"), (F.size("su") + F.size("sv")).alias("both"))
    return met.select("u", "v", "common", (F.col("both") - F.col("common")).cast("long").alias("total")).where(F.col("common") / F.col("total") >= threshold)


def tiled_pairs(members: DataFrame, key: str, tile: int = TILE) -> DataFrame:
    """(u, v), u < v, of members (key, id, comp) of one key and different comp.

    A key of many members is dealt into blocks, and each two blocks meet in a
    join key of their own, so no task holds a large key.
    """
    size = members.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / F.lit(tile)).alias("blocks"))
    placed = members.join(size, key).withColumn("at", F.pmod(F.xxhash64("id"), F.col("blocks")))
    side = lambda own, other, way, name: placed.select(key, F.col("at").alias(own), F.explode(way).alias(other), F.col("id").alias(name), F.col("comp").alias(f"{name}_comp"))
    a = side("lo", "hi", F.sequence(F.col("at"), F.col("blocks") - 1), "a")
    b = side("hi", "lo", F.sequence(F.lit(0).cast("long"), F.col("at")), "b")
    met = a.join(b, [key, "lo", "hi"]).where("a_comp <> b_comp and (lo < hi or a < b)")
    return met.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()


def links(sets: DataFrame, id_: str, items: str, threshold: float, group: str | None = None, permutations: int = PERMUTATIONS, recall: float = RECALL, tile: int = TILE) -> DataFrame:
    """(u, v, common, total): verified links, u < v, enough to connect all that the bands offer.

    sets: distinct ids (long), items an array of distinct 64-bit values; only
    sets of one group are compared.  Empty and null sets have no link; a null
    group is a group of its own.
    """
    n, rows = bands(threshold, permutations, recall)
    grouped = sets.select(F.col(id_).cast("long").alias("id"), F.col(items).alias("s"), (F.xxhash64(group) if group else F.lit(0).cast("long")).alias("g"))
    kept = materialise(grouped, "minhash-sets")
    signed = signatures(kept, "id", "s", permutations, "g")
    posts = materialise(signed.select("id", F.explode(band_keys(F.col("sig"), F.col("g"), n, rows)).alias("key")), "minhash-posts")
    shared = posts.groupBy("key").agg(F.min("id").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "hub")
    met = materialise(posts.join(shared, "key"), "minhash-buckets")
    discard(posts)
    star = materialise(met.where("id <> hub").select(F.col("hub").alias("u"), F.col("id").alias("v")).distinct(), "minhash-star")
    first = materialise(verified(star, kept, threshold), "minhash-links")
    comps = components(first.select("u", "v"))
    named = met.select("key", "id").join(comps, F.col("id") == F.col("node"), "left").select("key", "id", F.coalesce("comp", "id").alias("comp"))
    named = materialise(named, "minhash-named")
    open_ = named.groupBy("key").agg((F.min("comp") < F.max("comp")).alias("open")).where("open").select("key")
    across = tiled_pairs(named.join(open_, "key", "left_semi"), "key", tile).join(star, ["u", "v"], "left_anti")
    second = materialise(verified(across, kept, threshold), "minhash-links")
    for done in (met, star, named):
        discard(done)
    return first.unionByName(second)


def near_clusters(sets: DataFrame, id_: str, items: str, threshold: float, group: str | None = None, **options) -> DataFrame:
    """(id, cluster) of each row of sets: the smallest id that it is linked to, itself included."""
    comps = components(links(sets, id_, items, threshold, group, **options).select("u", "v"))
    ids = sets.select(F.col(id_).cast("long").alias("id"))
    return ids.join(comps, F.col("id") == F.col("node"), "left").select("id", F.coalesce("comp", "id").alias("cluster"))


def cluster_summary(clustered: DataFrame, group: str) -> DataFrame:
    """For each group what its clusters come to; clustered: group, cluster and n, the rows that a distinct text stands for.

    near_rows are those of clusters of more than one row, whether of equal or of near texts.
    """
    each = clustered.groupBy(group, "cluster").agg(F.sum("n").alias("rows_"), F.count(F.lit(1)).alias("texts"), F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("copied"))
    many = F.col("rows_") > 1
    out = each.groupBy(group).agg(
        F.sum("rows_").alias("n_rows"),
        F.sum("texts").alias("n_templates"),
        F.sum("copied").alias("exact_repeated_rows"),
        F.count_if(many).alias("near_clusters"),
        F.sum(F.when(many, F.col("rows_")).otherwise(0)).alias("near_rows"),
        F.max(F.when(many, F.col("rows_")).otherwise(0)).alias("largest_cluster"),
    )
    return out.withColumns({"unique_ratio": F.round(F.col("n_templates") / F.col("n_rows"), 6), "near_ratio": F.round(F.col("near_rows") / F.col("n_rows"), 6)})
