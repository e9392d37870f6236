"""Exact Jaccard self-join by prefix filtering; bitmaps and the verification of a tile's pairs are small helpers on Arrow data."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from ..sources.shared import discard, materialise, shuffles_end


def jaccard_pairs(sets: DataFrame, id_: str, items: str, threshold: float) -> DataFrame:
    """(u, v, common, total) of pairs u < v whose sets have a Jaccard similarity of threshold or more; see jaccard_classes."""
    return expanded(*jaccard_classes(sets, id_, items, threshold))


def jaccard_classes(sets: DataFrame, id_: str, items: str, threshold: float, made: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """(pairs, copies): pairs (u, v, common, total), u < v, of the first rows of equal sets alone, and (id, first, n) of the others.

    sets: one row for each id, items an array of distinct 64-bit values.  In one
    order for all, two sets of that similarity share one of their first
    n - ceil(threshold * n) + 1 items, so only those are joined, under the
    length bound.  Pairs are verified on the full sets.

    A row whose set equals an earlier one's is a copy, at one row, whatever the
    number of its kin; n is the size of the set.  Empty and null sets have
    neither pairs nor copies.  Equal sets are told by two hashes and their size.  An id of
    several different sets takes part with each; two such rows are no pair, and
    of the pairs of two ids the most similar one is listed.

    made: what makes the items from rows of sets, which have an id only until
    then, so that those without a candidate are passed by before they are made again.

    The sets are not written: they are made for their prefixes and bitmaps, and
    again for the verification of those that have a candidate left.  No step
    sends a set, or a bitmap of a frequent item's sets, once for each pair.
    """
    whole = lambda some: (made(some) if made else some).select(F.col(id_).alias("id"), F.col(items).alias("s"))
    rows, spark = whole(sets), sets.sparkSession
    with shuffles_end(spark):
        named = materialise(_prefixes(rows, threshold), "jaccard-prefix")
        first = named.where("n > 0").groupBy("c", "k", "n").agg(F.min("id").alias("first"))
        classes = materialise(first, "jaccard-classes")
        of = classes.select("c", "k", F.col("n").alias("m"), "first")
        met = named.select("id", "c", "k", "n").join(of, ["c", "k"]).where("n = m and id > first")
        copies = materialise(met.select("id", "first", F.col("n").cast("long").alias("n")), "jaccard-copies")
        posts = materialise(_posts(named.select("c", "n", F.explode("prefix").alias("item"))), "jaccard-posts")
        wanted = posts.select("c").distinct()
        # Of classes that share a name each has its own bitmap.
        each = named.join(wanted, "c", "left_semi").groupBy("c", "k", "n").agg(F.any_value("bits").alias("bits"))
        maps = materialise(each.select("c", "n", "bits"), "jaccard-bitmaps")
        discard(named)
        near = _near(posts, maps, threshold)
        discard(posts)
        discard(maps)
        wanted = near.select(F.explode(F.array("u", "v")).alias("c")).distinct()
        ids = materialise(classes.join(wanted, "c", "left_semi").select("c", "k", "n", F.col("first").alias("id")), "jaccard-wanted")
        discard(classes)
        again = _hashed(whole(among(sets, ids, id_, "id")).select("id", F.sort_array("s").alias("s")))
        full = materialise(again.join(ids, ["id", "c", "k", "n"]).select("c", "id", "s"), "jaccard-firsts")
        tiles = materialise(_tiles(near, ids), "jaccard-tiles")
        discard(near)
        sent = materialise(tiles.select("tile", F.explode(F.array("u", "v")).alias("c")).distinct(), "jaccard-sent")
        keys = (sent.join(ids, "c").agg(F.sum("n")).first()[0] or 0) // KEY_ITEMS + int(spark.conf.get("spark.sql.shuffle.partitions"))
        pairs = _verified(tiles, sent, full, keys, threshold)
        pairs = pairs.where("a <> b").groupBy(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).agg(F.max(F.struct(F.col("common") / F.col("total"), "common", "total")).alias("m"))
        pairs = materialise(pairs.select("u", "v", "m.common", "m.total"), "jaccard-pairs")
        for done in (tiles, sent, ids):
            discard(done)
    return pairs, copies


def expanded(pairs: DataFrame, copies: DataFrame) -> DataFrame:
    """All pairs (u, v, common, total) of rows, copies included, from what jaccard_classes returns."""
    of = copies.select("first", F.col("id").alias("member"))
    near = pairs
    for end in ("u", "v"):
        more = near.join(of, near[end] == of["first"]).withColumn(end, F.col("member")).select(*pairs.columns)
        near = near.unionByName(more)
    near = near.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"), "common", "total")
    star = copies.select(F.col("first").alias("u"), F.col("id").alias("v"), F.col("n").alias("common"), F.col("n").alias("total"))
    a, b = copies.select("first", F.col("id").alias("u"), "n"), copies.select("first", F.col("id").alias("v"))
    within = a.join(b, "first").where("u < v").select("u", "v", F.col("n").alias("common"), F.col("n").alias("total"))
    return near.unionByName(star).unionByName(within)


#: Sets whose items tell what is frequent, about; items that are then called frequent, at most.
SAMPLE_SETS, FREQUENT = 2000, 4096


def frequent_items(rows: DataFrame) -> list[int]:
    """The items (of rows id, s) that several sets of a sample hold, rarest first, at most FREQUENT."""
    n = rows.count()
    some = rows.where(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(max(1, n // SAMPLE_SETS))) == 0)
    # The outer explode asks for no filter on s, which would be pushed below and make s again there.
    each = some.select(F.explode_outer("s").alias("item")).where("item is not null").groupBy("item").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    return [r["item"] for r in each.orderBy(F.desc("f"), "item").limit(FREQUENT).collect()][::-1]


def _hashed(rows: DataFrame) -> DataFrame:
    """rows with c, k and n, two hashes and the size of the sorted set s."""
    return rows.select("*", F.xxhash64("s").alias("c"), F.hash("s").alias("k"), F.greatest(F.size("s"), F.lit(0)).alias("n"))


def _prefixes(rows: DataFrame, threshold: float) -> DataFrame:
    """(id, c, k, n, prefix, bits) of rows (id, s).

    Any order of items that is the same for all sets finds all pairs; one that
    puts frequent items last makes fewer candidates.  What is frequent comes
    from a sample of bounded size, all other items go by value, so each row
    makes its own prefix: nothing is counted or joined for it.
    """
    frequent = frequent_items(rows)
    known = F.split(F.lit(",".join(map(str, frequent))), ",") if frequent else F.array()
    split = _hashed(rows.select("id", F.sort_array("s").alias("s"))).withColumn("bits", _bitmap("s")).withColumn("common", F.array_intersect(known.cast("array<bigint>"), "s"))
    keep = (F.col("n") - F.ceil(F.lit(threshold) * F.col("n")) + 1).cast("int")
    ordered = F.concat(F.array_except("s", "common"), "common")  # array_except keeps the order of s
    return split.select("id", "c", "k", "n", F.slice(ordered, F.lit(1), keep).alias("prefix"), "bits")


def _posts(posts: DataFrame) -> DataFrame:
    """(item, c, n, held) of posts (item, c, n) whose item several sets hold in their prefixes; a post travels once, those that stand alone end there."""
    once = posts.repartition("item").groupBy("item", "c", "n").agg(F.lit(1).alias("one")).drop("one")
    own = Window.partitionBy("item")
    return once.withColumns({"lo": F.min("c").over(own), "hi": F.max("c").over(own), "held": F.count(F.lit(1)).over(own)}).where("lo < hi").select("item", "c", "n", "held")


#: Bits of a filter for each key, and 2 to this power bits at most (8 MB).
BITS_PER_KEY, MOST_BITS = 16, 26


def among(rows: DataFrame, keys: DataFrame, id_: str, key: str) -> DataFrame:
    """The rows whose id_ is a key of the written table keys, and few others: each row asks a broadcast bitmap of bounded size, none is shuffled."""
    size = 1 << min(MOST_BITS, max(15, (keys.count() * BITS_PER_KEY).bit_length()))
    bit, of_key = (F.pmod(F.xxhash64(x), F.lit(size)) + 1 for x in (id_, key))
    bitmap = keys.select(of_key.alias("b")).groupBy(F.bitmap_bucket_number("b").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("bits"))
    at = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.expr("substring(bits, cast(_at div 8 as int) + 1, 1)")), 16, 10).cast("int")
    asked = rows.withColumns({"_bucket": F.bitmap_bucket_number(bit), "_at": at})
    return asked.join(F.broadcast(bitmap), (F.col("_bucket") == F.col("bucket")) & (F.getbit(byte, (F.col("_at") % 8).cast("int")) == 1), "left_semi").drop("_bucket", "_at")


#: Words of 64 bits in a set's bitmap, and in its fold; items of a set of which a fold still tells much.
BITMAP_WORDS, FOLD_WORDS, FOLD_ITEMS = 64, 16, 1500


def _bitmap(items: str) -> Column:
    """Of each residue of a set's items whether it holds an odd number of them, as words; of no set all zeros."""

    def bitmap(sets):
        starts, ends = (x.to_numpy().astype(np.int64) for x in (sets.offsets[:-1], sets.offsets[1:]))
        values = sets.values.to_numpy()[starts[0] if len(starts) else 0 : ends[-1] if len(ends) else 0]
        bits = np.zeros(len(sets) * BITMAP_WORDS, np.uint64)
        word = np.repeat(np.arange(len(sets)) * BITMAP_WORDS, ends - starts) + ((values >> 6) & (BITMAP_WORDS - 1))
        np.bitwise_xor.at(bits, word, np.uint64(1) << (values & 63).astype(np.uint64))
        return pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * BITMAP_WORDS, pa.int32()), pa.array(bits.view(np.int64)))

    # The types are named, as Spark reads a column function's kind from them.
    bitmap.__annotations__ = {"sets": pa.Array, "return": pa.Array}
    return F.arrow_udf(bitmap, ArrayType(LongType()))(F.coalesce(F.col(items), F.array().cast("array<bigint>")))


def _folded(bits: Column, words: int) -> Column:
    """A bitmap of so many words: bits that come together by XOR tell the parity of their residues together."""
    if words == BITMAP_WORDS:
        return bits
    return F.array(*[reduce(Column.bitwiseXOR, [bits[i] for i in range(at, BITMAP_WORDS, words)]) for at in range(words)])


def _most(a: Column, b: Column, threshold: float) -> Column:
    """Items by which sets of a and b items that reach the threshold differ, at most, and one."""
    return (a + b) * F.lit((1 - threshold) / (1 + threshold)) + 1


def _sizes(a: Column, b: Column, threshold: float) -> Column:
    return F.least(a, b) >= F.lit(threshold) * F.greatest(a, b)


#: An item of so many sets is rare: its pairs are listed, so many for each post at most.
RARE = 8


def _near(posts: DataFrame, maps: DataFrame, threshold: float) -> DataFrame:
    """(u, v), u < v: the pairs of posts' sets that share an item, and whose sizes and bitmaps let them reach the threshold.

    Two bitmaps differ in no more bits than the sets do in items.  Pairs of
    rare items grow with the posts.  Those of other items may grow with their
    square, so they are held against the bitmaps where they meet, and what is
    left is made about once, not once for each item.
    """
    rare = posts.where(F.col("held") <= RARE)
    a, b = rare.alias("a"), rare.alias("b")
    met = a.join(b, "item").where((F.col("a.c") < F.col("b.c")) & _sizes(F.col("a.n"), F.col("b.n"), threshold))
    listed = candidates = materialise(met.select(F.col("a.c").alias("u"), F.col("b.c").alias("v")).distinct(), "jaccard-candidates")
    for words in (FOLD_WORDS, BITMAP_WORDS):
        some = maps.select("c", "n", _folded(F.col("bits"), words).alias("bits"))
        met = candidates.join(some.select(F.col("c").alias("u"), F.col("n").alias("nu"), F.col("bits").alias("bu")), "u").join(some.select(F.col("c").alias("v"), F.col("n").alias("nv"), F.col("bits").alias("bv")), "v")
        apart = F.reduce(F.zip_with("bu", "bv", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
        candidates = met.where(apart <= _most(F.col("nu"), F.col("nv"), threshold)).select("u", "v").distinct()
    close = materialise(candidates, "jaccard-close")
    discard(listed)
    frequent = _carried(posts.where(F.col("held") > RARE), maps)
    words = [F.col("bits")[i].alias(f"b{i}") for i in range(FOLD_WORDS)]
    short = frequent.where(F.col("n") * threshold <= FOLD_ITEMS).withColumn("bits", _folded(F.col("bits"), FOLD_WORDS))
    short = materialise(short.select("item", "c", "n", "p", "q", *words), "jaccard-frequent")
    long = materialise(frequent.where(F.col("n") > FOLD_ITEMS), "jaccard-frequent")
    met = _met(short, threshold, long=False).unionByName(_met(long, threshold, long=True))
    near = materialise(close.unionByName(met).distinct(), "jaccard-near")
    for done in (close, short, long):
        discard(done)
    return near


def _carried(posts: DataFrame, maps: DataFrame) -> DataFrame:
    """posts (item, c, n) with p and q, the two items before its own among its set's, and its set's bitmap."""
    own = Window.partitionBy("c", "n").orderBy("item")
    before = posts.select("item", "c", "n", F.lag("item", 1).over(own).alias("p"), F.lag("item", 2).over(own).alias("q"))
    return before.join(maps, ["c", "n"]).select("item", "c", "n", "p", "q", "bits")


def _met(carried: DataFrame, threshold: float, long: bool) -> DataFrame:
    """(u, v) of the sets that share an item of carried posts, by size and bitmap.

    Sets that share one of the items before have met there, or before that; at
    the first item that they share they have none, so each pair is made there.
    Pairs of long sets are told by whole bitmaps, others by the columns of a folded one.
    """
    a, b = carried.alias("a"), carried.alias("b")
    fits = (F.col("a.c") < F.col("b.c")) & _sizes(F.col("a.n"), F.col("b.n"), threshold)
    known = reduce(lambda x, y: x | y, [F.coalesce(F.col(f"a.{x}") == F.col(f"b.{y}"), F.lit(False)) for x in "pq" for y in "pq"])
    if long:
        apart = F.reduce(F.zip_with("a.bits", "b.bits", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    else:
        fits = fits & (F.least("a.n", "b.n") <= FOLD_ITEMS)
        apart = reduce(lambda x, y: x + y, [F.bit_count(F.col(f"a.b{i}").bitwiseXOR(F.col(f"b.b{i}"))) for i in range(FOLD_WORDS)])
    met = a.join(b, "item").where(fits & ~known & (apart <= _most(F.col("a.n"), F.col("b.n"), threshold)))
    return met.select(F.col("a.c").alias("u"), F.col("b.c").alias("v"))


#: Items, and sets, of a block; items that meet in one key of the verification, about.
BLOCK_ITEMS, BLOCK_SETS, KEY_ITEMS = 1 << 20, 1024, 1 << 21


def _tiles(near: DataFrame, ids: DataFrame) -> DataFrame:
    """(tile, u, v) of the pairs near.

    A set lies in a block of those that have the same smallest neighbour; a tile
    is that of two blocks.  Near copies of one another have few smallest
    neighbours, so a set goes to few tiles, whatever the number of its pairs.
    """
    ends = near.select(F.col("u").alias("c"), F.col("v").alias("o")).union(near.select(F.col("v"), F.col("u")))
    size = ids.groupBy("c").agg(F.sum("n").alias("n"))
    named = materialise(ends.groupBy("c").agg(F.least(F.min("o"), F.col("c")).alias("label")).join(size, "c"), "jaccard-labels")
    cut = named.groupBy("label").agg(F.ceil(F.greatest(F.sum("n") / BLOCK_ITEMS, F.count(F.lit(1)) / BLOCK_SETS)).alias("blocks"))
    block = named.join(cut, "label").select("c", F.xxhash64("label", F.pmod(F.xxhash64("c"), F.col("blocks"))).alias("block"))
    met = near.join(block.select(F.col("c").alias("u"), F.col("block").alias("x")), "u").join(block.select(F.col("c").alias("v"), F.col("block").alias("y")), "v")
    return met.select(F.xxhash64(F.least("x", "y"), F.greatest("x", "y")).alias("tile"), "u", "v")


def _counted(threshold: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """(a, b, common, total) of the pairs (u, v) of sets (c, id, s) that reach the threshold; a set's items are marked once for all its pairs."""

    def rows_of(names: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(i, row): for each of wanted, by its place i, the rows of the sorted names that are equal to it."""
        lo, hi = np.searchsorted(names, wanted), np.searchsorted(names, wanted, "right")
        i = np.repeat(np.arange(len(wanted)), hi - lo)
        return i, np.arange(len(i)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + lo[i]

    def counted(pairs: pa.Table, sets: pa.Table) -> pa.Table:
        sets = sets.sort_by("c")
        c, s = sets["c"].to_numpy(), sets["s"].combine_chunks()
        size = s.value_lengths().to_numpy().astype(np.int64)
        start = np.cumsum(size) - size
        values, item = np.unique(s.flatten().to_numpy(), return_inverse=True)
        i, a = rows_of(c, pairs["u"].to_numpy())
        j, b = rows_of(c, pairs["v"].to_numpy()[i])
        a = a[j]
        order = np.argsort(a, kind="stable")
        a, b = a[order], b[order]
        common, mark = np.zeros(len(a), np.int64), np.zeros(len(values), bool)
        edges = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1], [True]))) if len(a) else np.zeros(1, np.int64)
        for lo, end in zip(edges[:-1], edges[1:], strict=True):
            own = item[start[a[lo]] : start[a[lo]] + size[a[lo]]]
            mark[own] = True
            ends = np.cumsum(size[b[lo:end]])
            while lo < end:  # the items of so many partners at once
                hi = max(lo + 1, lo + int(np.searchsorted(ends, BLOCK_ITEMS, "right")))
                of = size[b[lo:hi]]
                at = np.cumsum(of) - of
                held = mark[item[np.arange(of.sum()) + np.repeat(start[b[lo:hi]] - at, of)]]
                common[lo:hi] = np.add.reduceat(held, at, dtype=np.int64)
                ends = ends[hi - lo :] - ends[hi - lo - 1]
                lo = hi
            mark[own] = False
        total = size[a] + size[b] - common
        kept = common / total >= threshold
        return pa.table({"a": sets["id"].take(pa.array(a[kept])), "b": sets["id"].take(pa.array(b[kept])), "common": common[kept], "total": total[kept]})

    return counted


def _verified(tiles: DataFrame, sent: DataFrame, full: DataFrame, keys: int, threshold: float) -> DataFrame:
    """(a, b, common, total) of the candidates (tile, u, v) among full (c, id, s) that reach the threshold, by id.

    sent: (tile, c), the sets of each tile.  Tiles are dealt to so many keys; a
    set travels once for each key of its tiles, not for each of its pairs.
    """
    key = F.pmod("tile", F.lit(keys)).alias("key")
    of = full.join(sent.select(key, "c").distinct(), "c").select("key", "c", "id", "s")
    kind = full.schema["id"].dataType.simpleString()
    return tiles.select(key, "u", "v").groupBy("key").cogroup(of.groupBy("key")).applyInArrow(_counted(threshold), f"a {kind}, b {kind}, common long, total long")
