"""Sharding by a k-d tree over document metadata, split at distributed weighted medians.

A document's size is the UTF-8 bytes of its text plus OVERHEAD.  A node of the
tree that stands for k shards is cut along its widest dimension (relative to
the whole table) where the weight of its left side is floor(k / 2) / k; the
leaves are the shards, so all come near the target bytes.

Documents of equal texts (by 128 bits of their hash) are one group: all have the
smallest lang, source and id that occurs in it, so they lie at one point, and a
group stays in one shard unless it is larger than a shard.

A cut is found without sorting: the order key (dimension, crc32 of the text,
hash of the id) is read in digits of DIGIT bits, and each job sums sizes by node
and digit and picks the digit in which the wanted weight lies, for all nodes of a
level at once.  A node's search ends when cutting beside the digit's rows is
within TOLERANCE of a shard; otherwise the next digit is looked at.  Where one
group is left, the cut is beside it, on the nearer side; only within a group
larger than a shard the digits of the id's hash go on.  The driver holds the
cuts (one less than shards); documents are assigned by a nested CASE.

lang and source are numbers: SIX bytes behind what all values begin with, in code
point order, in STEPS steps, and a hash of the whole value within a step.

Edge cases: null and empty text has size OVERHEAD; null lang, source and id
come first in their dimension; repeated rows each get a slot of their own; an
empty table gives no rows; very long texts count by their size only; input
columns named like an output are replaced.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, table

SHARDS = 24
OVERHEAD = 8
KEY_BITS, DIGIT = 60, 15
TOLERANCE = 0.001
#: Rows of a shard that are numbered together.
BUCKET_ROWS = 8192

DIMENSIONS = ("log_size", "lang", "source", "doc_id")


#: Bytes of a name that order it; steps of its dimension, and the hash within a step.
SIX, STEPS, WITHIN = 6, 1 << 18, 1 << 10


def _text_number(c: str, shared: int) -> Column:
    """The SIX bytes behind the first `shared` ones as a number above 0, in code point order; 0 for null and empty."""
    body = F.coalesce(F.col(c), F.lit("")).cast("binary")
    tail = F.rpad(F.hex(F.substring(body, shared + 1, SIX)), 2 * SIX, "0")
    return F.when(F.octet_length(body) > 0, F.conv(tail, 16, 10).cast("double") + 1).otherwise(F.lit(0.0))


def measured(documents: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, k0.., id_hash): for each dimension a key of KEY_BITS, first its value over the whole table's range, then text_crc32."""
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("long")
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    raw = documents.select(F.col("doc_id").alias("doc_id"), size.alias("size"), F.crc32(body).alias("text_crc32"), F.unhex(F.substring(F.sha2(body, 256), 1, 32)).alias("group"), F.col("lang").alias("lang"), F.col("source").alias("source"))
    raw = materialise(raw, "kd-measured")
    # A null comes first here as well: it is the group's smallest value if it occurs.
    low = lambda c: F.min(F.struct(F.col(c).isNotNull().alias("some"), F.col(c).alias("v")))["v"]
    groups = raw.groupBy("group").agg(F.count(F.lit(1)).alias("n"), *[low(c).alias(f"low_{c}") for c in ("lang", "source", "doc_id")]).where("n > 1").withColumn("many", F.lit(True)).drop("n")
    raw = raw.join(groups, "group", "left")
    raw = raw.withColumns({c: F.when(F.col("many"), F.col(f"low_{c}")).otherwise(F.col(c)) for c in ("lang", "source")} | {"at_id": F.when(F.col("many"), F.col("low_doc_id")).otherwise(F.col("doc_id"))})
    raw = materialise(raw.select("doc_id", "size", "text_crc32", "lang", "source", "at_id"), "kd-groups")
    named = {c: F.when(F.col(c) != "", F.col(c)) for c in ("lang", "source")}
    ends = raw.agg(*[f(v).alias(f"{n}_{c}") for c, v in named.items() for n, f in (("lo", F.min), ("hi", F.max))]).first()
    shared = {c: len(os.path.commonprefix([ends[f"lo_{c}"].encode(), ends[f"hi_{c}"].encode()])) if ends[f"lo_{c}"] else 0 for c in named}
    raw = raw.withColumns({"x0": F.log2(F.col("size").cast("double")), "x1": _text_number("lang", shared["lang"]), "x2": _text_number("source", shared["source"]), "x3": F.coalesce(F.col("at_id").cast("double"), F.lit(0.0))})
    ends = raw.agg(*[f(f"x{j}").alias(f"{n}{j}") for j in range(len(DIMENSIONS)) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    keys = {}
    for j, name in enumerate(DIMENSIONS):
        lo, hi = ends[f"lo{j}"] or 0.0, ends[f"hi{j}"] or 0.0
        steps = STEPS if name in named else STEPS * WITHIN
        value = F.floor((F.col(f"x{j}") - lo) / (hi - lo) * (steps - 1)).cast("long") if hi > lo else F.lit(0).cast("long")
        if name in named:
            value = value * WITHIN + F.when(F.coalesce(F.col(name), F.lit("")) == "", 0).otherwise(F.pmod(F.xxhash64(name), F.lit(WITHIN)))
        keys[f"k{j}"] = F.shiftleft(value, 32) + F.col("text_crc32")
    return raw.select("doc_id", "size", "text_crc32", *[v.alias(k) for k, v in keys.items()], F.pmod(F.xxhash64("doc_id"), F.lit(1 << 2 * DIGIT)).alias("id_hash"))


@dataclass
class Node:
    """A row of the node goes left if its key in the dimension is below cut[0], or equals it and its id_hash is not above cut[1]."""

    first: int
    shards: int
    dimension: int = 0
    cut: tuple[int, int] | None = None
    left: Node | None = None
    right: Node | None = None


def assignment(node: Node, ids: dict[int, Node] | None = None) -> Column:
    """The first shard of the leaf that a row falls into (which names the leaf)."""
    if node.left is None:
        if ids is not None:
            ids[node.first] = node
        return F.lit(node.first)
    key = F.col(f"k{node.dimension}")
    goes_left = (key < node.cut[0]) | ((key == node.cut[0]) & (F.col("id_hash") <= node.cut[1]))
    return F.when(goes_left, assignment(node.left, ids)).otherwise(assignment(node.right, ids))


def grow(rows: DataFrame, shards: int = SHARDS) -> Node:
    root = Node(0, shards)
    while True:
        leaves: dict[int, Node] = {}
        at_node = rows.withColumn("node", assignment(root, leaves))
        open_ = {k: n for k, n in leaves.items() if n.shards > 1}
        if not open_:
            return root
        spread = [(F.max(F.shiftright(f"k{j}", 32)) - F.min(F.shiftright(f"k{j}", 32))).alias(f"r{j}") for j in range(len(DIMENSIONS))]
        found = {s.node: s for s in at_node.groupBy("node").agg(F.sum("size").alias("w"), *spread).collect()}
        searching: dict[int, dict] = {}
        for k, n in open_.items():
            if s := found.get(k):
                n.dimension = max(range(len(DIMENSIONS)), key=lambda j: s[f"r{j}"])
                searching[k] = {"want": s.w * (n.shards // 2) / n.shards, "shard": s.w / n.shards, "prefix": None}
            else:
                n.cut = (0, 0)
        for shift, last in [(s, False) for s in range(KEY_BITS - DIGIT, -1, -DIGIT)] + [(DIGIT, True), (0, True)]:
            if not searching:
                break
            inside, digit = F.lit(False), F.lit(None).cast("long")
            for k, s in searching.items():
                key = F.col(f"k{open_[k].dimension}")
                match = F.col("node") == k
                if last:
                    match = match & (key == s["key"])
                    key = F.col("id_hash")
                if s["prefix"] is not None:
                    match = match & (F.shiftright(key, shift + DIGIT) == s["prefix"])
                inside, digit = inside | match, F.when(match, F.shiftright(key, shift)).otherwise(digit)
            sums = at_node.where(inside).groupBy("node", digit.alias("digit")).agg(F.sum("size").alias("w"))
            upto = F.sum("w").over(Window.partitionBy("node").orderBy("digit"))  # 2 ** DIGIT rows of a node at most
            missing = F.create_map(*[F.lit(v) for k, s in searching.items() for v in (k, float(s["want"]))])
            crossing = sums.withColumns({"upto": upto, "missing": missing[F.col("node")]}).where("upto >= missing").groupBy("node").agg(F.min(F.struct("digit", "upto", "w")).alias("at")).collect()
            for row in crossing:
                s, at = searching[row.node], row["at"]
                under, over = at.upto - at.w, at.upto
                # One group, or one row, is left: it stays whole, but for a group larger than a shard.
                end = shift == 0 and (last or at.w <= s["shard"])
                if end or min(s["want"] - under, over - s["want"]) <= TOLERANCE * s["shard"]:
                    value = at.digit + (over - s["want"] <= s["want"] - under)  # all below this digit go left
                    open_[row.node].cut = (s["key"], (value << shift) - 1) if last else (value << shift, -1)
                    del searching[row.node]
                else:
                    s["want"] -= under
                    s["prefix"] = at.digit
                    if shift == 0 and not last:
                        s["key"], s["prefix"] = at.digit, None
        for n in open_.values():
            n.left = Node(n.first, n.shards // 2)
            n.right = Node(n.first + n.shards // 2, n.shards - n.shards // 2)


def numbered(df: DataFrame, key: str, groups: int, name: str) -> DataFrame:
    """df with a gapless number from 0 within key; numbers run through buckets of about BUCKET_ROWS rows."""
    n = df.count()
    df = df.withColumn("_bucket", F.pmod(F.xxhash64("id_hash", "text_crc32"), F.lit(max(1, n // (groups * BUCKET_ROWS)))))
    sums = df.groupBy(key, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    within = Window.partitionBy(key, "_bucket").orderBy("id_hash", "text_crc32", "doc_id")
    return df.join(sums, [key, "_bucket"]).withColumn(name, F.row_number().over(within) - 1 + F.col("_before")).drop("_bucket", "_before")


def shard(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of each row of documents (doc_id, text, lang, source)."""
    rows = materialise(measured(documents), "kd-rows")
    placed = rows.withColumn("shard", assignment(grow(rows, shards)))
    return numbered(placed, "shard", shards, "slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )


def shard_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline's last stage: the shard and slot of each document that is left."""
    return shard(docs)


def query(spark, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))
