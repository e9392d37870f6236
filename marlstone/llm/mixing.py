"""Mixing sources to target weights by a low-discrepancy schedule; DataFrame functions only.

A document's size is its number of words.  Sources in code point order (null
last) weigh WEIGHTS in turn and share all words; no target exceeds CAP times its
source's size, the excess goes to the others by weight.

The schedule has one slot for every BLOCK words of the mix.  Slot i has the
golden-ratio point i * GOLDEN mod POINTS, and belongs to the source in whose
part of the cumulative targets the point falls; the k-th slot of a source takes
its k-th block.  A source's blocks are cut from its documents, shuffled by md5
of the id and laid end to end, again from the start when they are used up, up to
its target in whole words, where the last block is cut.  What a document gives
is the sum, block by block, of what the granted slots hold of it.  The points
give a source as many slots as it has blocks but for a few: slots beyond its
target grant nothing, and blocks that no slot has reached, such as those of a
source of a few words, get slots of their own after the others.  So a source of
any size gives its target.

Ranks and running sums are taken within buckets of bounded size and offset by
bucket totals, so that no source, however large, meets in one task.

Edge cases: null and empty text has size 0, nothing is taken; null source is a
source of its own; a null id is shuffled as the id 0; repeated rows each take
part, in the order of their sizes; a very long text spans as many blocks as it
needs; an empty table gives an empty mix; input columns named like an output
are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import DOCUMENT_COLUMNS, materialise, table

WEIGHTS = (1, 2, 3)
CAP = 3
BLOCK = 64
POINTS = 1 << 31
#: The odd number next to POINTS divided by the golden ratio.
GOLDEN = 1327217885
#: Parts of the unit interval by which slots find the sources that may own them.
CELLS = 4096
#: Rows of one source, and slots, that are ranked together.
BUCKET_ROWS, SLOT_CHUNK = 8192, 1 << 16


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sized: DataFrame) -> DataFrame:
    """One row for each source of sized (_source, _size): rank (from 0), source_size, docs, target and quota (target in whole words)."""
    by = sized.groupBy("_source").agg(F.sum("_size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    rank = F.row_number().over(Window.orderBy(F.col("_source").asc_nulls_last())) - 1
    by = by.withColumn("rank", rank).withColumn("w", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS) + 1).cast("int")).cast("long"))
    # Water level: in the order in which sources reach their caps, the first whose cap holds its share of what is left.
    order = Window.orderBy(F.col("source_size") / F.col("w"), "rank")
    total = F.sum("source_size").over(Window.partitionBy())
    by = by.withColumns({
        "left": total - F.coalesce(F.sum(CAP * F.col("source_size")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "ws": F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)),
        "place": F.row_number().over(order),
    })
    level = F.min(F.when(F.col("left") * F.col("w") <= CAP * F.col("source_size") * F.col("ws"), F.struct("place", "left", "ws"))).over(Window.partitionBy())
    by = by.withColumn("level", level)
    target = F.when(F.col("place") < F.col("level.place"), (CAP * F.col("source_size")).cast("double")).otherwise((F.col("level.left") * F.col("w")).cast("double") / F.col("level.ws"))
    return by.select("_source", "rank", "source_size", "docs", target.alias("target"), F.floor(target + 0.5).alias("quota"))


def _running(df: DataFrame, keys: list[str], bucket: str, amount: Column, order: list, name: str) -> DataFrame:
    """df with the sum of amount over the rows before this one, by keys in the order of bucket, then order."""
    sums = df.groupBy(*keys, bucket).agg(F.sum(amount).alias("_sum"))
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    within = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.join(sums, [*keys, bucket]).withColumn(name, F.coalesce(F.sum(amount).over(within), F.lit(0)) + F.col("_before")).drop("_before")


def schedule(sources: DataFrame, words: int) -> DataFrame:
    """(rank, block, slot): the slots of each source in a mix of so many words, numbered from 0."""
    spark = sources.sparkSession
    upto = F.sum("quota").over(Window.orderBy("rank"))
    share = sources.select("rank", "quota", upto.alias("upto"), F.sum("quota").over(Window.partitionBy()).alias("all")).where("quota > 0")
    point = lambda c: F.floor(c.cast("double") / F.col("all") * POINTS)
    part = share.select("rank", point(F.col("upto") - F.col("quota")).alias("lo"), point(F.col("upto")).alias("hi")).where("lo < hi")
    width = POINTS // CELLS
    cells = part.withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor((F.col("hi") - 1) / width))))
    n = math.ceil(words / BLOCK)
    slots = spark.range(0, n, 1, max(1, n >> 18)).select(F.col("id").alias("slot"), (F.col("id") % POINTS * GOLDEN % POINTS).alias("u"))
    owned = slots.withColumn("cell", F.floor(F.col("u") / width)).join(cells, "cell").where("lo <= u and u < hi").select("rank", "slot", F.shiftright("slot", SLOT_CHUNK.bit_length() - 1).alias("chunk"))
    return _running(owned, ["rank"], "chunk", F.lit(1), ["slot"], "block").select("rank", "block", "slot")


def grants(sources: DataFrame, slots: DataFrame, n: int) -> DataFrame:
    """(rank, block, slot): the slot that grants each block of the mix: one of the n of the schedule, or one after them for a block that these do not reach."""
    need = sources.select("rank", F.ceil(F.col("quota") / BLOCK).alias("blocks"))
    reached = slots.groupBy("rank").agg(F.count(F.lit(1)).alias("reached"))
    short = need.join(reached, "rank", "left").withColumn("reached", F.least("blocks", F.coalesce("reached", F.lit(0))))
    before = F.sum(F.col("blocks") - F.col("reached")).over(Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1))
    late = short.withColumn("before", F.coalesce(before, F.lit(0))).where("reached < blocks")
    late = late.select("rank", "reached", "before", F.explode(F.sequence(F.col("reached"), F.col("blocks") - 1)).alias("block"))
    late = late.select("rank", "block", (F.lit(n) + F.col("before") + F.col("block") - F.col("reached")).alias("slot"))
    return slots.join(need, "rank").where("block < blocks").select("rank", "block", "slot").unionByName(late)


def mix_blocks(documents: DataFrame) -> DataFrame:
    """mix() with more of each row's part in it: the granted blocks that hold words of it, the last of their slots, and its words in slots after the schedule's."""
    sized = documents.select(F.col("doc_id").alias("doc_id"), F.col("source").alias("_source"), word_count(F.col("text")).alias("_size"))
    sized = materialise(sized, "mixing-sizes")
    sources = materialise(targets(sized), "mixing-targets")
    words = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    n = math.ceil(words / BLOCK)
    granted = grants(sources, materialise(schedule(sources, words), "mixing-slots"), n)
    # One row for each source; the planner broadcasts it where it is small.
    placed = sized.join(sources, sized["_source"].eqNullSafe(sources["_source"])).drop(sources["_source"])
    shuffled = placed.withColumn("h", F.md5(F.coalesce(F.col("doc_id"), F.lit(0)).cast("string").cast("binary")))
    in_bucket = F.floor(F.conv(F.substring("h", 1, 8), 16, 10).cast("long") * F.ceil(F.col("docs") / BUCKET_ROWS) / (1 << 32))
    laid = _running(shuffled.where("_size > 0").withColumn("bucket", in_bucket), ["rank"], "bucket", F.col("_size"), ["h", "_size"], "start")

    # A piece is what one block holds of one round of a document; the last block ends at the quota.
    rounds = F.greatest(F.lit(0), F.least(F.lit(CAP - 1), F.floor((F.col("quota") - 1 - F.col("start")) / F.col("source_size")).cast("int")))
    lo = F.col("turn") * F.col("source_size") + F.col("start")
    turn = laid.withColumn("turn", F.explode(F.sequence(F.lit(0), rounds))).withColumns({"lo": lo, "hi": F.least(lo + F.col("_size"), "quota")})
    row = ["rank", "start", "doc_id", "_source", "_size", "source_size", "target"]
    at = F.floor(F.col("lo") / BLOCK)
    pieces = turn.select(*row, "lo", "hi", F.explode(F.sequence(at, F.greatest(at, F.floor((F.col("hi") - 1) / BLOCK)))).alias("block"))
    overlap = F.greatest(F.lit(0), F.least("hi", (F.col("block") + 1) * BLOCK) - F.greatest("lo", F.col("block") * BLOCK))
    pieces = pieces.select(*row, "block", overlap.cast("long").alias("held"))
    given = F.col("slot").isNotNull() & (F.col("held") > 0)
    taken = pieces.join(granted, ["rank", "block"], "left").groupBy(*row).agg(
        F.sum(F.when(given, F.col("held")).otherwise(0)).alias("taken"), F.min(F.when(given & (F.col("slot") < n), F.col("slot"))).alias("first_slot"),
        F.count_if(given).alias("blocks"), F.max(F.when(given, F.col("slot"))).alias("last_slot"), F.sum(F.when(given & (F.col("slot") >= n), F.col("held")).otherwise(0)).alias("late_words"),
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    nothing = shuffled.where("_size = 0").withColumns({"taken": zero, "first_slot": none, "blocks": zero, "last_slot": none, "late_words": zero})
    out = lambda df: df.select("doc_id", F.col("_source").alias("source"), F.col("_size").alias("size"), "source_size", "target", "taken", "first_slot", "blocks", "last_slot", "late_words")
    return out(taken).unionByName(out(nothing))


def mix(documents: DataFrame) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, first_slot) of each row of documents (doc_id, text, source)."""
    return mix_blocks(documents).drop("blocks", "last_slot", "late_words")


def mix_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: each document as often as the mix takes it, rounded; documents of no words go."""
    docs = docs.select(*DOCUMENT_COLUMNS)
    keys = ["doc_id", "source", "_size"]
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64("text", "lang")))
    left = docs.withColumn("_size", word_count(F.col("text"))).withColumn("_nth", nth)
    right = mix(docs).withColumnRenamed("size", "_size").withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("taken"))))
    right = right.select(*keys, "_nth", F.floor(F.col("taken") / F.col("_size") + 0.5).cast("int").alias("_copies")).where("_size > 0 and _copies > 0")
    right = right.select(*[F.col(c).alias(f"r{c}") for c in right.columns])
    same = F.lit(True)
    for c in (*keys, "_nth"):
        same = same & left[c].eqNullSafe(right[f"r{c}"])
    return left.join(right, same).select(*DOCUMENT_COLUMNS, F.explode(F.sequence(F.lit(1), F.col("r_copies"))).alias("_copy")).drop("_copy")


def query(spark, sf_dir: str) -> DataFrame:
    return mix_blocks(table(spark, sf_dir, "documents")).drop("source")


ORACLE = rf"""
with d as (select row_number() over () as row_, doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size, md5(cast(coalesce(doc_id, 0) as varchar)) as h from {{documents}}),
s0 as (select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) - 1 as k from d group by source),
s1 as (select *, k % 3 + 1 as w, cast(sum(source_size) over () as bigint) as total from s0),
s2 as (select *, total - cast(coalesce(sum(3 * source_size) over (order by source_size / w, k rows between unbounded preceding and 1 preceding), 0) as bigint) as rest,
         cast(sum(w) over (order by source_size / w, k rows between current row and unbounded following) as bigint) as ws,
         row_number() over (order by source_size / w, k) as place from s1),
lv as (select place as lp, rest as lr, ws as lw from s2 where rest * w <= 3 * source_size * ws order by place limit 1),
s as (select s2.*, case when place < lp then cast(3 * source_size as double) else cast(lr * w as double) / lw end as target from s2, lv),
q as (select s.*, cast(floor(target + 0.5) as bigint) as quota from s),
c as (select q.*, cast(sum(quota) over (order by k) as bigint) as upto, cast(sum(quota) over () as bigint) as all_, cast(ceil(total / {BLOCK}.0) as bigint) as n from q),
parts as (select k, cast(floor(cast(upto - quota as double) / all_ * {POINTS}) as bigint) as lo, cast(floor(cast(upto as double) / all_ * {POINTS}) as bigint) as hi from c where quota > 0),
points as (select i as slot, i % {POINTS} * {GOLDEN} % {POINTS} as u from range((select coalesce(max(n), 0) from c)) as t(i)),
slots as (select k, slot, row_number() over (partition by k order by slot) - 1 as block from points join parts on lo <= u and u < hi),
reached as (select c.k, cast(ceil(quota / {BLOCK}.0) as bigint) as blocks, least(cast(ceil(quota / {BLOCK}.0) as bigint), count(slot)) as m from c left join slots on c.k = slots.k group by c.k, quota),
short as (select *, cast(coalesce(sum(blocks - m) over (order by k rows between unbounded preceding and 1 preceding), 0) as bigint) as before from reached),
late as (select k, m + i as block, (select max(n) from c) + before + i as slot from short, unnest(range(blocks - m)) as x(i)),
granted as (select k, block, slot from slots join reached using (k) where block < blocks union all select k, block, slot from late),
p as (select d.*, k, n, source_size, target, quota,
        cast(coalesce(sum(size) over (partition by k order by h, size rows between unbounded preceding and 1 preceding), 0) as bigint) as start
      from d join c on d.source is not distinct from c.source),
turns as (select row_, k, n, turn * source_size + start as lo, least(turn * source_size + start + size, quota) as hi from p, range(3) as r(turn)),
pieces as (select row_, k, n, block, least(hi, (block + 1) * {BLOCK}) - greatest(lo, block * {BLOCK}) as held from turns, unnest(range(lo // {BLOCK}, (hi - 1) // {BLOCK} + 1)) as b(block) where lo < hi),
t as (select row_, sum(held) as taken, min(slot) filter (slot < n) as first_slot, count(*) as blocks, max(slot) as last_slot, coalesce(sum(held) filter (slot >= n), 0) as late_words from pieces join granted using (k, block) group by row_)
select doc_id, cast(size as bigint) as size, source_size, target, cast(coalesce(taken, 0) as bigint) as taken, first_slot, coalesce(blocks, 0) as blocks, last_slot, cast(coalesce(late_words, 0) as bigint) as late_words
from p left join t on p.row_ = t.row_
"""
