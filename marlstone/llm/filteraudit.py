"""Filter interaction audit: which of five filters removes what, in every order of applying them.

Each text's failures make a five-bit mask, bit i for filter LETTERS[i]; native
expressions compute it in one pass over the texts.  The filters, on whole texts
(null counts as empty; words are maximal runs of other bytes than ASCII white
space, case-sensitive):

  A  fewer than 100 words              B  fewer distinct words than 80 in 100
  C  more than one character in ten is A-Z    D  holds any of # $ % & * |
  E  identical to the text of a smaller doc_id

For E a groupBy of the texts' SHA-256 (partial before the shuffle) supplies the
smallest doc_id of each repeated text; only those are joined back, so a text
that a third of the rows share is one row of that join's small side, and the
planner splits its large side.  The masks are aggregated to 32 cells a part:
rows, good rows and toxic rows.  All that is reported of the 120 orders and
their steps follows from the cells alone, whatever the number of texts.

Edge cases: a null part and an empty one are one; a null doc_id is smaller than
none and larger than all, so two rows of null ids are no copies of each other;
repeated rows (id and text) are no copies of each other either, as neither id is
smaller; each row counts, also where ids repeat; of several labels of an id any
counts; null labels and labels of null ids count for nothing; other columns are
ignored; an empty table has no parts and gives no rows.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise, table

LETTERS = "ABCDE"
WORD = r"[^\x20\x09-\x0D]+"
ORDERS = ["".join(p) for p in itertools.permutations(LETTERS)]


def text_failures(text: Column) -> dict[str, Column]:
    """The conditions under which a text fails the filters that look at it alone."""
    words = F.regexp_extract_all(text, F.lit(WORD), 0)
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > 10 * F.length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def bit(letter: str) -> int:
    return 1 << LETTERS.index(letter)


def masks(documents: DataFrame, part: str = "lang") -> DataFrame:
    """(doc_id, part, mask) of each row of documents (doc_id, text and the column that names its part); the table in between is left in the shared folder."""
    text = F.coalesce("text", F.lit(""))
    mask = sum((F.when(c, bit(k)).otherwise(0) for k, c in text_failures(text).items()), F.lit(0))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), mask.alias("mask"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))
    rows = materialise(rows, "audit-masks")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1 and least is not null").select("digest", "least")
    copy = F.coalesce(F.col("least") < F.coalesce("doc_id", F.lit((1 << 63) - 1)), F.lit(False))
    out = rows.join(first, "digest", "left").select("doc_id", "part", (F.col("mask") + F.when(copy, bit("E")).otherwise(0)).alias("mask"))
    out._written_to = rows._written_to
    return out


def cells(masked: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): at most 32 rows for each part; labels: doc_id, quality, toxic."""
    marked = labels.where("doc_id is not null and (quality = 1 or toxic = 1)").groupBy(F.col("doc_id").alias("id"))
    marked = marked.agg(F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("g"), F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("t"))
    return (
        masked.join(marked, F.col("doc_id") == F.col("id"), "left")
        .groupBy("part", "mask")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("g").alias("good"), F.count_if("t").alias("toxic"))
    )


def enumerate_orders(by_cell: DataFrame) -> DataFrame:
    """The report: for each part, order and step what the filter at that step does, from the cells.

    A row that fails k filters is removed by each of them in 120 / k orders,
    which are as many as have it first among those k: that is its share of the
    Shapley sum.
    """
    orders = F.explode(F.array(*map(F.lit, ORDERS))).alias("filter_order")
    each = by_cell.select("*", orders).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))).alias("step"))
    at = {k: F.instr("filter_order", k) for k in LETTERS}
    bits = lambda holds: sum((F.when(holds(at[k]), bit(k)).otherwise(0) for k in LETTERS), F.lit(0))
    each = each.withColumns({"own": bits(lambda i: i == F.col("step")), "before": bits(lambda i: i < F.col("step"))})
    fails, earlier = F.col("mask").bitwiseAND(F.col("own")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0
    total = lambda when, amount="n": F.sum(F.when(when, F.col(amount)).otherwise(0)).cast("long")
    removed = fails & ~earlier
    share = F.when(fails, F.col("n") * F.lit(len(ORDERS)) / F.greatest(F.bit_count("mask"), F.lit(1))).otherwise(0).cast("long")
    return each.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~earlier).alias("kept"),
        total(removed).alias("removed"),
        total(fails & earlier).alias("redundant"),
        total(F.col("mask") == F.col("own")).alias("unique_fails"),
        total(removed, "good").alias("good_lost"),
        total(removed, "toxic").alias("toxic_lost"),
        F.sum(share).alias("shapley"),
    )


def audit(documents: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """The report of enumerate_orders() on documents (doc_id, text, part) and labels (doc_id, quality, toxic)."""
    masked = masks(documents, part)
    by_cell = materialise(cells(masked, labels), "audit-cells")
    discard(masked)
    return enumerate_orders(by_cell)


def query(spark, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: Counts every order and step on the rows themselves, not on cells.
ORACLE = rf"""
with recursive t as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from {{documents}}),
lows as (select text, min(doc_id) as low from t group by text),
f as (select t.doc_id, part, len(w) < 100 as a, 100 * len(list_distinct(w)) < 80 * len(w) as b,
        100 * len(regexp_extract_all(t.text, '[A-Z]')) > 10 * length(t.text) as c, regexp_matches(t.text, '[#$%&*|]') as d,
        coalesce(low < coalesce(t.doc_id, 9223372036854775807), false) as e from t join lows on t.text = lows.text),
marks as (select doc_id, coalesce(bool_or(quality = 1), false) as g, coalesce(bool_or(toxic = 1), false) as x from labels where doc_id is not null group by doc_id),
r as (select part, (case when a then 'A' else '' end) || (case when b then 'B' else '' end) || (case when c then 'C' else '' end) || (case when d then 'D' else '' end) || (case when e then 'E' else '' end) as failed,
        coalesce(g, false) as g, coalesce(x, false) as x from f left join marks on f.doc_id = marks.doc_id),
k as (select part, failed, count(*) as n, count(*) filter (g) as g, count(*) filter (x) as x from r group by part, failed),
orders as (select '' as o union all select o || l from orders, (values ('A'), ('B'), ('C'), ('D'), ('E')) as v(l) where not contains(o, l)),
steps as (select o as filter_order, cast(i as integer) as step, o[i:i] as letter, o[1:i - 1] as before from orders, range(1, 6) as s(i) where length(o) = 5),
done as (select part, filter_order, step, letter, n, g, x, failed = letter as only_, contains(failed, letter) as fails,
           length(translate(failed, before, '')) < length(failed) as earlier from k, steps),
report as (select part, filter_order, step, any_value(letter) as letter, cast(coalesce(sum(n) filter (not fails and not earlier), 0) as bigint) as kept,
             cast(coalesce(sum(n) filter (fails and not earlier), 0) as bigint) as removed, cast(coalesce(sum(n) filter (fails and earlier), 0) as bigint) as redundant,
             cast(coalesce(sum(n) filter (only_), 0) as bigint) as unique_fails, cast(coalesce(sum(g) filter (fails and not earlier), 0) as bigint) as good_lost,
             cast(coalesce(sum(x) filter (fails and not earlier), 0) as bigint) as toxic_lost from done group by part, filter_order, step)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, cast(sum(removed) over (partition by part, letter) as bigint) as shapley from report
"""
