"""Deduplication: first wins on one key, and greedy acceptance over a conflict graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import discard, materialise, shuffles_end
from .frames import ranked


def first_wins(rows: DataFrame, key: Column, seq: str) -> DataFrame:
    """rows with status and matched: of equal keys one row of the smallest seq is accepted, the others match its seq.

    One value for each key of several rows is aggregated (partially, before the
    shuffle) and joined back; the planner splits or broadcasts that join, so a
    key that many rows share does not meet in one task.  Of several rows with
    the smallest seq the one of the smallest hash of its columns is accepted,
    and one of rows that are equal in all: only those equal rows are numbered.
    A null key is no copy of another: such rows are accepted.
    """
    keyed = rows.withColumns({"_key": F.sha2(key.cast("binary"), 256), "_tie": F.xxhash64(*rows.columns)})
    each = keyed.where("_key is not null").groupBy("_key", F.col(seq).alias("_seq"), "_tie").agg(F.count(F.lit(1)).alias("_equal"))
    first = each.groupBy("_key").agg(F.min(F.struct("_seq", "_tie", "_equal")).alias("_first"), F.sum("_equal").alias("_n")).where("_n > 1")
    first = materialise(first.select("_key", "_first"), "firsts")
    out = keyed.join(first, "_key", "left")
    leads = F.col("_first").isNull() | (F.col(seq).eqNullSafe(F.col("_first._seq")) & (F.col("_tie") == F.col("_first._tie")))
    done = out.withColumn("_copy", ~leads)
    if not first.where("_first._equal > 1").isEmpty():
        again = leads & (F.coalesce("_first._equal", F.lit(1)) > 1)
        nth = F.row_number().over(Window.partitionBy("_key").orderBy("_tie"))
        done = done.where(~again).unionByName(out.where(again).withColumn("_copy", nth > 1))
    return done.withColumns({"status": F.when(F.col("_copy"), "duplicate").otherwise("accepted"), "matched": F.when(F.col("_copy"), F.col("_first._seq"))}).drop("_key", "_tie", "_first", "_copy")


def zipped(left: DataFrame, right: DataFrame, group: str, order: list[str], value: str) -> DataFrame:
    """(group, i, chosen, rejected, unpaired): the i-th rows of a group in both stages, counted from 1; unpaired where one stage has none.

    order: a number (long), then ties.  A group is numbered in parts, so a large
    one does not meet in one task.
    """
    a, b = (
        ranked(x, group, order[0], order[1:]).select(group, (F.col("_rank") + 1).alias("i"), F.col(value).alias(n), F.lit(True).alias(f"_{n}"))
        for x, n in ((left, "chosen"), (right, "rejected"))
    )
    return a.join(b, [group, "i"], "full_outer").select(group, "i", "chosen", "rejected", (F.col("_chosen").isNull() | F.col("_rejected").isNull()).alias("unpaired"))


def greedy_accept(rows: DataFrame, seq: str, conflicts: DataFrame, copies: DataFrame | None = None) -> DataFrame:
    """(seq, status, matched): rows are taken in order, one is accepted unless it conflicts with an accepted earlier one.

    conflicts: u, v with u < v.  copies: seq, first; a copy conflicts with its
    first and with all that its first does, so it is rejected by its first, or
    by what rejected that.  Copies take no part in the rounds.  Rounds over the undecided edges: a row without
    an undecided earlier neighbour is accepted, and rejects its later
    neighbours.  The number of rounds is that of the longest chain of
    conflicts; each round is joins on the remaining edges only.
    """
    with shuffles_end(rows.sparkSession):
        edges = materialise(conflicts.select("u", "v").distinct(), "greedy")
        rejected = None
        todo = edges
        while not todo.isEmpty():
            blocked = todo.select(F.col("v").alias("n")).distinct()
            free = materialise(todo.select(F.col("u").alias("n")).distinct().join(blocked, "n", "left_anti"), "greedy")
            out = materialise(todo.join(free, todo["u"] == free["n"], "left_semi").select(F.col("v").alias("n")).distinct(), "greedy")
            rejected = out if rejected is None else rejected.union(out)
            gone = free.union(out)
            rest = todo.join(gone, todo["u"] == gone["n"], "left_anti")
            # A row whose blockers are all rejected has no edge left: it is accepted by default.
            left = materialise(rest.join(gone, rest["v"] == gone["n"], "left_anti"), "greedy")
            discard(free)
            if todo is not edges:
                discard(todo)
            todo = left
    base = rows.select(seq)
    if rejected is None:
        by = base.select(seq, F.col(seq).cast("long").alias("matched")).limit(0)
    else:
        by = edges.join(rejected, edges["v"] == rejected["n"], "left_semi").join(rejected, edges["u"] == rejected["n"], "left_anti").groupBy(F.col("v").alias(seq)).agg(F.min("u").alias("matched"))
    if copies is not None:
        of_first = by.select(F.col(seq).alias("first"), F.col("matched").alias("by_first"))
        by = by.unionByName(copies.join(of_first, "first", "left").select(seq, F.coalesce("by_first", "first").alias("matched")))
    return base.join(by, seq, "left").select(seq, F.when(F.col("matched").isNull(), "accepted").otherwise("rejected").alias("status"), F.col("matched").cast("long").alias("matched"))


def key_conflicts(rows: DataFrame, seq: str, keys: list[Column]) -> tuple[DataFrame, DataFrame]:
    """Edges (u, v) between rows that share one of several keys, and copies (seq, first), for greedy_accept.

    Within a key each row conflicts with all later ones.  Rows that agree in
    all keys are copies of their first, at one row each; only the firsts of
    distinct key combinations are paired.  A null key is shared with no row.
    """
    names = [f"k{i}" for i in range(len(keys))]
    named = rows.select(seq, *[F.sha2(k.cast("binary"), 256).alias(n) for n, k in zip(names, keys, strict=True)]).where(F.coalesce(*names).isNotNull())
    first = materialise(named.groupBy(*names).agg(F.min(seq).alias("first")), "keys")
    on = F.lit(True)
    for n in names:
        on = on & named[n].eqNullSafe(first[n])
    copies = named.join(first, on).where(F.col(seq) > F.col("first")).select(seq, "first")
    edges = None
    for n in names:
        a, b = first.select(F.col("first").alias("u"), n), first.select(F.col("first").alias("v"), n)
        some = a.join(b, n).where("u < v").select("u", "v")
        edges = some if edges is None else edges.union(some)
    return edges.distinct(), copies


def multi_key_accept(rows: DataFrame, seq: str, keys: list[Column]) -> DataFrame:
    """(seq, status, matched) of greedy_accept on several keys, without the pairs: one row for each row and key.

    In each round a row that comes first, of the undecided, in all its keys is
    accepted, and the other undecided rows of its keys are rejected.  A null
    key is shared with no row.  Only the first of rows that agree in all keys
    takes part in the rounds.
    """
    names = [f"k{i}" for i in range(len(keys))]
    named = materialise(rows.select(seq, *[F.sha2(F.concat(F.lit(f"{i}:").cast("binary"), k.cast("binary")), 256).alias(n) for i, (n, k) in enumerate(zip(names, keys, strict=True))]), "keys")
    first = named.where(F.coalesce(*names).isNotNull()).groupBy(*names).agg(F.min(seq).alias("n"))
    posts = first.withColumn("ks", F.array_compact(F.array(*names)))
    todo = materialise(posts.select("n", F.size("ks").alias("of"), F.explode("ks").alias("k")), "keys")
    held = None
    while not todo.isEmpty():
        leads = materialise(todo.groupBy("k").agg(F.min(F.struct("n", "of")).alias("m")).select("k", "m.n", "m.of"), "greedy")
        free = leads.groupBy("n").agg(F.count(F.lit(1)).alias("c"), F.first("of").alias("of")).where("c = of").select("n")
        won = materialise(leads.join(free, "n", "left_semi").select("k", F.col("n").alias("by")), "greedy")
        held = won if held is None else held.union(won)
        gone = materialise(todo.join(won, "k", "left_semi").select("n").distinct(), "greedy")
        todo = materialise(todo.join(gone, "n", "left_anti"), "greedy")
    if held is None:
        return named.select(seq, F.lit("accepted").alias("status"), F.lit(None).cast("long").alias("matched"))
    # One accepted row at most holds a key; of a row's keys' holders the first that is earlier rejects it.
    met = named.select(seq, F.explode(F.array_compact(F.array(*names))).alias("k")).join(held, "k").where(F.col("by") < F.col(seq)).groupBy(seq).agg(F.min("by").alias("by"))
    return named.select(seq).join(met, seq, "left").select(seq, F.when(F.col("by").isNull(), "accepted").otherwise("rejected").alias("status"), F.col("by").cast("long").alias("matched"))
