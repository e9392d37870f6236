"""Frames and sweeps over an ordered key whose rows do not meet in one task.

A key's rows are cut into parts by ranges of their order column, as many as its
number of rows asks for, and what a part needs of those before it is carried in:
the rows of the last seconds, the last rows, a running depth.  A part is a
partition of a window of its own, so one key may hold any share of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import materialise

#: Rows of a key in a part, about, where its order column is even.
PART_ROWS = 50_000


def cut_by_range(rows: DataFrame, key: str, order: str, part_rows: int = PART_ROWS) -> DataFrame:
    """rows with _part, a number that grows with the order column (long, nulls first) within a key (null keys are one key)."""
    k = F.col(key)
    extent = rows.groupBy(k.alias("_key")).agg(F.min(order).alias("_lo"), F.max(order).alias("_hi"), F.ceil(F.count(F.lit(1)) / F.lit(part_rows)).alias("_parts"))
    # In doubles, so that a wide range does not overflow; a part's edge need not be exact, only the same for equal values.
    at = (F.col(order).cast("double") - F.col("_lo")) / (F.col("_hi").cast("double") - F.col("_lo") + 1) * F.col("_parts")
    met = rows.join(extent, k.eqNullSafe(F.col("_key")))
    return met.withColumn("_part", F.when(F.col(order).isNull(), 0).otherwise(F.least(F.floor(at), F.col("_parts") - 1)).cast("long")).drop("_key", "_lo", "_hi", "_parts")


def ranked(rows: DataFrame, key: str, order: str, ties: list[str], part_rows: int = PART_ROWS) -> DataFrame:
    """rows with _rank, from 0 within a key in the order of order, then ties."""
    cut = cut_by_range(rows, key, order, part_rows)
    sizes = cut.groupBy(F.col(key).alias("_key"), F.col("_part").alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("_key").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.withColumn("_before", before).drop("_n")
    met = cut.join(sizes, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_part") == F.col("_p"))).drop("_key", "_p")
    within = F.row_number().over(Window.partitionBy(key, "_part").orderBy(order, *ties)) - 1
    return met.withColumn("_rank", (within + F.col("_before")).cast("long")).drop("_before", "_part")


def within_last(rows: DataFrame, key: str, at: str, span: int, aggregates: dict[str, Column], parts: int = 24) -> DataFrame:
    """rows with aggregates over those of the key whose `at` (long) is at most span before theirs, their own and equals included.

    A part spans `parts` spans; the rows of its last span are carried into the
    next one, where they are counted but not returned.
    """
    width = span * parts
    own = F.floor(F.col(at) / F.lit(width)).cast("long")
    late = F.col(at) >= (own + 1) * F.lit(width) - F.lit(span)
    both = rows.withColumn("_part", F.explode(F.when(late, F.array(own, own + 1)).otherwise(F.array(own))))
    frame = Window.partitionBy(key, "_part").orderBy(at).rangeBetween(-span, 0)
    out = both.withColumns({name: a.over(frame) for name, a in aggregates.items()})
    return out.where(F.col("_part") == own).drop("_part")


def last_rows(rows: DataFrame, key: str, order: str, ties: list[str], n: int, aggregates: dict[str, Column], part_rows: int = PART_ROWS) -> DataFrame:
    """rows with aggregates over the key's last n rows in the order of order, then ties, their own included.

    Rows are ranked, and cut by rank into parts of part_rows; the last n - 1 of
    a part are carried into the next.
    """
    size = max(n, part_rows)
    own = F.floor(F.col("_rank") / F.lit(size)).cast("long")
    late = F.col("_rank") >= (own + 1) * F.lit(size) - F.lit(n - 1)
    both = ranked(rows, key, order, ties, part_rows).withColumn("_part", F.explode(F.when(late, F.array(own, own + 1)).otherwise(F.array(own))))
    frame = Window.partitionBy(key, "_part").orderBy("_rank").rowsBetween(-(n - 1), 0)
    out = both.withColumns({name: a.over(frame) for name, a in aggregates.items()})
    return out.where(F.col("_part") == own).drop("_part", "_rank")


def large_keys(events: DataFrame, key: str, part_rows: int = PART_ROWS) -> DataFrame:
    """(_large) the keys of more than part_rows rows, written."""
    many = events.groupBy(F.col(key).alias("_large")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > part_rows)
    return materialise(many.select("_large", F.lit(True).alias("_found")), "sweep-large")


def swept(events: DataFrame, key: str, at: str, depths: list[str], part_rows: int = PART_ROWS, large: DataFrame | None = None, dealt: bool = False) -> DataFrame:
    """(key, at, next, prev, the depths' changes, and for each depth d its value before and after: d_before, d_after) of each distinct position.

    events: key, at (long) and by how much each depth changes there.  Changes at
    one position are added first.  A key of at most part_rows rows meets in one
    task, so its rows travel once; only larger ones are cut into parts.
    large: large_keys() of events, or of rows of which events has no more;
    dealt: whether events lie by key already, as a sweep leaves them.
    """
    large = large_keys(events, key, part_rows) if large is None else large
    if large.isEmpty():
        return _swept_whole(events, key, at, depths, dealt)
    # The table of large keys is short: of so many rows a part of them at most.
    marked = events.join(large, F.col(key).eqNullSafe(F.col("_large")), "left")
    small = _swept_whole(marked.where("_found is null").drop("_large", "_found"), key, at, depths, False)
    return small.unionByName(_swept_in_parts(marked.where("_found").drop("_large", "_found"), key, at, depths, part_rows))


def _swept_whole(events: DataFrame, key: str, at: str, depths: list[str], dealt: bool) -> DataFrame:
    sums = (events if dealt else events.repartition(key)).groupBy(key, at).agg(*[F.sum(d).alias(d) for d in depths])
    own = Window.partitionBy(key).orderBy(at)
    upto = own.rowsBetween(Window.unboundedPreceding, 0)
    out = sums.withColumns({"next": F.lead(at).over(own), "prev": F.lag(at).over(own), **{f"{d}_after": F.sum(d).over(upto).cast("long") for d in depths}})
    out = out.withColumns({f"{d}_before": F.col(f"{d}_after") - F.col(d) for d in depths})
    return out.select(key, at, "next", "prev", *depths, *[f"{d}_{w}" for d in depths for w in ("before", "after")])


def _swept_in_parts(events: DataFrame, key: str, at: str, depths: list[str], part_rows: int) -> DataFrame:
    """swept() of large keys: a part gets the depth at its start and the positions next to its ends from a table with one row for each part."""
    sums = events.groupBy(key, at).agg(*[F.sum(d).alias(d) for d in depths])
    cut = cut_by_range(sums, key, at, part_rows)
    ends = cut.groupBy(F.col(key).alias("_key"), F.col("_part").alias("_p")).agg(F.min(at).alias("_first"), F.max(at).alias("_last"), *[F.sum(d).alias(f"_{d}") for d in depths])
    order = Window.partitionBy("_key").orderBy("_p")
    carried = {f"_{d}": F.coalesce(F.sum(f"_{d}").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) for d in depths}
    ends = ends.select("_key", "_p", F.lead("_first").over(order).alias("_next"), F.lag("_last").over(order).alias("_prev"), *[c.alias(n) for n, c in carried.items()])
    met = cut.join(ends, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_part") == F.col("_p"))).drop("_key", "_p")
    own = Window.partitionBy(key, "_part").orderBy(at)
    upto = own.rowsBetween(Window.unboundedPreceding, 0)
    out = met.withColumns({
        "next": F.coalesce(F.lead(at).over(own), "_next"),
        "prev": F.coalesce(F.lag(at).over(own), "_prev"),
        **{f"{d}_after": (F.sum(d).over(upto) + F.col(f"_{d}")).cast("long") for d in depths},
    })
    out = out.withColumns({f"{d}_before": F.col(f"{d}_after") - F.col(d) for d in depths})
    return out.select(key, at, "next", "prev", *depths, *[f"{d}_{w}" for d in depths for w in ("before", "after")])


def gaps(ranges: DataFrame, key: str, start: str, stop: str, part_rows: int = PART_ROWS) -> DataFrame:
    """(key, gap_start, gap_stop): what lies between the ranges [start, stop) of a key; an empty range ends the gap before it."""
    last = F.greatest(start, stop)
    points = ranges.select(key, F.inline(F.array(F.struct(F.col(start).cast("long").alias("at"), F.lit(1).alias("depth"), F.lit(1).alias("begins")), F.struct(last.cast("long").alias("at"), F.lit(-1).alias("depth"), F.lit(0).alias("begins")))))
    met = swept(points, key, "at", ["depth", "begins"], part_rows)
    return met.where("depth_before = 0 and begins > 0 and prev is not null").select(key, F.col("prev").alias("gap_start"), F.col("at").alias("gap_stop"))


def uncovered(planned: DataFrame, completed: DataFrame, key: str, start: str, stop: str, part_rows: int = PART_ROWS) -> DataFrame:
    """(key, start, stop): the largest pieces of the planned ranges [start, stop) of a key that no completed range of it covers.

    Ranges may overlap, nest and repeat, in either table; empty ones count for
    nothing.  A sweep over both tables' ends keeps two depths; neighbouring
    pieces are joined where a cut between them changes neither answer.
    """
    points = None
    for side, name in ((planned, "plan"), (completed, "done")):
        deep = lambda at, by, name=name: F.struct(at.cast("long").alias("at"), *[F.lit(by if n == name else 0).alias(n) for n in ("plan", "done")])
        some = side.where(F.col(start) < F.col(stop)).select(F.col(key).alias(key), F.inline(F.array(deep(F.col(start), 1), deep(F.col(stop), -1))))
        points = some if points is None else points.unionByName(some)
    large = large_keys(points, key, part_rows)
    met = swept(points, key, "at", ["plan", "done"], part_rows, large)
    open_ = lambda when: (F.col(f"plan_{when}") > 0) & (F.col(f"done_{when}") <= 0)
    # Where a piece begins and where it ends: +1 and -1 of one depth, swept again to bring both together.
    edges = met.where(open_("before") != open_("after")).select(key, "at", F.when(open_("after"), 1).otherwise(-1).alias("edge"))
    pieces = swept(edges, key, "at", ["edge"], part_rows, large, dealt=True)
    return pieces.where("edge > 0").select(key, F.col("at").alias(start), F.col("next").alias(stop))
