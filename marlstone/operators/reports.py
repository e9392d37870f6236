"""Report aggregations over keys, lengths, clusters, evidence and telemetry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import within_last


def uniqueness(rows: DataFrame, key: Column) -> DataFrame:
    """One row: total, unique, duplicate_count, unique_ratio, repeated_value_count and maximum_repetition of key."""
    n = rows.groupBy(key.alias("k")).agg(F.count(F.lit(1)).alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0))
    return n.agg(
        total.cast("long").alias("total"),
        F.count(F.lit(1)).alias("unique_count"),
        (total - F.count(F.lit(1))).cast("long").alias("duplicate_count"),
        F.when(total == 0, F.lit(1.0)).otherwise(F.round(F.count(F.lit(1)) / total, 6)).alias("unique_ratio"),
        F.count_if(F.col("n") > 1).alias("repeated_value_count"),
        F.coalesce(F.max("n"), F.lit(0)).alias("maximum_repetition"),
    )


def value_counts(rows: DataFrame, fields: list[str]) -> DataFrame:
    """(field, value, n) for each field; null counts as the value "null"."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.coalesce(F.col(f).cast("string"), F.lit("null")).alias("value")) for f in fields])
    return rows.select(F.inline(pairs)).groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))


def length_stats(rows: DataFrame, group: str, length: Column) -> DataFrame:
    n = rows.select(group, length.cast("long").alias("n"))
    return n.groupBy(group).agg(
        F.count("n").alias("n_rows"), F.round(F.avg("n"), 2).alias("mean_length"), F.median("n").alias("median_length"), F.expr("percentile_disc(0.9) within group (order by n)").cast("long").alias("p90_length"), F.ceil(F.avg("n")).cast("long").alias("ceil_mean")
    )


def duplicate_rate(rows: DataFrame, group: str, key: Column) -> DataFrame:
    """For each group and for all rows (group null): rows, distinct keys, duplicates and their rate."""
    each = rows.select(F.col(group).alias("grp"), F.sha2(key.cast("binary"), 256).alias("k"))
    per_key = each.groupBy("grp", "k").agg(F.count(F.lit(1)).alias("n"))
    groups = per_key.groupBy("grp").agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_unique"))
    whole = per_key.groupBy("k").agg(F.sum("n").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_unique")).select(F.lit(None).cast("string").alias("grp"), "n_rows", "n_unique")
    return groups.unionByName(whole).select("grp", "n_rows", "n_unique", (F.col("n_rows") - F.col("n_unique")).alias("n_duplicates"), F.round((F.col("n_rows") - F.col("n_unique")) / F.greatest(F.col("n_rows"), F.lit(1)), 6).alias("rate"))


def cluster_members(rows: DataFrame, id_: str, key: Column) -> DataFrame:
    """(cluster, id): all distinct ids of each key of more than one row; one row for each, no lists.  A null key is no cluster."""
    named = rows.select(F.sha2(key.cast("binary"), 256).alias("cluster"), id_).where("cluster is not null")
    repeated = named.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("cluster")
    return named.join(repeated, "cluster", "left_semi").distinct()


def clusters(rows: DataFrame, id_: str, key: Column, preview: int = 5) -> DataFrame:
    """Keys of more than one row: size, first member and a preview of the smallest members.

    cluster_members() has all members; no task gathers a whole key here.
    """
    named = rows.select(F.sha2(key.cast("binary"), 256).alias("cluster"), id_, F.pmod(F.xxhash64(id_), F.lit(64)).alias("_p")).where("cluster is not null")
    found = named.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), F.min(id_).alias("first_member")).where("size > 1")
    # Each part of a key gives its own smallest ids; the key's smallest are among them.
    near = named.where(F.col(id_).isNotNull()).distinct().withColumn("_r", F.row_number().over(Window.partitionBy("cluster", "_p").orderBy(id_))).where(F.col("_r") <= preview)
    shown = near.groupBy("cluster").agg(F.array_join(F.slice(F.array_sort(F.collect_list(id_)), 1, preview), ",").alias("members"))
    return found.join(shown, "cluster", "left").select("cluster", "size", "first_member", F.coalesce("members", F.lit("")).alias("members"))


def top_clusters(found: DataFrame, k: int = 20) -> DataFrame:
    return found.orderBy(F.desc("size"), "first_member").limit(k)


def concentration(rows: DataFrame, field: str, limit: float = 0.40) -> DataFrame:
    """Values with their share of all rows; flagged beyond the limit if they repeat."""
    n = rows.groupBy(field).agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy())  # one row for each value
    return n.select(field, "n", F.round(share, 6).alias("share"), ((share > limit) & (F.col("n") > 1)).alias("over_limit"))


def evidence_status(rows: DataFrame, evidence: DataFrame, id_: str, passed: Column) -> DataFrame:
    """(id, status): passed, failed or missing; evidence that names an id twice counts as failed unless all of it passes."""
    each = evidence.groupBy(id_).agg(F.every(passed).alias("_ok"))
    return rows.select(id_).join(each, id_, "left").select(id_, F.when(F.col("_ok").isNull(), "missing").when(F.col("_ok"), "passed").otherwise("failed").alias("status"))


def count_mismatch(expected: DataFrame, actual: DataFrame, group: str) -> DataFrame:
    """Groups whose expected and actual counts (column n) differ; absent counts as 0."""
    both = expected.select(group, F.col("n").alias("e")).join(actual.select(group, F.col("n").alias("a")), group, "full_outer")
    return both.select(group, F.coalesce("e", F.lit(0)).cast("long").alias("expected"), F.coalesce("a", F.lit(0)).cast("long").alias("actual")).where("expected <> actual")


def telemetry(events: DataFrame) -> DataFrame:
    """By user: attempts, errors, cost, largest and smallest positive value, first event's type."""
    return events.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.count_if(F.col("event_type") == "error").alias("errors"),
        F.round(F.sum("value"), 4).alias("cost"),
        F.max("value").alias("max_value"),
        F.min(F.when(F.col("value") > 0, F.col("value"))).alias("min_positive"),
        F.min_by("event_type", F.struct("ts", "event_id")).alias("first_type"),
    )


def bursts(events: DataFrame, seconds: int, limit: int) -> DataFrame:
    """Events at which a user has more than limit events within the last seconds; a user's events are counted in parts of time."""
    at = events.withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    counted = within_last(at, "user_id", "us", seconds * 1_000_000, {"recent": F.count(F.lit(1))})
    return counted.where(F.col("recent") > limit).select("event_id", "user_id", "recent")


def sample_by_group(rows: DataFrame, group: str, id_: str, k: int, seed: str) -> DataFrame:
    """The k rows of each group that come first by a seeded hash of the id."""
    order = F.sha2(F.concat(F.lit(seed), F.col(id_).cast("string")).cast("binary"), 256)
    # Each part of a group gives its own first k; the group's first k are among them.
    part = F.pmod(F.xxhash64(id_), F.lit(64))
    near = rows.withColumns({"_h": order, "_p": part}).withColumn("_r", F.row_number().over(Window.partitionBy(group, "_p").orderBy("_h", id_))).where(F.col("_r") <= k)
    return near.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy("_h", id_))).where(F.col("rank") <= k).drop("_h", "_p", "_r")


def reason_counts(rows: DataFrame, issues: str, group: str) -> DataFrame:
    """(group, reason, n): how many rows of a group have each of their issue codes; a row counts for each of its own."""
    return rows.select(group, F.explode(F.array_distinct(issues)).alias("reason")).groupBy(group, "reason").agg(F.count(F.lit(1)).alias("n"))


def coverage(expected: DataFrame, actual: DataFrame, id_: str) -> DataFrame:
    """(id, status): matched, missing (expected only), unexpected (actual only), or duplicate (more than one actual row).

    Counts are aggregated before the join; a null id matches nothing.
    """
    want = expected.select(id_).distinct().withColumn("_want", F.lit(True))
    got = actual.groupBy(id_).agg(F.count(F.lit(1)).alias("_n"))
    status = F.when(F.col("_n").isNull(), "missing").when(F.col("_want").isNull(), "unexpected").when(F.col("_n") > 1, "duplicate").otherwise("matched")
    return want.join(got, id_, "full_outer").select(id_, status.alias("status"))


def field_mismatches(rows: DataFrame, specs: DataFrame, id_: str, fields: list[str]) -> DataFrame:
    """(id, issue): rows without a spec, specs without a row, and the first field in which a row differs from its spec."""
    a = rows.select(id_, F.lit(True).alias("_row"), *[F.col(f).alias(f"_a_{f}") for f in fields])
    b = specs.select(id_, F.lit(True).alias("_spec"), *[F.col(f).alias(f"_b_{f}") for f in fields])
    issue = F.when(F.col("_spec").isNull(), "missing_spec").when(F.col("_row").isNull(), "missing_row")
    for f in fields:
        issue = issue.when(~F.col(f"_a_{f}").eqNullSafe(F.col(f"_b_{f}")), f"{f}_mismatch")
    return a.join(b, id_, "full_outer").select(id_, issue.alias("issue")).where("issue is not null")


def ordered_fingerprint(rows: DataFrame, seq: str, row: Column, part_rows: int) -> DataFrame:
    """(fingerprint, parts): a hash of all rows in the order of seq, over the hashes of parts of part_rows numbers of seq each.

    The last step gets one hash for each part, in one task.
    """
    each = rows.select(F.floor(F.col(seq) / part_rows).alias("part"), F.col(seq).alias("seq"), F.sha2(row.cast("binary"), 256).alias("h"))
    of = lambda items: F.sha2(F.array_join(F.transform(F.array_sort(items), lambda x: x["h"]), "").cast("binary"), 256)
    parts = each.groupBy("part").agg(of(F.collect_list(F.struct("seq", "h"))).alias("h"))
    return parts.agg(of(F.collect_list(F.struct("part", "h"))).alias("fingerprint"), F.count(F.lit(1)).alias("parts"))


def first_by_group(rows: DataFrame, group: str, seq: str, k: int) -> DataFrame:
    """The k rows of each group that come first by seq."""
    near = rows.withColumn("_p", F.pmod(F.xxhash64(seq), F.lit(64)))
    near = near.withColumn("_r", F.row_number().over(Window.partitionBy(group, "_p").orderBy(seq))).where(F.col("_r") <= k)
    return near.withColumn("_r", F.row_number().over(Window.partitionBy(group).orderBy(seq))).where(F.col("_r") <= k).drop("_p", "_r")
