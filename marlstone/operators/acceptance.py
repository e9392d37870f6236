"""Acceptance summaries, capacity proofs, examples and release blockers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import multi_key_accept


def content_summary(rows: DataFrame, kinds: dict[str, Column]) -> DataFrame:
    """(kind, total, unique_count, duplicate_count, maximum_repetition) for each named fingerprint, in one pass; null fingerprints are left out."""
    each = rows.select(F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), c.cast("string").alias("key")) for k, c in kinds.items()])).alias("x")).select("x.kind", "x.key")
    n = each.where("key is not null").groupBy("kind", "key").agg(F.count(F.lit(1)).alias("n"))
    out = n.groupBy("kind").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("unique_count"), F.max("n").alias("maximum_repetition"))
    return out.select("kind", "total", "unique_count", (F.col("total") - F.col("unique_count")).alias("duplicate_count"), "maximum_repetition")


def rejection_reasons(rows: DataFrame, seq: str, keys: dict[str, Column]) -> DataFrame:
    """(reason, n): rows are accepted in order unless an accepted earlier one holds one of their keys; a rejected row counts for each such key."""
    verdicts = multi_key_accept(rows, seq, list(keys.values())).select(seq, "status")
    named = F.explode(F.array(*[F.struct(F.lit(k).alias("reason"), F.sha2(c.cast("binary"), 256).alias("key")) for k, c in keys.items()]))
    posts = rows.select(seq, named.alias("x")).select(seq, "x.reason", "x.key").where("key is not null").join(verdicts, seq)
    # At most one accepted row holds a key.
    held = posts.where("status = 'accepted'").select("reason", "key", F.col(seq).alias("by"))
    return posts.where("status = 'rejected'").join(held, ["reason", "key"]).where(F.col("by") < F.col(seq)).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def same_counts(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """One row, same: whether two tables (key, n) name the same keys with the same counts; null is a key like others."""
    both = expected.select(F.lit(1).alias("side"), key, "n").unionByName(actual.select(F.lit(-1).alias("side"), key, "n"))
    return both.groupBy(key).agg(F.sum(F.col("side") * F.col("n")).alias("n")).agg((F.count_if(F.col("n") != 0) == 0).alias("same"))


def structure_report(rows: DataFrame, group: str, exact: Column, structure: Column, family: str) -> DataFrame:
    """For each group: rows, distinct texts, distinct structures, families and the largest family's share."""
    keyed = rows.select(group, exact.alias("_exact"), structure.alias("_structure"), F.col(family).alias("_family"))
    texts = keyed.groupBy(group).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("_exact").alias("unique_exact"), F.count_distinct("_structure").alias("unique_structures"))
    largest = keyed.groupBy(group, "_family").agg(F.count(F.lit(1)).alias("n")).groupBy(group).agg(F.count(F.lit(1)).alias("families"), F.max("n").alias("_most"))
    both = texts.select("*", F.col(group).alias("_g")).join(largest.withColumnRenamed(group, "_h"), F.expr("_g <=> _h"))
    return both.select(group, "n_rows", "unique_exact", "unique_structures", "families", F.round(F.col("_most") / F.col("n_rows"), 6).alias("largest_share"))


def capacity(rows: DataFrame, group: str, key: Column, tokens: Column, target: int) -> DataFrame:
    """For each group: rows, duplicates, capacity (distinct keys), mean tokens of a row, projected tokens and whether they reach the target."""
    n = rows.select(group, key.alias("_k"), tokens.alias("_t")).groupBy(group, "_k").agg(F.count(F.lit(1)).alias("n"), F.sum("_t").alias("t"))
    out = n.groupBy(group).agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("capacity"), F.sum("t").alias("_t"))
    projected = F.floor(F.col("capacity") * F.col("_t") / F.col("n_rows")).cast("long")
    return out.select(group, "n_rows", (F.col("n_rows") - F.col("capacity")).alias("duplicates"), "capacity", F.round(F.col("_t") / F.col("n_rows"), 4).alias("mean_tokens"), projected.alias("projected_tokens"), (projected >= target).alias("enough"))


def merged_results(parts: DataFrame, group: str, name: str, n: str, ok: str) -> DataFrame:
    """One row for each group: counts of its parts summed, their maps of counts merged ('name=n', by name), their flags joined by and."""
    named = parts.groupBy(group, name).agg(F.sum(n).alias("n"), F.bool_and(ok).alias("ok"))
    entry = F.concat(F.coalesce(F.col(name).cast("string"), F.lit("null")), F.lit("="), F.col("n"))
    return named.groupBy(group).agg(F.sum("n").alias("n"), F.array_join(F.array_sort(F.collect_list(entry)), ",").alias("merged"), F.bool_and("ok").alias("ok"))


def blockers(*checks: tuple[str, DataFrame]) -> DataFrame:
    """(blocker, n) of the checks, each a one-row table whose column n counts offences, that found any."""
    out = None
    for code, df in checks:
        row = df.select(F.lit(code).alias("blocker"), F.col("n").cast("long").alias("n"))
        out = row if out is None else out.unionByName(row)
    return out.where("n > 0")


def funnel(candidates: Column, rates: tuple[Column, Column, Column]) -> tuple[Column, Column, Column]:
    """Judge calls, reviewer calls and accepted rows (one at least) of so many candidates."""
    judged = candidates * rates[0]
    reviewed = judged * rates[1]
    return judged, reviewed, F.greatest(F.lit(1.0), reviewed * rates[2])


#: Limits and patterns of a source inventory (fixed values).
MIN_SOURCES, MAX_TEMPLATE_SHARE = 3, 0.40
NUMBERED = r"(?:_|-)(?:variant|version|style|tone)?\d+$"


def source_issues(sources: DataFrame, group: str, key: str, template: str, output_mode: Column, interactions: Column, surface: Column, least: int = MIN_SOURCES, share: float = MAX_TEMPLATE_SHARE) -> DataFrame:
    """(group, key, issue): what is wrong with an inventory of sources; key is null where it is the group's fault.

    A group needs `least` sources, no template of more than `share` of them; a
    source a key that is no numbered variant and stands once, tool calls only
    with tools, and a surface that no other source has.  surface: the source
    without its key and metadata, as a text in which numbers and marks say nothing.
    """
    rows = sources.select(F.col(group).alias("group"), F.col(key).alias("key"), F.col(template).alias("_template"), output_mode.alias("_mode"), interactions.alias("_how"), F.sha2(surface.cast("binary"), 256).alias("_surface"))
    sizes = rows.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    most = rows.groupBy("group", "_template").agg(F.count(F.lit(1)).alias("n")).groupBy("group").agg(F.max("n").alias("most"))
    of_group = sizes.withColumnRenamed("group", "_g").join(most, F.col("_g").eqNullSafe(F.col("group"))).select("group", F.explode(F.array_compact(F.array(
        F.when(F.col("n") < least, "too_few_sources"), F.when(F.col("most") > F.lit(share) * F.col("n"), "concentrated_template"),
    ))).alias("issue"))
    bare = F.trim(F.coalesce("key", F.lit("")))
    own = rows.select("group", "key", F.explode(F.array_compact(F.array(
        F.when(bare == "", "missing_key"), F.when(F.regexp_like(bare, F.lit(NUMBERED)), "numbered_variant"),
        F.when((F.col("_mode") == "tool_call") & ~F.coalesce(F.array_contains("_how", "tool_mediated"), F.lit(False)), "tool_call_without_tools"),
    ))).alias("issue"))
    twice = rows.where(bare != "").groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    alike = rows.groupBy("_surface").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_surface")
    shared = rows.join(twice, "key", "left_semi").select("group", "key", F.lit("repeated_key").alias("issue"))
    near = rows.join(alike, "_surface", "left_semi").select("group", "key", F.lit("superficial_copy").alias("issue"))
    return of_group.select("group", F.lit(None).cast("string").alias("key"), "issue").unionByName(own).unionByName(shared).unionByName(near)


def controller_totals(controllers: DataFrame, order: str) -> DataFrame:
    """One row of the run's totals over its batch-size controllers (current, maximum, minimum, observed_minimum, observed_peak and four counts); the last by order gives the current size; zeros without any."""
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    counts = ("increases", "decreases", "successes", "failures")
    return controllers.agg(
        zero(F.max_by("current", order)).alias("current"), zero(F.max("maximum")).alias("maximum"), zero(F.min("minimum")).alias("minimum"), zero(F.min("observed_minimum")).alias("observed_minimum"),
        zero(F.max("observed_peak")).alias("observed_peak"), *[zero(F.sum(c)).alias(c) for c in counts],
    )
