"""Planning: quotas, schedules, mixed-radix generators, gaps and publish gates, as projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def even_split(groups: DataFrame, key: str, total: int) -> DataFrame:
    """total over the groups in key order, the remainder to the earliest."""
    n = F.count(F.lit(1)).over(Window.partitionBy())
    rank = F.row_number().over(Window.orderBy(key))
    return groups.select(key, n.alias("n"), rank.alias("rank")).select(key, (F.floor(F.lit(total) / F.col("n")) + (F.col("rank") <= F.lit(total) % F.col("n")).cast("int")).cast("long").alias("planned"))


def token_targets(groups: DataFrame, key: str, share: str, mean_tokens: str, capacity: str, budget: int) -> DataFrame:
    """Share of a token budget -> rows, at most the capacity."""
    target = F.round(F.col(share) * budget).cast("long")
    return groups.select(key, target.alias("token_target"), F.least(F.ceil(target / F.col(mean_tokens)).cast("long"), F.col(capacity).cast("long")).alias("planned_rows"))


def completion(targets: DataFrame, accepted: DataFrame, key: str) -> DataFrame:
    """targets (key, target) against accepted (key, got): deficit and status."""
    got = F.coalesce("got", F.lit(0)).cast("long")
    return targets.join(accepted, key, "left").select(key, "target", got.alias("got"), F.greatest(F.col("target") - got, F.lit(0)).cast("long").alias("deficit"), F.when(got >= F.col("target"), "complete").when(got == 0, "empty").otherwise("underfilled").alias("status"))


def replacements(report: DataFrame, acceptance: float, ceiling: int) -> DataFrame:
    """Rows to generate for each deficit at an acceptance rate, at most ceiling."""
    return report.where("deficit > 0").withColumn("to_generate", F.least(F.ceil(F.col("deficit") / acceptance), F.lit(ceiling)).cast("long"))


def mixed_radix(spark: SparkSession, n: int, radices: dict[str, int]) -> DataFrame:
    """Row i of n with the digits of i, first name fastest."""
    out, rest = spark.range(n).select(F.col("id").alias("i")), F.col("i")
    for name, r in radices.items():
        out = out.withColumn(name, (rest % r).cast("long"))
        rest = F.floor(rest / r)
    return out


def weighted_schedule(spark: SparkSession, n: int, weights: dict[str, int]) -> DataFrame:
    """(i, category, ordinal): rounds of sum(weights) slots, each category as often as its weight; ordinal counts within the category."""
    slots = [name for name, w in weights.items() for _ in range(w)]
    first = {name: slots.index(name) for name in weights}
    names, starts, sizes = (F.array(*[F.lit(v) for v in vs]) for vs in (slots, [first[s] for s in slots], [weights[s] for s in slots]))
    slot = (F.col("id") % len(slots)).cast("int")
    return spark.range(n).select(F.col("id").alias("i"), names[slot].alias("category"), (F.floor(F.col("id") / len(slots)) * sizes[slot] + slot - starts[slot]).cast("long").alias("ordinal"))


def hash_order(rows: DataFrame, id_: str, salt: str) -> DataFrame:
    """A stable pseudo-random rank of a catalog.

    Ids are ranked within the buckets of their hash's first digits, behind the
    rows of the buckets before; one task sees a count for each bucket (65536).
    """
    h = F.sha2(F.concat(F.lit(salt), F.col(id_).cast("string")).cast("binary"), 256)
    hashed = rows.select(id_, h.alias("_h"), F.substring(h, 1, 4).alias("_bucket"))
    sizes = hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = hashed.join(sizes.select("_bucket", before.alias("_before")), "_bucket")
    return ranked.select(id_, (F.row_number().over(Window.partitionBy("_bucket").orderBy("_h", id_)) + F.col("_before")).cast("long").alias("rank"))


def gate(checks: dict[str, DataFrame]) -> DataFrame:
    """(check, passed) for one-row frames of a boolean each."""
    out = None
    for name, df in checks.items():
        row = df.select(F.lit(name).alias("check_name"), F.col(df.columns[0]).alias("passed"))
        out = row if out is None else out.unionByName(row)
    return out


def changed(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """Keys whose value differs between two reports, or is in one only."""
    a, b = old.select(key, F.col(value).alias("old_value")), new.select(key, F.col(value).alias("new_value"))
    return a.join(b, key, "full_outer").where(~F.col("old_value").eqNullSafe(F.col("new_value")))


def cost(tokens_in: Column, tokens_out: Column, price_in: float, price_out: float) -> Column:
    return F.round((tokens_in * price_in + tokens_out * price_out) / 1_000_000, 6)


def prefer_final(files: DataFrame, key: list[str], is_shard: str) -> DataFrame:
    """Of each key the final files, or all its shards where there is none."""
    finals = files.where(~F.col(is_shard)).select(*key).distinct().withColumn("_final", F.lit(True))
    return files.join(finals, key, "left").where(~F.col(is_shard) | F.col("_final").isNull()).drop("_final")


def yields(counts: DataFrame, key: str, wanted: int) -> DataFrame:
    """counts (key, capacity, ok, seen) -> yield_rate of the rows seen, the rows projected from the capacity, and the headroom over wanted."""
    rate = F.col("ok") / F.greatest(F.col("seen"), F.lit(1))
    projected = F.floor(F.col("capacity") * rate).cast("long")
    return counts.select(key, "capacity", F.round(rate, 6).alias("yield_rate"), projected.alias("projected"), (projected - wanted).alias("headroom"))


def choice(id_: Column, salt: str, options: tuple[str, ...]) -> Column:
    """One of the options by a salted hash of the id."""
    n = F.conv(F.substring(F.md5(F.concat(F.lit(salt), id_.cast("string")).cast("binary")), 1, 8), 16, 10).cast("long") % len(options)
    return F.element_at(F.array(*map(F.lit, options)), n.cast("int") + 1)
