"""Acceptance and sessions with keyed state in the state store, and manifests that prove what was accepted.

A batch costs what its own keys cost: what was accepted before is looked up by
key in the state store, not read again.  State and output are committed by the
checkpoint, so a batch that is run again changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def _first_of_key(seq: str):
    """A function for applyInPandasWithState: the row of the smallest seq of a key's first batch, then nothing."""

    def run(key: tuple, batches: Iterator, state) -> Iterator:
        if key[0] is None:
            # No key: each row is one of its own.
            for rows in batches:
                yield rows.drop(columns=["_key"])
            return
        best = None
        for rows in batches:
            if not state.exists:
                near = rows.sort_values(seq, kind="stable").head(1)
                if best is None or near[seq].iloc[0] < best[seq].iloc[0]:
                    best = near
        if best is not None:
            state.update((int(best[seq].iloc[0]),))
            yield best.drop(columns=["_key"])

    return run


def accepted(stream: DataFrame, key: Column, seq: str) -> DataFrame:
    """The first row of each key of a stream: of the batch in which the key first comes, that of the smallest seq (long, not null).

    Repeated rows, in a batch or later, are dropped; rows of a null key are all kept.
    """
    keyed = stream.withColumn("_key", F.sha2(key.cast("binary"), 256))
    return keyed.groupBy("_key").applyInPandasWithState(_first_of_key(seq), stream.schema, "seq long", "append", "NoTimeout")


def accept_stream(stream: DataFrame, key: Column, seq: str, out: str, checkpoint: str) -> StreamingQuery:
    """Write the accepted rows of what has arrived to parquet shards in `out`; shards once written never change."""
    rows = accepted(stream, key, seq)
    return rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def shards(spark, out: str) -> DataFrame:
    """(shard, sha256, n_bytes) of the parquet files at `out`, by their bytes alone, so that a damaged one is told too."""
    name = F.element_at(F.split("path", "/"), -1)
    files = spark.read.format("binaryFile").load(out).where("path like '%.parquet'")
    return files.select(name.alias("shard"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("n_bytes"))


def manifest(spark, out: str) -> DataFrame:
    """(shard, sha256, n_bytes, n_rows) of each shard that the sink at `out` has committed; a shard without rows has 0."""
    # Both readers go by the sink's own log, so files of a failed attempt are no shards.
    counted = spark.read.parquet(out).groupBy(F.url_decode(F.element_at(F.split(F.input_file_name(), "/"), -1)).alias("shard")).agg(F.count(F.lit(1)).alias("n_rows"))
    return shards(spark, out).join(counted, "shard", "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)).cast("long"))


def damaged(found: DataFrame, sealed: DataFrame) -> DataFrame:
    """(shard, issue) of the shards of a manifest that are missing or changed among shards(); to be looked at before a job goes on. New shards are no issue."""
    was = sealed.select("shard", F.col("sha256").alias("_sha"))
    issue = F.when(F.col("sha256").isNull(), "missing").when(F.col("sha256") != F.col("_sha"), "changed")
    return was.join(found, "shard", "left").select("shard", issue.alias("issue")).where("issue is not null")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """(user_id, start, stop, n, total): a user's sessions, which end when nothing comes for `gap`; each event_id counts once.

    Works on a stream, where events that come after the watermark are dropped
    and a session is given when the watermark has passed it, and on a table.
    """
    ts = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if events.isStreaming:
        ts = ts.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])
    else:
        ts = ts.dropDuplicates(["event_id"])
    out = ts.where("ts is not null").groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return out.select("user_id", F.unix_micros("w.start").alias("start"), F.unix_micros("w.end").alias("stop"), "n", F.round("total", 4).alias("total"))


def sliding(events: DataFrame, width: str = "1 hour", slide: str = "15 minutes", late: str = "1 hour") -> DataFrame:
    """(event_type, start, n, highest): counts and highest values in windows that overlap, each event_id once; a stream or a table, as sessions()."""
    ts = events.withColumn("ts", F.col("ts").cast("timestamp"))
    ts = ts.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"]) if events.isStreaming else ts.dropDuplicates(["event_id"])
    out = ts.where("ts is not null").groupBy("event_type", F.window("ts", width, slide).alias("w")).agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("highest"))
    return out.select("event_type", F.unix_seconds("w.start").alias("start"), "n", "highest")
