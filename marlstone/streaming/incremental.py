"""Incremental acceptance: Structured Streaming jobs that add to accepted output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def accept_stream(stream: DataFrame, key: Column, seq: str, out: str, checkpoint: str) -> StreamingQuery:
    """Accept the first row of each key, in batches that each overwrite a batch_id partition of their own.

    A batch joins the keys accepted by other batches, so a batch that is run
    again after a failure gives the same rows.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        from ..operators.dedup import first_wins

        spark = batch.sparkSession
        fresh = first_wins(batch, key, seq).where("status = 'accepted'").drop("status", "matched").withColumn("key", F.sha2(key.cast("binary"), 256))
        if _exists(spark, out):
            before = spark.read.parquet(out).where(F.col("batch_id") != batch_id).select("key")
            fresh = fresh.join(before, "key", "left_anti")
        fresh.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and values by event type in event-time windows; works on a stream (with a watermark) and on a table alike."""
    ts = events.withColumn("ts", F.col("ts").cast("timestamp"))
    ts = ts.withWatermark("ts", late) if events.isStreaming else ts
    return ts.groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.unix_seconds(F.col("window.start")).alias("window_start"), "event_type", "n", F.round("total", 4).alias("total"))
