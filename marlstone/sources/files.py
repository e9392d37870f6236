"""Discovery of files and manifests, counted consolidation, and audits of rejected rows."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def discover(spark: SparkSession, path: str, names: str = "*.jsonl", batch: str = r"\.batch") -> DataFrame:
    """(file, dataset, bytes, issue) of the files below path that match names; only the listing is read.

    issue: nested (not in path itself) or batch (an internal part by its name),
    else null.  dataset is the name up to its first dot, under which
    planning.prefer_final chooses between a final file and its parts.
    """
    root = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", names).load(path).select(F.col("path").alias("file"), F.col("length").alias("bytes"))
    name = F.element_at(F.split("file", "/"), -1)
    parent = F.regexp_replace("file", "/[^/]*$", "")
    here = F.rtrim(F.regexp_replace(F.lit(path), "^file:/*", "/"), F.lit("/"))
    issue = F.when(~F.endswith(parent, here), "nested").when(F.rlike(name, F.lit(batch)), "batch")
    return root.select("file", F.regexp_extract(name, r"^[^.]*", 0).alias("dataset"), "bytes", issue.alias("issue"))


def manifests(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(file, metadata, issue): one JSON document a file; bad_json where it does not parse, no_metadata where it has none."""
    docs = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json").select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("_text"))
    got = docs.withColumns({"_any": F.try_parse_json("_text"), "metadata": F.from_json("_text", f"metadata struct<{schema}>")["metadata"]})
    issue = F.when(F.col("_any").isNull(), "bad_json").when(F.col("metadata").isNull(), "no_metadata")
    return got.select("file", "metadata", issue.alias("issue"))


def consolidate(shards: DataFrame, expected: DataFrame, group: str, path: str) -> DataFrame:
    """Write the rows of all shards, one folder a group, and return (group, expected, found) where the counts differ.

    expected: group, expected.  What is counted is what was written, so an
    empty result says that the files hold what the shards claimed.
    """
    shards.write.mode("overwrite").partitionBy(group).json(path)
    kind = shards.schema[group].dataType
    written = shards.sparkSession.read.schema(shards.schema).json(path).groupBy(F.col(group).cast(kind)).agg(F.count(F.lit(1)).alias("found"))
    return expected.join(written, group, "full_outer").where(~F.col("expected").eqNullSafe(F.col("found"))).select(group, "expected", "found")


def rejected_audit(specs: DataFrame, rows: DataFrame, decisions: DataFrame, id_: str, rejected: Column) -> DataFrame:
    """(id, spec, row, decision) of the rows whose decision is a rejection, as JSON texts; spec or row is null where none has the id."""
    one = lambda df, name: df.select(id_, F.to_json(F.struct(*[c for c in df.columns if c != id_])).alias(name))
    out = one(decisions.where(rejected), "decision").join(one(rows, "row"), id_, "left").join(one(specs, "spec"), id_, "left")
    return out.select(id_, "spec", "row", "decision")


def write_manifest(report: DataFrame, path: str, **fixed: str) -> str:
    """Write a report's rows as JSON lines with fixed fields and a run id, for manifests() and readers of JSON alike; returns the run id."""
    run = uuid.uuid4().hex
    report.withColumns({k: F.lit(v) for k, v in {**fixed, "run_id": run}.items()}).write.mode("append").json(path)
    return run
