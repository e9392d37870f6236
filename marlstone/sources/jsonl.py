"""JSON-lines scans with line numbers and issue codes, and the matching sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def scan(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, text, row, issues) of each line; row is a variant, null where issues is not empty; never fails on content.

    Line numbers are those within the file: a file is split into parts by
    Spark, so parts are counted first and numbered within.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("text"))
    sizes = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    numbered = lines.join(sizes, ["file", "block"]).withColumn("line", F.row_number().over(Window.partitionBy("file", "block").orderBy("at")) + F.col("before"))
    row = F.try_parse_json("text")
    blank = F.length(F.trim(F.coalesce(F.col("text"), F.lit("")))) == 0
    issues = F.when(blank, F.array(F.lit("empty_line"))).when(row.isNull(), F.array(F.lit("bad_json"))).when(~F.schema_of_variant(row).rlike("^OBJECT"), F.array(F.lit("not_object"))).otherwise(F.array().cast("array<string>"))
    return numbered.select("file", F.col("line").cast("long").alias("line"), "text", F.when(F.size(issues) == 0, row).alias("row"), issues.alias("issues"))


def _whole_rows(scanned: DataFrame, checks: Column | None) -> DataFrame:
    """A scan whose issues hold those of checks too: a column on `row` that gives an array of codes."""
    if checks is None:
        return scanned
    return scanned.withColumn("issues", F.when(F.size("issues") == 0, F.coalesce(checks, F.array().cast("array<string>"))).otherwise(F.col("issues")))


def read_strict(spark: SparkSession, path: str, schema: str, checks: Column | None = None) -> DataFrame:
    """Rows of the schema (in DDL); the job ends with the file, line and issues of the first bad row that a task meets.

    Bad are lines that are no JSON object, objects that do not fit the schema,
    and what checks finds; blank lines are left out.
    """
    found = _whole_rows(scan(spark, path), checks).where(~F.array_contains("issues", "empty_line"))
    row = F.try_variant_get("row", "$", f"struct<{schema}>")
    unfit = row.isNull()
    for name in StructType.fromDDL(schema).names:
        # A value that does not fit its type reads as null.
        given = F.try_variant_get("row", f"$['{name}']", "variant")
        unfit = unfit | (given.isNotNull() & ~F.is_variant_null(given) & row[name].isNull())
    issues = F.when(F.size("issues") > 0, F.array_join("issues", ",")).when(unfit, "bad_type")
    where = F.concat(F.lit("bad row at "), "file", F.lit(" line "), F.col("line").cast("string"), F.lit(": "), issues)
    typed = found.select(F.when(issues.isNull(), row).otherwise(F.raise_error(where).cast(f"struct<{schema}>")).alias("r"))
    return typed.select("r.*")


def error_table(spark: SparkSession, path: str, checks: Column | None = None, tool_or_role: tuple[str, ...] = ("role", "tool")) -> DataFrame:
    """(file, line, id, error, tool_or_role) of each issue of each row; id is the row's own where it has one, tool_or_role whether the code names one of those."""
    found = _whole_rows(scan(spark, path), checks)
    named = F.lit(False)
    for word in tool_or_role:
        named = named | F.contains(F.col("error"), F.lit(word))
    each = found.select("file", "line", F.try_variant_get("row", "$.id", "string").alias("id"), F.explode("issues").alias("error"))
    return each.withColumn("tool_or_role", named)


def write_validated(rows: DataFrame, path: str, issues: Column) -> int:
    """Overwrite path with rows as JSON lines and return how many were written; nothing is replaced if any row has issues (an array of codes)."""
    bad = rows.select(issues.alias("i")).where("size(i) > 0").limit(1).collect()
    if bad:
        raise ValueError(f"invalid row: {','.join(bad[0]['i'])}")
    rows.write.mode("overwrite").json(path)
    # What is counted is what was written.
    return rows.sparkSession.read.text(path).count()


def write_split(tagged: DataFrame, path: str, issues: str = "issues") -> None:
    """Rows without issues under status=accepted, the others with their issues under status=rejected, in one pass."""
    tagged.withColumn("status", F.when(F.size(issues) == 0, "accepted").otherwise("rejected")).write.mode("overwrite").partitionBy("status").json(path)


def write_groups(df: DataFrame, path: str, group: str) -> None:
    """One folder of JSON lines for each group."""
    df.write.mode("overwrite").partitionBy(group).json(path)
