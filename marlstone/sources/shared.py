"""Tables, and the folder that driver and executors share."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it.

    Where none is named, a session in one process (tests, a laptop) gets a
    temporary one; on a cluster that would be a folder of the driver alone.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="marlstone-shared-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, tag: str, by: str | None = None, compression: str = "snappy") -> DataFrame:
    """Write df to the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and gives the
    optimizer the true size, so that it alone decides what to broadcast.
    by: a column of few values, one folder for each, of which a filter reads only its own.
    """
    spark = df.sparkSession
    path = new_path(spark, tag)
    writer = df.write if by is None else df.write.partitionBy(by)
    writer.option("compression", compression).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


@contextlib.contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """Within, a statement's shuffle files are deleted as it ends, not when the driver happens to collect its garbage.

    For steps that write each result: a frame run again would shuffle again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def discard(written: DataFrame) -> None:
    """Delete a table that materialise() wrote, once nothing reads it any more."""
    spark = written.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(written._written_to)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
