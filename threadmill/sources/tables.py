"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir or the context's checkpoint folder. Where neither is set, a session on one machine gets a new folder; on a cluster that is an error."""
    got = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not got:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        got = "file://" + tempfile.mkdtemp(prefix="threadmill-")
        spark.sparkContext.setCheckpointDir(got)
    return got.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing uses yet; it goes when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/threadmill-{label}-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def bound_batches(spark: SparkSession, rows: int = 1000, size: int = 8_000_000) -> None:
    """From now on Python workers of this session get at most so many rows and bytes at once: whole texts go through them, and a lazy plan runs later. Smaller bounds stay."""
    for name, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        now = "".join(c for c in spark.conf.get(name) if c.isdigit() or c == "-")
        if not 0 < int(now) <= most or not spark.conf.get(name).isdigit():
            spark.conf.set(name, most)


def exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def stored(df: DataFrame, label: str) -> DataFrame:
    """df as a Parquet table in the shared folder: what reads it doesn't run df's plan again, and Spark knows its true size."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
