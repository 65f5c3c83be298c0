"""Small helpers that every operator of this folder shares."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Largest number of rows of a narrow table (keys and numbers) that is sent to every executor.
BROADCAST_ROWS = 200_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or what SparkContext.setCheckpointDir was given.

    Where neither is set, a session on one machine gets a new folder of its own (tests); on a cluster that is an error, as executors wouldn't share it.
    """
    got = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not got:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        import tempfile

        got = "file://" + tempfile.mkdtemp(prefix="threadmill-")
        spark.sparkContext.setCheckpointDir(got)
    return got.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing uses yet; it goes when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/threadmill-{label}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """df as a Parquet table in the shared folder: lineage ends there, and Spark knows its true size."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Deletes the files of a written table that nothing reads any more."""
    spark = df.sparkSession
    for path in {name.rpartition("/")[0] for name in df.inputFiles()}:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def release_memory() -> None:
    """Gives memory that a Python worker has freed back to the system: workers stay for later tasks."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000, size: int = 8_000_000) -> Iterator[None]:
    """Python workers get at most so many rows and bytes at once in jobs that run while this holds; whole texts are in them."""
    wanted = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows), "spark.sql.execution.arrow.maxBytesPerBatch": str(size)}
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written table, with a broadcast hint if it has no more than `rows` rows; else Spark joins it by shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for working columns that df doesn't use (Spark's names ignore case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def text_of(name: str) -> Column:
    """A text column by its exact name, null as empty."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
