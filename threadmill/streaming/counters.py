"""What a capture counts while it runs: metrics that Spark observes in the stream, kept by trigger."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from threadmill.sources.events import decode, extract, raw_posts
from threadmill.sources.tables import exists
from threadmill.streaming.capture import first_per_key

#: Names of the observed metrics begin with this.
PREFIX = "threadmill_"


def counted_posts(frames: DataFrame, run_id: str, ttl_ms: int | None = None) -> DataFrame:
    """First posts per uri of a frame stream, which is counted on its way: frames (lines), blank lines, those that don't decode, commits, commits that don't extract, creates and unique posts."""
    n, failed = F.count(F.lit(1)), F.col("extract_error").isNotNull()
    seen = frames.observe(f"{PREFIX}frames", n.alias("frames"), F.count_if(F.trim("value") == "").alias("blank_lines"))
    decoded = decode(seen).observe(f"{PREFIX}decoded", F.count_if("decode_error").alias("decode_errors"), F.count_if(~F.col("decode_error") & (F.col("event_type") == "commit")).alias("commits"))
    extracted = extract(decoded).observe(f"{PREFIX}extracted", F.count_if(failed).alias("extract_errors"), F.count_if(~failed).alias("creates"))
    posts = raw_posts(extracted.where(~failed).drop("extract_error"), run_id, F.lit(None).cast("string")).drop("captured_at").withColumn("record", F.to_json("record"))
    return first_per_key(posts, "uri", ["seq"], ttl_ms).observe(f"{PREFIX}unique", n.alias("unique_posts"))


class TriggerCounters(StreamingQueryListener):
    """Writes each ended trigger's metrics of this engine's streams to a folder of its number under `path`: a trigger that is run again replaces what it counted before.

    Metrics arrive after their trigger has committed; those of a driver that dies in between are lost. `ended` is set when a watched stream has ended.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path, self.ended, self.fault = spark, path, threading.Event(), None

    def onQueryStarted(self, event) -> None:
        self.ended.clear()

    def onQueryProgress(self, event) -> None:
        p = event.progress
        found = [(name, int(value)) for observed, row in p.observedMetrics.items() if observed.startswith(PREFIX) for name, value in row.asDict().items()]
        # A trigger without rows of its own, as of timers, has the same number as no other.
        if found and p.numInputRows:
            try:
                rows = self.spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(name).alias("counter"), F.lit(n).cast("long").alias("n")) for name, n in found])).alias("c"))
                rows.select("c.*").coalesce(1).write.mode("overwrite").json(f"{self.path}/{p.batchId}")
            except Exception as fault:  # an error here would only be printed by Spark
                self.fault = fault

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.set()


@contextmanager
def counting(spark: SparkSession, path: str, seconds: float = 60) -> Iterator[None]:
    """While this is open, one stream's counters are kept under `path`; on leaving it waits until the last of them have arrived."""
    listener = TriggerCounters(spark, path)
    spark.streams.addListener(listener)
    try:
        yield
        if not listener.ended.wait(seconds):
            raise TimeoutError(f"the stream's last counters didn't arrive in {seconds} s")
        if listener.fault:
            raise listener.fault
    finally:
        spark.streams.removeListener(listener)


def counters(spark: SparkSession, path: str) -> DataFrame:
    """Rows (counter, n) over all triggers that are kept under `path`, of all runs of the checkpoint, and `duplicates`: creates that were no first post. No rows before the first trigger."""
    if not exists(spark, path):
        return spark.createDataFrame([], "counter string, n long")
    kept = spark.read.schema("counter string, n long").json(f"{path}/*").groupBy("counter").agg(F.sum("n").alias("n"))
    of = lambda name: F.sum(F.when(F.col("counter") == name, F.col("n")).otherwise(0))
    return kept.unionByName(kept.agg((of("creates") - of("unique_posts")).alias("n")).withColumn("counter", F.lit("duplicates")))
