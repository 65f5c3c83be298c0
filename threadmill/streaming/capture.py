"""Capture as a stream: frames in, unique posts out."""

from __future__ import annotations

import time
from collections.abc import Iterator

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from threadmill.sources.events import decode, extract_creates, raw_posts
from threadmill.sources.tables import exists

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def frame_stream(spark: SparkSession, path: str, files: int = 100) -> DataFrame:
    """JSON-line frames of a folder as they arrive, so many files a trigger (backpressure)."""
    return spark.readStream.option("maxFilesPerTrigger", files).text(path)


def capture(frames: DataFrame, run_id: str) -> DataFrame:
    """Posts of a frame stream, one per uri over the whole stream."""
    return raw_posts(extract_creates(decode(frames)), run_id, F.current_timestamp().cast("string")).dropDuplicates(["uri"])


def unique_within(frames: DataFrame, run_id: str, time: str = "event_time", late: str = "24 hours") -> DataFrame:
    """As capture, with state that a watermark bounds: a uri that returns after `late` counts again."""
    posts = raw_posts(extract_creates(decode(frames)), run_id, F.current_timestamp().cast("string"))
    return posts.withColumn("event_ts", F.try_to_timestamp(time)).withWatermark("event_ts", late).dropDuplicatesWithinWatermark(["uri"])


def drain(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Runs the stream over all that has arrived and ends; Parquet files and progress commit together."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def upsert_counts(stream: DataFrame, keys: list[str], path: str, checkpoint: str) -> None:
    """Running counts per key, each batch's result as a folder of its own."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    counts = stream.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    counts.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(put).trigger(availableNow=True).start().awaitTermination()


def posts_of(frames: DataFrame, run_id: str) -> DataFrame:
    """Posts of a frame stream or table, with the record as JSON text."""
    posts = raw_posts(extract_creates(decode(frames)), run_id, F.lit(None).cast("string"))
    return posts.drop("captured_at").withColumn("record", F.to_json("record"))


class FirstSeen(StatefulProcessor):
    """Of each key's rows the first by `order`, once for as long as the key is remembered: the state holds when it came and goes by its time-to-live."""

    def __init__(self, order: list[str], ttl_ms: int | None) -> None:
        self.order, self.ttl = order, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "at long", self.ttl)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if self.seen.exists():
            return
        first = min(rows, key=lambda r: tuple((r[c] is None, r[c]) if r[c] is not None else (True, 0) for c in self.order))
        self.seen.update((int(time.time() * 1000),))
        yield first


def first_per_key(stream: DataFrame, key: str, order: list[str], ttl_ms: int | None = None) -> DataFrame:
    """Each key's first row over the whole stream: within a trigger by `order` (nulls last), over triggers by arrival. With `ttl_ms`, a key that comes again later than that counts again.

    The stream is to be written in update mode. Without a time-to-live this is an aggregate: the least row of a key by its trigger's time and `order`, given out in the trigger whose time it
    has. Its state is that row. With one, state is a time per key that a Python worker asks for, key by key. Both are kept in RocksDB and in the checkpoint.
    """
    if ttl_ms is not None:
        return stream.groupBy(key).transformWithState(FirstSeen(order, ttl_ms), stream.schema, "Update", "ProcessingTime")
    now = F.current_timestamp()  # one for all rows of a trigger, also when it is run again
    place = F.struct("_now", *[x for i, c in enumerate(order) for x in (F.col(c).isNull().alias(f"no{i}"), F.col(c).alias(f"of{i}"))])
    first = stream.withColumn("_now", now).groupBy(F.col(key).alias("_key")).agg(F.min("_now").alias("_at"), F.min_by(F.struct(*stream.columns), place).alias("_row"))
    return first.where(F.col("_at") == now).select("_row.*")


def collect_until(stream: DataFrame, path: str, checkpoint: str, target: int | None = None, order: list[str] | None = None) -> int:
    """Runs a stream over all that has arrived and returns the rows that `path` holds; with a target it stops once there are exactly so many.

    Each trigger's rows go to a folder of its number and replace what an earlier try left there, so a repeated trigger changes nothing, and a later call with the same checkpoint goes on
    where this one ended. Of the trigger that passes the target, the first rows by `order` stay and its others are given up. How many rows a trigger left is kept beside them.
    """
    spark, full = stream.sparkSession, []

    def held(before: int | None = None) -> int:
        if not exists(spark, f"{path}/_counts"):
            return 0
        counts = spark.read.schema("n long, number long").json(f"{path}/_counts/*")
        counts = counts if before is None else counts.where(F.col("number") < before)
        return counts.agg(F.sum("n")).first()[0] or 0

    def put(batch: DataFrame, number: int) -> None:
        left = None if target is None else target - held(number)
        if left is not None and left <= 0:
            full.append(number)
            raise RuntimeError("the target is reached")  # so the trigger isn't committed, and a later call takes it up
        rows = batch if left is None else batch.orderBy(*[F.col(c).asc_nulls_last() for c in order or batch.columns]).limit(left)
        rows.write.mode("overwrite").parquet(f"{path}/rows/number={number}")
        n = spark.read.parquet(f"{path}/rows/number={number}").count()
        spark.range(1).select(F.lit(n).alias("n"), F.lit(number).alias("number")).coalesce(1).write.mode("overwrite").json(f"{path}/_counts/{number}")
        if left is not None and n >= left:
            full.append(number)

    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    try:
        running = stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(put).trigger(availableNow=True).start()
        while not running.awaitTermination(1):
            last = [p["numInputRows"] for p in running.recentProgress[-3:]]
            if full or last == [0, 0, 0]:  # with a time-to-live Spark goes on with empty triggers
                running.stop()
    except StreamingQueryException:
        if not full:
            raise
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    return held()


def collected(spark: SparkSession, path: str) -> DataFrame:
    """The rows that collect_until has left."""
    return spark.read.option("basePath", f"{path}/rows").parquet(f"{path}/rows").drop("number")
