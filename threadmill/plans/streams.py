"""Queries that replay the driver's tables as streams, each with SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from threadmill.plans.registry import _FRAME, query, table
from threadmill.sources.tables import new_folder
from threadmill.streaming import capture, counters

#: Triggers that a replay is dealt out over.
TRIGGERS = 4


def _frames(spark: SparkSession, sf: str) -> str:
    """A folder of frames, a post per event: a user's events of a type are one post, so that posts repeat within triggers and over them."""
    path = new_folder(spark, "frames")
    op = F.struct(F.lit("create").alias("action"), F.concat(F.lit("app.bsky.feed.post/"), "event_type").alias("path"), F.concat(F.lit("c"), "event_id").alias("cid"), F.struct(F.col("ts").cast("string").alias("createdAt"), F.col("props").alias("text")).alias("record"))
    frame = F.struct(F.lit("#commit").alias("t"), F.col("event_id").alias("seq"), F.col("ts").cast("string").alias("time"), F.concat(F.lit("did:"), "user_id").alias("repo"), F.array(op).alias("ops"))
    table(spark, sf, "events").select(F.to_json(frame).alias("value")).repartition(TRIGGERS).write.text(path)
    return path


@query("SELECT DISTINCT 'at://did:' || user_id || '/app.bsky.feed.post/' || event_type AS uri, 'did:' || user_id AS repo_did, event_type AS rkey, 'create' AS operation, false AS has_reply FROM events")
def stream_capture(spark: SparkSession, sf: str) -> DataFrame:
    """All events as frames through the capture stream in several triggers: one post per uri. Which of a uri's posts arrives first depends on the files, so the columns are those that they share."""
    folder = new_folder(spark, "capture")
    posts = capture.posts_of(capture.frame_stream(spark, _frames(spark, sf), 1), "cap_1")
    capture.collect_until(capture.first_per_key(posts, "uri", ["seq"]), f"{folder}/out", f"{folder}/checkpoint")
    return capture.collected(spark, f"{folder}/out").select("uri", "repo_did", "rkey", "operation", "has_reply")


@query("""WITH f AS (SELECT event_id, user_id, event_id % 14 AS c, event_id % 17 = 0 AS broken FROM events UNION ALL SELECT event_id, user_id, event_id % 14, event_id % 17 = 0 FROM events WHERE event_id % 3 = 0),
p AS (SELECT *, NOT broken AND c NOT IN (2, 5, 6, 7, 10, 11, 12) AS made FROM f),
n AS (SELECT count(*) AS frames, count(*) FILTER (broken) AS decode_errors, count(*) FILTER (NOT broken) AS commits, count(*) FILTER (NOT broken AND c IN (6, 7)) AS extract_errors, count(*) FILTER (made) AS creates,
  count(DISTINCT (event_id, user_id)) FILTER (made) AS unique_posts, count(*) FILTER (made) - count(DISTINCT (event_id, user_id)) FILTER (made) AS duplicates, count(*) FILTER (broken AND NOT broken) AS blank_lines FROM p)
UNPIVOT n ON COLUMNS(*) INTO NAME counter VALUE n""")
def capture_counters(spark: SparkSession, sf: str) -> DataFrame:
    """What the capture stream counts over several triggers of frames in fourteen shapes, a third of them twice and some broken."""
    folder, frames = new_folder(spark, "counted"), new_folder(spark, "frames")
    line = F.when(F.col("event_id") % 17 == 0, "not json").otherwise(F.expr(_FRAME))
    table(spark, sf, "events").select(F.explode(F.array_repeat(line, F.when(F.col("event_id") % 3 == 0, 2).otherwise(1))).alias("value")).repartition(TRIGGERS).write.text(frames)
    with counters.counting(spark, f"{folder}/counters"):
        capture.collect_until(counters.counted_posts(capture.frame_stream(spark, frames, 1), "cap_1"), f"{folder}/out", f"{folder}/checkpoint")
    return counters.counters(spark, f"{folder}/counters")
