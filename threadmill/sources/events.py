"""Event frames: decoding, extraction of created posts and the dataset families' rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

COLLECTION = "app.bsky.feed.post"
# Event types by their aliases.
TYPES = {
    "#commit": "commit", "commit": "commit", "com.atproto.sync.subscriberepos#commit": "commit", "#info": "info", "info": "info", "com.atproto.sync.subscriberepos#info": "info",
    "#identity": "identity", "identity": "identity", "com.atproto.sync.subscriberepos#identity": "identity", "#account": "account", "account": "account", "com.atproto.sync.subscriberepos#account": "account",
    "#sync": "sync", "sync": "sync", "com.atproto.sync.subscriberepos#sync": "sync",
}


def _text(of: str, *names: str) -> Column:
    """The first of the struct's fields that isn't empty."""
    return F.coalesce(*[F.nullif(F.col(f"{of}.{n}"), F.lit("")) for n in names])


def _once(column: Column, where: Column | None = None) -> Column:
    """The column from a generator of one row (none where `where` fails): filters on it stay above, so it isn't worked out again for each condition that names it.

    It is to name whole columns: where it named fields of structs, Spark 4.1 pruned other columns that were still needed and failed.
    """
    return F.explode(F.array(column) if where is None else F.when(where, F.array(column)))


# What is read of a frame and of its commit, each in one walk; what isn't an object has none of it and is null.
HEAD = "struct<t: string, type: string, event_type: string, seq: bigint, time: string>"
OP = "struct<action: string, op: string, path: string, cid: string, record: variant, value: variant>"
COMMIT = f"struct<repo: string, repo_did: string, ops: array<{OP}>, blocks: map<string, variant>, records_by_cid: map<string, variant>>"


def decode(frames: DataFrame, column: str = "value") -> DataFrame:
    """frames with event_type, seq, event_time, payload and decode_error; blank lines go, and what isn't a JSON object is an error row."""
    line = F.col(column)
    kind = F.lower(F.trim(_text("_head", "t", "type", "event_type")))
    known = F.create_map(*[F.lit(x) for kv in TYPES.items() for x in kv])
    return (
        frames.withColumn("payload", _once(F.try_parse_json(line), F.trim(line) != ""))
        .withColumn("_head", _once(F.try_variant_get("payload", "$", HEAD)))
        .withColumn("decode_error", F.col("_head").isNull())
        .withColumns({"event_type": F.coalesce(F.try_element_at(known, kind), kind, F.lit("unknown")), "seq": F.col("_head.seq"), "event_time": F.col("_head.time")})
        .drop("_head")
    )


def _object(v: Column) -> Column:
    """The variant where it is an object, else null: only an object can be read as a struct, and one without fields reads none of it."""
    return F.when(F.try_variant_get(v, "$", "struct<>").isNotNull(), v)


def extract(events: DataFrame, collection: str = COLLECTION) -> DataFrame:
    """A row per created post of commit events (uri, repo_did, collection, rkey, cid, record), and one with `extract_error` for a commit without a repo or whose ops are no list.

    An operation's record is its `record` if that is an object, else its `value` if that is one, else what `blocks` or `records_by_cid` hold for its cid; without any object
    it is no post. Operations that are no objects go. A commit, its operations and its maps are read once, however many operations it has.
    """
    commits = events.where(~F.col("decode_error") & (F.col("event_type") == "commit")).withColumn("_commit", _once(F.try_variant_get("payload", "$", COMMIT)))
    read = commits.select("seq", "event_time", _text("_commit", "repo", "repo_did").alias("repo_did"), "_commit.ops", "_commit.blocks", "_commit.records_by_cid")
    judged = read.withColumn("extract_error", F.when(F.col("repo_did").isNull(), "commit without repo").when(F.col("ops").isNull(), "commit without a list of ops"))
    each = judged.withColumn("op", F.explode(F.when(F.col("extract_error").isNull(), F.col("ops")).otherwise(F.array(F.lit(None).cast(OP)))))
    path = F.btrim(_text("op", "path"), F.lit("/"))
    rkey = F.substring_index(path, "/", -1)
    named = each.select(
        "seq", "event_time", "repo_did", "extract_error", _text("op", "action", "op").alias("action"), F.substring(path, F.lit(1), F.length(path) - F.length(rkey) - 1).alias("collection"),
        rkey.alias("rkey"), "op.cid", "op.record", "op.value", "blocks", "records_by_cid",
    )
    kept = named.where(F.col("extract_error").isNotNull() | ((F.col("action") == "create") & (F.col("collection") == collection)))
    by_cid = lambda name: _object(F.try_element_at(F.col(name), F.col("cid")))
    record = F.coalesce(_object(F.col("record")), _object(F.col("value")), by_cid("blocks"), by_cid("records_by_cid"))
    return (
        kept.withColumn("record", _once(record))
        .where(F.col("extract_error").isNotNull() | F.col("record").isNotNull())
        .withColumn("uri", F.concat(F.lit("at://"), "repo_did", F.lit("/"), "collection", F.lit("/"), "rkey"))
        .drop("value", "blocks", "records_by_cid")
    )


def extract_creates(events: DataFrame, collection: str = COLLECTION) -> DataFrame:
    """The posts of `extract`, without its error rows."""
    return extract(events, collection).where("extract_error is null").drop("extract_error")


def raw_posts(created: DataFrame, run_id: str, captured_at: Column) -> DataFrame:
    """The raw_posts contract (14 columns)."""
    field = lambda name: F.try_variant_get("record", f"$.{name}", "variant")
    has = lambda name: field(name).isNotNull() & ~F.is_variant_null(field(name))  # noqa: E731  is_variant_null is false where there is no such field
    return created.select(
        F.lit(run_id).alias("capture_run_id"), "seq", "repo_did", "event_time", F.lit("create").alias("operation"), "collection", "rkey", "uri", "cid",
        F.try_variant_get("record", "$.createdAt", "string").alias("record_created_at"), has("reply").alias("has_reply"), has("embed").alias("has_embed"), captured_at.alias("captured_at"), "record",
    )


def family_of_path(path: Column) -> Column:
    """Dataset family from a file's path; null where none or more than one is named."""
    # Names of the families.
    names = ("raw_posts", "hydrated_posts", "hydration_misses", "actor_profiles")
    found = F.filter(F.array(*map(F.lit, names)), lambda n: F.array_contains(F.split(path, "[/\\\\]"), n))
    return F.when(F.size(found) == 1, found[0])


# Keys that tell a family by its rows.
ROW_KEYS = {"raw_posts": ("repo_did", "has_reply", "has_embed"), "hydrated_posts": ("author_did", "like_count", "quote_count"), "actor_profiles": ("actor_run_id", "followers_count", "follows_count"), "hydration_misses": ("cid_at_capture", "reason", "attempt_count")}


def family_of_row(line: Column) -> Column:
    """Dataset family from the keys of a JSON row; null where no family's keys are all there, an error where two families' are."""
    keys = F.coalesce(F.json_object_keys(line), F.array().cast("array<string>"))
    each = F.array(*[F.when(F.size(F.array_except(F.array(*map(F.lit, own)), keys)) == 0, name) for name, own in ROW_KEYS.items()])
    found = F.filter(each, lambda n: n.isNotNull())
    return F.when(F.size(found) > 1, F.raise_error(F.lit("a row that fits two families")).cast("string")).when(F.size(found) == 1, found[0])
