"""Row contracts of the dataset families: staging projections of landed payloads, and rows made from service views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

LINEAGE = ["source_filename", "source_file_row_number", "source_run_tag", "dataset_family", "load_invocation_id", "loaded_at"]

# Columns of the staged families, with the type that a payload's field is read as.
STAGED = {
    "raw_posts": "capture_run_id string, seq bigint, repo_did string, event_time string, operation string, collection string, rkey string, uri string, cid string, record_created_at string, has_reply boolean, has_embed boolean, captured_at string, record variant",
    "hydrated_posts": "hydrate_run_id string, capture_run_id string, uri string, cid string, indexed_at string, author_did string, author_handle string, author_display_name string, reply_count bigint, repost_count bigint, like_count bigint, quote_count bigint, labels variant, hydrated_at string, record variant",
    "hydration_misses": "hydrate_run_id string, capture_run_id string, uri string, cid_at_capture string, captured_at string, status string, reason string, checked_at string, attempt_count bigint",
    "actor_profiles": "actor_run_id string, did string, handle string, display_name string, description string, followers_count bigint, follows_count bigint, posts_count bigint, indexed_at string, created_at string, labels variant, associated variant, enriched_at string, profile variant",
}


def columns_of(family: str) -> list[tuple[str, str]]:
    return [tuple(c.split()) for c in STAGED[family].split(", ")]


def stage(landed: DataFrame, family: str, payload: str = "raw_payload") -> DataFrame:
    """The flat staging rows of a family: a column per field of the payload, nested ones as variants, and the lineage columns that are there."""
    fields = [F.try_variant_get(payload, f"$.{name}", kind).alias(name) for name, kind in columns_of(family)]
    return landed.select(*fields, *[c for c in LINEAGE if c in landed.columns])


def _kind(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v), F.lit("VOID"))


def _mapping(v: Column) -> Column:
    """The variant where it is an object, else null."""
    return F.when(_kind(v).startswith("OBJECT"), v)


def _list(v: Column) -> Column:
    """The variant where it is a list, else an empty one."""
    return F.when(_kind(v).startswith("ARRAY"), v).otherwise(F.parse_json(F.lit("[]")))


def text_at(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def whole_at(v: Column, path: str) -> Column:
    """The field as a whole number, null where it isn't one."""
    return F.try_variant_get(v, path, "bigint")


def any_at(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def hydrated_rows(views: DataFrame, hydrate_run: str, capture_run: str, hydrated_at: Column, view: str = "view") -> DataFrame:
    """Rows of hydrated_posts from post views. An author that is no object gives nulls, labels that are no list an empty list."""
    v = F.col(view)
    author = _mapping(any_at(v, "$.author"))
    return views.select(
        F.lit(hydrate_run).alias("hydrate_run_id"), F.lit(capture_run).alias("capture_run_id"), text_at(v, "$.uri").alias("uri"), text_at(v, "$.cid").alias("cid"), text_at(v, "$.indexedAt").alias("indexed_at"),
        text_at(author, "$.did").alias("author_did"), text_at(author, "$.handle").alias("author_handle"), text_at(author, "$.displayName").alias("author_display_name"),
        *[whole_at(v, f"$.{n}Count").alias(f"{n}_count") for n in ("reply", "repost", "like", "quote")],
        _list(any_at(v, "$.labels")).alias("labels"), hydrated_at.alias("hydrated_at"), _mapping(any_at(v, "$.record")).alias("record"),
    )


def miss_rows(targets: DataFrame, hydrate_run: str, capture_run: str, reason: str, checked_at: Column) -> DataFrame:
    """Rows of hydration_misses from unresolved targets(uri, cid, captured_at, attempts)."""
    return targets.select(
        F.lit(hydrate_run).alias("hydrate_run_id"), F.lit(capture_run).alias("capture_run_id"), "uri", F.col("cid").alias("cid_at_capture"), "captured_at",
        F.lit("missing").alias("status"), F.lit(reason).alias("reason"), checked_at.alias("checked_at"), F.col("attempts").alias("attempt_count"),
    )


def actor_rows(views: DataFrame, actor_run: str, enriched_at: Column, view: str = "view") -> DataFrame:
    """Rows of actor_profiles from profile views, which are kept whole as well."""
    v = F.col(view)
    return views.select(
        F.lit(actor_run).alias("actor_run_id"), text_at(v, "$.did").alias("did"), text_at(v, "$.handle").alias("handle"), text_at(v, "$.displayName").alias("display_name"), text_at(v, "$.description").alias("description"),
        *[whole_at(v, f"$.{n}Count").alias(f"{n}_count") for n in ("followers", "follows", "posts")],
        text_at(v, "$.indexedAt").alias("indexed_at"), text_at(v, "$.createdAt").alias("created_at"), _list(any_at(v, "$.labels")).alias("labels"),
        _mapping(any_at(v, "$.associated")).alias("associated"), enriched_at.alias("enriched_at"), v.alias("profile"),
    )


def text_of_row(row: Column) -> Column:
    """record.text if that is a string, else text if that is one, else empty."""
    string = lambda path: F.when(_kind(any_at(row, path)) == "STRING", text_at(row, path))
    return F.coalesce(string("$.record.text"), string("$.text"), F.lit(""))


def first_filled(*choices: Column) -> Column:
    """The first that is neither null nor empty, else empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in choices], F.lit(""))


def sorted_json(v: Column) -> Column:
    """JSON text of a variant; Spark keeps a variant's keys in order."""
    return F.to_json(v)


def distribution_value(v: Column) -> Column:
    """A value as profiles count it: null by name, plain values as text, nested ones as JSON."""
    return F.when(v.isNull() | F.is_variant_null(v), "null").when(_kind(v).rlike("^(OBJECT|ARRAY)"), F.to_json(v)).otherwise(F.try_variant_get(v, "$", "string"))
