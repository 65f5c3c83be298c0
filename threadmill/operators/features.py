"""Features and engagement labels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from threadmill.functions import text as T
from threadmill.operators.relational import freshest_by_key, left_with_hit, null_safe_total, one_per_key, quantiles


def candidate_counts(matches: DataFrame) -> DataFrame:
    """Per uri: distinct candidates, matched ones and their share."""
    each = matches.groupBy("uri", "candidate_id").agg(F.max(F.col("is_matched").cast("int")).alias("hit"))
    n, hits = F.count(F.lit(1)), F.sum("hit")
    return each.groupBy("uri").agg(n.alias("candidate_count"), hits.alias("matched_candidate_count"), F.when(n > 0, hits / n).otherwise(0.0).alias("matched_candidate_rate"))


def engagement_label(df: DataFrame, total: str, low: float = 0.33, high: float = 0.66) -> DataFrame:
    """df with engagement_label and label_rule: quantile bins, or fixed ones where the quantiles meet or leave a class empty.

    The quantiles are exact; they and the class sizes are one row, so they are broadcast.
    """
    q = quantiles(df, total, [low, high]).select(F.col("q")[0].alias("q_low"), F.col("q")[1].alias("q_high"))
    sizes = df.crossJoin(F.broadcast(q)).groupBy("q_low", "q_high").agg(
        F.count_if(F.col(total) <= F.col("q_low")).alias("n_low"),
        F.count_if((F.col(total) > F.col("q_low")) & (F.col(total) <= F.col("q_high"))).alias("n_mid"),
        F.count_if(F.col(total) > F.col("q_high")).alias("n_high"),
    )
    fallback = (F.col("q_low") == F.col("q_high")) | (F.least("n_low", "n_mid", "n_high") == 0)
    bins = F.when(F.col(total) <= F.col("q_low"), "LOW").when(F.col(total) <= F.col("q_high"), "MEDIUM").otherwise("HIGH")
    fixed = F.when(F.col(total) <= 0, "LOW").when(F.col(total) == 1, "MEDIUM").otherwise("HIGH")
    return (
        df.crossJoin(F.broadcast(sizes))
        .withColumns({"label_rule": F.when(fallback, "fallback_bins").otherwise("quantile_bins"), "engagement_label": F.when(fallback, fixed).otherwise(bins)})
        .drop("q_low", "q_high", "n_low", "n_mid", "n_high")
    )


def fill_types(df: DataFrame, booleans: list[str], numbers: list[str], texts: dict[str, str]) -> DataFrame:
    """Null-free feature columns: false, 0.0 and given words."""
    filled: dict[str, Column] = {c: F.coalesce(F.col(c).cast("boolean"), F.lit(False)) for c in booleans}
    filled |= {c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) for c in numbers}
    filled |= {c: F.coalesce(F.col(c).cast("string"), F.lit(v)) for c, v in texts.items()}
    return df.withColumns(filled)


def ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def column_groups(df: DataFrame, limit: int = 12, drop: tuple[str, ...] = ()) -> DataFrame:
    """A row per column: numeric, categorical (at most `limit` values), constant or debug. One pass counts the distinct values of all."""
    columns = [c for c in df.columns if c not in drop]
    kinds = dict(df.dtypes)
    counted = df.agg(*[F.countDistinct(F.coalesce(F.col(c).cast("string"), F.lit("<null>"))).alias(c) for c in columns])
    rows = counted.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(kinds[c]).alias("kind"), F.col(c).alias("distinct_values")) for c in columns])).alias("r")).select("r.*")
    text = F.col("kind") == "string"
    group = F.when(F.col("distinct_values") <= 1, "constant").when(~text, "numeric").when(F.col("distinct_values") <= limit, "categorical").otherwise("debug")
    return rows.withColumn("column_group", group)


# The feature contract's columns by kind, and what a missing stage, method or mode is called.
BOOLEANS = """has_hashtag has_url has_mention has_special_chars has_non_ascii has_candidate has_trend_match is_ambiguous_match trend_date_available same_day_trend_match post_is_weekend
actor_profile_found actor_has_display_name actor_has_description actor_has_avatar actor_has_banner""".split()
NUMBERS = """post_token_count post_char_count post_unique_token_count post_unique_token_ratio raw_exclamation_count raw_question_count raw_uppercase_ratio candidate_count matched_candidate_count
matched_candidate_rate match_score trend_counts trend_num_hours trend_post_day_diff post_hour_utc post_day_of_week post_month actor_followers_count actor_follows_count actor_posts_count
actor_followers_to_follows_ratio actor_description_char_count eng_like_count eng_reply_count eng_repost_count eng_quote_count engagement_total""".split()
NAMED = {"match_stage": "no_candidate", "match_method": "none", "temporal_pool_mode": "none", "trend_name_clean": "", "trend_date": ""}
LABELS = ["engagement_label", "engagement_total", "eng_like_count", "eng_reply_count", "eng_repost_count", "eng_quote_count"]
DEBUG = """uri post_created_at source_run_tag text_source hydrated_author_did hydrated_author_handle trend_name_clean trend_date match_method temporal_pool_mode eng_author_did eng_author_handle
actor_did actor_handle post_text_raw post_text_clean post_text_alnum""".split()
STAGE_ORDER = ["exact", "fuzzy", "semantic", "unmatched", "no_candidate"]


def best_for_join(best: DataFrame) -> DataFrame:
    """One match row per uri: by stage, score and counts (null as 0), then name."""
    order = F.array_position(F.array(*map(F.lit, STAGE_ORDER[:4])), F.col("match_stage"))
    number = lambda c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0))
    stage = F.when(F.coalesce(order, F.lit(0)) == 0, 99).otherwise(order)
    return one_per_key(best, ["uri"], [stage, number("match_score").desc(), number("trend_counts").desc(), F.col("trend_name_clean").asc_nulls_last()])


def feature_table(prepared: DataFrame, best: DataFrame, matches: DataFrame, hydrated: DataFrame, actors: DataFrame) -> DataFrame:
    """Prepared posts left-joined to their best match, candidate counts, engagement and actor, a row per post, with a mark per join of whether it found a partner.

    Every right side has one row per key before it is joined, so rows of `prepared` neither go nor multiply.
    """
    joined = left_with_hit(prepared, best_for_join(best), ["uri"], "hit_best_match")
    joined = left_with_hit(joined, candidate_counts(matches), ["uri"], "hit_candidate_counts")
    joined = left_with_hit(joined, freshest_by_key(hydrated, ["uri"], ["hydrated_at", "indexed_at"]).drop("hydrated_at", "indexed_at"), ["uri"], "hit_hydrated")
    people = freshest_by_key(actors, ["did"], ["actor_indexed_at", "actor_created_at"]).drop("actor_indexed_at", "actor_created_at").withColumn("actor_did", F.col("did")).withColumnRenamed("did", "hydrated_author_did")
    return left_with_hit(joined, people, ["hydrated_author_did"], "hit_actor", "uri")


def feature_flags(df: DataFrame) -> DataFrame:
    """The feature table with the derived columns of the contract; days are those of UTC."""
    number = lambda c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0))
    yes = lambda c: F.coalesce(F.col(c).cast("boolean"), F.lit(False))
    filled = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) != ""
    posted, trend = F.col("post_created_at").try_cast("timestamp"), F.col("trend_date").try_cast("timestamp")
    gap = F.datediff(trend, posted)
    likes = {f"eng_{c}": number(c) for c in ("like_count", "reply_count", "repost_count", "quote_count")}
    people = {f"actor_{c}": number(c) for c in ("followers_count", "follows_count", "posts_count")}
    out = df.withColumns(
        {
            **{c: number(c) for c in ("candidate_count", "matched_candidate_count", "matched_candidate_rate", "match_score", "trend_counts", "trend_num_hours")},
            "has_candidate": number("candidate_count") > 0,
            "has_trend_match": yes("is_matched"),
            "is_ambiguous_match": yes("is_ambiguous"),
            "trend_date_available": trend.isNotNull(),
            "trend_post_day_diff": gap,
            "same_day_trend_match": yes("is_matched") & F.coalesce(gap == 0, F.lit(False)),
            **likes,
            **people,
            "actor_profile_found": filled("actor_did"),
            "actor_followers_to_follows_ratio": ratio(number("followers_count"), number("follows_count")),
            "actor_has_display_name": filled("display_name"),
            "actor_has_description": filled("description"),
            "actor_description_char_count": F.length(F.coalesce(F.col("description"), F.lit(""))),
            "actor_has_avatar": yes("has_avatar"),
            "actor_has_banner": yes("has_banner"),
        }
    )
    out = out.select("*", *T.time_parts(posted), *T.post_shape(F.col("post_text_raw"), F.col("post_text_alnum"), F.col("post_token_count")))
    return out.withColumn("engagement_total", null_safe_total(list(likes)))


def final_types(df: DataFrame) -> DataFrame:
    """The contract's columns without nulls."""
    there = lambda names: [c for c in names if c in df.columns]
    return fill_types(df, there(BOOLEANS), there(NUMBERS), {c: v for c, v in NAMED.items() if c in df.columns})


def contract_groups(columns: list[str]) -> dict[str, list[str]]:
    """Columns for labels, for looking things up, and for models."""
    held = {"label_columns": [c for c in LABELS if c in columns], "debug_columns": [c for c in DEBUG if c in columns]}
    apart = {c for own in held.values() for c in own}
    return held | {"model_feature_columns": [c for c in columns if c not in apart and not c.startswith(("raw_source_row_json", "hydrated_source_row_json"))]}


def contract_columns(df: DataFrame, groups: Callable[[list[str]], dict[str, list[str]]]) -> DataFrame:
    """A feature table's own columns with their kind in the contract, the groups of `groups` that they are in (a row each, null for none) and how many rows hold no value: one aggregate."""
    own = groups(df.columns)
    held = {c: kind for kind, names in contract_groups(df.columns).items() for c in names}
    nulls = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in held])
    rows = F.array(*[F.struct(F.lit(c).alias("name"), F.lit(kind).alias("kind"), F.lit(g).cast("string").alias("ablation"), F.col(f"`{c}`").alias("nulls")) for c, kind in held.items() for g in ([x for x, names in own.items() if c in names] or [None])])
    return nulls.select(F.explode(rows).alias("r")).select("r.*")


def feature_summary(df: DataFrame) -> DataFrame:
    """Measures of a feature table as rows (measure, key, value): rows, labels, stages, and per model column its nulls, and range or distinct values."""
    model = contract_groups(df.columns)["model_feature_columns"]
    kinds = dict(df.dtypes)
    numeric = [c for c in model if kinds[c] in ("int", "bigint", "double", "float", "smallint", "tinyint", "boolean")]
    value = {c: F.col(c).cast("double") for c in numeric}
    parts = {("row_count", ""): F.count(F.lit(1)), ("unique_uri_count", ""): F.countDistinct("uri")}
    parts |= {("missing", c): F.count_if(F.col(c).isNull()) for c in model}
    parts |= {(m, c): F.coalesce(f(value[c]), F.lit(0.0)) for c in numeric for m, f in (("min", F.min), ("mean", F.avg), ("max", F.max))}
    parts |= {("cardinality", c): F.countDistinct(c) for c in model if kinds[c] == "string"}
    one = df.agg(*[f.cast("double").alias(f"m{i}") for i, f in enumerate(parts.values())])
    rows = F.array(*[F.struct(F.lit(m).alias("measure"), F.lit(k).alias("key"), F.col(f"m{i}").alias("value")) for i, (m, k) in enumerate(parts)])
    out = one.select(F.explode(rows).alias("s")).select("s.*")
    for measure, column in (("label", "engagement_label"), ("stage", "match_stage")):
        if column in df.columns:
            counts = df.groupBy(F.col(column).cast("string").alias("key")).agg(F.count(F.lit(1)).cast("double").alias("value"))
            out = out.unionByName(counts.select(F.lit(measure).alias("measure"), "key", "value"))
    return out
