"""Queries of the row contracts, prepared posts, the feature table, summaries and lifecycles on the driver's tables, each with SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from threadmill.functions import text as T
from threadmill.operators import features, lifecycle, matching, models, posts, relational, summaries
from threadmill.plans.registry import _drawn_candidates, _keyed_trends, query, table
from threadmill.sources import contracts

# Row contracts: payloads are made from the events' rows


def _payloads(spark: SparkSession, sf: str, fields: dict[str, str]) -> DataFrame:
    """Events with a variant `raw_payload` of the given fields (expressions), and their lineage."""
    body = ", ".join(f"'{name}', {value}" for name, value in fields.items())
    rows = table(spark, sf, "events").withColumn("raw_payload", F.expr(f"parse_json(to_json(named_struct({body}), map('ignoreNullFields', 'false')))"))
    return rows.select("event_id", "raw_payload", F.concat(F.lit("run/"), "event_type", F.lit(".jsonl.gz")).alias("source_filename"), F.col("event_id").alias("source_file_row_number"), F.lit("run").alias("source_run_tag"))


@query("""SELECT 'cap_1' AS capture_run_id, event_id AS seq, 'did:' || user_id AS repo_did, 'at://' || event_id AS uri, event_id % 2 = 0 AS has_reply, ([true, NULL, false, NULL, true, false, NULL])[event_id % 7 + 1] AS has_embed,
CAST(json_extract(props, '$.k') AS BIGINT) AS k, 'run/' || event_type || '.jsonl.gz' AS source_filename, event_id AS source_file_row_number FROM events""")
def stg_raw(spark: SparkSession, sf: str) -> DataFrame:
    landed = _payloads(spark, sf, {"capture_run_id": "'cap_1'", "seq": "event_id", "repo_did": "concat('did:', user_id)", "uri": "concat('at://', event_id)", "has_reply": "event_id % 2 = 0", "has_embed": "element_at(array(parse_json('\"yes\"'), parse_json('\"x\"'), parse_json('\"No\"'), parse_json('null'), parse_json('1'), parse_json('false'), parse_json('[true]')), cast(event_id % 7 + 1 as int))", "record": "parse_json(props)"})
    staged = contracts.stage(landed, "raw_posts")
    return staged.select("capture_run_id", "seq", "repo_did", "uri", "has_reply", "has_embed", F.try_variant_get("record", "$.k", "bigint").alias("k"), "source_filename", "source_file_row_number")


@query("SELECT 'at://' || event_id AS uri, user_id AS like_count, CAST(NULL AS BIGINT) AS reply_count, 'did:' || user_id AS author_did, 2 AS labels FROM events")
def stg_hydrated(spark: SparkSession, sf: str) -> DataFrame:
    landed = _payloads(spark, sf, {"uri": "concat('at://', event_id)", "like_count": "user_id", "reply_count": "'many'", "author_did": "concat('did:', user_id)", "labels": "array(1, 2)"})
    staged = contracts.stage(landed, "hydrated_posts")
    return staged.select("uri", "like_count", "reply_count", "author_did", F.size(F.try_variant_get("labels", "$", "array<int>")).alias("labels"))


@query("SELECT 'at://' || event_id AS uri, 'missing' AS status, event_id % 4 AS attempt_count, event_type AS reason FROM events")
def stg_misses(spark: SparkSession, sf: str) -> DataFrame:
    landed = _payloads(spark, sf, {"uri": "concat('at://', event_id)", "status": "'missing'", "attempt_count": "event_id % 4", "reason": "event_type"})
    return contracts.stage(landed, "hydration_misses").select("uri", "status", "attempt_count", "reason")


@query("SELECT 'did:' || user_id AS did, event_type AS handle, event_id AS followers_count, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def stg_actors(spark: SparkSession, sf: str) -> DataFrame:
    landed = _payloads(spark, sf, {"did": "concat('did:', user_id)", "handle": "event_type", "followers_count": "event_id", "profile": "parse_json(props)"})
    return contracts.stage(landed, "actor_profiles").select("did", "handle", "followers_count", F.try_variant_get("profile", "$.k", "bigint").alias("k"))


@query("""SELECT 'hyd_1' AS hydrate_run_id, 'at://' || event_id AS uri, CASE WHEN event_id % 3 <> 0 THEN 'did:' || user_id END AS author_did, event_id AS like_count, CAST(NULL AS BIGINT) AS quote_count,
CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END AS labels, event_id % 5 <> 0 AS has_record FROM events""")
def norm_hydrated(spark: SparkSession, sf: str) -> DataFrame:
    views = _payloads(spark, sf, {"uri": "concat('at://', event_id)", "author": "if(event_id % 3 <> 0, parse_json(to_json(named_struct('did', concat('did:', user_id)))), parse_json('\"x\"'))", "likeCount": "cast(event_id as string)", "quoteCount": "'x'", "labels": "if(event_id % 2 = 0, parse_json('[7]'), parse_json('{}'))", "record": "if(event_id % 5 <> 0, parse_json(props), parse_json('1'))"})
    rows = contracts.hydrated_rows(views, "hyd_1", "cap_1", F.lit("2024-01-01"), "raw_payload")
    return rows.select("hydrate_run_id", "uri", "author_did", "like_count", "quote_count", F.size(F.try_variant_get("labels", "$", "array<variant>")).alias("labels"), F.col("record").isNotNull().alias("has_record"))


@query("SELECT 'hyd_1' AS hydrate_run_id, 'at://' || event_id AS uri, event_type AS cid_at_capture, 'missing' AS status, 'not_returned' AS reason, event_id % 3 AS attempt_count FROM events")
def norm_miss(spark: SparkSession, sf: str) -> DataFrame:
    targets = table(spark, sf, "events").select(F.concat(F.lit("at://"), "event_id").alias("uri"), F.col("event_type").alias("cid"), F.col("ts").cast("string").alias("captured_at"), (F.col("event_id") % 3).alias("attempts"))
    return contracts.miss_rows(targets, "hyd_1", "cap_1", "not_returned", F.lit("2024-01-01")).select("hydrate_run_id", "uri", "cid_at_capture", "status", "reason", "attempt_count")


@query("SELECT 'act_1' AS actor_run_id, 'did:' || user_id AS did, event_type AS display_name, event_id AS followers_count, CAST(NULL AS BIGINT) AS posts_count, 0 AS labels, event_id % 2 = 0 AS has_associated FROM events")
def norm_actor(spark: SparkSession, sf: str) -> DataFrame:
    views = _payloads(spark, sf, {"did": "concat('did:', user_id)", "displayName": "event_type", "followersCount": "event_id", "labels": "'none'", "associated": "if(event_id % 2 = 0, parse_json('{}'), parse_json('[]'))"})
    rows = contracts.actor_rows(views, "act_1", F.lit("2024-01-01"), "raw_payload")
    return rows.select("actor_run_id", "did", "display_name", "followers_count", "posts_count", F.size(F.try_variant_get("labels", "$", "array<variant>")).alias("labels"), F.col("associated").isNotNull().alias("has_associated"))


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'record ' || event_type WHEN 1 THEN 'own ' || event_type ELSE '' END AS text FROM events")
def extract_text(spark: SparkSession, sf: str) -> DataFrame:
    rows = _payloads(spark, sf, {"text": "if(event_id % 4 = 2, parse_json('3'), if(event_id % 4 = 3, parse_json('null'), parse_json(to_json(named_struct('t', concat('own ', event_type)))):t))", "record": "if(event_id % 4 = 0, parse_json(to_json(named_struct('text', concat('record ', event_type)))), parse_json('{\"text\": 5}'))"})
    return rows.select("event_id", contracts.text_of_row(F.col("raw_payload")).alias("text"))


@query("SELECT event_id, CASE event_type WHEN 'click' THEN 'null' WHEN 'view' THEN CAST(event_id AS VARCHAR) ELSE '[1,2]' END AS value FROM events")
def distribution_value(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select("event_id", F.expr("parse_json(case event_type when 'click' then 'null' when 'view' then cast(event_id as string) else '[1, 2]' end)").alias("v"))
    return rows.select("event_id", contracts.distribution_value(F.col("v")).alias("value"))


# Prepared posts


def _raw_posts(spark: SparkSession, sf: str) -> DataFrame:
    d = F.col("doc_id")
    created = F.when(d % 3 == 0, "").when(d % 3 == 2, F.concat(F.lit("2024-01-0"), d % 9 + 1))
    return table(spark, sf, "documents").select(d.cast("string").alias("uri"), F.when(d % 11 != 0, F.col("text")).alias("text"), created.alias("record_created_at"), F.lit("2024-02-01").alias("captured_at"), F.col("source").alias("repo_did"), d.alias("position"))


def _hydrated_posts(spark: SparkSession, sf: str) -> DataFrame:
    d = F.col("doc_id")
    return table(spark, sf, "labels").select(
        (d + d % 2).cast("string").alias("uri"), F.when(F.col("quality") == 1, F.concat(F.lit("Hydrated "), d.cast("string"))).otherwise("").alias("text"), F.lit(None).cast("string").alias("record_created_at"),
        F.when(F.col("toxic") == 1, "2024-03-01").alias("indexed_at"), F.lit("2024-04-01").alias("hydrated_at"), F.concat(F.lit("did:"), d.cast("string")).alias("author_did"), d.alias("position"),
    )


def _prepared(spark: SparkSession, sf: str) -> DataFrame:
    return posts.prepare(_raw_posts(spark, sf), _hydrated_posts(spark, sf), "run", ["position"])


_PREPARED = """WITH r AS (SELECT CAST(doc_id AS VARCHAR) AS uri, CASE WHEN doc_id % 11 <> 0 THEN text END AS text, CASE doc_id % 3 WHEN 0 THEN '' WHEN 2 THEN '2024-01-0' || (doc_id % 9 + 1) END AS created FROM documents
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY doc_id) = 1),
h AS (SELECT CAST(doc_id + doc_id % 2 AS VARCHAR) AS uri, CASE WHEN quality = 1 THEN 'Hydrated ' || doc_id ELSE '' END AS text, CASE WHEN toxic = 1 THEN '2024-03-01' END AS indexed_at, 'did:' || doc_id AS author_did FROM labels
  QUALIFY row_number() OVER (PARTITION BY doc_id + doc_id % 2 ORDER BY doc_id) = 1),
p AS (SELECT coalesce(r.uri, h.uri) AS uri, coalesce(nullif(r.created, ''), nullif(h.indexed_at, ''), CASE WHEN h.uri IS NOT NULL THEN '2024-04-01' END, CASE WHEN r.uri IS NOT NULL THEN '2024-02-01' END, '') AS post_created_at,
  CASE WHEN coalesce(h.text, '') <> '' THEN 'hydrated_record_text' WHEN coalesce(r.text, '') <> '' THEN 'raw_record_text' ELSE 'none' END AS text_source,
  coalesce(nullif(h.text, ''), nullif(r.text, ''), '') AS post_text_raw, h.author_did AS hydrated_author_did FROM r FULL JOIN h ON r.uri = h.uri)
"""


@query(_PREPARED + "SELECT uri, post_created_at, text_source, post_text_raw, hydrated_author_did FROM p")
def prepared_posts(spark: SparkSession, sf: str) -> DataFrame:
    return _prepared(spark, sf).select("uri", "post_created_at", "text_source", "post_text_raw", "hydrated_author_did")


# RE2's \b and \s know fewer characters than Java's, so words and \x0b are named here. DuckDB has no compatibility form; the canonical one is the same for texts without such characters.
@query(_PREPARED + r""", b AS (SELECT *, regexp_replace(regexp_replace(nfc_normalize(post_text_raw), '[‘’]', '''', 'g'), '[\r\n\t]', ' ', 'g') AS base FROM p),
c AS (SELECT *, trim(regexp_replace(regexp_replace(lower(base), '[&\-/_,.;:!?(){}\[\]"`]+', ' ', 'g'), '[\s\x0b\x1c-\x1f\x85\p{Z}]+', ' ', 'g')) AS post_text_clean,
  regexp_matches(base, '(^|[^\p{L}\p{N}_])#[\p{L}\p{N}_]') AS has_hashtag, regexp_matches(base, '(^|[^\p{L}\p{N}_])@[\p{L}\p{N}_]') AS has_mention,
  regexp_matches(base, '(?i)(https?://[^\s\x0b]|www\.[^\s\x0b]|((^|[^\p{L}\p{N}_])[a-z0-9]|[\p{L}\p{N}_]-)[a-z0-9-]*\.([a-z0-9-]+\.)*[a-z]{2,}($|[^\p{L}\p{N}_]))') AS has_url,
  regexp_matches(base, '[^A-Za-z0-9\s\x0b]') AS has_special_chars, regexp_matches(base, '[^\x00-\x7F]') AS has_non_ascii FROM b)
SELECT 'row_count' AS measure, '' AS key, CAST(count(*) AS DOUBLE) AS value FROM c
UNION ALL SELECT 'non_empty_raw_text_count', '', count(*) FILTER (trim(post_text_raw) <> '') FROM c
UNION ALL SELECT 'non_empty_clean_text_count', '', count(*) FILTER (trim(post_text_clean) <> '') FROM c
UNION ALL SELECT 'blank_clean_text_count', '', count(*) FILTER (trim(post_text_clean) = '') FROM c
UNION ALL SELECT 'duplicate_raw_text_rows', '', count(*) - count(DISTINCT post_text_raw) FROM c WHERE trim(post_text_raw) <> ''
UNION ALL SELECT 'duplicate_clean_text_rows', '', count(*) - count(DISTINCT post_text_clean) FROM c WHERE trim(post_text_clean) <> ''
UNION ALL SELECT 'flag', 'has_hashtag', count(*) FILTER (has_hashtag) FROM c
UNION ALL SELECT 'flag', 'has_url', count(*) FILTER (has_url) FROM c
UNION ALL SELECT 'flag', 'has_mention', count(*) FILTER (has_mention) FROM c
UNION ALL SELECT 'flag', 'has_special_chars', count(*) FILTER (has_special_chars) FROM c
UNION ALL SELECT 'flag', 'has_non_ascii', count(*) FILTER (has_non_ascii) FROM c
UNION ALL SELECT 'text_source', text_source, count(*) FROM c GROUP BY 2""")
def prepared_summary(spark: SparkSession, sf: str) -> DataFrame:
    return posts.summarize(_prepared(spark, sf))


# The feature table


def _feature_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, ...]:
    d, i = F.col("doc_id"), F.col("item_id")
    when = F.timestamp_seconds(F.lit(1704067200) + (d % 400) * 3600)
    prepared = table(spark, sf, "documents").select(
        d.alias("uri"), when.alias("post_created_at"), F.col("text").alias("post_text_raw"), F.col("text").alias("post_text_alnum"), F.length("text").alias("post_token_count"), F.when(d % 5 < 4, (d % 1500).cast("string")).alias("hydrated_author_did")
    )
    items = table(spark, sf, "benchmark")
    matches = items.crossJoin(F.broadcast(spark.range(2).withColumnRenamed("id", "c"))).select(
        i.alias("uri"), (i * 2 + F.col("c")).alias("candidate_id"), F.element_at(F.array(*map(F.lit, features.STAGE_ORDER[:4])), (i % 4 + 1).cast("int")).alias("match_stage"), ((i + F.col("c")) % 10 / 10.0).alias("match_score"),
        F.length("text").cast("double").alias("trend_counts"), F.lit(None).cast("double").alias("trend_num_hours"), F.col("text").alias("trend_name_clean"), F.date_add(F.lit("2024-01-01").cast("date"), (i % 30).cast("int")).alias("trend_date"),
        ((i % 4 < 3) & (F.col("c") == 0)).alias("is_matched"), (i % 3 == 0).alias("is_ambiguous"),
    )
    hydrated = table(spark, sf, "labels").select(d.alias("uri"), F.col("quality").alias("like_count"), F.col("toxic").alias("reply_count"), F.lit(None).cast("int").alias("repost_count"), (d % 3).alias("quote_count"), F.lit("a").alias("hydrated_at"), F.lit("b").alias("indexed_at"))
    actors = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("did"), F.abs("c_acctbal").alias("followers_count"), F.col("c_nationkey").alias("follows_count"), F.lit(1).alias("posts_count"), F.col("c_name").alias("display_name"),
        F.when(F.col("c_nationkey") > 9, F.col("c_mktsegment")).alias("description"), (F.col("c_custkey") % 2 == 0).alias("has_avatar"), F.lit(None).cast("boolean").alias("has_banner"), F.lit("a").alias("actor_indexed_at"), F.lit("b").alias("actor_created_at"),
    )
    return prepared, matches, matches, hydrated, actors


_FEATURES = """WITH d AS (SELECT doc_id AS uri, TIMESTAMP '2024-01-01' + to_hours(CAST(doc_id % 400 AS INTEGER)) AS posted, CASE WHEN doc_id % 5 < 4 THEN CAST(doc_id % 1500 AS VARCHAR) END AS author FROM documents),
m AS (SELECT item_id AS uri, ['exact', 'fuzzy', 'semantic', 'unmatched'][item_id % 4 + 1] AS match_stage, (item_id + c) % 10 / 10.0 AS match_score, length(text) AS trend_counts, item_id % 4 < 3 AND c = 0 AS is_matched, DATE '2024-01-01' + CAST(item_id % 30 AS INTEGER) AS trend_date,
  item_id % 3 = 0 AS is_ambiguous FROM benchmark, (VALUES (0), (1)) v(c)),
b AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY uri ORDER BY match_score DESC) = 1),
c AS (SELECT uri, count(*) AS candidate_count, count(*) FILTER (is_matched) AS matched FROM m GROUP BY uri),
a AS (SELECT CAST(c_custkey AS VARCHAR) AS did, abs(c_acctbal) AS followers, c_nationkey AS follows, CASE WHEN c_nationkey > 9 THEN c_mktsegment ELSE '' END AS description, c_custkey % 2 = 0 AS avatar FROM customer),
f AS (SELECT d.uri, d.posted, b.uri AS b_uri, c.uri AS c_uri, l.doc_id AS l_uri, a.did, coalesce(b.match_stage, 'no_candidate') AS match_stage, CAST(coalesce(b.match_score, 0) AS DOUBLE) AS match_score, CAST(coalesce(c.candidate_count, 0) AS DOUBLE) AS candidate_count,
  coalesce(b.is_matched, false) AS has_trend_match, coalesce(b.is_ambiguous, false) AS is_ambiguous_match, CAST(coalesce(date_diff('day', CAST(posted AS DATE), trend_date), 0) AS DOUBLE) AS trend_post_day_diff,
  coalesce(b.is_matched AND date_diff('day', CAST(posted AS DATE), trend_date) = 0, false) AS same_day_trend_match, trend_date IS NOT NULL AS trend_date_available, CAST(coalesce(quality, 0) + coalesce(toxic, 0) + CASE WHEN l.doc_id IS NULL THEN 0 ELSE l.doc_id % 3 END AS DOUBLE) AS engagement_total,
  a.did IS NOT NULL AS actor_profile_found, round(CASE WHEN coalesce(follows, 0) > 0 THEN followers / follows ELSE 0 END, 6) AS ratio, coalesce(description, '') <> '' AS actor_has_description, coalesce(avatar, false) AS actor_has_avatar
  FROM d LEFT JOIN b USING (uri) LEFT JOIN c USING (uri) LEFT JOIN labels l ON l.doc_id = d.uri LEFT JOIN a ON a.did = d.author)
"""


def _features(spark: SparkSession, sf: str) -> DataFrame:
    return features.final_types(features.feature_flags(features.feature_table(*_feature_inputs(spark, sf))))


@query(_FEATURES + """SELECT uri, match_stage, match_score, candidate_count, has_trend_match, is_ambiguous_match, trend_post_day_diff, same_day_trend_match, trend_date_available, engagement_total, actor_profile_found, ratio,
actor_has_description, actor_has_avatar FROM f""")
def feature_table(spark: SparkSession, sf: str) -> DataFrame:
    named = "uri match_stage match_score candidate_count has_trend_match is_ambiguous_match trend_post_day_diff same_day_trend_match trend_date_available engagement_total actor_profile_found actor_has_description actor_has_avatar".split()
    return _features(spark, sf).select(*named, F.round("actor_followers_to_follows_ratio", 6).alias("ratio"))


@query(_FEATURES + """SELECT count(*) AS rows, count(b_uri) AS hit_best_match_both, count(*) - count(b_uri) AS hit_best_match_left_only, count(c_uri) AS hit_candidate_counts_both, count(*) - count(c_uri) AS hit_candidate_counts_left_only,
count(l_uri) AS hit_hydrated_both, count(*) - count(l_uri) AS hit_hydrated_left_only, count(did) AS hit_actor_both, count(*) - count(did) AS hit_actor_left_only FROM f""")
def feature_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return relational.coverage(features.feature_table(*_feature_inputs(spark, sf)), ["hit_best_match", "hit_candidate_counts", "hit_hydrated", "hit_actor"])


@query(_FEATURES + """SELECT 'row_count' AS measure, '' AS key, CAST(count(*) AS DOUBLE) AS value FROM f UNION ALL SELECT 'unique_uri_count', '', count(DISTINCT uri) FROM f
UNION ALL SELECT 'stage', match_stage, count(*) FROM f GROUP BY 2 UNION ALL SELECT 'max', 'match_score', max(match_score) FROM f UNION ALL SELECT 'min', 'trend_post_day_diff', min(trend_post_day_diff) FROM f""")
def feature_summary(spark: SparkSession, sf: str) -> DataFrame:
    got = features.feature_summary(_features(spark, sf))
    wanted = F.col("measure").isin("row_count", "unique_uri_count", "stage") | ((F.col("measure") == "max") & (F.col("key") == "match_score")) | ((F.col("measure") == "min") & (F.col("key") == "trend_post_day_diff"))
    return got.where(wanted)


@query(_FEATURES + r""", c0 AS (SELECT unnest(string_split(regexp_replace('uri post_created_at hydrated_author_did trend_name_clean trend_date actor_did post_text_raw post_text_alnum
engagement_total eng_like_count eng_reply_count eng_repost_count eng_quote_count
post_token_count candidate_id match_stage match_score trend_counts trend_num_hours is_matched is_ambiguous hit_best_match candidate_count matched_candidate_count matched_candidate_rate hit_candidate_counts
like_count reply_count repost_count quote_count hit_hydrated followers_count follows_count posts_count display_name description has_avatar has_banner hit_actor has_candidate has_trend_match is_ambiguous_match
trend_date_available trend_post_day_diff same_day_trend_match actor_followers_count actor_follows_count actor_posts_count actor_profile_found actor_followers_to_follows_ratio actor_has_display_name
actor_has_description actor_description_char_count actor_has_avatar actor_has_banner post_hour_utc post_day_of_week post_is_weekend post_month post_unique_token_count post_unique_token_ratio
raw_exclamation_count raw_question_count raw_uppercase_ratio', '\s+', ' ', 'g'), ' ')) AS name),
g AS (SELECT name, ablation FROM c0, (VALUES ('trend_match'), ('post_text'), ('actor_account'), ('temporal')) v(ablation) WHERE CASE ablation
  WHEN 'trend_match' THEN regexp_matches(name, '^(trend_|match_)|^(has_candidate|has_trend_match|is_ambiguous|is_ambiguous_match|is_matched|candidate_count|matched_candidate_count|matched_candidate_rate|same_day_trend_match)$')
  WHEN 'post_text' THEN regexp_matches(name, '^(post_|raw_)') WHEN 'actor_account' THEN regexp_matches(name, '^actor_|^(followers_count|follows_count|posts_count|has_avatar|has_banner|display_name|description)$')
  ELSE regexp_matches(name, '^post_hour_|^(post_day_of_week|post_is_weekend|post_month|trend_post_day_diff|same_day_trend_match)$') END),
x AS (SELECT count(*) AS total, count(*) FILTER (author IS NULL) AS author, count(*) FILTER (b_uri IS NULL) AS best, count(*) FILTER (quality IS NULL) AS quality, count(*) FILTER (toxic IS NULL) AS toxic, count(*) FILTER (l_uri IS NULL) AS label,
  count(*) FILTER (f.did IS NULL) AS actor, count(*) FILTER (NOT actor_has_description) AS description FROM f JOIN d USING (uri) LEFT JOIN labels ON labels.doc_id = f.uri)
SELECT name, CASE WHEN regexp_matches(name, '^(eng_.*|engagement_total)$') THEN 'label_columns'
  WHEN name IN ('uri', 'post_created_at', 'hydrated_author_did', 'trend_name_clean', 'trend_date', 'actor_did', 'post_text_raw', 'post_text_alnum') THEN 'debug_columns' ELSE 'model_feature_columns' END AS kind, ablation,
  CASE WHEN name = 'hydrated_author_did' THEN author WHEN name IN ('candidate_id', 'is_matched', 'is_ambiguous') THEN best WHEN name = 'like_count' THEN quality WHEN name = 'reply_count' THEN toxic WHEN name = 'quote_count' THEN label
  WHEN name IN ('repost_count', 'has_banner') THEN total WHEN name IN ('followers_count', 'follows_count', 'posts_count', 'display_name', 'has_avatar', 'actor_did') THEN actor WHEN name = 'description' THEN description ELSE 0 END AS nulls
FROM c0 LEFT JOIN g USING (name), x""")
def contract_columns(spark: SparkSession, sf: str) -> DataFrame:
    """The feature table's own columns with their kind, their ablation groups and their empty rows."""
    return features.contract_columns(_features(spark, sf), models.ablation_groups)


@query("""SELECT item_id AS uri, (item_id + CASE WHEN item_id % 10 = 9 THEN 0 ELSE 1 END) % 10 / 10.0::DOUBLE AS match_score FROM benchmark""")
def best_for_join(spark: SparkSession, sf: str) -> DataFrame:
    return features.best_for_join(_feature_inputs(spark, sf)[1]).select("uri", "match_score")


# Summaries


def _matched(spark: SparkSession, sf: str) -> DataFrame:
    return matching.match(_drawn_candidates(spark, sf), _keyed_trends(spark, sf))


@query()
def match_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = _matched(spark, sf).persist()
    return summaries.match_summary(rows, matching.best_per_candidate(rows), matching.best_per_post(rows))


@query()
def first_stage_counts(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.first_stages(_matched(spark, sf), matching.STAGES)


@query("""WITH c AS (SELECT conv_id AS uri, CASE WHEN turn % 2 = 0 THEN 'hashtag' ELSE 'ngram_2' END AS s, turn % 4 AS n, role FROM conversations WHERE conv_id % 3 <> 0)
SELECT 'total_posts' AS measure, '' AS key, CAST(count(DISTINCT conv_id) AS DOUBLE) AS value FROM conversations UNION ALL SELECT 'posts_with_candidates', '', count(DISTINCT uri) FROM c
UNION ALL SELECT 'posts_without_candidates', '', (SELECT count(DISTINCT conv_id) FROM conversations) - count(DISTINCT uri) FROM c UNION ALL SELECT 'total_candidate_rows', '', count(*) FROM c
UNION ALL SELECT 'avg_candidates_per_post', '', round(count(*) / (SELECT count(DISTINCT conv_id) FROM conversations), 6) FROM c UNION ALL SELECT 'avg_candidates_per_post_with_candidates', '', round(count(*) / count(DISTINCT uri), 6) FROM c
UNION ALL SELECT 'source_type', s, count(*) FROM c GROUP BY 2 UNION ALL SELECT 'token_count', CAST(n AS VARCHAR), count(*) FROM c GROUP BY 2 UNION ALL SELECT 'top_phrase', role, count(*) FROM c GROUP BY 2""")
def candidate_summary(spark: SparkSession, sf: str) -> DataFrame:
    said = table(spark, sf, "conversations")
    own = said.where("conv_id % 3 <> 0").select(F.col("conv_id").alias("uri"), F.when(F.col("turn") % 2 == 0, "hashtag").otherwise("ngram_2").alias("candidate_source_type"), (F.col("turn") % 4).alias("candidate_token_count"), F.col("role").alias("candidate_phrase_alnum"))
    return summaries.candidate_summary(said.select(F.col("conv_id").alias("uri")).distinct(), own).withColumn("value", F.round("value", 6))


@query("""WITH t AS (SELECT event_type AS name, CAST(ts AS DATE) AS day FROM events), d AS (SELECT day, count(*) AS n FROM t GROUP BY 1)
SELECT 'row_count' AS measure, '' AS key, CAST(count(*) AS DOUBLE) AS value FROM t UNION ALL SELECT 'hashtag_rows', '', 0 UNION ALL SELECT 'unique_dates', '', count(*) FROM d UNION ALL SELECT 'rows_per_day_min', '', min(n) FROM d
UNION ALL SELECT 'rows_per_day_max', '', max(n) FROM d UNION ALL SELECT 'rows_per_day_median', '', median(n) FROM d UNION ALL SELECT 'rows_per_day_mean', '', round(avg(n), 6) FROM d UNION ALL SELECT 'unique_topics', '', count(DISTINCT name) FROM t
UNION ALL SELECT 'repeated_topics_ge_2', '', count(*) FROM (SELECT name FROM t GROUP BY 1 HAVING count(*) >= 2) UNION ALL SELECT 'repeated_topics_ge_10', '', count(*) FROM (SELECT name FROM t GROUP BY 1 HAVING count(*) >= 10)
UNION ALL SELECT 'duplicate_rows', '', count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM t)) FROM t UNION ALL SELECT 'duplicate_date_name_rows', '', count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM t)) FROM t
UNION ALL SELECT 'unique_hashtags', '', 0 UNION ALL SELECT 'top_topic', name, count(*) FROM t GROUP BY 2""")
def trend_profile(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select(F.col("event_type").alias("name"), F.to_date("ts").alias("day"))
    return summaries.trend_profile(rows, "name", "day").withColumn("value", F.round("value", 6))


@query("""WITH f AS (SELECT l_linenumber AS k, l_returnflag || l_linestatus AS raw, min(l_orderkey) AS first, count(*) AS m FROM lineitem GROUP BY 1, 2)
SELECT k, count(*) AS variants, CAST(sum(m) AS BIGINT) AS n FROM f GROUP BY 1 HAVING count(*) > 1""")
def duplicate_variants(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select(F.lit("d").alias("day"), F.col("l_linenumber").alias("k"), F.concat("l_returnflag", "l_linestatus").alias("raw"), "l_orderkey")
    return summaries.duplicate_variants(rows, "day", "k", "raw", "l_orderkey").select("k", "variants", "n")


@query("SELECT least(1000, count(*)) AS expected_rows, least(1000, count(*)) AS sample_rows, least(1000, count(*)) - least(1000, count(*) FILTER (r <= 1000 AND c_nationkey <> 3)) AS rows_that_differ, count(*) FILTER (r <= 1000 AND c_nationkey = 3) = 0 AS matches FROM (SELECT *, row_number() OVER (ORDER BY c_custkey) AS r FROM customer)")
def sample_agrees(spark: SparkSession, sf: str) -> DataFrame:
    full = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    sample = full.withColumn("c_nationkey", F.when(F.col("c_nationkey") == 3, 99).otherwise(F.col("c_nationkey")))
    return summaries.sample_agrees(full, sample, ["c_custkey"])


@query("""SELECT 'files_count' AS measure, '' AS key, CAST(count(DISTINCT event_type) AS DOUBLE) AS value FROM events UNION ALL SELECT 'rows_count', '', count(*) FROM events UNION ALL SELECT 'missing_required_rows', '', count(*) FROM events
UNION ALL SELECT 'missing:k', '', count(*) FILTER (NOT contains(props, '"k"')) FROM events UNION ALL SELECT 'missing:zz', '', count(*) FROM events UNION ALL SELECT 'null:k', '', 0 UNION ALL SELECT 'null:zz', '', 0
UNION ALL SELECT 'key', k, count(*) FROM (SELECT unnest(json_keys(props)) AS k FROM events) GROUP BY 2
UNION ALL SELECT * FROM (SELECT 'value:k', coalesce(json_extract_string(props, '$.k'), 'null') AS v, count(*) AS n FROM events GROUP BY 2 ORDER BY n DESC, v LIMIT 10)""")
def dataset_profile(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.dataset_profile(table(spark, sf, "events"), "props", "event_type", ["k", "zz"], ["k"])


@query(r"""WITH t AS (SELECT CASE WHEN event_id % 50 = 0 THEN '{"id": ' WHEN event_id % 50 <> 1 THEN '{"id": ' || event_id || ', "props": ' || props || ', "tags": ["' || event_type || '", {"user": ' || user_id || ', "odd name": [[' || (event_id % 2 = 0) || '], null, 0.5]}]' ||
  CASE WHEN event_id % 3 = 0 THEN ', "value": null' ELSE '' END || '}' END AS line FROM events),
n AS (SELECT regexp_replace(r.fullkey, '\[\d+\]', '[]', 'g') AS path, CASE WHEN r.type IN ('OBJECT', 'ARRAY', 'NULL', 'BOOLEAN') THEN lower(r.type) WHEN r.type = 'VARCHAR' THEN 'string' ELSE 'number' END AS kind FROM (SELECT line FROM t WHERE json_valid(line)) t, json_tree(t.line) r
  UNION ALL SELECT '$', CASE WHEN line IS NULL THEN 'missing' ELSE 'invalid' END FROM t WHERE line IS NULL OR NOT json_valid(line))
SELECT path, kind, count(*) AS n FROM n GROUP BY 1, 2""")
def nested_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Paths and kinds of nested texts made of each event; some are cut off, some are missing."""
    e = F.col("event_id")
    parts = [F.lit('{"id": '), e, F.lit(', "props": '), "props", F.lit(', "tags": ["'), "event_type", F.lit('", {"user": '), "user_id", F.lit(', "odd name": [['), e % 2 == 0, F.lit("], null, 0.5]}]"), F.when(e % 3 == 0, ', "value": null').otherwise(""), F.lit("}")]
    line = F.when(e % 50 == 0, '{"id": ').when(e % 50 != 1, F.concat(*[(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]))
    return summaries.nested_profile(table(spark, sf, "events").select(line.alias("line")), "line")


@query("""WITH f AS (SELECT source AS file, count(*) AS rows, max(n_chars) AS bytes FROM documents GROUP BY 1)
SELECT * FROM f UNION ALL SELECT '(all)', CAST(sum(rows) AS BIGINT), CAST(sum(bytes) AS BIGINT) FROM f""")
def file_listing(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.file_listing(table(spark, sf, "documents"), "source", "n_chars")


@query("""WITH f AS (SELECT lang AS family, source AS run_id, n_chars % 5 AS file, count(*) AS rows, max(n_chars) AS bytes FROM documents GROUP BY 1, 2, 3),
g AS (SELECT family, count(*) AS files, CAST(sum(rows) AS BIGINT) AS rows, CAST(sum(bytes) AS BIGINT) AS bytes, count(DISTINCT run_id) AS runs FROM f GROUP BY 1)
SELECT v.family, coalesce(files, 0) AS files, coalesce(rows, 0) AS rows, coalesce(bytes, 0) AS bytes, coalesce(runs, 0) AS runs FROM (VALUES ('en'), ('de'), ('none')) v(family) LEFT JOIN g USING (family)""")
def run_manifest(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select(F.col("lang").alias("family"), F.col("source").alias("run_id"), (F.col("n_chars") % 5).alias("file"), F.col("n_chars").alias("file_bytes"))
    return summaries.run_manifest(rows, ["en", "de", "none"]).withColumn("runs", F.size("run_ids").cast("long")).drop("run_ids")


@query("SELECT 'rows' AS measure, '' AS key, CAST(count(*) AS DOUBLE) AS value FROM labels UNION ALL SELECT 'columns', '', 2")
def schema_profile(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.schema_profile(table(spark, sf, "labels").select("doc_id", "toxic")).where("measure <> 'type'")


@query("""SELECT 'rows' AS measure, '' AS key, CAST(count(*) AS DOUBLE) AS value FROM events UNION ALL SELECT 'duplicate_keys', '', count(*) FROM (SELECT user_id FROM events GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'mature', '', count(*) FILTER (ts <= TIMESTAMP '2024-01-10') FROM events UNION ALL SELECT 'immature', '', count(*) FILTER (ts > TIMESTAMP '2024-01-10') FROM events
UNION ALL SELECT 'bytes_per_row', '', round(avg(length(props)), 6) FROM events UNION ALL SELECT 'projected_bytes', '', round(avg(length(props)) * 20000, 6) FROM events""")
def preflight(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").withColumn("at", F.col("ts").cast("timestamp"))
    return summaries.preflight(rows, "user_id", "at", F.lit("2024-01-10").cast("timestamp"), F.length("props"), 20_000).withColumn("value", F.round("value", 6))


@query("SELECT quality, toxic, count(*) AS n FROM labels WHERE quality IS DISTINCT FROM toxic GROUP BY 1, 2")
def wrong_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.wrong_pairs(table(spark, sf, "labels"), "quality", "toxic")


@query("""WITH c AS (SELECT c, count(*) FILTER (quality = c AND toxic = c) AS hits, count(*) FILTER (quality = c) AS support, count(*) FILTER (toxic = c) AS named FROM labels, (VALUES (0), (1)) v(c) GROUP BY c)
SELECT c AS class, support, round(CASE WHEN named > 0 THEN hits / named ELSE 0 END, 9) AS precision, round(CASE WHEN support > 0 THEN hits / support ELSE 0 END, 9) AS recall FROM c""")
def class_table(spark: SparkSession, sf: str) -> DataFrame:
    got = summaries.class_table(table(spark, sf, "labels").select(F.col("quality").cast("int").alias("quality"), F.col("toxic").cast("int").alias("toxic")), "quality", "toxic")
    return got.select("class", "support", F.round("precision", 9).alias("precision"), F.round("recall", 9).alias("recall"))


@query("SELECT trim(regexp_replace(regexp_replace(lower(event_type || '-' || user_id % 3), '[^\\p{L}\\p{N}\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS simple_key, CAST(2 AS BIGINT) AS forms FROM events GROUP BY 1 HAVING count(DISTINCT event_id % 2) > 1")
def simple_key_collisions(spark: SparkSession, sf: str) -> DataFrame:
    mark = F.when(F.col("event_id") % 2 == 0, "-").otherwise("_")
    rows = table(spark, sf, "events").select(F.concat("event_type", mark, (F.col("user_id") % 3).cast("string")).alias("raw"))
    return summaries.simple_key_collisions(rows, "raw")


@query(r"""SELECT url, regexp_matches(url, '[-_.,/&]{2,}') AS has_repeated_separator, regexp_matches(url, '^\s|\s$') AS has_edge_space, length(trim(url)) < 3 AS is_short, NOT regexp_matches(url, '[\p{L}]') AS is_low_information FROM pages""")
def name_tests(spark: SparkSession, sf: str) -> DataFrame:
    tests = T.text_tests(F.col("url"), ["the", "a"])
    return table(spark, sf, "pages").select("url", *[tests[c].alias(c) for c in ("has_repeated_separator", "has_edge_space", "is_short", "is_low_information")])


# Lifecycles


@query("""SELECT event_id, epoch(ts) AS epoch, n || ' B' AS size FROM (SELECT event_id, ts, printf('%.1f', CAST(event_id % 1000 AS DOUBLE)) AS n FROM events)""")
def iso_parse(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").withColumn("iso", F.concat(F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.when(F.col("event_id") % 2 == 0, "Z").otherwise("")))
    return rows.select("event_id", T.iso_time(F.col("iso")).cast("double").alias("epoch"), T.human_bytes((F.col("event_id") % 1000).cast("double")).alias("size"))


def _queue(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("event_id")
    return table(spark, sf, "events").select(
        "event_id", F.element_at(F.array(*map(F.lit, ("pending", "claimed", "retryable", "hydrated"))), (e % 4 + 1).cast("int")).alias("status"), F.when(e % 3 == 0, "old").alias("last_error"),
        F.when(e % 4 == 1, F.concat(F.lit("w"), e % 2 * 0 + e % 3)).alias("claimed_by"), F.lit(None).cast("timestamp").alias("claim_expires"),
    )


_QUEUE = "WITH q AS (SELECT event_id, ['pending', 'claimed', 'retryable', 'hydrated'][event_id % 4 + 1] AS status, CASE WHEN event_id % 3 = 0 THEN 'old' END AS last_error, CASE WHEN event_id % 4 = 1 THEN 'w' || event_id % 3 END AS claimed_by FROM events)\n"


@query(_QUEUE + """, o AS (SELECT *, ['hydrated', 'retryable', 'missing', 'failed'][event_id % 7 % 4 + 1] AS outcome, CASE WHEN event_id % 5 = 0 THEN 'new' END AS error FROM q),
l AS (SELECT *, (outcome IN ('hydrated', 'retryable') AND status = 'claimed') OR (outcome IN ('missing', 'failed') AND status IN ('claimed', 'retryable')) AS legal FROM o)
SELECT event_id, CASE WHEN legal THEN outcome ELSE status END AS status, CASE WHEN NOT legal THEN last_error WHEN outcome = 'hydrated' THEN NULL WHEN outcome = 'retryable' THEN error ELSE coalesce(error, last_error) END AS last_error,
CASE WHEN NOT legal THEN claimed_by END AS claimed_by FROM l""")
def mark_with_errors(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("event_id")
    outcomes = table(spark, sf, "events").select("event_id", F.element_at(F.array(*map(F.lit, ("hydrated", "retryable", "missing", "failed"))), (e % 7 % 4 + 1).cast("int")).alias("outcome"), F.when(e % 5 == 0, "new").alias("error"))
    return lifecycle.mark_with_errors(_queue(spark, sf), outcomes, "event_id").drop("claim_expires")


@query(_QUEUE + "SELECT event_id, CASE WHEN claimed_by = 'w1' THEN 'retryable' ELSE status END AS status, CASE WHEN claimed_by = 'w1' THEN 'shutdown' ELSE last_error END AS last_error, CASE WHEN claimed_by <> 'w1' THEN claimed_by END AS claimed_by FROM q")
def shutdown_release(spark: SparkSession, sf: str) -> DataFrame:
    return lifecycle.release_on_shutdown(_queue(spark, sf), "w1").drop("claim_expires")


@query("SELECT event_id AS run_id, ts AS started_at FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def latest_run(spark: SparkSession, sf: str) -> DataFrame:
    return lifecycle.latest_run(table(spark, sf, "events").select(F.col("event_id").alias("run_id"), F.col("ts").alias("started_at")))


@query("SELECT event_type AS stream, sum(CASE WHEN event_type = 'view' THEN 0 ELSE 1 END) > 0 AS has_data FROM events GROUP BY 1")
def has_data(spark: SparkSession, sf: str) -> DataFrame:
    return lifecycle.has_data(table(spark, sf, "events").select(F.col("event_type").alias("stream"), F.when(F.col("event_type") == "view", 0).otherwise(1).alias("n")), "n")


@query("SELECT count(*) FILTER (event_id % 2 = 0) > 0 AND count(*) FILTER (event_id % 2 <> 0) = 0 AS ends_run FROM events")
def only_retries(spark: SparkSession, sf: str) -> DataFrame:
    return lifecycle.only_retries(table(spark, sf, "events").select(F.when(F.col("event_id") % 2 == 0, "retryable").otherwise("hydrated").alias("outcome")))


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS path, CASE o_orderkey % 3 WHEN 0 THEN 'loaded' WHEN 1 THEN 'failed' ELSE 'pending' END AS status, CASE WHEN o_orderkey % 3 = 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 5 ELSE 7 END END AS rows FROM orders""")
def load_status(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    orders = table(spark, sf, "orders").select("o_orderkey")
    files = orders.select(k.cast("string").alias("path"), F.lit(9).alias("local_rows"))
    history = orders.where(k % 3 < 2).select(k.cast("string").alias("file_name"), F.when(k % 3 == 0, "LOADED").otherwise("LOAD_FAILED").alias("status"), F.when(k % 2 == 0, 5).alias("row_count"), F.lit(1).alias("load_time"))
    landing = orders.select(k.cast("string").alias("file_name"), F.lit(7).alias("rows"))
    return lifecycle.load_status(files, history, landing)


# Models


def _vectors(spark: SparkSession, sf: str) -> tuple[DataFrame, list[str]]:
    vectors = table(spark, sf, "embeddings")
    names = [f"x{i}" for i in range(vectors.agg(F.max(F.size("embedding"))).first()[0] or 0)]
    base = vectors.select("vec_id", F.col("label").cast("string").alias("label"), *[F.col("embedding")[i].cast("double").alias(x) for i, x in enumerate(names)])
    return models.stratified_split(base, "label", "vec_id"), names


@query()
def model_importances(spark: SparkSession, sf: str) -> DataFrame:
    split, names = _vectors(spark, sf)
    return models.importances(models.softmax_regression(names, "label").fit(split.where("split = 'train'")), names)


@query()
def model_predictions(spark: SparkSession, sf: str) -> DataFrame:
    split, names = _vectors(spark, sf)
    return models.predictions(models.softmax_regression(names, "label").fit(split.where("split = 'train'")), split.where("split = 'test'"), "label", "vec_id")


