"""The engine's queries on the driver's tables, each with SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from threadmill.functions import text as T
from threadmill.operators import candidates, features, matching, models, quality, relational, state, stumps
from threadmill.sources import events as ev

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Deduplication and the curated join


@query("""
WITH h AS (SELECT l_orderkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) = 1)
SELECT o_orderkey, o_custkey, l_suppkey, coalesce(l_suppkey, o_custkey) AS join_actor, c_name, c_acctbal,
  round(coalesce(l_quantity, 0) + coalesce(l_extendedprice, 0) + coalesce(l_discount, 0) + coalesce(l_tax, 0), 4) AS engagement_total
FROM orders LEFT JOIN h ON o_orderkey = l_orderkey LEFT JOIN customer ON coalesce(l_suppkey, o_custkey) = c_custkey""")
def curated_posts_core(spark: SparkSession, sf: str) -> DataFrame:
    """Latest version per key of the enrichment, joined to its base rows and actors."""
    raw = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf, "lineitem")
    latest = relational.latest_by_key(lines, ["l_orderkey"], ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"])
    numbers = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    hydrated = latest.select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey", *numbers)
    actors = table(spark, sf, "customer").select(F.col("c_custkey").alias("actor_key"), "c_name", "c_acctbal")
    joined = relational.curated(raw, hydrated, actors, "o_orderkey", "o_custkey", "l_suppkey")
    return joined.select("o_orderkey", "o_custkey", "l_suppkey", "join_actor", "c_name", "c_acctbal", F.round(relational.null_safe_total(numbers), 4).alias("engagement_total"))


@query("SELECT conv_id, turn, role, text FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1")
def latest_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return relational.latest_by_key(table(spark, sf, "conversations"), ["conv_id"], ["turn"])


@query("SELECT conv_id, turn, role, text FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1")
def first_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return relational.first_by_key(table(spark, sf, "conversations"), ["conv_id"], ["turn"])


@query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def freshest_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return relational.freshest_by_key(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("""SELECT count(*) AS rows, count(quality) AS labelled_both, count(*) - count(quality) AS labelled_left_only
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def join_coverage(spark: SparkSession, sf: str) -> DataFrame:
    joined = relational.left_with_hit(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels"), ["doc_id"], "labelled")
    return relational.coverage(joined, ["labelled"])


@query("SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS surrogate_id FROM (SELECT DISTINCT user_id FROM events)")
def surrogate_ids(spark: SparkSession, sf: str) -> DataFrame:
    return relational.numbered(table(spark, sf, "events").select("user_id").distinct(), "user_id")


# Text

_POST = r"""
WITH c AS (SELECT doc_id, text, regexp_replace(text, '[\r\n\t]', ' ', 'g') AS base FROM documents),
d AS (SELECT *, trim(regexp_replace(regexp_replace(lower(base), '[&\-/_,.;:!?(){{}}\[\]"`]+', ' ', 'g'), '[\s\x1c-\x1f\x85\p{{Z}}]+', ' ', 'g')) AS clean FROM c),
p AS (SELECT *, trim(regexp_replace(regexp_replace(clean, '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g')) AS alnum FROM d)
""".replace("{{", "{").replace("}}", "}")


@query(_POST + r"""SELECT doc_id, clean AS post_text_clean, alnum AS post_text_alnum,
  CAST(len(list_filter(string_split(clean, ' '), lambda t: t <> '')) AS BIGINT) AS post_token_count, CAST(length(clean) AS BIGINT) AS post_char_count,
  regexp_matches(base, '(^|[^\p{L}\p{N}_])#[\p{L}\p{N}_]') AS has_hashtag, regexp_matches(base, '(^|[^\p{L}\p{N}_])@[\p{L}\p{N}_]') AS has_mention,
  regexp_matches(base, '(?i)((https?://\S+)|(www\.\S+)|(\b(?:[a-z0-9-]+\.)+[a-z]{2,}(?:/\S*)?\b))') AS has_url, regexp_matches(base, '[^A-Za-z0-9\s]') AS has_special_chars, regexp_matches(base, '[^\x00-\x7F]') AS has_non_ascii FROM p""")
def post_text(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", T.post_text(F.col("text")).alias("p"))
    return docs.select("doc_id", *[f"p.{c}" for c in ("post_text_clean", "post_text_alnum", "post_token_count", "post_char_count", "has_hashtag", "has_url", "has_mention", "has_special_chars", "has_non_ascii")])


@query(_POST + r"""SELECT doc_id, CAST(len(list_distinct(list_filter(string_split(alnum, ' '), lambda t: t <> ''))) AS BIGINT) AS post_unique_token_count,
  CAST(length(text) - length(replace(text, '!', '')) AS BIGINT) AS raw_exclamation_count, CAST(length(text) - length(replace(text, '?', '')) AS BIGINT) AS raw_question_count,
  round(CASE WHEN len(regexp_extract_all(text, '\p{L}')) > 0 THEN len(regexp_extract_all(text, '\p{Lu}')) / len(regexp_extract_all(text, '\p{L}')) ELSE 0.0 END, 9) AS raw_uppercase_ratio FROM p""")
def post_shape(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", T.post_text(F.col("text")).alias("p"))
    shaped = docs.select("doc_id", *T.post_shape(F.col("text"), F.col("p.post_text_alnum"), F.col("p.post_token_count")))
    return shaped.select("doc_id", "post_unique_token_count", "raw_exclamation_count", "raw_question_count", F.round("raw_uppercase_ratio", 9).alias("raw_uppercase_ratio"))


def _trends(spark: SparkSession, sf: str) -> DataFrame:
    """Dated trend names drawn from the benchmark's whole items, up to 20 of each: trend_id is the item's number and the place in it."""
    items = table(spark, sf, "benchmark").select("item_id", F.length("text").alias("n"), T.post_text(F.col("text")).alias("p"))
    drawn = candidates.generate(items.select(F.struct("item_id", "n").alias("uri"), "p.post_text_clean", "p.post_text_alnum"))
    item, place = F.col("uri.item_id"), F.col("candidate_rank_in_post")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (item % 30).cast("int"))
    return drawn.select((item * 100 + place).alias("trend_id"), F.col("candidate_phrase_raw").alias("name"), day.alias("trend_date"), (F.col("uri.n") - place).cast("double").alias("counts"))


_TREND = r"""
WITH t AS (SELECT item_id AS trend_id, text AS name FROM benchmark),
l AS (SELECT *, trim(regexp_replace(replace(lower(name), 'ß', 'ss'), '[\s\p{Z}]+', ' ', 'g')) AS low FROM t),
n AS (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(low, '[&\-.,/_]+', ' ', 'g'), '''', ' ', 'g'), '[^\p{L}\p{N}_\s\p{Z}#$]', ' ', 'g'), '[\s\p{Z}]+', ' ', 'g')) AS with_hash FROM l),
k AS (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(low, '^#', ''), '[&\-.,/_]+', ' ', 'g'), '''', ' ', 'g'), '[^\p{L}\p{N}_\s\p{Z}#$]', ' ', 'g'), '[\s\p{Z}]+', ' ', 'g')) AS key FROM n)
"""


@query(_TREND + r"""SELECT trend_id, name AS trend_name_raw, with_hash AS trend_name_clean, with_hash AS normalized_key_with_hash, key AS trend_name_clean_no_hash, key AS normalized_key_no_hash,
  trim(regexp_replace(key, '^\$', '')) AS normalized_key_no_dollar, trim(regexp_replace(key, '^\$', '')) AS trend_name_clean_no_dollar,
  trim(regexp_replace(regexp_replace(key, '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g')) AS trend_name_alnum, CAST(len(list_filter(string_split(key, ' '), lambda t: t <> '')) AS BIGINT) AS trend_name_token_count,
  CAST(length(key) AS BIGINT) AS trend_name_char_count, trim(name) = '' AS is_blank_raw, starts_with(trim(name), '#') AS is_hashtag, regexp_matches(name, '[^A-Za-z0-9\s]') AS has_special_chars,
  regexp_matches(name, '[^\x00-\x7F]') AS has_non_ascii, regexp_matches(name, '(?i)(https?://\S+|www\.\S+|\b[a-z0-9-]+\.[a-z]{2,}\b)') AS has_url_like FROM k""")
def trend_names(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("trend_id"), T.trend_name(F.col("text")).alias("t")).select("trend_id", "t.*")


@query()
def topic_candidates(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", T.post_text(F.col("text")).alias("p"))
    return candidates.generate(docs.select(F.col("doc_id").alias("uri"), "p.post_text_clean", "p.post_text_alnum"))


def _said_on():
    """A conversation's date, from its number."""
    return F.date_add(F.lit("2024-01-01").cast("date"), (F.col("conv_id") % 40).cast("int"))


def _segments(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Candidates and trends that name market segments of nations in two spellings, for the two queries that have SQL."""
    day = lambda n, of: F.date_add(F.lit("2024-01-01").cast("date"), (F.col(n) % of).cast("int"))
    segment = F.element_at(F.array(*map(F.lit, ("Building", "Machinery", "Furniture", "Household", "Automobile", "Shipping"))), (F.col("s_suppkey") % 6 + 1).cast("int"))
    phrase = F.concat(segment, F.lit("-"), F.col("s_nationkey").cast("string"))
    own = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("candidate_id"), F.col("s_suppkey").alias("uri"), T.candidate_phrase(phrase)["candidate_phrase_alnum"].alias("key"), F.when(F.col("s_suppkey") % 11 > 0, day("s_suppkey", 40)).alias("candidate_date"))
    name = F.concat(F.lit("#"), "c_mktsegment", F.lit("_"), F.col("c_nationkey").cast("string"))
    trends = table(spark, sf, "customer").select(F.col("c_custkey").alias("trend_id"), name.alias("name"), day("c_custkey", 30).alias("trend_date"), F.col("c_acctbal").alias("counts"), T.trend_name(name)["normalized_key_no_hash"].alias("key"))
    return own, trends


def _drawn_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Dated candidates drawn from the conversations' whole texts, ranked within each turn."""
    said = table(spark, sf, "conversations").select("conv_id", "turn", _said_on().alias("candidate_date"), T.post_text(F.col("text")).alias("p"))
    posts = said.select(F.struct("conv_id", "turn", "candidate_date").alias("uri"), "p.post_text_clean", "p.post_text_alnum")
    number = F.struct("uri.conv_id", "uri.turn", "candidate_rank_in_post")
    return candidates.generate(posts).select(number.alias("candidate_id"), F.col("uri.conv_id").alias("uri"), F.col("candidate_phrase_alnum").alias("key"), F.col("uri.candidate_date").alias("candidate_date"), "candidate_rank_in_post")


def _keyed_trends(spark: SparkSession, sf: str) -> DataFrame:
    return _trends(spark, sf).withColumn("key", T.trend_name(F.col("name"))["normalized_key_no_hash"])


_CAND = """WITH k AS (SELECT c_custkey AS trend_id, lower(c_mktsegment) || ' ' || c_nationkey AS key, DATE '2024-01-01' + CAST(c_custkey % 30 AS INTEGER) AS trend_date FROM customer),
c AS (SELECT s_suppkey AS candidate_id, ['building', 'machinery', 'furniture', 'household', 'automobile', 'shipping'][s_suppkey % 6 + 1] || ' ' || s_nationkey AS key, CASE WHEN s_suppkey % 11 > 0 THEN DATE '2024-01-01' + CAST(s_suppkey % 40 AS INTEGER) END AS candidate_date FROM supplier),
near AS (SELECT DISTINCT unnest(range(trend_date - 3, trend_date + 4, INTERVAL 1 DAY))::DATE AS d FROM k),
timed AS (SELECT c.*, CASE WHEN candidate_date IS NULL THEN 'global_fallback_no_candidate_date' WHEN candidate_date IN (SELECT d FROM near) THEN 'date_window' ELSE 'global_fallback_no_date_overlap' END AS mode FROM c)
"""


@query(_CAND + "SELECT candidate_id, key, mode FROM timed")
def temporal_pool(spark: SparkSession, sf: str) -> DataFrame:
    return matching.temporal_mode(*_segments(spark, sf)).select("candidate_id", "key", "mode")


@query(_CAND + """SELECT candidate_id, trend_id, 'exact' AS stage, 1.0::DOUBLE AS score FROM timed JOIN k USING (key) WHERE mode <> 'date_window' OR abs(date_diff('day', candidate_date, trend_date)) <= 3""")
def exact_match(spark: SparkSession, sf: str) -> DataFrame:
    own, trends = _segments(spark, sf)
    return matching.exact_pairs(matching.temporal_mode(own, trends), trends)


def _number():
    """A candidate's conversation, turn and place as text."""
    return F.concat_ws("-", *[F.col(f"candidate_id.{c}").cast("string") for c in ("conv_id", "turn", "candidate_rank_in_post")]).alias("candidate_id")


@query()
def staged_match(spark: SparkSession, sf: str) -> DataFrame:
    return matching.match(_drawn_candidates(spark, sf), _keyed_trends(spark, sf)).select(_number(), "uri", "stage", "trend_id", "score", "stage_rank", "is_matched", "is_ambiguous")


@query()
def best_match_per_post(spark: SparkSession, sf: str) -> DataFrame:
    return matching.best_per_post(matching.match(_drawn_candidates(spark, sf), _keyed_trends(spark, sf))).select("uri", _number(), "stage", "trend_id", "score")


@query()
def candidate_match_counts(spark: SparkSession, sf: str) -> DataFrame:
    return features.candidate_counts(matching.match(_drawn_candidates(spark, sf), _keyed_trends(spark, sf)))


# Features


@query("""WITH q AS (SELECT quantile_cont(o_totalprice, 0.33) AS lo, quantile_cont(o_totalprice, 0.66) AS hi FROM orders)
SELECT o_orderkey, CASE WHEN o_totalprice <= lo THEN 'LOW' WHEN o_totalprice <= hi THEN 'MEDIUM' ELSE 'HIGH' END AS engagement_label, 'quantile_bins' AS label_rule FROM orders, q""")
def engagement_label(spark: SparkSession, sf: str) -> DataFrame:
    return features.engagement_label(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice").select("o_orderkey", "engagement_label", "label_rule")


@query("SELECT doc_id, toxic, CASE WHEN toxic <= 0 THEN 'LOW' WHEN toxic = 1 THEN 'MEDIUM' ELSE 'HIGH' END AS engagement_label, 'fallback_bins' AS label_rule FROM labels")
def engagement_label_fallback(spark: SparkSession, sf: str) -> DataFrame:
    return features.engagement_label(table(spark, sf, "labels").select("doc_id", "toxic"), "toxic").select("doc_id", "toxic", "engagement_label", "label_rule")


@query("""SELECT event_id, CAST(hour(ts) AS INTEGER) AS post_hour_utc, CAST(isodow(ts) - 1 AS INTEGER) AS post_day_of_week, isodow(ts) >= 6 AS post_is_weekend, CAST(month(ts) AS INTEGER) AS post_month FROM events""")
def time_features(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", *T.time_parts(F.col("ts")))


@query("""SELECT doc_id, quality IS NOT NULL AS labelled, coalesce(CAST(quality AS DOUBLE), 0.0) AS quality, coalesce(CAST(toxic AS DOUBLE), 0.0) AS toxic, coalesce(NULL, 'no_candidate') AS match_stage
FROM documents LEFT JOIN labels USING (doc_id)""")
def feature_types(spark: SparkSession, sf: str) -> DataFrame:
    joined = relational.left_with_hit(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels"), ["doc_id"], "labelled").withColumn("match_stage", F.lit(None).cast("string"))
    return features.fill_types(joined, ["labelled"], ["quality", "toxic"], {"match_stage": "no_candidate"}).select("doc_id", "labelled", "quality", "toxic", "match_stage")


@query("""SELECT 'lang' AS "column", 'string' AS kind, count(DISTINCT lang) AS distinct_values, CASE WHEN count(DISTINCT lang) <= 12 THEN 'categorical' ELSE 'debug' END AS column_group FROM documents
UNION ALL SELECT 'source', 'string', count(DISTINCT source), CASE WHEN count(DISTINCT source) <= 12 THEN 'categorical' ELSE 'debug' END FROM documents
UNION ALL SELECT 'n_chars', 'bigint', count(DISTINCT n_chars), 'numeric' FROM documents""")
def column_groups(spark: SparkSession, sf: str) -> DataFrame:
    return features.column_groups(table(spark, sf, "documents").select("lang", "source", "n_chars"))


# Profiles


@query("""SELECT count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, min(value) AS min, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.9), 6) AS p90,
round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99, max(value) AS max FROM events""")
def describe(spark: SparkSession, sf: str) -> DataFrame:
    return quality.describe(table(spark, sf, "events"), "value").select("n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "min", *[F.round(p, 6).alias(p) for p in ("p50", "p90", "p95", "p99")], "max")


@query("""WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS a, quantile_cont(l_extendedprice, 0.75) AS b FROM lineitem)
SELECT round(a - 1.5 * (b - a), 4) AS lower_bound, round(b + 1.5 * (b - a), 4) AS upper_bound, count(*) FILTER (l_extendedprice < a - 1.5 * (b - a) OR l_extendedprice > b + 1.5 * (b - a)) AS outliers,
round(count(*) FILTER (l_extendedprice < a - 1.5 * (b - a) OR l_extendedprice > b + 1.5 * (b - a)) / count(*), 9) AS outlier_ratio FROM lineitem, q GROUP BY a, b""")
def iqr_outliers(spark: SparkSession, sf: str) -> DataFrame:
    got = quality.iqr_outliers(table(spark, sf, "lineitem").select("l_extendedprice"), "l_extendedprice")
    return got.select(F.round("lower_bound", 4).alias("lower_bound"), F.round("upper_bound", 4).alias("upper_bound"), "outliers", F.round("outlier_ratio", 9).alias("outlier_ratio"))


@query("""SELECT 'doc_id' AS "column", count(*) FILTER (doc_id IS NULL) AS nulls, count(*) FILTER (trim(CAST(doc_id AS VARCHAR)) = '') AS blanks, count(*) AS n FROM documents
UNION ALL SELECT 'lang', count(*) FILTER (lang IS NULL), count(*) FILTER (trim(lang) = ''), count(*) FROM documents""")
def missingness(spark: SparkSession, sf: str) -> DataFrame:
    return quality.missingness(table(spark, sf, "documents").select("doc_id", "lang"))


@query("SELECT count(*) AS collisions FROM (SELECT lower(text) FROM documents GROUP BY 1 HAVING count(DISTINCT text) > 1)")
def case_collisions(spark: SparkSession, sf: str) -> DataFrame:
    return quality.case_collisions(table(spark, sf, "documents"), "text")


@query("""WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1)
SELECT CAST(min(day) AS VARCHAR) AS first_day, CAST(max(day) AS VARCHAR) AS last_day, count(*) AS days, CAST(date_diff('day', min(day), max(day)) + 1 - count(*) AS BIGINT) AS missing_days, count(*) FILTER (n < 50) AS days_under_50, count(*) FILTER (n < 100) AS days_under_100 FROM d""")
def temporal_coverage(spark: SparkSession, sf: str) -> DataFrame:
    got = quality.temporal_coverage(table(spark, sf, "events"), F.to_date("ts"))
    return got.withColumns({c: F.col(c).cast("string") for c in ("first_day", "last_day")})


@query("""WITH s AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)
SELECT CAST(day AS VARCHAR) AS day FROM (SELECT unnest(generate_series((SELECT min(day) FROM s), (SELECT max(day) FROM s), INTERVAL 1 DAY))::DATE AS day) WHERE day NOT IN (SELECT day FROM s)""")
def missing_days(spark: SparkSession, sf: str) -> DataFrame:
    return quality.missing_days(table(spark, sf, "orders"), F.to_date("o_orderdate")).withColumn("day", F.col("day").cast("string"))


@query(r"""
WITH t AS (SELECT text, DATE '2024-01-01' + CAST(conv_id % 40 AS INTEGER) AS day, replace(replace(lower(coalesce(text, '')), '’', ''''), '‘', '''') AS low FROM conversations),
k AS (SELECT text, day, trim(regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim(regexp_replace(replace(low, 'ß', 'ss'), '[\s\p{Z}]+', ' ', 'g')), '[&\-.,/_]+', ' ', 'g'), '''', ' ', 'g'),
  '[^\p{L}\p{N}_\s\p{Z}#$]', ' ', 'g'), '[\s\p{Z}]+', ' ', 'g')), '^#', '')) AS k FROM t),
g AS (SELECT day, k, count(DISTINCT text) AS variants, count(*) AS n, CAST(count(*) - count(DISTINCT text) - max(CASE WHEN text IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS duplicates_before, count(*) - 1 AS duplicates_after FROM k GROUP BY 1, 2)
SELECT CAST(day AS VARCHAR) AS day, k, variants, n, duplicates_before, duplicates_after, 'group' AS level FROM g WHERE variants > 1
UNION ALL SELECT NULL, NULL, CAST(coalesce(sum(variants), 0) AS BIGINT), CAST(coalesce(sum(n), 0) AS BIGINT), CAST(coalesce(sum(duplicates_before), 0) AS BIGINT), CAST(coalesce(sum(duplicates_after), 0) AS BIGINT), 'all' FROM g""")
def duplicate_impact(spark: SparkSession, sf: str) -> DataFrame:
    said = table(spark, sf, "conversations").select("text", T.trend_name(F.col("text"))["normalized_key_no_hash"].alias("k"), _said_on().alias("day"))
    return quality.duplicate_impact(said, ["k"], "text", "day").withColumn("day", F.col("day").cast("string"))


@query(r"""SELECT count(*) AS n, count(*) FILTER (contains(url, '#')) AS with_hash, count(*) FILTER (contains(url, '&')) AS with_ampersand, count(*) FILTER (contains(url, '''')) AS with_apostrophe, count(*) FILTER (contains(url, '-')) AS with_hyphen,
count(*) FILTER (contains(url, ',')) AS with_comma, count(*) FILTER (contains(url, '.')) AS with_period, count(*) FILTER (regexp_matches(url, '[0-9]')) AS with_digit, count(*) FILTER (contains(url, '$')) AS with_dollar,
count(*) FILTER (regexp_matches(url, '[^\x00-\x7F]')) AS with_non_ascii, count(*) FILTER (regexp_matches(url, '\S\s+\S')) AS with_multi_word FROM pages""")
def text_noise(spark: SparkSession, sf: str) -> DataFrame:
    return quality.text_noise(table(spark, sf, "pages"), "url")


@query("SELECT source, count(*) AS rows, count(DISTINCT text) AS distinct_texts, count(*) FILTER (trim(text) <> '') AS with_text FROM documents GROUP BY source")
def source_ranking(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(F.sha2("text", 256)).alias("distinct_texts"), F.count_if(F.trim("text") != "").alias("with_text"))


@query("SELECT CAST(event_type AS VARCHAR) AS value, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, value LIMIT 3")
def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    return relational.top_counts(table(spark, sf, "events"), "event_type", 3)


@query("""WITH a AS (SELECT source AS family, count(*) AS local_rows, count(DISTINCT doc_id) AS local_keys FROM documents GROUP BY 1),
b AS (SELECT source AS family, count(*) AS landing_rows, count(DISTINCT doc_id) AS landing_keys FROM documents WHERE doc_id IN (SELECT doc_id FROM labels) GROUP BY 1)
SELECT family, local_rows, local_keys, landing_rows, landing_keys, local_rows IS NOT DISTINCT FROM landing_rows AND local_keys IS NOT DISTINCT FROM landing_keys AS agrees FROM a FULL JOIN b USING (family)""")
def load_parity(spark: SparkSession, sf: str) -> DataFrame:
    """All documents against those that have landed a label."""
    docs = table(spark, sf, "documents").select(F.col("source").alias("family"), "doc_id")
    return quality.parity(docs, docs.join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi"), "family", "doc_id")


@query("SELECT quality, toxic, count(*) AS n FROM labels GROUP BY 1, 2")
def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return quality.confusion(table(spark, sf, "labels"), "quality", "toxic")


@query("""WITH c AS (SELECT c, count(*) FILTER (quality = c AND toxic = c) AS hits, count(*) FILTER (quality = c) AS support, count(*) FILTER (toxic = c) AS named FROM labels, (VALUES (0), (1)) v(c) GROUP BY c),
m AS (SELECT *, CASE WHEN named > 0 THEN hits / named ELSE 0 END AS p, CASE WHEN support > 0 THEN hits / support ELSE 0 END AS r FROM c)
SELECT round(sum(hits) / sum(support), 9) AS accuracy, round(avg(p), 9) AS macro_precision, round(avg(r), 9) AS balanced_accuracy, round(avg(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END), 9) AS macro_f1 FROM m""")
def classification_metrics(spark: SparkSession, sf: str) -> DataFrame:
    got = quality.class_metrics(table(spark, sf, "labels"), "quality", "toxic")
    return got.select(*[F.round(c, 9).alias(c) for c in got.columns])


@query("""SELECT f AS field, CASE f WHEN 'k' THEN count(*) FILTER (NOT contains(props, '"k"')) ELSE count(*) END AS missing, CAST(0 AS BIGINT) AS nulls FROM events, (VALUES ('k'), ('zz')) v(f) GROUP BY f""")
def required_fields(spark: SparkSession, sf: str) -> DataFrame:
    return quality.required_fields(table(spark, sf, "events"), "props", ["k", "zz"])


# Events and queue state

#: Frames in fourteen shapes, in turn: a record of its own; null, a string or a number in its place, with or without `value`; records by cid; no repo; ops that are no list; both maps; an operation
#: that is no object; other actions, collections and paths; and every alias.
_OP = """'"path":"', CASE event_id % 14 WHEN 11 THEN 'app.bsky.feed.like/' WHEN 12 THEN 'nopath' WHEN 13 THEN '/app.bsky.feed.post/' ELSE 'app.bsky.feed.post/' END, event_id, '","cid":"c', event_id, '"',
  CASE event_id % 14 WHEN 1 THEN concat(',"record":null,"value":', props) WHEN 2 THEN ',"record":"x"' WHEN 3 THEN concat(',"record":5,"value":', props) WHEN 4 THEN ',"record":null' WHEN 5 THEN ',"record":null'
    WHEN 8 THEN '' ELSE concat(',"record":', props) END, '}'"""
_FRAME = f"""concat('{{"', if(event_id % 14 = 13, 'type":"commit', 't":"#commit'), '","seq":', event_id, ',"time":"', ts, '"', CASE event_id % 14 WHEN 6 THEN '' WHEN 13 THEN concat(',"repo_did":"did:', user_id, '"') ELSE concat(',"repo":"did:', user_id, '"') END,
  CASE event_id % 14 WHEN 4 THEN concat(',"records_by_cid":{{"c', event_id, '":', props, '}}') WHEN 8 THEN concat(',"records_by_cid":{{"c', event_id, '":', props, '}},"blocks":{{"c', event_id, '":{{"k":-1}}}}') ELSE '' END,
  ',"ops":', if(event_id % 14 = 7, '{{}}', concat('[', if(event_id % 14 = 9, '5,', ''), '{{"', if(event_id % 14 = 13, 'op', 'action'), '":"', if(event_id % 14 = 10, 'delete', 'create'), '",', {_OP}, ']')), '}}')"""


@query("""SELECT CASE WHEN c NOT IN (6, 7) THEN 'at://did:' || user_id || '/app.bsky.feed.post/' || event_id END AS uri, event_id AS seq, CASE WHEN c <> 6 THEN 'did:' || user_id END AS repo_did, CASE WHEN c NOT IN (6, 7) THEN CAST(event_id AS VARCHAR) END AS rkey,
  CASE WHEN c NOT IN (6, 7) THEN 'c' || event_id END AS cid, CASE WHEN c IN (6, 7) THEN NULL WHEN c = 8 THEN -1 ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k, CASE c WHEN 6 THEN 'commit without repo' WHEN 7 THEN 'commit without a list of ops' END AS extract_error
FROM (SELECT *, event_id % 14 AS c FROM events) WHERE c NOT IN (2, 5, 10, 11, 12)""")
def extract_creates(spark: SparkSession, sf: str) -> DataFrame:
    frames = table(spark, sf, "events").select(F.expr(_FRAME).alias("value"))
    named = lambda c: F.when(F.col("extract_error").isNull(), F.col(c)).alias(c)
    return ev.extract(ev.decode(frames)).select("uri", "seq", "repo_did", named("rkey"), "cid", F.try_variant_get("record", "$.k", "bigint").alias("k"), "extract_error")


def _state(spark: SparkSession, sf: str) -> DataFrame:
    words = F.element_at(F.array(*map(F.lit, ("pending", "claimed", "retryable", "hydrated"))), (F.col("event_id") % 4 + 1).cast("int"))
    rows = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("captured_at"), words.alias("status"), (F.col("event_id") % 3).cast("int").alias("attempts"))
    return rows.withColumn("claim_expires", F.when(F.col("status") == "claimed", F.col("captured_at") + F.expr("INTERVAL 1 DAY")))


def _now():
    return F.lit("2024-01-20 00:00:00").cast("timestamp")


_STATE = """WITH s AS (SELECT event_id, ts AS captured_at, ['pending', 'claimed', 'retryable', 'hydrated'][event_id % 4 + 1] AS status, CAST(event_id % 3 AS INTEGER) AS attempts,
  CASE WHEN event_id % 4 = 1 THEN ts + INTERVAL 1 DAY END AS claim_expires FROM events)
"""


@query(_STATE + """, p AS (SELECT event_id FROM s WHERE status IN ('pending', 'retryable') AND captured_at <= TIMESTAMP '2024-01-20' - INTERVAL 24 HOUR ORDER BY captured_at, event_id LIMIT 200)
SELECT event_id, CASE WHEN p.event_id IS NOT NULL THEN 'claimed' ELSE status END AS status, attempts + CASE WHEN p.event_id IS NOT NULL THEN 1 ELSE 0 END AS attempts FROM s LEFT JOIN p USING (event_id)""")
def claim_batch(spark: SparkSession, sf: str) -> DataFrame:
    return state.claim(_state(spark, sf), _now(), "event_id").select("event_id", "status", "attempts")


@query(_STATE + "SELECT event_id, CASE WHEN status = 'claimed' AND claim_expires <= TIMESTAMP '2024-01-20' THEN 'pending' ELSE status END AS status, attempts FROM s")
def release_expired(spark: SparkSession, sf: str) -> DataFrame:
    return state.release_expired(_state(spark, sf), _now()).select("event_id", "status", "attempts")


def _outcomes(spark: SparkSession, sf: str) -> DataFrame:
    claims = _state(spark, sf).where("status = 'claimed'").withColumn("attempts", F.col("attempts") + 1)
    codes = F.element_at(F.array(*map(F.lit, (200, 429, 503, 400))), (F.col("event_id") % 7 % 4 + 1).cast("int"))
    answers = _state(spark, sf).where("event_id % 5 <> 0").select("event_id", codes.alias("response_code"))
    return state.classify_outcomes(claims, answers, "event_id")


_OUTCOME = """, o AS (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN CASE WHEN attempts + 1 >= 3 THEN 'missing' ELSE 'retryable' END
  ELSE ['hydrated', 'retryable', 'retryable', 'failed'][event_id % 7 % 4 + 1] END AS outcome FROM s WHERE status = 'claimed')
"""


@query(_STATE + _OUTCOME + "SELECT event_id, outcome FROM o")
def outcome_classify(spark: SparkSession, sf: str) -> DataFrame:
    return _outcomes(spark, sf).select("event_id", "outcome")


@query(_STATE + _OUTCOME + "SELECT event_id, coalesce(outcome, status) AS status FROM s LEFT JOIN o USING (event_id)")
def mark_terminal(spark: SparkSession, sf: str) -> DataFrame:
    return state.mark(_state(spark, sf), _outcomes(spark, sf), "event_id").select("event_id", "status")


@query(_STATE + """SELECT max(captured_at) <= TIMESTAMP '2024-01-19' AS is_mature, count(*) FILTER (status IN ('pending', 'retryable') AND captured_at <= TIMESTAMP '2024-01-19') AS mature_unresolved, count(*) FILTER (status = 'claimed') AS claimed,
max(captured_at) <= TIMESTAMP '2024-01-19' AND count(*) FILTER (status IN ('pending', 'retryable') AND captured_at <= TIMESTAMP '2024-01-19') = 0 AND count(*) FILTER (status = 'claimed') = 0 AS passes FROM s""")
def completion_gate(spark: SparkSession, sf: str) -> DataFrame:
    return state.completion_gate(_state(spark, sf), _now())


@query("""SELECT did, CASE WHEN min(s) = 0 THEN 'hydrated' ELSE 'captured' END AS seed_source FROM (SELECT CAST(user_id AS VARCHAR) AS did, CASE WHEN event_id % 4 = 3 THEN 0 ELSE 1 END AS s FROM events)
WHERE did NOT IN (SELECT CAST(user_id AS VARCHAR) FROM events WHERE user_id % 10 = 0) GROUP BY did""")
def seed_actors(spark: SparkSession, sf: str) -> DataFrame:
    seen = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("did"), "event_id", "user_id")
    return state.seed_actors(seen.where("user_id % 10 = 0").select("did").distinct(), seen.where("event_id % 4 = 3"), seen, "did")


@query("SELECT user_id, event_id, event_type, ts FROM events WHERE user_id % 2 = 1 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1")
def dedupe_insert(spark: SparkSession, sf: str) -> DataFrame:
    """Of the users that the state of even ones doesn't hold, the last event each."""
    rows = table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts").withColumns({"back": -F.unix_micros(F.col("ts").cast("timestamp")), "own": -F.col("event_id")})
    return state.insert_new(rows.where("user_id % 2 = 0"), rows, "user_id", ["back", "own"]).drop("back", "own")


# Sets and manifests


@query("SELECT 'orders' AS family, count(*) AS n FROM orders UNION ALL SELECT 'events', count(*) FROM events UNION ALL SELECT 'documents', count(*) FROM documents UNION ALL SELECT 'pages', count(*) FROM pages")
def landing_counts(spark: SparkSession, sf: str) -> DataFrame:
    one = [table(spark, sf, n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("family"), "n") for n in ("orders", "events", "documents", "pages")]
    return one[0].unionByName(one[1]).unionByName(one[2]).unionByName(one[3])


@query("SELECT l_returnflag AS family, count(*) AS files, CAST(sum(l_linenumber) AS BIGINT) AS rows_loaded FROM lineitem GROUP BY 1 ORDER BY 1")
def manifest_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("family")).agg(F.count(F.lit(1)).alias("files"), F.sum("l_linenumber").alias("rows_loaded")).orderBy("family")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def manifest_anti(spark: SparkSession, sf: str) -> DataFrame:
    """Files the manifest doesn't hold."""
    return table(spark, sf, "orders").select("o_orderkey").join(table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti")


@query("SELECT source, count(DISTINCT doc_id) AS keys, count(DISTINCT l.doc_id) AS shared, round(count(DISTINCT l.doc_id) / count(DISTINCT d.doc_id), 9) AS overlap_rate FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY source".replace("count(DISTINCT doc_id) AS keys", "count(DISTINCT d.doc_id) AS keys"))
def source_overlap(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "source")
    hits = table(spark, sf, "labels").select("doc_id").distinct().withColumn("hit", F.col("doc_id"))
    both = docs.join(hits, "doc_id", "left").groupBy("source").agg(F.countDistinct("doc_id").alias("keys"), F.countDistinct("hit").alias("shared"))
    return both.withColumn("overlap_rate", F.round(F.col("shared") / F.col("keys"), 9))


@query("SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey FROM orders")
def key_overlap(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("k")).intersect(table(spark, sf, "orders").select("o_custkey"))


@query("SELECT coalesce(d.doc_id, l.doc_id) AS uri, d.doc_id IS NOT NULL AS in_raw, l.doc_id IS NOT NULL AS in_hydrated FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id")
def prepare_posts(spark: SparkSession, sf: str) -> DataFrame:
    """Keyed full outer join of the two families."""
    raw = table(spark, sf, "documents").select("doc_id").withColumn("in_raw", F.lit(True))
    hydrated = table(spark, sf, "labels").select("doc_id").withColumn("in_hydrated", F.lit(True))
    no = F.lit(False)
    return raw.join(hydrated, "doc_id", "full").select(F.col("doc_id").alias("uri"), F.coalesce("in_raw", no).alias("in_raw"), F.coalesce("in_hydrated", no).alias("in_hydrated"))


# Models


@query("""SELECT label, CASE WHEN r <= CASE WHEN n <= 1 THEN 0 ELSE least(n - 1, greatest(1, round_even(n * 0.3, 0))) END THEN 'test' ELSE 'train' END AS split, vec_id
FROM (SELECT label, vec_id, count(*) OVER (PARTITION BY label) AS n, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || vec_id), vec_id) AS r FROM embeddings)""")
def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    return models.stratified_split(table(spark, sf, "embeddings").select("vec_id", "label"), "label", "vec_id")


@query("SELECT s_suppkey, round((s_acctbal - avg(s_acctbal) OVER ()) / stddev_pop(s_acctbal) OVER (), 9) AS s_acctbal FROM supplier")
def standardize(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_acctbal")
    return models.encode(rows, rows, ["s_acctbal"]).select("s_suppkey", F.round("s_acctbal", 9).alias("s_acctbal"))


@query("""WITH r AS (SELECT doc_id, toxic, row_number() OVER (PARTITION BY toxic ORDER BY md5('42:' || doc_id), doc_id) - 1 AS r, count(*) OVER (PARTITION BY toxic) AS n FROM labels)
SELECT doc_id, toxic, copy FROM (SELECT doc_id, toxic, unnest(range(0, CAST(((SELECT max(n) FROM r) - 1 - r) // n + 1 AS BIGINT))) AS copy FROM r)""")
def balanced_resample(spark: SparkSession, sf: str) -> DataFrame:
    return models.balanced_resample(table(spark, sf, "labels").select("doc_id", "toxic"), "toxic", "doc_id")


def _vectors(spark: SparkSession, sf: str) -> tuple[DataFrame, list[str]]:
    """The split vectors, a column per component, and the columns' names."""
    vectors = table(spark, sf, "embeddings")
    names = [f"x{i}" for i in range(vectors.agg(F.max(F.size("embedding"))).first()[0])]
    base = vectors.select("vec_id", F.col("label").cast("string").alias("label"), *[F.col("embedding")[i].cast("double").alias(x) for i, x in enumerate(names)])
    return models.stratified_split(base, "label", "vec_id"), names


def _model(spark: SparkSession, sf: str, kind) -> DataFrame:
    split, names = _vectors(spark, sf)
    fitted = kind(names, "label").fit(split.where("split = 'train'"))
    return fitted.transform(split.where("split = 'test'")).select("vec_id", "label", "prediction")


@query()
def softmax_model(spark: SparkSession, sf: str) -> DataFrame:
    return _model(spark, sf, models.softmax_regression)


@query()
def stump_model(spark: SparkSession, sf: str) -> DataFrame:
    split, names = _vectors(spark, sf)
    fitted = stumps.fit(split.where("split = 'train'"), names, "label", "vec_id")
    return fitted.transform(split.where("split = 'test'")).select("vec_id", "label", "prediction", F.transform("probability", lambda p: F.round(p, 9)).alias("probability"))
