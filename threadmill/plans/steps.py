"""Queries of single functions and steps (scores of keys, candidates, lifecycles, file names, model inputs) on the driver's tables, each with SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from threadmill.functions import text as T
from threadmill.operators import candidates, lifecycle, models, state
from threadmill.plans.registry import SQL, _POST, query, table
from threadmill.sources import contracts, events, files

# Candidates and scores


def _listed(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


_STOP, _LINKS = _listed(candidates.STOPWORDS), _listed(sorted(candidates.ARTIFACTS))

#: A hashtag's place is that of its text, which is its own unless the same letters follow a word before.
SQL["topic_candidates"] = _POST + rf"""
, w AS (SELECT doc_id, clean, list_filter(string_split(alnum, ' '), lambda t: t <> '') AS ws FROM p),
words AS (SELECT doc_id, unnest(ws) AS a, generate_subscripts(ws, 1) - 1 AS i FROM w),
f AS (SELECT doc_id, i, a, a IN ({_STOP}) AS s, CAST(a IN ({_LINKS}) AS INTEGER) AS l, length(a) >= 10 AND regexp_matches(a, '[a-z]') AND regexp_matches(a, '[0-9]') AS x FROM words),
n AS (SELECT doc_id, i, unnest([1, 2, 3, 4]) AS n, a, s, l, x, lead(a) OVER o AS b, lead(s) OVER o AS sb, lead(l) OVER o AS lb, lead(x) OVER o AS xb, lead(a, 2) OVER o AS c, lead(s, 2) OVER o AS sc, lead(l, 2) OVER o AS lc, lead(x, 2) OVER o AS xc,
  lead(a, 3) OVER o AS d, lead(s, 3) OVER o AS sd, lead(l, 3) OVER o AS ld, lead(x, 3) OVER o AS xd FROM f WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
g AS (SELECT doc_id, i, n, CASE n WHEN 1 THEN a WHEN 2 THEN a || ' ' || b WHEN 3 THEN a || ' ' || b || ' ' || c ELSE a || ' ' || b || ' ' || c || ' ' || d END AS phrase, s AS first_stop, CASE n WHEN 1 THEN s WHEN 2 THEN sb WHEN 3 THEN sc ELSE sd END AS last_stop,
  l + CASE WHEN n > 1 THEN lb ELSE 0 END + CASE WHEN n > 2 THEN lc ELSE 0 END + CASE WHEN n > 3 THEN ld ELSE 0 END AS links, x OR (n > 1 AND xb) OR (n > 2 AND xc) OR (n > 3 AND xd) AS id_like FROM n),
k AS (SELECT doc_id, 'ngram_' || n AS source, 5 - n AS place, i, phrase, phrase AS own, n FROM g WHERE n > 1 AND phrase IS NOT NULL AND length(phrase) BETWEEN 3 AND 64 AND NOT first_stop AND NOT last_stop AND links < 2 AND links * 2 < n AND NOT id_like),
t AS (SELECT doc_id, clean, unnest(regexp_extract_all(clean, '(?:^|[^\p{{L}}\p{{N}}_])(#[\p{{L}}\p{{N}}_]+)', 1)) AS tag FROM w),
h AS (SELECT doc_id, 'hashtag' AS source, 0 AS place, strpos(clean, tag) - 1 AS i, tag AS phrase, trim(regexp_replace(tag, '[^a-z0-9]+', ' ', 'g')) AS own FROM t),
hk AS (SELECT *, len(string_split(own, ' ')) AS n FROM h WHERE own <> '' AND length(phrase) BETWEEN 3 AND 64 AND len(list_filter(string_split(own, ' '), lambda y: y NOT IN ({_STOP}))) > 0 AND len(string_split(own, ' ')) <= 4
  AND CASE WHEN len(string_split(own, ' ')) = 1 THEN length(own) >= 3 AND own NOT IN ({_LINKS}) AND own <> 'macro' ELSE len(list_filter(string_split(own, ' '), lambda y: y IN ({_LINKS}))) < 2 AND len(list_filter(string_split(own, ' '), lambda y: y IN ({_LINKS}))) * 2 < len(string_split(own, ' ')) END),
longer AS (SELECT * FROM hk UNION ALL SELECT * FROM k),
single AS (SELECT doc_id, 'unigram_fallback' AS source, 9 AS place, i, phrase, phrase AS own, n FROM g WHERE n = 1 AND length(phrase) BETWEEN 3 AND 64 AND NOT first_stop AND links = 0 AND phrase <> 'macro' AND NOT id_like AND doc_id NOT IN (SELECT doc_id FROM longer)),
first AS (SELECT * FROM (SELECT * FROM longer UNION ALL SELECT * FROM single) QUALIFY row_number() OVER (PARTITION BY doc_id, own ORDER BY place, i) = 1)
SELECT * FROM (SELECT doc_id AS uri, source AS candidate_source_type, CAST(i AS INTEGER) AS candidate_start_index, phrase AS candidate_phrase_raw, phrase AS candidate_phrase_clean, own AS candidate_phrase_alnum, CAST(n AS BIGINT) AS candidate_token_count,
  CAST(length(phrase) AS BIGINT) AS candidate_char_count, regexp_matches(own, '[0-9]') AS candidate_contains_digit, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY place, i) AS INTEGER) AS candidate_rank_in_post FROM first) WHERE candidate_rank_in_post <= 20"""


@query("""WITH a AS (SELECT item_id AS id, lower(text) AS x FROM benchmark), p AS (SELECT a.id, a.x, b.x AS y FROM a JOIN a b ON b.id = a.id + 1),
xt AS (SELECT id, t, count(*) AS n FROM (SELECT id, unnest(string_split(x, ' ')) AS t FROM p) WHERE t <> '' GROUP BY 1, 2), yt AS (SELECT id, t, count(*) AS n FROM (SELECT id, unnest(string_split(y, ' ')) AS t FROM p) WHERE t <> '' GROUP BY 1, 2),
c AS (SELECT p.id, coalesce((SELECT sum(xt.n * yt.n) FROM xt JOIN yt USING (id, t) WHERE xt.id = p.id), 0) / (sqrt((SELECT sum(n * n) FROM xt WHERE xt.id = p.id)) * sqrt((SELECT sum(n * n) FROM yt WHERE yt.id = p.id))) AS cosine FROM p),
xg AS (SELECT DISTINCT id, substr(x, i, 3) AS g FROM (SELECT id, x, unnest(range(1, length(x) - 1)) AS i FROM p)), yg AS (SELECT DISTINCT id, substr(y, i, 3) AS g FROM (SELECT id, y, unnest(range(1, length(y) - 1)) AS i FROM p)),
j AS (SELECT p.id, (SELECT count(*) FROM xg JOIN yg USING (id, g) WHERE xg.id = p.id) / (SELECT count(*) FROM (SELECT id, g FROM xg UNION SELECT id, g FROM yg) u WHERE u.id = p.id) AS jaccard FROM p)
SELECT id, round(cosine, 9) AS token_cosine, round(jaccard, 9) AS trigram_jaccard, round(0.7 * cosine + 0.3 * jaccard, 9) AS semantic_score FROM c JOIN j USING (id)""")
def text_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Each benchmark item's whole text against the next one's."""
    a = table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), F.lower("text").alias("x"))
    pairs = a.join(a.select((F.col("id") - 1).alias("id"), F.col("x").alias("y")), "id")
    x, y = F.col("x"), F.col("y")
    scores = {"token_cosine": T.token_cosine(T.tokens(x), T.tokens(y)), "trigram_jaccard": T.trigram_jaccard(x, y), "semantic_score": T.semantic_score(x, y)}
    return pairs.select("id", *[F.round(c, 9).alias(name) for name, c in scores.items()])


@query(r"""WITH l AS (SELECT doc_id, source || ' ' || lang || ' ' || n_chars || '!' AS raw FROM documents)
SELECT doc_id, raw AS candidate_phrase_raw, trim(regexp_replace(regexp_replace(raw, '[&\-/_,.;:!?]+', ' ', 'g'), '\s+', ' ', 'g')) AS candidate_phrase_no_hash,
CAST(len(string_split(trim(regexp_replace(raw, '[^a-z0-9]+', ' ', 'g')), ' ')) AS BIGINT) AS candidate_token_count, regexp_matches(raw, '[0-9]') AS candidate_contains_digit FROM l""")
def candidate_phrases(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.concat_ws(" ", "source", "lang", F.concat(F.col("n_chars").cast("string"), F.lit("!")))
    got = table(spark, sf, "documents").select("doc_id", T.candidate_phrase(raw).alias("c"))
    return got.select("doc_id", "c.candidate_phrase_raw", "c.candidate_phrase_no_hash", "c.candidate_token_count", "c.candidate_contains_digit")


@query(r"SELECT conv_id, turn, trim(regexp_replace(replace(lower(text), 'ß', 'ss'), '[\s\p{Z}]+', ' ', 'g')) AS k FROM conversations")
def key_normal(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").select("conv_id", "turn", T.key_normal(F.col("text")).alias("k"))


# Files


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'raw_posts' WHEN 2 THEN 'hydration_misses' END AS family, CASE event_id % 3 WHEN 0 THEN 'raw_posts' WHEN 1 THEN 'actor_profiles' END AS family_of_keys, event_id % 2 = 0 AS same_file FROM events""")
def dataset_families(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("event_id")
    path = F.concat(F.lit("s/"), F.element_at(F.array(*map(F.lit, ("raw_posts", "posts", "hydration_misses", "raw_posts/hydrated_posts"))), (e % 4 + 1).cast("int")), F.lit("/f.gz"))
    row = F.when(e % 3 == 0, '{"repo_did": 1, "has_reply": null, "has_embed": 2, "x": 3}').when(e % 3 == 1, '{"actor_run_id": 1, "followers_count": 2, "follows_count": 3}').otherwise('{"repo_did": 1, "like_count": 2}')
    name = F.concat(F.lit("f"), e.cast("string"), F.lit(".gz"))
    staged = F.concat(F.when(e % 2 == 0, "stage/").otherwise("stage/x"), name)
    return table(spark, sf, "events").select("event_id", events.family_of_path(path).alias("family"), events.family_of_row(row).alias("family_of_keys"), T.file_matches(staged, name).alias("same_file"))


@query("SELECT 'a/t/' || event_id AS file_name, ts AS load_time FROM events WHERE event_id % 3 = 0 AND ts >= TIMESTAMP '2024-01-19'")
def copy_history(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select(F.concat(F.when(F.col("event_id") % 3 == 0, "a/t/").otherwise("a/u/"), F.col("event_id").cast("string")).alias("file_name"), F.col("ts").alias("load_time"))
    return lifecycle.copy_history(rows, "t", F.lit("2024-01-20").cast(dict(rows.dtypes)["load_time"]))


@query("""SELECT page_id, trim(url) AS name, CASE WHEN page_id % 2 = 0 THEN '2024-01-02' END AS day FROM pages""")
def snapshot(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "pages").select("page_id", F.concat(F.lit(" "), "url", F.lit("  ")).alias("name"), F.when(F.col("page_id") % 2 == 0, "2024-01-02").otherwise("no day").alias("date"))
    return files.snapshot(raw).select("page_id", "name", F.col("date").cast("string").alias("day"))


@query("""SELECT * FROM (SELECT 'head' AS part, event_id FROM events ORDER BY event_id LIMIT 25) UNION ALL SELECT * FROM (SELECT 'tail', event_id FROM events ORDER BY event_id DESC LIMIT 25)""")
def head_and_tail(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select("event_id")
    head, tail = files.head_rows(rows, [F.col("event_id").asc()], 25), files.tail_rows(rows, "event_id", 25)
    return head.select(F.lit("head").alias("part"), "event_id").unionByName(tail.select(F.lit("tail").alias("part"), "event_id"))


@query("""WITH n AS (SELECT n_nationkey, row_number() OVER (ORDER BY n_nationkey) - 1 AS i, count(*) OVER () AS c FROM nation)
SELECT CAST(r AS BIGINT) AS fixture_row, n_nationkey FROM (SELECT unnest(range(60)) AS r) JOIN n ON i = r % c""")
def fixture_rows(spark: SparkSession, sf: str) -> DataFrame:
    return files.cycle_rows(table(spark, sf, "nation").select("n_nationkey"), "n_nationkey", 60)


@query("""SELECT doc_id, coalesce(CASE WHEN quality = 1 THEN 'good' END, '') AS word, '{"toxic":' || toxic || '}' AS nested, '[' || quality || ',' || toxic || ']' AS listed FROM labels""")
def csv_cells(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "labels").select("doc_id", F.when(F.col("quality") == 1, "good").alias("word"), F.struct("toxic").alias("nested"), F.array("quality", "toxic").alias("listed"))
    return rows.select("doc_id", *[files.csv_cell(rows, c).alias(c) for c in ("word", "nested", "listed")])


@query("""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN '{"a":1,"b":' || user_id || '}' ELSE '{"a":null,"b":[1,' || user_id || ']}' END AS sorted FROM events""")
def sorted_json(spark: SparkSession, sf: str) -> DataFrame:
    u, e = F.col("user_id").cast("string"), F.col("event_id")
    text = F.when(e % 2 == 0, F.concat(F.lit('{"b": '), u, F.lit(', "a": 1}'))).otherwise(F.concat(F.lit('{"b": [1, '), u, F.lit('], "a": null}')))
    return table(spark, sf, "events").select("event_id", contracts.sorted_json(F.parse_json(text)).alias("sorted"))


# Lifecycles


@query("""SELECT event_id, CASE WHEN event_id = 10 THEN 'completed' WHEN event_id % 3 = 0 THEN 'failed' ELSE 'running' END AS status, CASE WHEN event_id = 10 THEN user_id + 50 ELSE user_id END AS rows,
CASE WHEN event_id = 10 THEN round((user_id + 50) / 100, 9) ELSE 0 END AS rows_per_second FROM events""")
def run_finish(spark: SparkSession, sf: str) -> DataFrame:
    started = F.lit("2024-01-01 00:00:00").cast("timestamp")
    runs = table(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, "failed").otherwise("running").alias("status"), F.col("user_id").alias("rows"), started.alias("started_at"), F.lit(None).cast("timestamp").alias("ended_at"))
    done = lifecycle.finish(lifecycle.add_counters(runs, "event_id", 10, {"rows": 50}), "event_id", 10, "completed", F.lit("2024-01-01 00:01:40").cast("timestamp"))
    return lifecycle.rates(done, ["rows"]).select("event_id", "status", "rows", F.round(F.coalesce("rows_per_second", F.lit(0.0)), 9).alias("rows_per_second"))


@query("SELECT 'p' || event_id AS path, CASE WHEN event_id = 7 THEN 'closed' ELSE 'open' END AS status FROM events UNION ALL SELECT 'new', 'open'")
def batch_files(spark: SparkSession, sf: str) -> DataFrame:
    now = F.lit("2024-01-01").cast("timestamp")
    held = table(spark, sf, "events").select(F.concat(F.lit("p"), F.col("event_id").cast("string")).alias("path"), F.lit("raw").alias("family"), F.lit("open").alias("status"), now.alias("opened_at"), F.lit(None).cast("timestamp").alias("ended_at"))
    return lifecycle.finish(lifecycle.open_file(held, "new", "raw", now), "path", "p7", "closed", now).select("path", "status")


@query("SELECT event_id, least(1.0 * pow(2, event_id % 9), 30.0) AS seconds FROM events")
def backoff(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", state.backoff_seconds(F.col("event_id") % 9 + 1).alias("seconds"))


@query("""SELECT event_id, user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS claim_rank FROM events WHERE event_id % 3 < 2""")
def claim_rank(spark: SparkSession, sf: str) -> DataFrame:
    words = F.element_at(F.array(*map(F.lit, ("pending", "retryable", "claimed"))), (F.col("event_id") % 3 + 1).cast("int"))
    rows = table(spark, sf, "events").select("event_id", "user_id", "ts", words.alias("status"))
    return state.claim_rank(rows, "event_id", "ts", "user_id").select("event_id", "user_id", "claim_rank")


# Model inputs


@query("""SELECT c_custkey, CAST(coalesce(m = 'BUILDING', false) AS DOUBLE) AS building, CAST(coalesce(m = 'MACHINERY', false) AS DOUBLE) AS machinery, CAST(m IS NULL AS DOUBLE) AS missing
FROM (SELECT c_custkey, CASE WHEN c_nationkey > 3 THEN c_mktsegment END AS m FROM customer)""")
def one_hot(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").select("c_custkey", F.when(F.col("c_nationkey") > 3, F.col("c_mktsegment")).alias("m"))
    hot = models.one_hot(rows, "m", ["BUILDING", "MACHINERY"])
    return hot.select("c_custkey", F.col("`m=BUILDING`").alias("building"), F.col("`m=MACHINERY`").alias("machinery"), F.col("`m=__MISSING__`").alias("missing"))


@query("SELECT doc_id, round(count(*) OVER () / ((SELECT count(DISTINCT toxic) FROM labels) * count(*) OVER (PARTITION BY toxic)), 9) AS class_weight FROM labels")
def class_weights(spark: SparkSession, sf: str) -> DataFrame:
    return models.class_weights(table(spark, sf, "labels"), "toxic").select("doc_id", F.round("class_weight", 9).alias("class_weight"))


@query("SELECT source AS model FROM documents GROUP BY 1 ORDER BY round(avg(n_chars), 3) DESC, count(DISTINCT lang) DESC, count(*) DESC, source LIMIT 1")
def model_choice(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").groupBy(F.col("source").alias("model")).agg(F.round(F.avg("n_chars"), 3).alias("macro_f1"), F.countDistinct("lang").alias("balanced_accuracy"), F.count(F.lit(1)).alias("accuracy"))
    return models.better(rows).select("model")
