"""The queries of this folder's operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat, exact_dedup, html_text, importance, licences, mixing, near_dedup, packing, quality_rules, sequences, topk, toxicity, warc
from .frames import read_table, text_of


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.reply_order(read_table(spark, sf_dir, "conversations"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", mixing.words(text_of("text")).alias("size"))
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.classify(docs, read_table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(read_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.mark_copies(docs, keep="max").select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(read_table(spark, sf_dir, "pages"))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dedup.near_classes(docs).select("doc_id", "class_id", "class_size", "n_links", "kept")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(read_table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op11_event_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    second = F.lit(1_000_000)
    clicks = read_table(spark, sf_dir, "clicks").where("client_id is not null and ts is not null and kind is not null")
    at, marked = sequences.micros(F.col("ts")), F.crc32(F.col("click_id").cast("string").cast("binary")) % 5 == 0
    event = lambda t, kind: F.struct(t.alias("t"), kind.alias("kind"))
    own = event(at, F.col("kind"))
    around = F.array(own, event(at - second, F.lit("open")), event(at + second, F.lit("shut")))
    events = clicks.select(F.col("client_id").alias("client"), F.explode(F.when(marked, around).otherwise(F.array(own))).alias("e")).select("client", "e.t", "e.kind")
    found = sequences.frequent(events, gap=900_000_000, span=2_250_000_000)
    return found.select("pattern", "length", "support", "clients_crc", "n_wider", "closed")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance.importance(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality_rules.cleaned(docs, with_text=False)
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}
    return dict(sorted(found.items(), key=lambda kv: int(kv[0][2:].split("_")[0])))


MIX_SQL = f"""
WITH docs AS (
  SELECT doc_id, source, md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS docs FROM docs GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS place FROM s0),
s2 AS (SELECT *, CAST((place % 3) + 1 AS DOUBLE) AS weight FROM s1),
s3 AS (SELECT *, row_number() OVER w AS spot,
         (sum(source_size) OVER () - coalesce(sum({mixing.MOST_REPEATS} * source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
       FROM s2 WINDOW w AS (ORDER BY source_size / weight, place)),
f AS (SELECT min(spot) AS first_spot, arg_min(level, spot) AS level FROM s3 WHERE {mixing.MOST_REPEATS} * source_size >= level * weight),
t AS (SELECT place, source, source_size, docs,
        CASE WHEN spot < first_spot THEN CAST({mixing.MOST_REPEATS} * source_size AS DOUBLE) ELSE f.level * weight END AS target FROM s3, f),
n AS (SELECT *, CAST(round(sum(target) OVER () / {mixing.BLOCK_WORDS}) AS BIGINT) AS seats, target / nullif(sum(target) OVER (), 0) AS unit, count(*) OVER () AS members FROM t),
q AS (SELECT place, k, target / (2 * k + 1) AS quotient, seats
      FROM (SELECT *, unnest(range(0, CAST(floor(coalesce(unit, 0) * (seats + members / 2.0) + 0.5) AS BIGINT) + 2)) AS k FROM n WHERE target > 0)),
won AS (SELECT place, count(*) AS quota FROM (SELECT *, row_number() OVER (ORDER BY quotient DESC, place, k) AS r FROM q) WHERE r <= seats GROUP BY place),
placed AS (SELECT d.*, n.place, n.docs, n.source_size, n.target, coalesce(won.quota, 0) AS quota,
             CAST('0x' || substr(d.key, 1, 8) AS BIGINT) % CAST(ceil(n.docs / {mixing.SHARD_ROWS}.0) AS BIGINT) AS shard
           FROM docs d JOIN n ON d.source IS NOT DISTINCT FROM n.source LEFT JOIN won ON won.place = n.place),
sh AS (SELECT place, shard, CAST(sum(size) AS BIGINT) AS words, any_value(quota) AS quota FROM placed GROUP BY place, shard),
sn AS (SELECT *, words / nullif(sum(words) OVER (PARTITION BY place), 0) AS unit, count(*) OVER (PARTITION BY place) AS members FROM sh),
sq AS (SELECT place, shard, k, words / (2 * k + 1) AS quotient, quota
       FROM (SELECT *, unnest(range(0, CAST(floor(coalesce(unit, 0) * (quota + members / 2.0) + 0.5) AS BIGINT) + 2)) AS k FROM sn WHERE words > 0)),
sw AS (SELECT place, shard, count(*) AS blocks FROM (SELECT *, row_number() OVER (PARTITION BY place ORDER BY quotient DESC, shard, k) AS r FROM sq) WHERE r <= quota GROUP BY place, shard),
laid AS (SELECT p.*, coalesce(sw.blocks, 0) AS blocks,
           CAST(sum(p.size) OVER (PARTITION BY p.place, p.shard ORDER BY p.key, p.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - p.size AS start,
           CAST(sum(p.size) OVER (PARTITION BY p.place, p.shard) AS BIGINT) AS whole
         FROM placed p LEFT JOIN sw ON sw.place = p.place AND sw.shard = p.shard),
asked AS (SELECT *, CAST(least(blocks * {mixing.BLOCK_WORDS}, {mixing.MOST_REPEATS} * whole) AS BIGINT) AS wanted FROM laid),
cp AS (SELECT *, CASE WHEN whole > 0 THEN wanted // whole ELSE 0 END AS copies FROM asked)
SELECT doc_id, size, source_size, target,
       CAST(copies * size + greatest(0, least(size, wanted - copies * whole - start)) AS BIGINT) AS taken
FROM cp"""

TOPK_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
p AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20"""

WARC_SQL = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN first END AS refers_to
FROM g"""

DEDUP_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))"""


#: The table of CRC-32 by its rule, and the check sum of a text of ASCII characters.
CRC_TABLE = "(SELECT list(v ORDER BY n) FROM (SELECT n, list_reduce(list_concat([n], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(n)))"
CRC = "xor(list_reduce(list_concat([4294967295::BIGINT], {bytes}), lambda c, b: xor(c >> 8, {table}[xor(c, b) & 255 + 1])), 4294967295)".replace("xor(c, b) & 255 + 1", "(xor(c, b) & 255) + 1")


def crc_of_number(text: str) -> str:
    return CRC.format(bytes=f"list_transform(range(1, length({text}) + 1), lambda i: CAST(ascii(substr({text}, i, 1)) AS BIGINT))", table="crc_table")


def _chain(m: int) -> str:
    """Latest starts of patterns of m kinds by client and end, from those of m - 1 kinds."""
    return f"""l{m} AS (SELECT e.client, e.t, list_append(p.kinds, e.kind) AS kinds, max(p.start) AS start FROM l{m - 1} p JOIN e ON e.client = p.client AND e.t > p.t AND e.t <= p.t + 900000000
  WHERE e.t - p.start <= 2250000000 GROUP BY ALL)"""


SEQUENCE_SQL = f"""
WITH x AS (SELECT {CRC_TABLE} AS crc_table),
c AS (SELECT client_id AS client, epoch_us(ts) AS t, kind, {crc_of_number('CAST(click_id AS VARCHAR)')} % 5 = 0 AS marked FROM clicks, x WHERE client_id IS NOT NULL AND ts IS NOT NULL AND kind IS NOT NULL),
e AS (SELECT client, t, kind FROM c UNION SELECT client, t - 1000000, 'open' FROM c WHERE marked UNION SELECT client, t + 1000000, 'shut' FROM c WHERE marked),
l1 AS (SELECT client, t, [kind] AS kinds, t AS start FROM e),
{_chain(2)}, {_chain(3)}, {_chain(4)},
s AS (SELECT DISTINCT client, kinds FROM (SELECT client, kinds FROM l1 UNION ALL SELECT client, kinds FROM l2 UNION ALL SELECT client, kinds FROM l3 UNION ALL SELECT client, kinds FROM l4)),
k AS (SELECT kinds, count(*) AS support, CAST(sum({crc_of_number('CAST(client AS VARCHAR)')}) AS BIGINT) AS clients_crc FROM s, x GROUP BY kinds),
f AS (SELECT * FROM k WHERE support >= 2 AND support * 100 >= 30 * (SELECT count(DISTINCT client) FROM e)),
sub AS (SELECT DISTINCT kinds AS wider, support, list_filter(kinds, lambda y, i: (bits >> (i - 1)) & 1 = 1) AS kinds FROM f, range(1, 15) b(bits) WHERE bits < (1 << len(kinds)) - 1),
w AS (SELECT f.kinds, count(*) AS n FROM f JOIN sub ON sub.kinds = f.kinds AND sub.support = f.support GROUP BY f.kinds)
SELECT array_to_string(f.kinds, '>') AS pattern, CAST(len(f.kinds) AS INTEGER) AS length, support, clients_crc, coalesce(w.n, 0) AS n_wider, coalesce(w.n, 0) = 0 AS closed
FROM f LEFT JOIN w ON w.kinds = f.kinds"""


def _runs(table: str) -> str:
    return f"""(SELECT row, unnest(grams) AS gram FROM (SELECT row, [a, a || ' ' || b, a || ' ' || b || ' ' || c] AS grams FROM (SELECT row, a, lead(a) OVER o AS b, lead(a, 2) OVER o AS c
    FROM (SELECT row, unnest(words) AS a, generate_subscripts(words, 1) AS i FROM {table}) WINDOW o AS (PARTITION BY row ORDER BY i))))"""


def _words(table: str, ident: str) -> str:
    return f"SELECT row_number() OVER () AS row, {ident} AS doc_id, regexp_extract_all(translate(coalesce(text, ''), '{importance.UPPER}', '{importance.LOWER}'), '{importance.WORD}') AS words FROM {table}"


_GRAM_BYTES = "list_transform(range(1, strlen(gram) + 1), lambda i: CAST('0x' || substr(hexed, 2 * i - 1, 2) AS BIGINT))"

IMPORTANCE_SQL = f"""
WITH x AS (SELECT {CRC_TABLE} AS crc_table),
d AS MATERIALIZED ({_words('documents', 'doc_id')}), b AS MATERIALIZED ({_words('benchmark', 'item_id')}),
dg AS MATERIALIZED (SELECT row, gram, count(*) AS n FROM {_runs('d')} WHERE gram IS NOT NULL GROUP BY ALL), bg AS MATERIALIZED (SELECT gram, count(*) AS n FROM {_runs('b')} WHERE gram IS NOT NULL GROUP BY ALL),
u AS MATERIALIZED (SELECT gram, {CRC.format(bytes=_GRAM_BYTES, table='crc_table')} % {importance.BUCKETS} AS bucket FROM (SELECT gram, hex(encode(gram)) AS hexed FROM (SELECT gram FROM dg UNION SELECT gram FROM bg)), x),
s AS (SELECT bucket, sum(n) AS s FROM dg JOIN u USING (gram) GROUP BY bucket), t AS (SELECT bucket, sum(n) AS t FROM bg JOIN u USING (gram) GROUP BY bucket),
a AS (SELECT (SELECT coalesce(sum(n), 0) FROM dg) AS big_s, (SELECT coalesce(sum(n), 0) FROM bg) AS big_t),
gain AS (SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * (big_s + {importance.BUCKETS}) / (CAST(s + 1 AS DOUBLE) * (big_t + {importance.BUCKETS})))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (bucket), a),
w AS (SELECT row, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS weight FROM dg JOIN u USING (gram) JOIN gain USING (bucket) GROUP BY row),
e AS (SELECT doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{importance.SEED}:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM d LEFT JOIN w USING (row)),
r AS (SELECT *, CASE WHEN n_words >= {importance.LEAST_WORDS} THEN row_number() OVER (PARTITION BY n_words >= {importance.LEAST_WORDS} ORDER BY score DESC, doc_id) END AS place, count(*) FILTER (n_words >= {importance.LEAST_WORDS}) OVER () AS fit FROM e)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {importance.SHARE} * fit // 100 THEN place END AS rank FROM r"""


def oracle_sql() -> dict[str, str]:
    return {"op2_source_mixing": MIX_SQL, "op3_exact_topk": TOPK_SQL, "op5_warc": WARC_SQL, "op6_exact_dedup": DEDUP_SQL, "op9_license_scan": licences.scan_sql(), "op11_event_sequences": SEQUENCE_SQL, "op12_importance_resampling": IMPORTANCE_SQL, "op13_quality_rules": quality_rules.RULES_SQL}
