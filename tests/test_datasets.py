"""Row contracts, files, lifecycles, features and models on small fixtures."""

import gzip
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from threadmill.functions import text as T
from threadmill.operators import candidates, features, lifecycle, matching, models, posts, quality, relational, state, summaries
from threadmill.sources import contracts, events, files
from threadmill.streaming import capture


def variants(spark, rows):
    return spark.createDataFrame([(json.dumps(r),) for r in rows], "j string").select(F.parse_json("j").alias("view"))


def test_hydrated_contract(spark):
    views = variants(spark, [{"uri": "at://x/1", "author": {"did": "d", "handle": "h"}, "likeCount": "7", "replyCount": 2, "quoteCount": "no", "labels": [1], "record": {"text": "t"}}, {"uri": "at://x/2", "author": "gone", "labels": {}, "record": 5}])
    a, b = contracts.hydrated_rows(views, "hyd_1", "cap_1", F.lit("now")).orderBy("uri").collect()
    assert (a["author_did"], a["like_count"], a["reply_count"], a["quote_count"], a["repost_count"]) == ("d", 7, 2, None, None)
    assert b["author_did"] is None and b["record"] is None and str(b["labels"].toPython()) == "[]"
    assert len(a.asDict()) == 15
    p = contracts.actor_rows(views, "act_1", F.lit("now")).collect()
    assert len(p) == 2 and len(p[0].asDict()) == 14


def test_text_and_dates_are_chosen(spark):
    raw = [("u1", "raw one", "", "c", "d", 1), ("u1", "raw later", "x", "c", "d", 2), ("u2", "", None, "c2", "d", 1), ("", "nobody", "x", "c", "d", 1)]
    hyd = [("u1", "better", None, None, "i", "h", "a", "n", 1), ("u3", None, "made", None, "i", "h", "a", "n", 1)]
    r = spark.createDataFrame(raw, "uri string, text string, record_created_at string, captured_at string, repo_did string, position int")
    h = spark.createDataFrame(hyd, "uri string, text string, record_created_at string, x string, indexed_at string, hydrated_at string, author_did string, author_handle string, position int").drop("x")
    got = {x["uri"]: x for x in posts.prepare(r, h, "tag", ["position"]).collect()}
    assert {u: (x["post_text_clean"], x["text_source"], x["post_created_at"]) for u, x in got.items()} == {
        "u1": ("better", "hydrated_record_text", "i"),
        "u2": ("", "none", "c2"),
        "u3": ("", "none", "made"),
    }


def test_a_hashtag_may_begin_with_a_stopword():
    assert candidates.usable("#caféthe", ["caf", "the"], True) and not candidates.usable("caf the", ["caf", "the"], False)


def test_feature_table_keeps_base_rows(spark):
    prepared = spark.createDataFrame([("a", "2024-01-05T10:00:00Z", "Hi!! You", "hi you", 2, "d1"), ("b", None, "", "", 0, None)], "uri string, post_created_at string, post_text_raw string, post_text_alnum string, post_token_count int, hydrated_author_did string")
    best = spark.createDataFrame([("a", s, x, 1.0, 2.0, "t", "2024-01-05", s != "unmatched", True) for s, x in (("fuzzy", 0.9), ("exact", 0.1), ("unmatched", 1.0))], "uri string, match_stage string, match_score double, trend_counts double, trend_num_hours double, trend_name_clean string, trend_date string, is_matched boolean, is_ambiguous boolean")
    matches = spark.createDataFrame([("a", 1, True), ("a", 1, False), ("a", 2, False)], "uri string, candidate_id int, is_matched boolean")
    hydrated = spark.createDataFrame([("a", 1, 2, None, 4, "1", "1"), ("a", 9, 9, 9, 9, "0", "1")], "uri string, like_count int, reply_count int, repost_count int, quote_count int, hydrated_at string, indexed_at string")
    actors = spark.createDataFrame([("d1", 10, 4, 1, " ", "bio", True, None, "1", "1")], "did string, followers_count int, follows_count int, posts_count int, display_name string, description string, has_avatar boolean, has_banner boolean, actor_indexed_at string, actor_created_at string")
    got = {r["uri"]: r for r in features.final_types(features.feature_flags(features.feature_table(prepared, best, matches, hydrated, actors))).collect()}
    a, b = got["a"], got["b"]
    assert len(got) == 2 and a["match_stage"] == "exact" and a["same_day_trend_match"] and a["engagement_total"] == 7.0 and a["candidate_count"] == 2.0
    assert a["actor_followers_to_follows_ratio"] == 2.5 and not a["actor_has_display_name"] and a["actor_has_description"] and a["post_hour_utc"] == 10
    assert b["match_stage"] == "no_candidate" and b["trend_name_clean"] == "" and not b["actor_profile_found"] and b["trend_post_day_diff"] == 0.0
    groups = features.contract_groups(list(a.asDict()))
    assert "engagement_total" in groups["label_columns"] and "uri" in groups["debug_columns"] and "match_score" in groups["model_feature_columns"]
    assert features.ratio(F.lit(1), F.lit(0)) is not None


def write_lines(folder):
    (folder / "sub").mkdir(parents=True)
    (folder / "b.jsonl").write_text('{"n": 3}\n\n  \n{"n": 4}\n')
    with gzip.open(folder / "a.jsonl.gz", "wt") as f:
        f.write('{"n": 1}\n\n{"n": 2}\n')
    (folder / "sub" / "c.jsonl").write_text('{"n": 5}\n')
    (folder / "x.jsonl.tmp").write_text("{}")


def test_strict_reader_numbers_lines_and_rows(spark, tmp_path):
    write_lines(tmp_path / "in")
    rows = files.scan_json(spark, str(tmp_path / "in"), strict=True).orderBy("row_index").collect()
    assert [(r["row_index"], r["line"], json.loads(r["value"])["n"]) for r in rows] == [(1, 1, 1), (2, 3, 2), (3, 1, 3), (4, 4, 4), (5, 1, 5)]
    (tmp_path / "in" / "d.jsonl").write_text("{}\n[1]\n")
    with pytest.raises(PySparkException, match=r"d\.jsonl:2"):
        files.scan_json(spark, str(tmp_path / "in"), strict=True).collect()
    with pytest.raises(FileNotFoundError):
        files.scan_lines(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError):
        files.scan_lines(spark, str(tmp_path / "in" / "x.jsonl.tmp"))


def test_lines_of_split_files_are_numbered(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "big.jsonl").write_text("".join(f'{{"n": {i}}}\n' for i in range(1, 4001)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = files.scan_json(spark, str(tmp_path / "in")).select("line", "row_index", F.try_variant_get("row", "$.n", "int").alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 4000 and all(r["line"] == r["row_index"] == r["n"] for r in rows)


def test_exports_and_stage(spark, tmp_path):
    write_lines(tmp_path / "in")
    source = str(tmp_path / "in")
    assert files.export_sample(spark, source, str(tmp_path / "o" / "t.jsonl"), 2, tail=True) == 2
    assert (tmp_path / "o" / "t.jsonl").read_text() == '{"n":4}\n{"n":5}\n'
    assert files.export_sample(spark, source, str(tmp_path / "h.json"), 3) == 3 and json.loads((tmp_path / "h.json").read_text()) == [{"n": 1}, {"n": 2}, {"n": 3}]
    with pytest.raises(ValueError):
        files.export_sample(spark, source, str(tmp_path / "h.csv"), 3)
    assert files.top_of_lines(spark, source, str(tmp_path / "top"), 4) == 4 and len(gzip.open(tmp_path / "top.jsonl.gz").read().splitlines()) == 4
    put = lambda: files.stage_put(spark, [f"{source}/b.jsonl"], str(tmp_path / "stage"), "tag", "raw_posts", "r1")
    assert put() == [("b.jsonl", "copied")] and put() == [("b.jsonl", "skipped")]
    staged = files.scan_stage(spark, str(tmp_path / "stage")).collect()
    assert {(r["source_run_tag"], r["source_filename"], r["source_file_row_number"]) for r in staged} == {("tag", "tag/raw_posts/r1/b.jsonl", 1), ("tag", "tag/raw_posts/r1/b.jsonl", 4)}
    assert files.write_jsonl(spark.range(25), str(tmp_path / "json"), 10) == 25
    assert files.sql_snapshot(spark.range(30), str(tmp_path / "snap"), ["id"], 10) == 30
    assert files.scan_csv(spark, str(tmp_path / "snap" / "sample")).count() == 10 and spark.read.json(str(tmp_path / "snap" / "summary")).first()["sample_rows"] == 10
    with pytest.raises(PySparkException, match="fixture"):
        files.cycle_rows(spark.range(0), "id", 3).collect()
    assert [r["id"] for r in files.tail_rows(spark.range(9), "id", 2).collect()] == [7, 8]
    assert [r["id"] for r in files.head_rows(spark.range(9), [F.col("id").desc()], 2).collect()] == [8, 7]
    files.stage_copy(spark.range(3).selectExpr("id", "'t' AS run_tag", "'f' AS family"), str(tmp_path / "copy"))
    assert (tmp_path / "copy" / "run_tag=t" / "family=f").is_dir()
    m = spark.createDataFrame([("a", 1.0)], "model string, f1 double")
    files.write_model(str(tmp_path / "model"), m, m, m, m)
    assert spark.read.json(str(tmp_path / "model" / "metrics")).count() == 1
    assert files.source_root("x") == "x" and files.source_root() == files.DEFAULT_ROOT
    snap = files.snapshot(spark.createDataFrame([(" a ", "2024-01-02"), (None, "bad")], "name string, date string")).collect()
    assert [(r["name"], str(r["date"])) for r in snap] == [("a", "2024-01-02"), ("", "None")]


def test_families_and_keys(spark):
    df = spark.createDataFrame([("x/raw_posts/f",), ("x/raw_posts/hydrated_posts/f",), ("x",)], "p string")
    assert [r[0] for r in df.select(events.family_of_path(F.col("p"))).collect()] == ["raw_posts", None, None]
    keys = spark.createDataFrame([("  Große   Straße ",), (None,)], "s string").select(T.key_normal(F.col("s"))).collect()
    assert [r[0] for r in keys] == ["grosse strasse", ""]
    one = spark.range(1)
    assert one.select(T.file_matches(F.lit("a/b.gz"), F.lit("b.gz"))).first()[0] and not one.select(T.file_matches(F.lit("a/xb.gz"), F.lit("b.gz"))).first()[0]
    assert one.select(T.human_bytes(F.lit(1536.0))).first()[0] == "1.5 KB"
    tests = T.text_tests(F.lit("the 🎉--a "), ["the", "a"])
    assert one.select(*[c.alias(k) for k, c in tests.items()]).first().asDict() == {"has_emoji": True, "has_repeated_separator": True, "has_edge_space": True, "is_short": False, "is_low_information": False, "is_mostly_stopwords": False}


def test_run_lifecycle(spark):
    now = F.lit("2024-01-01 00:01:00").cast("timestamp")
    runs = spark.createDataFrame([("r1", "running", 0, "2024-01-01 00:00:00"), ("r2", "failed", 3, "2024-01-01 00:00:00")], "run_id string, status string, rows int, s string")
    runs = runs.withColumns({"started_at": F.to_timestamp("s"), "ended_at": F.lit(None).cast("timestamp")})
    counted = lifecycle.add_counters(runs, "run_id", "r1", {"rows": 30})
    done = lifecycle.finish(counted, "run_id", "r1", "completed", now)
    again = {r["run_id"]: r for r in lifecycle.rates(lifecycle.finish(done, "run_id", "r1", "completed", now), ["rows"]).collect()}
    assert again["r1"]["status"] == "completed" and again["r1"]["rows_per_second"] == 0.5 and again["r2"]["rows"] == 3
    with pytest.raises(PySparkException, match="can't become failed"):
        lifecycle.finish(done, "run_id", "r1", "failed", now).collect()
    batch = lifecycle.open_file(lifecycle.open_file(spark.createDataFrame([], "path string, family string, status string, opened_at timestamp, ended_at timestamp"), "p1", "f", now), "p2", "f", now)
    assert batch.count() == 2 and lifecycle.finish(batch, "path", "p1", "closed", now).where("status = 'closed'").count() == 1
    with pytest.raises(PySparkException, match="already"):
        lifecycle.open_file(batch, "p1", "f", now).collect()
    assert lifecycle.run_id("hydrate").startswith("hyd_") and len(lifecycle.run_id("capture").split("_")[2]) == 8
    assert 3.6 <= lifecycle.wait_seconds(3, 1.0, 30.0, seed=1) <= 4.4 and lifecycle.wait_seconds(99) <= 33
    assert lifecycle.drain(lambda n: n == 3) == 3 and lifecycle.drain(lambda n: False, 5) == 5
    assert [r[0] for r in spark.range(1, 8).select(state.backoff_seconds(F.col("id"))).collect()] == [1, 2, 4, 8, 16, 30, 30]
    history = spark.createDataFrame([("a/t/1", "LOADED", 5, "2024-01-01 00:00:30"), ("a/u/1", "LOADED", 5, "2024-01-01 00:00:30"), ("a/t/0", "LOADED", 1, "2023-12-01 00:00:00")], "file_name string, status string, row_count int, at string").withColumn("load_time", F.to_timestamp("at"))
    assert [r["file_name"] for r in lifecycle.copy_history(history, "t", now).collect()] == ["a/t/1"]


def test_lookup_asks_each_id_once(spark):
    df = spark.createDataFrame([(f"i{n % 60}",) for n in range(200)] + [(None,)], "id string")

    def fetch(ids):
        assert len(ids) <= 25 and len(set(ids)) == len(ids)
        return [{"id": i, "v": k} for i in ids if i != "i7" for k in (1, 2)]

    got = {r["id"]: r["answer"] for r in lifecycle.lookup(df, "id", fetch, "id string, answer string").collect()}
    assert len(got) == 60 and got["i7"] is None and json.loads(got["i8"]) == {"id": "i8", "v": 1}


def test_models_are_compared(spark):
    rows = [(i, "ab"[i % 2], float(i % 2) + (i % 5) / 10, float(i % 7)) for i in range(80)]
    df = spark.createDataFrame(rows, "id int, label string, match_score double, post_hour_utc double")
    split = models.stratified_split(df, "label", "id").persist()
    names = ["match_score", "post_hour_utc"]
    got = {r["model"]: r for r in models.experiments(split, "label", "id", names, trees=20).collect()}
    assert len(got) == 6 and got["stumps"]["accuracy"] == 1.0
    best = models.better(spark.createDataFrame([(r["model"], r["macro_f1"], r["balanced_accuracy"], r["accuracy"]) for r in got.values()], "model string, macro_f1 double, balanced_accuracy double, accuracy double")).first()
    assert best["macro_f1"] == max(r["macro_f1"] for r in got.values())
    without = {r["model"]: r for r in models.ablations(split, "label", "id", names, trees=20).collect()}
    assert without["without_actor_account"]["skipped"] == "no columns of this group" and without["without_trend_match"]["accuracy"] < 1
    fitted = models.bagged_stumps(names, "label", 20).fit(split)
    assert models.importances(fitted, names).first()["feature"] == "match_score"
    assert models.importances(models.softmax_regression(names, "label").fit(split), names).where("class is not null").count() >= 2
    p = models.predictions(fitted, split, "label", "id", 5).collect()
    assert len(p) == 5 and abs(p[0]["probability_a"] + p[0]["probability_b"] - 1) < 1e-9
    assert models.keeps_refinement(0.1, 0.0, 0.05) and not models.keeps_refinement(0.1, 0.0, 0.06)
    hot = models.one_hot(spark.createDataFrame([("x",), (None,), ("z",)], "c string"), "c", ["x", "y"]).collect()
    assert [[r[k] for k in ("c=x", "c=y", "c=__MISSING__")] for r in hot] == [[1.0, 0.0, 0.0], [0.0, 0.0, 1.0], [0.0, 0.0, 0.0]]


def test_places_and_ranks(spark):
    df = spark.range(0, 5000, 7).withColumnRenamed("id", "k").repartition(5)
    got = {r["k"]: r["surrogate_id"] for r in relational.numbered(df, "k", 9).collect()}
    assert got == {k: i for i, k in enumerate(range(0, 5000, 7))}
    assert relational.numbered(df.limit(0), "k").count() == 0
    s = spark.createDataFrame([(1, "pending", 5, "a"), (2, "retryable", 3, "a"), (3, "claimed", 1, "a")], "id int, status string, captured_at int, w string")
    assert [(r["id"], r["claim_rank"]) for r in state.claim_rank(s, "id", "captured_at", "w").orderBy("claim_rank").collect()] == [(2, 1), (1, 2)]
    wrong = summaries.wrong_pairs(spark.createDataFrame([("a", "b"), ("a", "a"), ("a", "b")], "t string, p string"), "t", "p").first()
    assert (wrong["t"], wrong["p"], wrong["n"]) == ("a", "b", 2)
    assert quality.missingness(spark.createDataFrame([(None, " ")], "a int, b string")).count() == 2


def test_streams_bound_their_state(spark, tmp_path):
    (tmp_path / "in").mkdir()
    frame = {"t": "#commit", "seq": 1, "time": "2024-01-01T00:00:00Z", "repo": "did:1", "ops": [{"action": "create", "path": "app.bsky.feed.post/a", "cid": "c", "record": {"text": "x"}}]}
    (tmp_path / "in" / "a.jsonl").write_text((json.dumps(frame) + "\n") * 3)
    stream = capture.unique_within(capture.frame_stream(spark, str(tmp_path / "in")), "cap_1").withColumn("record", F.col("record").cast("string"))
    capture.drain(stream, str(tmp_path / "out"), str(tmp_path / "check"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
    counted = capture.frame_stream(spark, str(tmp_path / "in"))
    capture.upsert_counts(counted, ["value"], str(tmp_path / "counts"), str(tmp_path / "check2"))
    assert spark.read.parquet(str(tmp_path / "counts")).first()["n"] == 3
