"""Queries that once read a part of their tables, on fixtures where the rest matters."""

from datetime import date, timedelta

from pyspark.sql import functions as F

from threadmill.operators import candidates, posts, relational
from threadmill.plans.registry import QUERIES


def write(df, folder, name):
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_missing_days_reads_all_orders(spark, tmp_path):
    days = [date(2024, 1, 1) + timedelta(d) for d in (0, 1, 2, 5, 6, 9)]
    rows = [(i, 7 if i in (0, 5) else i + 1, d, "1-URGENT" if i in (0, 5) else "5-LOW") for i, d in enumerate(days)]
    sf = write(spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderdate date, o_orderpriority string"), tmp_path, "orders")
    got = {r["day"] for r in QUERIES["missing_days"](spark, sf).collect()}
    assert got == {"2024-01-04", "2024-01-05", "2024-01-08", "2024-01-09"}


def test_duplicate_impact_groups_whole_texts(spark, tmp_path):
    texts = ["A long beginning, one end", "a long beginning one END", "A long beginning, other end", "Early-Case x", "early case X", "early case X", "alone"]
    rows = [(40 * i, 1, "user", t) for i, t in enumerate(texts)] + [(1, 1, "user", "A long beginning, one end")]
    sf = write(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"), tmp_path, "conversations")
    got = QUERIES["duplicate_impact"](spark, sf).collect()
    groups = {(str(r["day"]), r["k"]): (r["variants"], r["n"], r["duplicates_before"], r["duplicates_after"]) for r in got if r["level"] == "group"}
    assert groups == {("2024-01-01", "a long beginning one end"): (2, 2, 0, 1), ("2024-01-01", "early case x"): (2, 3, 1, 2)}
    total = [r for r in got if r["level"] == "all"]
    assert len(total) == 1 and (total[0]["n"], total[0]["duplicates_before"], total[0]["duplicates_after"]) == (8, 1, 3)


def test_matching_draws_from_whole_texts(spark, tmp_path):
    late = "nobody expected anything but quiet until small business owners spoke"
    write(spark.createDataFrame([(1, 1, "user", late), (2, 1, "user", "sunshine")], "conv_id long, turn int, role string, text string"), tmp_path, "conversations")
    sf = write(spark.createDataFrame([(1, "small business grows"), (2, "sunshine")], "item_id long, text string"), tmp_path, "benchmark")
    got = {r["uri"]: (r["stage"], r["trend_id"] // 100) for r in QUERIES["best_match_per_post"](spark, sf).collect()}
    assert got == {1: ("exact", 1), 2: ("exact", 2)}


def test_models_use_every_component(spark, tmp_path):
    # The label shows in components 8 to 15 only.
    rows = [(i, i % 3, [float((i * 7 + j) % 5) if j < 8 else float(i % 3) + ((i * 13 + j * 5) % 11 - 5) / 50 for j in range(16)]) for i in range(120)]
    sf = write(spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>"), tmp_path, "embeddings")
    for name in ("softmax_model", "stump_model"):
        got = QUERIES[name](spark, sf).collect()
        assert len(got) == 36 and all(str(int(r["prediction"])) == r["label"] for r in got), name


def test_rows_without_a_key_are_dealt_out(spark):
    """Posts without an author hold whole texts, and none of them finds an actor: they must not meet in one task."""
    held = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        left = spark.range(400).select(F.col("id").alias("uri"), F.when(F.col("id") % 100 == 0, F.col("id").cast("string")).alias("did"))
        right = spark.range(0, 200, 100).select(F.col("id").cast("string").alias("did"), F.lit("x").alias("name"))
        got = relational.left_with_hit(left, right, ["did"], "hit", "uri")
        assert got.columns == ["did", "uri", "name", "hit"]
        tasks = [r["task"] for r in got.withColumn("task", F.spark_partition_id()).collect() if r["did"] is None]
        assert len(tasks) == 396 and max(map(tasks.count, set(tasks))) < 200
        assert sorted((r["uri"], r["name"]) for r in got.where("hit").collect()) == [(0, "x"), (100, "x")]
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def test_python_workers_get_bounded_batches(spark):
    names = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")
    held = {k: spark.conf.get(k) for k in names}
    try:
        for make in (candidates.generate, lambda p: posts.prepare(p, p, "run", ["position"])):
            spark.conf.set(names[0], 10_000)
            spark.conf.unset(names[1])
            make(spark.createDataFrame([], "uri string, text string, post_text_clean string, post_text_alnum string, record_created_at string, indexed_at string, hydrated_at string, captured_at string, author_did string, position int"))
            assert [int(spark.conf.get(k)) for k in names] == [1000, 8_000_000]
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
