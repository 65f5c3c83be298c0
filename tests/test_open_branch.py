"""The semantic stage for candidates without an index hit, and its pool."""

from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from threadmill.operators import matching


def frames(spark, candidates, trends):
    c = spark.createDataFrame(candidates, "candidate_id long, uri string, key string, d string").withColumn("candidate_date", F.to_date("d")).drop("d")
    t = spark.createDataFrame(trends, "trend_id long, key string, d string, counts double").withColumns({"trend_date": F.to_date("d"), "name": F.col("key")}).drop("d")
    return c, t


def test_semantic_stage_without_index_hit(spark):
    c, t = frames(
        spark,
        [(1, "u1", "what is in abc", "2024-01-02"), (2, "u2", "this is us", "2024-01-02"), (3, "u3", "what is in abc", "2024-02-02"), (4, "u4", "what is red", "2024-01-02")],
        [(10, "what is in xyz", "2024-01-01", 5.0), (11, "is this us", "2024-01-01", 1.0), (12, "red what is", "2024-01-01", 1.0), (13, "what is in far", "2024-02-20", 1.0)],
    )
    got = {(r["candidate_id"], r["trend_id"]): (r["stage"], r["score"]) for r in matching.match(c, t).collect()}
    assert got[1, 10] == ("semantic", pytest.approx(0.705)) and got[2, 11] == ("semantic", pytest.approx(0.867, abs=1e-3))
    assert (1, 13) not in got and (4, 12) in got and (4, 10) not in got
    # No trend is near the third candidate's date: its pool is all trends.
    assert {k for k in got if k[0] == 3} == {(3, 10), (3, 13)}


def test_semantic_pool_keeps_the_nearest(spark):
    keys = [f"what is in {'xyz'[i % 3] * (i + 1)}" for i in range(6)]
    c, t = frames(spark, [(1, "u1", "what is in abc", "2024-01-02"), (2, "u2", "in is what", "2024-01-02")], [(i, k, "2024-01-01", float(i)) for i, k in enumerate(keys)])
    timed = matching.temporal_mode(c, t)
    whole = {(r["candidate_id"], r["trend_id"]) for r in matching.semantic_pairs(timed, t, 0.5).collect()}
    for pool, most in ((3, 5000), (6, 5000), (3, 4)):
        got = {(r["candidate_id"], r["trend_id"]) for r in matching.semantic_pairs(timed, t, 0.5, pool=pool, most=most).collect()}
        want = set()
        for i, key, cut in ((1, "what is in abc", 4 * most), (2, "in is what", most)):
            left = sorted(range(6), key=lambda j: -j)[:cut]
            left.sort(key=lambda j: (-SequenceMatcher(None, key, keys[j]).ratio(), -j))
            want |= {(i, j) for j in left[:pool]} & whole
        assert got == want
