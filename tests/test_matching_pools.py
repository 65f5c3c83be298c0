"""Stage pools and both scoring stages against a comparison of all candidates with all trends, with pools far smaller than in production."""

import io
import random
from contextlib import redirect_stdout
from datetime import date, timedelta
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from threadmill.functions.text import semantic_score
from threadmill.operators import matching

WORDS = "solar panel storm river council market garden engine".split() + ["the", "of", "in"]
DAY = date(2024, 3, 1)


def made(rng, n, ids):
    rows = []
    for i in range(n):
        words = rng.choices(WORDS, k=rng.randint(1, 4))
        key = " ".join(words)
        if rng.random() < 0.4:
            at = rng.randrange(len(key))
            key = key[:at] + rng.choice("xyz") + key[at + 1 :]
        if rng.random() < 0.15:
            key = " ".join(rng.choices(["the", "of", "in"], k=2))
        rows.append((ids + i, " ".join(key.split()), None if rng.random() < 0.1 else DAY + timedelta(rng.randrange(-12, 12))))
    return rows


def frames(spark, cands, trends):
    c = spark.createDataFrame(cands, "candidate_id long, key string, candidate_date date").withColumn("uri", F.col("candidate_id"))
    t = spark.createDataFrame([(*r, float(r[0] % 7)) for r in trends], "trend_id long, key string, trend_date date, counts double").withColumn("name", F.concat("key", F.lit("!")))
    return c, t


def ratio(a, b):
    return SequenceMatcher(None, a, b).ratio()


def plain(cands, trends, most, top, score):
    """Each candidate's (stage, {trend: score}) by the rule, one by one."""
    out = {}
    by_count = lambda t: (-float(t[0] % 7), t[1] + "!", t[0])
    for i, key, day in cands:
        pool = [t for t in trends if day and t[2] and abs((t[2] - day).days) <= matching.WINDOW_DAYS] or list(trends)
        exact = {t[0]: 1.0 for t in pool if t[1] == key}
        if not key or exact:
            out[i] = ("exact", exact) if exact else ("unmatched", {})
            continue
        named = [w for w in key.split() if w not in matching.BLOCK_STOPWORDS]
        shares = [t for t in trends if set(named) & set(t[1].split())]
        if shares:
            pool = [t for t in pool if t in shares]
        elif not named:
            pool = sorted(pool, key=by_count)[:most]
        pool = sorted(pool, key=by_count)[: 4 * most]
        near = sorted(pool, key=lambda t: (-ratio(key, t[1]), *by_count(t)))[:most]
        fuzzy = {t[0]: ratio(key, t[1]) for t in near if ratio(key, t[1]) >= matching.FUZZY}
        semantic = {t[0]: score[key, t[1]] for t in near[:top] if score[key, t[1]] >= matching.SEMANTIC}
        out[i] = ("fuzzy", fuzzy) if fuzzy else ("semantic", semantic) if semantic else ("unmatched", {})
    return out


@pytest.mark.parametrize(("seed", "most", "top"), [(1, 5000, 250), (2, 4, 3), (3, 2, 2)])
def test_stages_equal_the_rule(spark, seed, most, top):
    rng = random.Random(seed)
    trends, cands = made(rng, 90, 1000), made(rng, 60, 0)
    c, t = frames(spark, cands, trends)
    pairs = spark.createDataFrame(sorted({(a[1], b[1]) for a in cands for b in trends}), "a string, b string")
    score = {(r["a"], r["b"]): r["s"] for r in pairs.withColumn("s", semantic_score(F.col("a"), F.col("b"))).collect()}
    want = plain(cands, trends, most, top, score)
    got = {}
    for r in matching.match(c, t, most=most, pool=top).collect():
        stage, rows = got.setdefault(r["candidate_id"], (r["stage"], {}))
        assert stage == r["stage"]
        if r["trend_id"] is not None:
            rows[r["trend_id"]] = r["score"]
    assert {k: (s, sorted(rows)) for k, (s, rows) in got.items()} == {k: (s, sorted(rows)) for k, (s, rows) in want.items()}
    assert all(rows[x] == pytest.approx(want[k][1][x]) for k, (_, rows) in got.items() for x in rows)
    assert {s for s, _ in want.values()} >= {"exact", "semantic", "unmatched"} | ({"fuzzy"} if seed == 1 else set())


def test_no_similar_key_is_missed_and_few_others_are_met(spark):
    rng = random.Random(7)
    keys = sorted({"".join(rng.choices("abcde ", k=rng.randint(1, 30))).strip() or "a" for _ in range(150)})
    near = sorted({k[:i] + rng.choice("abcde") + k[i + rng.randint(0, 1) :] for k in keys for i in [rng.randrange(len(k))]})
    want = {(a, b) for a in keys for b in near if a != b and ratio(a, b) >= 0.88}
    met = matching.similar_keys(spark.createDataFrame([(k,) for k in keys], "ckey string"), spark.createDataFrame([(k,) for k in near], "tkey string"), 0.88)
    got = {tuple(r) for r in met.collect()}
    assert got >= want and len(want) > 40 and len(got) < 3 * len(want)  # of 22,000 pairs


def test_no_join_without_a_key(spark):
    rng = random.Random(3)
    c, t = frames(spark, made(rng, 20, 0), made(rng, 400, 1000))
    timed = matching.temporal_mode(c, t)
    with redirect_stdout(io.StringIO()) as out:
        matching.fuzzy_pairs(timed, t).explain()
        matching.semantic_pairs(timed, t, pool=3).explain()
        matching.match(c, t).explain()
    assert "NestedLoop" not in out.getvalue() and "Cartesian" not in out.getvalue()


def test_pairs_that_only_share_a_token_are_not_written(spark, monkeypatch):
    """Each of 60 candidates shares a token with each of 50 trends, and only one pair is alike."""
    sizes = {}

    def counted(df, label, write=matching.stored):
        sizes[label] = max(sizes.get(label, 0), (out := write(df, label)).count())
        return out

    monkeypatch.setattr(matching, "stored", counted)
    letters = "abcdefghijklmnopqrstuvwxyz"
    cands = [(i, f"storm {letters[i % 26] * 7} {letters[i // 26] * 9} one", DAY) for i in range(59)] + [(59, "storm of the western harbor", DAY)]
    trends = [(1000 + i, f"storm {letters[25 - i % 26] * 5} {i} two more", DAY) for i in range(49)] + [(1049, "storm of the western harbour", DAY)]
    got = {(r["candidate_id"], r["stage"]) for r in matching.match(*frames(spark, cands, trends)).collect() if r["is_matched"]}
    assert got == {(59, "fuzzy")}
    assert max(n for label, n in sizes.items() if label not in ("trend-days", "rare-pairs")) < 200, sizes  # 3000 pairs share a token
