"""Frequent sequences against a search of all chains, with chunks and trees far smaller than in production."""

import random
import zlib
from collections import defaultdict

import pytest

from threadmill.llm import sequences

GAP, SPAN = 100, 250
KINDS = ["a", "b", "c"]


def supported(events, gap, span, longest):
    """Patterns of one client by going on from every event to every later one in reach."""
    events, found = sorted(set(events)), set()
    level = {((k,), t, t) for t, k in events}
    for _ in range(longest):
        found |= {p for p, _, _ in level}
        level = {(p + (k,), s, t) for p, s, e in level for t, k in events if 0 < t - e <= gap and t - s <= span} if len(next(iter(level), ((),))[0]) < longest else set()
    return found


def brute(rows, gap, span, longest=4, least=2, share=30):
    by = defaultdict(list)
    for c, t, k in rows:
        if None not in (c, t, k):
            by[c].append((t, k))
    who = defaultdict(set)
    for c, events in by.items():
        for p in supported(events, gap, span, longest):
            who[p].add(c)
    kept = {p: cs for p, cs in who.items() if len(cs) >= least and len(cs) * 100 >= share * len(by)}

    def within(p, q):
        it = iter(q)
        return all(x in it for x in p)

    out = set()
    for p, cs in kept.items():
        n = sum(len(q) > len(p) and len(kept[q]) == len(cs) and within(p, q) for q in kept)
        out.add((">".join(p), len(p), len(cs), sum(zlib.crc32(str(c).encode()) for c in cs), n, n == 0))
    return out


def got(spark, rows, gap, span, **more):
    df = spark.createDataFrame(rows, "client long, t long, kind string")
    out = sequences.frequent(df, gap, span, **more).drop("kinds")
    return {tuple(r) for r in out.collect()}


def made(rng, clients, hot):
    rows = [(c, t + rng.randrange(3), rng.choice(KINDS)) for c in range(clients) for t in rng.sample(range(1500), rng.randint(1, 12))]
    dense = [(99, rng.randrange(-600, 600), rng.choice(KINDS)) for _ in range(hot)]
    return rows + dense + rng.choices(rows, k=20) + [(None, 1, "a"), (3, None, "a"), (3, 5, None)]


@pytest.mark.parametrize("seed", range(3))
def test_chunks_of_any_size_give_all_chains(spark, seed):
    rng = random.Random(seed)
    rows = made(rng, 8, 130)
    want = brute(rows, GAP, SPAN)
    for chunk_rows, fan in ((7, 4), (23, 6), (32_768, 32)):
        assert got(spark, rows, GAP, SPAN, chunk_rows=chunk_rows, fan=fan) == want


def test_longer_patterns(spark):
    rows = made(random.Random(9), 5, 40)
    assert got(spark, rows, 60, 150, longest=5, chunk_rows=5, fan=4) == brute(rows, 60, 150, 5)


def test_ties_nothing_and_rare_kinds(spark):
    assert got(spark, [], GAP, SPAN) == set()
    assert got(spark, [(1, 5, "a"), (1, 5, "b"), (2, 5, "b"), (2, 5, "a")], GAP, SPAN) == {("a", 1, 2, sum(zlib.crc32(x) for x in (b"1", b"2")), 0, True), ("b", 1, 2, sum(zlib.crc32(x) for x in (b"1", b"2")), 0, True)}
    assert got(spark, [(c, 5, f"only{c}") for c in range(9)], GAP, SPAN) == set()
    edges = [(c, t, k) for c in (1, 2) for t, k in ((0, "a"), (100, "b"), (200, "c"), (250, "a"), (351, "b"))]
    assert got(spark, edges, GAP, SPAN, chunk_rows=1, fan=4) == brute(edges, GAP, SPAN)


def test_clashing_columns_are_ignored(spark):
    rows = [(1, 5, "a", 7, "w"), (2, 9, "a", 8, "w")]
    df = spark.createDataFrame(rows, "client long, t long, kind string, first long, whole string")
    assert [r["support"] for r in sequences.frequent(df, GAP, SPAN).collect()] == [2]
