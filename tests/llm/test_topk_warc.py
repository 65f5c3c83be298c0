"""Best-first search against all scores, with ties and repeated ids; archives with payloads of many chunks."""

import gzip

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadmill.llm import topk, warc


def brute(rows, k):
    v = {}
    for i, e in rows:
        v.setdefault(i, []).append(np.floor(64 * np.array(e)).astype(int))
    first = {i: min(map(tuple, x)) for i, x in v.items()}
    out = {}
    for q in first:
        if q % 20 == 0:
            every = [(-int(np.dot(first[q], x)), i) for i, own in v.items() for x in own if i != q and len(x) == len(first[q])]
            out[q] = sorted(every)[:k]
    return out


@pytest.mark.parametrize("shard_rows, block_rows", [(40, 3), (10_000, 4096)])
def test_waves_ties_repeated_ids(spark, shard_rows, block_rows):
    r = np.random.default_rng(4)
    rows = [(i, [float(x) for x in r.integers(-3, 4, 6) / 8]) for i in range(240)]
    rows += [(i, rows[i][1]) for i in (20, 21, 22)] + [(60, [9.0] * 6), (300, [1.0, 2.0]), (320, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit("x")).withColumn("score", F.lit(1))
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, k=7, shard_rows=shard_rows, block_rows=block_rows).collect()
    found = {}
    for x in sorted(got, key=lambda x: x["rank"]):
        found.setdefault(x["query_id"], []).append((-x["score"], x["vec_id"]))
    assert found == {q: x for q, x in brute(rows, 7).items() if x}


@pytest.mark.parametrize("size", [1e7, 2e6, 3e7])
def test_scores_beyond_doubles_are_exact(spark, size):
    r = np.random.default_rng(5)
    rows = [(i, [float(x) for x in np.floor(r.uniform(-size, size, 3) * 64) / 64]) for i in range(300)]
    rows += [(i + 300, [x + 1 / 64 for x in rows[i][1]]) for i in range(0, 300, 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for x in topk.top_k(df, F.col("vec_id") % 20 == 0, k=9, shard_rows=90).orderBy("rank").collect():
        got.setdefault(x["query_id"], []).append((-x["score"], x["vec_id"]))
    ints = {i: [int(y * 64) for y in v] for i, v in rows}
    want = {q: sorted((-sum(a * b for a, b in zip(ints[q], ints[i], strict=True)), i) for i in ints if i != q)[:9] for q in ints if q % 20 == 0}
    assert got == want


def test_a_best_score_that_is_no_long_is_an_error(spark):
    df = spark.createDataFrame([(0, [1e10]), (20, [1e10]), (21, [1e300])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large|OverflowError"):
        topk.top_k(df, F.col("vec_id") % 20 == 0).collect()


def test_search_opens_few_nodes_when_the_floor_is_high():
    r = np.random.default_rng(2)
    x = np.floor(r.normal(size=(4000, 16)) * 64)
    tree = topk.BallTree(x)
    asks = x[:50]
    every = asks @ x.T
    for i in range(50):
        every[i, i] = -np.inf
    kth = np.sort(every, axis=1)[:, -20]
    got = topk.search(tree, x, np.arange(4000), asks, np.arange(50), 20, kth)
    assert all((np.sort(s)[::-1] == np.sort(every[i])[::-1][:20]).all() for i, (s, _) in enumerate(got))


def test_writer_gets_bounded_chunks(spark, tmp_path):
    text = "".join(chr(0x20 + i % 90) + "é" for i in range(50_000))
    pages = [(1, "http://a/", text), (2, "http://a/", text), (3, "http://b/", ""), (4, None, None), (5, "c", "x" * 64)]
    df = spark.createDataFrame([(*p, 1, "z") for p in pages], "page_id long, url string, html string, record int, data string")
    rows = warc.chunk_rows(warc.plan_records(df), 64)
    sizes = [(r["page_id"], r["chunk_number"], len(r["data"])) for r in rows.select("page_id", "chunk_number", "data").collect()]
    assert max(n for _, _, n in sizes) == 64 and sum(n for _, _, n in sizes) == len(text.encode()) + 64
    folder = str(tmp_path / "w")
    warc.make_folder(spark, folder)
    files = [r["path"] for r in warc.write_archives(warc.plan_records(df).coalesce(1), folder, 64).collect()]
    chunks = [x for f in files for x in warc.read_records(gzip.open(f), 100)]
    whole = {}
    for x in chunks:
        whole.setdefault(x["record_id"], []).append(x["data"])
    assert sorted(b"".join(x) for x in whole.values()) == sorted([text.encode(), b"", b"", b"", b"x" * 64])
    kinds = {x["page_id"]: (x["record_type"], x["refers_to"]) for x in chunks if x["ended"]}
    assert kinds == {1: ("revisit", 2), 2: ("response", None), 3: ("response", None), 4: ("response", None), 5: ("response", None)}
