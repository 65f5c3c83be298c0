"""The corpus pipeline against a plain version of its stages, each worked out from the documents that the one before kept."""

import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from test_large_groups import VOCAB, all_pairs_classes, edited
from tokenizers import Tokenizer

import corpus_pipeline
from threadmill.llm import packing, queries, toxicity

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(8)
    texts = [" ".join(rng.choices(VOCAB, k=rng.randint(20, 120))) for _ in range(120)]
    texts += [t + " you stupid idiot clown" for t in texts[:40]]
    texts += [rng.choice(texts[:120]) for _ in range(30)]
    base = rng.choices(VOCAB, k=100)
    texts += [" ".join(edited(rng, base, 2)) for _ in range(40)]
    texts += ["", None, "  ", "one", " ".join(rng.choices(VOCAB, k=4000))]
    toxic = [int("idiot" in (t or "")) for t in texts]
    rows = [(i, t, "en", None if i % 11 == 0 else f"s{i % 4 if i % 3 else 0}", len(t or "")) for i, t in enumerate(texts)]
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path), rows


def mixed_by_sql(rows):
    """The copies of each document that the mix takes, words counted by the SQL of the mixing query."""
    db = duckdb.connect()
    db.register("documents", pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"]))
    out = []
    for doc_id, size, _, _, taken in db.execute(queries.MIX_SQL).fetchall():
        text = next(r[1] for r in rows if r[0] == doc_id)
        out += [(doc_id, text)] * (taken // size if size else 0)
        if size and taken % size:
            out.append((doc_id, " ".join(text.split()[: taken % size]) + " "))
    return out


def test_pipeline(spark, corpus):
    path, rows = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    scores = {r["doc_id"]: r["score"] for r in toxicity.classify(docs, spark.read.parquet(f"{path}/labels.parquet")).collect()}
    kept = [r for r in rows if scores[r[0]] < 0.3]
    assert 0 < len(rows) - len(kept) < len(rows) / 2 and sum("idiot" in (r[1] or "") for r in kept) <= 4

    first = {}
    for r in kept:
        first.setdefault(r[1] or "", r)
    kept = list(first.values())
    classes = all_pairs_classes([r[1] for r in kept])
    kept = [r for i, r in enumerate(kept) if classes[i] == i]

    tok = Tokenizer.from_file(packing.tokenizer_path())
    want = Counter()
    for doc_id, text in mixed_by_sql(kept):
        ids = [*tok.encode(text, add_special_tokens=False).ids, 0]
        for k, a in enumerate(range(0, len(ids), 2048)):
            want[doc_id, k, a, len(ids[a : a + 2048]), zlib.crc32(np.array(ids[a : a + 2048], "<u4").tobytes())] += 1

    got = corpus_pipeline.run(spark, path).collect()
    found = Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got)
    # A text without words takes none of the mix; it comes along with the whole passes over its shard, three at most.
    bare = {r[0] for r in kept if not (r[1] or "").split()}
    assert Counter({k: n for k, n in found.items() if k[0] not in bare}) == want
    assert all(n <= 3 for k, n in found.items() if k[0] in bare)
    ends = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 2048 and len(ends) <= sum(r["length"] for r in got) / 2048 * 1.1 + 1


def test_stages_keep_the_columns_and_take_empty_tables(spark, corpus):
    path, _ = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    none = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, none, path)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, none, path).count() == 0
