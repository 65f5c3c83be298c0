"""Near-duplicate classes against a comparison of all pairs, with groups far larger than what is compared pair by pair."""

import random

import pytest

from threadmill.llm import near_dedup

VOCAB = [f"v{i}" for i in range(900)]


def all_pairs_classes(texts):
    """Smallest index of each text's class, by comparing every text with every other."""
    bags = [near_dedup.shingles(t) for t in texts]
    up = list(range(len(texts)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, x in enumerate(bags):
        for j in range(i):
            if len(x[0]) and len(bags[j][0]) and near_dedup.overlap(x, bags[j]) >= near_dedup.SIMILAR:
                a, b = sorted((top(i), top(j)))
                up[b] = a
    return [top(i) for i in range(len(texts))]


def edited(rng, words, n):
    out = list(words)
    for i in rng.sample(range(len(out)), n):
        out[i] = f"e{rng.randrange(10**6)}"
    return out


def star(rng):
    """Copies of one text with one to four changes: some pairs of them are linked, others only through a third."""
    base = rng.choices(VOCAB, k=100)
    return [" ".join(edited(rng, base, rng.randint(1, 4))) for _ in range(90)]


def chain(rng):
    """Each text is the one before with a change, so the ends share little but are one class."""
    own, out = rng.choices(VOCAB, k=120), []
    for _ in range(70):
        own = edited(rng, own, 2)
        out.append(" ".join(own))
    return out


def passage(rng):
    """Texts that share a long passage and are alike to about 0.75, among them some near copies."""
    shared, out = rng.choices(VOCAB, k=110), []
    for _ in range(60):
        own = shared + [f"o{rng.randrange(10**6)}" for _ in range(18)]
        out.append(" ".join(own))
        if rng.random() < 0.2:
            out.append(" ".join(edited(rng, own, 1)))
    return out


@pytest.mark.parametrize("make", [star, chain, passage])
def test_large_groups_lose_no_link(spark, make):
    rng = random.Random(make.__name__)
    texts = make(rng) + [" ".join(rng.choices(VOCAB, k=50)) for _ in range(20)]
    rng.shuffle(texts)
    want = all_pairs_classes(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in near_dedup.near_classes(df).collect()}
    assert [got[i]["class_id"] for i in range(len(texts))] == want
    assert all(r["kept"] == (r["class_id"] == r["doc_id"]) and r["class_size"] == want.count(r["class_id"]) for r in got.values())
    assert all((r["n_links"] > 0) == (r["class_size"] > 1) for r in got.values())
