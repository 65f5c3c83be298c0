"""Importance resampling against a plain version, with every odd text."""

import hashlib
import math
import re
import zlib
from collections import Counter

from threadmill.llm import importance

DOCS = [
    (1, "The quick brown Fox, jumps over the lazy dog. " * 4),
    (2, "été à l'ÉCOLE naïve ünïcode straße " * 6),
    (3, ""),
    (4, None),
    (5, "... --- !!!"),
    (6, "one two"),
    (6, "one two"),
    (7, "a\x00b \x7f {c} `d` 0123 x y " * 9),
    (None, "The lazy dog and the quick brown fox went to school together every day of the week and nobody there knew " * 2),
    (8, "word " * 50_000),
    (9, " ".join(f"w{i % 37}" for i in range(400))),
]
TARGET = ["the lazy dog and the quick fox", "one two three", None, ""]


def runs(text):
    words = re.findall(importance.WORD, (text or "").translate(str.maketrans(importance.UPPER, importance.LOWER)))
    return len(words), [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def plain(docs, target, buckets=10_000):
    of = lambda g: zlib.crc32(g.encode()) % buckets
    own = [(i, *runs(t)) for i, t in docs]
    s, t = Counter(of(g) for _, _, gs in own for g in gs), Counter(of(g) for x in target for g in runs(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets))))
    out = []
    for i, n, gs in own:
        w = sum(gain(of(g)) for g in gs)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, n, len(gs), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = sorted((x for x in out if x[1] >= 20), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    for r, x in enumerate(fit[: len(fit) * 40 // 100]):
        x[5] = r + 1
    return sorted(map(tuple, out), key=str)


def frames(spark, docs, target):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(x,) for x in target], "text string")


def test_equals_a_plain_version(spark):
    docs, target = frames(spark, DOCS, TARGET)
    got = importance.importance(docs.repartition(3), target, share=40)
    assert sorted(map(tuple, got.collect()), key=str) == plain(DOCS, TARGET)
    assert got.where("rank is not null").count() == 2


def test_nothing_to_draw_from(spark):
    docs, target = frames(spark, [], TARGET)
    assert importance.importance(docs, target).collect() == []
    docs, target = frames(spark, [(1, None), (2, "")], [])
    assert [tuple(r)[1:4] for r in importance.importance(docs, target).collect()] == [(0, 0, 0)] * 2


def test_draws_rows_with_their_columns(spark):
    docs, target = frames(spark, DOCS, TARGET)
    wide = docs.selectExpr("doc_id", "text", "1 as weight", "'x' as rank", "2 as buckets")
    got = importance.draw(wide, target, share=40)
    assert got.columns == wide.columns and got.count() == importance.importance(docs, target, share=40).where("rank is not null and doc_id is not null").count()
