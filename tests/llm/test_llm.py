import random
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from threadmill.llm import chat, exact_dedup, html_text, licences, mixing, near_dedup, packing, topk, toxicity, warc

rng = random.Random(5)
VOCAB = [f"w{i}x" for i in range(400)]


def words(n):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


def docs_frame(spark, texts):
    rows = [(i, t, "en", f"s{i % 3}" if i % 7 else None, len(t or ""), "extra") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string")


@pytest.fixture(scope="module")
def texts():
    base = words(300)
    near = base.split()
    near[10] = "changed"
    return [base, base, " ".join(near), words(200), "", None, "short one", words(5000), words(60), base, "  spaced   out ", "line\nbreak tab\tx"] + [words(40) for _ in range(20)]


def test_exact_dedup(spark, texts):
    df = docs_frame(spark, texts)
    for keep, best in (("max", max), ("min", min)):
        got = exact_dedup.mark_copies(df, keep=keep).collect()
        groups = {}
        for i, t in enumerate(texts):
            groups.setdefault(t or "", []).append(i)
        assert len(got) == len(texts)
        for r in got:
            own = groups[r["text"] or ""]
            assert r["keep_id"] == best(own) and r["group_size"] == len(own) and r["kept"] == (r["doc_id"] == best(own))
    hot = spark.range(2000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "same text").otherwise(F.col("id").cast("string")).alias("text"))
    got = exact_dedup.mark_copies(hot, keep="max")
    assert got.where("kept").count() == 1001 and got.where("group_size = 1000").count() == 1000
    again = spark.createDataFrame([(None, "x"), (None, "x"), (3, "x"), (3, "x")], "doc_id long, text string")
    assert exact_dedup.mark_copies(again).where("kept").count() == 1
    assert exact_dedup.mark_copies(df.limit(0)).count() == 0


def test_mixing(spark, texts):
    df = docs_frame(spark, texts).withColumn("size", mixing.words(F.col("text"))).withColumn("taken", F.lit(1))
    got = mixing.mix(df, shard_rows=4).collect()
    assert len(got) == len(texts) and all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    per = {}
    for r in got:
        per.setdefault(r["source"], [0, r["target"], r["source_size"]])[0] += r["taken"]
    assert all(abs(t - want) <= mixing.BLOCK_WORDS + 1 and want <= 3 * size + 1e-6 for t, want, size in per.values())
    out = mixing.take_mix(docs_frame(spark, texts)).collect()
    counts = {}
    for r in out:
        counts[r["doc_id"]] = counts.get(r["doc_id"], 0) + len((r["text"] or "").split())
    plain = {r["doc_id"]: r["taken"] for r in mixing.mix(df).collect()}
    assert all(counts.get(k, 0) == v for k, v in plain.items())
    assert mixing.mix(df.limit(0)).count() == 0


def test_topk(spark):
    r = np.random.default_rng(1)
    table = [(i, [float(x) for x in r.normal(size=8)]) for i in range(300)] + [(300, None), (301, [float("nan")] * 8), (302, []), (303, [1.0] * 8), (304, [1.0] * 8)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<float>")
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, k=5, shard_rows=64, block_rows=4).collect()
    v = {i: np.floor(64 * np.array(e, dtype=np.float32).astype(float)).astype(int) for i, e in table if e and not np.isnan(e).any()}
    want = {q: sorted(((-int(v[q] @ v[c]), c) for c in v if c != q))[:5] for q in v if q % 20 == 0}
    found = {}
    for x in sorted(got, key=lambda x: x["rank"]):
        found.setdefault(x["query_id"], []).append((-x["score"], x["vec_id"]))
    assert found == want
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_near_classes(spark, texts):
    df = docs_frame(spark, texts)
    got = {r["doc_id"]: r for r in near_dedup.near_classes(df).collect()}
    assert {i for i, r in got.items() if r["class_id"] == 0} == {0, 1, 2, 9}
    assert sum(r["kept"] for r in got.values()) == len(texts) - 3 and got[2]["n_links"] == 1
    assert got[4]["class_size"] == got[5]["class_size"] == 1
    assert near_dedup.near_classes(df.limit(0)).count() == 0


def test_signatures_estimate_weighted_overlap():
    a, b = near_dedup.shingles(words(400) + " " + "same " * 60), None
    keys, counts = a
    half = counts.copy()
    half[: len(half) // 3] = 0
    b = (keys[half > 0], half[half > 0])
    sig = near_dedup.signatures([a, b], 2048)
    assert abs((sig[0] == sig[1]).mean() - near_dedup.overlap(a, b)) < 0.05


def test_components(spark):
    chain = spark.createDataFrame([(f"n{i:03d}", f"n{i + 1:03d}") for i in range(40)] + [("x", "y")], "a string, b string")
    got = {r["node"]: r["label"] for r in near_dedup.components(chain).collect()}
    assert {got[f"n{i:03d}"] for i in range(41)} == {"n000"} and got["y"] == "x"


def test_packing(spark, texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.tokenizer_path())
    special = texts + ["İstanbul ΣΑΣ Σ. don't x'.", "<|endoftext|> a", "a\x1cb", "é é ﬁ ½ 12,3.", "日本語 テスト!", "'sé 'S THE'S."]
    df = docs_frame(spark, special)
    got = packing.pack(df, capacity=256).collect()
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    for i, t in enumerate(special):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        own = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [r["length"] for r in own] == [len(ids[a : a + 256]) for a in range(0, len(ids), 256)]
        assert all(r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes()) for r in own)
    for rows in by_seq.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 256
    assert len(by_seq) <= sum(r["length"] for r in got) / 256 * 1.1 + 1
    assert packing.pack(df.limit(0)).count() == 0


def test_warc_round_trip(spark, tmp_path):
    big = "é<p>WARC/1.1\r\n</p>" * 200_000
    pages = [(1, "http://a/", "x" * 1500), (2, "http://a/ü b", "x" * 1500), (3, None, None), (4, "u", "small"), (5, "u", "small"), (6, "v", big), (6, "v", big), (None, "w", "y")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = sorted(((r["page_id"] or 0, r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.archive(df).collect()), key=str)
    n = len(big.encode())
    assert got == sorted([(1, 1500, "revisit", 2), (2, 1500, "response", None), (3, 0, "response", None), (4, 5, "response", None), (5, 5, "response", None), (6, n, "response", None), (6, n, "response", None), (0, 1, "response", None)], key=str)
    assert max(r["chunks"] for r in warc.archive(df).collect()) == -(-n // warc.CHUNK)
    assert warc.archive(df.limit(0)).count() == 0


def test_html(spark):
    page = (
        "<html><head><title>T</title></head><body><header>Top</header><nav>Menu</nav><div class='ad'>Buy</div><article><h1>Head &amp; line</h1><p>One\n two<br>three<p><b>Four"
        "<form>f</form><div class=comments>c</div></article><aside>Side</aside><footer>&copy;</footer></body></html>"
    )
    shared = "subscribe to our letter for news and offers every single week"
    plain = [(10 + i, f"http://h/{i}", f"<div>{shared}</div><div>{words(30)}</div>") for i in range(4)]
    rows = [(1, "http://h/x", page), (2, None, None), (3, "", "")] + plain
    got = {r["page_id"]: r for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1]["text"] == "Head & line\nOne two three\nFour" and got[1]["n_chars"] == len(got[1]["text"])
    assert got[2]["text"] == got[3]["text"] == ""
    assert all("subscribe" not in got[10 + i]["text"] and len(got[10 + i]["text"].split()) == 30 for i in range(4))


def test_licences(spark):
    mit = "Copyright (c) 2020 Someone\n\n" + licences._MIT.upper().replace(",", " ,\n")
    df = spark.createDataFrame([(1, mit), (2, "Released under the MIT Licence!"), (3, None), (4, "text. Released under the MIT License.")], "doc_id long, text string")
    assert {r["doc_id"]: r["license_id"] for r in licences.scan_licences(df).collect()} == {1: "MIT", 2: "MIT-notice", 3: None, 4: None}


def test_chat(spark):
    rows = [
        (1, 0, "user", "How do I sort a large table quickly?\nThanks in advance."),
        (1, 1, "user", "An unrelated question about weather today."),
        (1, 2, "bot", "Bob wrote:\n> How do I sort a large table quickly?\nUse an external sort."),
        (1, 3, "user", ">> How do I sort a large table quickly?\n> Use an external sort.\nThat works."),
        (1, 4, "user", "> never written anywhere at all\nNo parent."),
        (None, 0, None, None),
        (2, None, "user", "> x"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("parent_turn", F.lit(9))
    got = chat.reply_order(df).collect()
    own = [(r["turn"], r["thread"], r["parent_turn"], r["reply_depth"], r["body"], r["quote_levels"]) for r in got if r["conv_id"] == 1]
    assert [x[:4] for x in own] == [(0, 0, None, 0), (2, 0, 0, 1), (3, 0, 2, 2), (1, 1, None, 0), (4, 4, None, 0)]
    assert own[1][4] == "Use an external sort." and own[2][5] == 2 and len(got) == 7


def test_toxicity(spark):
    rows = [(i, (words(40) + (" you idiot bad1x zork" + str(i % 3) + " clown" if i % 4 == 0 else "") + " end")) for i in range(400)] + [(400, None), (401, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.classify(df, labels).collect()}
    assert len(got) == 402 and all(0 <= r["score"] <= 1 for r in got.values())
    held = [r for r in got.values() if r["held_out"] and r["doc_id"] < 400]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got.values())
    assert np.mean([r["predicted"] == int(r["doc_id"] % 4 == 0) for r in held]) > 0.95
    assert toxicity.keep_civil(df, labels).columns == df.columns
    assert all(r["score"] == 0 for r in toxicity.classify(df, labels.limit(0)).collect())


def test_isotonic_rises():
    s = np.array([0.1, 0.2, 0.3, 0.4, 0.5])
    x, y = toxicity.isotonic(s, np.array([0, 1, 0, 1, 1.0]))
    assert (np.diff(y) >= 0).all() and (np.diff(x) > 0).all()


def test_apportion_is_sainte_lague(spark):
    shares = [13.0, 7.0, 7.0, 1.5, 0.0, 40.25]
    df = spark.createDataFrame([(0, i, s, 23) for i, s in enumerate(shares)], "g int, m int, s double, n long")
    got = {r["m"]: r["quota"] for r in mixing.apportion(df, "g", "m", "s", "n").collect()}
    seats = [0] * len(shares)
    for _ in range(23):
        best = max(range(len(shares)), key=lambda i: (shares[i] / (2 * seats[i] + 1), -i))
        seats[best] += 1
    assert [got[i] for i in range(len(shares))] == seats


def test_pandas_is_used_only_off_the_native_paths():
    assert pd is not None and not any("pandas" in open(m.__file__).read() for m in (chat, mixing, exact_dedup, licences))


def test_toxicity_sample_is_drawn_from_labels_with_texts(spark):
    rows = [(i, words(30) + (" vile idiot" if i % 2 else "")) for i in range(200)] + [(0, "again")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("toxic", F.lit(7))
    other = [(10_000 + i, 1) for i in range(5000)]  # labels of another corpus
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + other, "doc_id long, toxic int")
    model = toxicity.fit(df, labels, rows=120)
    assert model.trees is not None and 0.3 < model.prior < 0.7
    got = toxicity.classify(df, labels).collect()
    assert len(got) == 203 and all(isinstance(r["score"], float) for r in got)
    assert toxicity.classify(df.limit(0), labels).count() == 0
