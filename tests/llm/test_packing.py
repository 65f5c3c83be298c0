"""Token ids, piece places and clashing names of packing, against the tokenizer itself."""

import unicodedata

import numpy as np
import pyarrow as pa
import pytest

from threadmill.llm import packing


@pytest.fixture(scope="module")
def known():
    return packing.WordIds(packing.tokenizer_path())


@pytest.mark.parametrize("frame", ["ABC{}. x", "{}", "a{}b", "a {}! 7{}; b", "q{}\u0301.) z", "{}'S (x{}"])
def test_ids_of_every_letter_and_mark(known, frame):
    chars = [chr(c) for c in range(1, 0x20000) if unicodedata.category(chr(c)) not in ("Cs", "Cn", "Co")]
    for at in range(0, len(chars), 20_000):
        texts = [frame.replace("{}", c) for c in chars[at : at + 20_000]]
        ids, sizes = known.of(pa.array(texts))
        want = [e.ids for e in known.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        assert sizes.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]


def test_forgetting_changes_no_id(known, monkeypatch):
    monkeypatch.setattr(packing, "MEMORY", 50)
    own = packing.WordIds(packing.tokenizer_path())
    texts = [" ".join(f"word{i % 37} {'x' * (i % 50)}y{i}, (z{i})" for i in range(k, k + 40)) for k in range(0, 4000, 40)]
    for t in texts:
        ids, _ = own.of(pa.array([t, "", t]))
        assert ids.tolist() == 2 * own.tokenizer.encode(t, add_special_tokens=False).ids
        assert len(own.place) <= 51 + len(set(t.split()))


def test_slices_cover_all_texts():
    texts = pa.array(["a" * n for n in (5, 3, 50, 0, 2, 9, 9)])
    got = list(packing.slices(texts, 12))
    assert [a for a, _ in got] == [0] + [b for _, b in got[:-1]] and got[-1][1] == len(texts)
    assert list(packing.slices(pa.array([], pa.string()))) == []


def test_null_and_repeated_ids_and_clashing_names(spark):
    rows = [(None, "a b c", 1, 2), (None, "a b c", 1, 2), (7, "x " * 300, 1, 2), (7, None, 1, 2)]
    df = spark.createDataFrame(rows, "length long, text string, sequence_id int, offset int")
    got = packing.pack(df, id_col="length", capacity=64).collect()
    assert sorted(got[0].asDict()) == sorted(["length_id", *packing.OUT])
    assert sum(r["length"] for r in got if r["length_id"] is None) == 8 and sum(r["length"] for r in got if r["length_id"] == 7) == 302
    places = {(r["sequence_id"], r["offset"]) for r in got}
    assert len(places) == len(got)
    used = {}
    for r in got:
        used[r["sequence_id"]] = used.get(r["sequence_id"], 0) + r["length"]
    assert max(used.values()) <= 64


def test_crc_is_of_the_ids_with_the_end():
    text, piece, start, length, crc = packing.cut_pieces(np.array([5, 6, 7], np.uint32), np.array([0, 3]), 2, 0)
    import zlib

    assert text.tolist() == [0, 1, 1] and length.tolist() == [1, 2, 2] and start.tolist() == [0, 0, 2]
    assert crc.tolist() == [zlib.crc32(np.array(x, "<u4").tobytes()) for x in ([0], [5, 6], [7, 0])]


def test_mix_keeps_null_and_repeated_ids_apart(spark):
    from threadmill.llm import mixing

    rows = [(None, "a", 10, 5), (None, "a", 10, 5), (3, None, 40, 5), (3, "b", 0, 5), (4, "b", 25_000, 5)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long, target int")
    got = mixing.mix(df).collect()
    assert len(got) == 5 and all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    assert {r["source"]: r["source_size"] for r in got} == {"a": 20, "b": 25_000, None: 40}
