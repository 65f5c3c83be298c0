import os

import pytest

from threadmill.llm import licences

COMMON = "/usr/share/common-licenses"


def scan(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r["license_id"] for r in licences.scan_licences(df).orderBy("doc_id").collect()]


def test_whole_unlicense(spark):
    text = licences.WHOLE[0][1]
    assert scan(spark, [text.upper().replace(". ", ".\n"), text + " and more"]) == ["Unlicense", None]


@pytest.mark.skipif(not os.path.isdir(COMMON), reason="no licence texts here")
def test_whole_common_licences(spark):
    files = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    texts = {f: open(f"{COMMON}/{f}", encoding="utf-8").read() for f in files}
    assert scan(spark, list(texts.values())) == list(files.values())
    assert scan(spark, [texts["GPL-3"][:9000]]) == [None]


def test_neighbouring_spellings_and_wrapped_lines(spark):
    bsd = dict(licences.KNOWN)["BSD-2-Clause"]
    wrapped = bsd.replace("above copyright notice", "above\ncopyright notice").replace("BY THE COPYRIGHT HOLDERS", "BY THE\n * COPYRIGHT HOLDERS")
    df = spark.createDataFrame([("licence licence the Centre centre",), ("sub licence per cent per cent x",)], "t string")
    assert [r[0] for r in df.select(licences.canonical(df["t"])).collect()] == ["license license the center center", "sublicense percent percent x"]
    heads = ["", "Copyright (c) 2011, A. Person\n", "# Copyright 1999-2004 The X Project. All rights reserved.\n", "Copyright by Y\n", "Copyright <YEAR> <NAME>\n"]
    assert scan(spark, [h + wrapped for h in heads]) == ["BSD-2-Clause"] * len(heads)


def test_scan_matches_its_sql(spark):
    import duckdb

    mit = licences._MIT
    texts = ["", None, mit, "Copyright 2020 Q\n" + mit.replace("sublicense", "sub-licence"), mit + " x", "Licence, licence; non-commercial Labour\r\nper cent"] + [t for _, t in licences.KNOWN]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    want = sorted(con.execute(licences.scan_sql()).fetchall())
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(tuple(r) for r in licences.scan_licences(df).collect()) == want


def test_empty_table_and_clashing_names(spark):
    df = spark.createDataFrame([(1, "x", 9), (None, licences._MIT * 1 + " " * 100_000, 9)], "license_id long, text string, license_digest int")
    got = licences.scan_licences(df, id_col="license_id").collect()
    assert {(r["license_id_id"], r["license_id"]) for r in got} == {(1, None), (None, "MIT")}
    assert licences.scan_licences(df.limit(0), id_col="license_id").count() == 0
