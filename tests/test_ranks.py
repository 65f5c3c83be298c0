"""Exact quantiles and seeded places that no single task works out."""

import math
import random
import struct

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from threadmill.functions import text as T
from threadmill.operators.models import seeded
from threadmill.operators.relational import places, quantiles, with_image
from threadmill.sources import events

SHARES = [0.0, 0.25, 0.33, 0.5, 0.66, 0.9, 0.99, 1.0]


def drawn(kind, n):
    r = random.Random(n)
    return {"distinct": lambda: r.uniform(-5, 5), "tied": lambda: float(r.randrange(4)), "skewed": lambda: 0.0 if r.random() < 0.7 else r.expovariate(1)}[kind]


@pytest.mark.parametrize("kind", ["distinct", "tied", "skewed"])
def test_quantiles_are_exact(spark, kind):
    for n in (1, 2, 3, 10, 30_000):
        f = drawn(kind, n)
        values = [f() for _ in range(n)]
        rows = spark.createDataFrame([(v,) for v in [*values, None]], "x double").repartition(5)
        got = quantiles(rows, "x", SHARES).first()["q"]
        assert got == pytest.approx(np.quantile(values, SHARES).tolist(), rel=1e-12, abs=1e-12)


def test_quantiles_of_nothing_are_null(spark):
    assert quantiles(spark.createDataFrame([(None,)], "x double"), "x", [0.5]).first()["q"] == [None]
    assert quantiles(spark.createDataFrame([], "x int"), "x", [0.1, 0.5]).first()["q"] == [None, None]


def test_images_are_the_bits_in_order(spark):
    r = random.Random(3)
    edges = [0.0, -0.0, 5e-324, 2.2250738585072009e-308, 2.0**-1022, 1.0, 1.0 - 2**-53, 1.7976931348623157e308, math.inf]
    values = [*edges, *(2.0**e for e in range(-1074, 1024)), *(math.nextafter(2.0**e, 0) for e in range(-1073, 1024)), *(struct.unpack("d", r.randbytes(8))[0] for _ in range(3000))]
    values = [x for v in values if not math.isnan(v) for x in (v, -v)]
    got = with_image(spark.createDataFrame([(v,) for v in values], "v double"), "v", "k").collect()
    assert len(got) == len(values)
    for row in got:
        bits = struct.unpack("q", struct.pack("d", abs(row["v"])))[0]
        assert row["k"] == (bits if row["v"] >= 0 else -bits)
    odd = with_image(spark.createDataFrame([(math.nan,), (None,)], "v double"), "v", "k").collect()
    assert odd[0]["k"] > max(row["k"] for row in got) and odd[1]["k"] is None


def test_quantiles_of_values_that_differ_in_their_last_bits(spark):
    values = [1.0]
    for _ in range(4999):
        values.append(math.nextafter(values[-1], 2))
    values += [-v for v in values] + [math.inf, -math.inf, 5e-324]
    mixed = list(values)
    random.Random(1).shuffle(mixed)
    n = len(values) - 1
    picked = sorted(values)
    got = quantiles(spark.createDataFrame([(v,) for v in mixed], "x double"), "x", [k / n for k in (0, 1, 4000, 5000, 5001, 7777, n)]).first()["q"]
    assert got == pytest.approx([picked[k] for k in (0, 1, 4000, 5000, 5001, 7777, n)], rel=1e-15)


def test_quantiles_with_odd_values(spark):
    q = lambda values: quantiles(spark.createDataFrame([(v,) for v in values], "x double"), "x", [0.0, 0.5, 1.0]).first()["q"]
    assert q([math.inf, math.inf, -math.inf]) == [-math.inf, math.inf, math.inf]
    assert q([-0.0, 0.0, 0.0]) == [0.0, 0.0, 0.0]
    low, mid, high = q([math.nan, math.inf, 1.0])
    assert (low, mid) == (1.0, math.inf) and math.isnan(high)


def test_places_follow_the_digest(spark):
    rows = [(i, None if i % 7 == 0 else i % 2) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, g int")
    got = {r["k"]: (r["_rank"], r["_n"]) for r in places(df, "g", seeded("k"), "k").collect()}
    digests = {r["k"]: r["d"] for r in df.select("k", seeded("k").alias("d")).collect()}
    for g in (None, 0, 1):
        own = sorted((k for k, x in rows if x == g), key=lambda k: (digests[k], k))
        assert [got[k] for k in own] == [(i + 1, len(own)) for i in range(len(own))]


def test_one_leading_symbol_goes_before_punctuation(spark):
    names = spark.createDataFrame([("#A-b",), ("-#a",), (" #$x y",), ("##a",), (None,)], "n string")
    got = [(r["t"]["normalized_key_with_hash"], r["t"]["normalized_key_no_hash"], r["t"]["normalized_key_no_dollar"]) for r in names.select(T.trend_name(F.col("n")).alias("t")).collect()]
    assert got == [("#a b", "a b", "a b"), ("#a", "#a", "#a"), ("#$x y", "$x y", "x y"), ("##a", "#a", "#a"), ("", "", "")]


def test_a_row_that_fits_two_families_is_an_error(spark):
    both = '{"repo_did": 1, "has_reply": 1, "has_embed": 1, "cid_at_capture": 1, "reason": 1, "attempt_count": 1}'
    with pytest.raises(PySparkException, match="two families"):
        spark.createDataFrame([(both,)], "j string").select(events.family_of_row(F.col("j"))).collect()
    assert spark.createDataFrame([("[]",), (None,), ("x",)], "j string").select(events.family_of_row(F.col("j"))).distinct().collect() == [(None,)]
