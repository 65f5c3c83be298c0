"""Bagged stumps against a plain NumPy version that sees the same rows, weights and features."""

import numpy as np
from pyspark.sql import functions as F

from threadmill.operators import stumps


def plain(x, y, classes, weights, drawn, cuts):
    """Best split and class shares of each bag, from the repeated rows themselves."""
    share = lambda v: (np.bincount(v, minlength=classes) + 1) / (len(v) + classes)
    gini = lambda p: 1 - (p**2).sum()
    out = []
    for b, own in enumerate(drawn):
        rows = np.repeat(np.arange(len(x)), weights[:, b])
        best = (0.0, -1, None, share(y[rows]), share(y[rows]))
        for f in own:
            for cut in cuts[f]:
                left = x[rows, f] <= cut
                if left.any() and not left.all():
                    l, r = share(y[rows][left]), share(y[rows][~left])
                    gain = gini(share(y[rows])) - left.mean() * gini(l) - (~left).mean() * gini(r)
                    if gain > best[0] + 1e-12:
                        best = (gain, f, cut, l, r)
        out.append(best)
    return out


def test_equals_a_plain_version(spark):
    rng = np.random.default_rng(4)
    n, classes = 400, 3
    y = rng.integers(0, classes, n)
    x = np.stack([y + rng.normal(size=n), rng.integers(0, 2, n), np.full(n, 7.0), rng.normal(size=n).round(1), (y == 2) * 1.0 + rng.integers(0, 2, n), rng.normal(size=n)], axis=1)
    names = [f"f{i}" for i in range(x.shape[1])]
    df = spark.createDataFrame([(i, "abc"[k], *map(float, v)) for i, (k, v) in enumerate(zip(y, x, strict=True))], f"id long, label string, {', '.join(f'{c} double' for c in names)}").repartition(5)
    fitted = stumps.fit(df, names, "label", "id", bags=30)
    assert fitted.labels == ["a", "b", "c"] and fitted.cuts[1] == [0.5] and fitted.cuts[2] == []
    assert np.allclose([(x[:, 5] <= c).mean() for c in fitted.cuts[5]], np.linspace(0.05, 0.95, 9), atol=1 / n)
    h = np.array([r["h"] for r in df.select("id", F.xxhash64("id").alias("h")).orderBy("id").collect()])
    weights = stumps.bag_weights(h, 30)
    assert 0.9 < weights.mean() < 1.1 and 0.8 < weights.var() < 1.2
    drawn = stumps.bag_features(len(names), 30)
    want = plain(x, y, classes, weights, drawn, fitted.cuts)
    for (gain, f, cut, left, right), got in zip(want, fitted.stumps.itertuples(), strict=True):
        assert got.feature == f and np.isclose(got.gain, gain) and np.allclose(got.left, left) and np.allclose(got.right, right)
        assert f < 0 or got.threshold == cut
    p = np.zeros((n, classes))
    for _, f, cut, left, right in want:
        p += left if f < 0 else np.where((x[:, f] <= cut)[:, None], left, right)
    rows = fitted.transform(df).orderBy("id").collect()
    assert np.allclose([r["probability"] for r in rows], p / 30) and [r["prediction"] for r in rows] == list(p.argmax(axis=1))
    gains = np.bincount([f for _, f, *_ in want if f >= 0], [g for g, f, *_ in want if f >= 0], len(names))
    assert np.allclose(list(fitted.importances().values()), gains / gains.sum())


def test_one_class_and_nulls(spark):
    df = spark.createDataFrame([(i, "only", float(i), None) for i in range(9)], "id long, label string, a double, b double")
    fitted = stumps.fit(df, ["a", "b"], "label", "id", bags=3)
    assert set(fitted.stumps["feature"]) == {-1}
    assert [r["probability"] for r in fitted.transform(df).collect()] == [[1.0]] * 9
