"""Bagged decision stumps, all fitted from one table of counts."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

# Bags, thresholds a feature, and the seed of the model contract.
BAGS, THRESHOLDS, SEED = 200, 9, 42


def mixed(x: np.ndarray) -> np.ndarray:
    """Well spread 64-bit numbers from consecutive ones (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bag_weights(hashes: np.ndarray, bags: int, seed: int = SEED) -> np.ndarray:
    """How often each row is in each bag: Poisson numbers of mean 1 from the row's hash, so a row has the same ones wherever it is. That is a bootstrap without knowing the rows' number."""
    with np.errstate(over="ignore"):
        step = (np.arange(1, bags + 1, dtype=np.uint64) + np.uint64(seed << 32)) * np.uint64(0x9E3779B97F4A7C15)
        u = (mixed(hashes.astype(np.uint64)[:, None] + step) >> np.uint64(11)) / 2.0**53
    upto = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(20)])
    return np.searchsorted(upto, u.ravel(), side="right").reshape(u.shape)


def bag_features(n: int, bags: int, most: int | None = None, seed: int = SEED) -> list[list[int]]:
    """The features that each bag may split on, in the order in which ties are settled: the root of their number."""
    most = min(n, most or max(1, int(math.sqrt(n))))
    rng = np.random.default_rng(seed)
    return [rng.choice(n, most, replace=False).tolist() for _ in range(bags)]


def thresholds(train: DataFrame, features: list[str], most: int = THRESHOLDS) -> list[list[float]]:
    """Where each feature may be split: values at 5 to 95 % of the training rows, off by a rank of a ten-thousandth of them at most, all features in one aggregate; the middle of a feature of two values; nothing for one of a single value."""
    shares = np.linspace(0.05, 0.95, max(3, most)).tolist()
    own = train.select(*[F.col(c).cast("double").alias(c) for c in features])
    ends = own.agg(*[x for c in features for x in (F.min(c), F.max(c))]).first()
    inner = own.agg(*[F.count_if((F.col(c) > ends[2 * i]) & (F.col(c) < ends[2 * i + 1])) if ends[2 * i] is not None else F.lit(0) for i, c in enumerate(features)], *[F.percentile_approx(c, F.array(*map(F.lit, shares)), 10_000).alias(f"{c}_cuts") for c in features]).first()
    out = []
    for i, c in enumerate(features):
        low, high = ends[2 * i], ends[2 * i + 1]
        if low is None or low == high:
            out.append([])
        elif not inner[i]:
            out.append([(low + high) / 2])
        else:
            out.append(sorted(set(inner[f"{c}_cuts"])))
    return out


@dataclass
class Stumps:
    """A fitted ensemble: `stumps` has a row per bag (feature -1 where nothing gains), and what it takes to score rows."""

    features: list[str]
    labels: list[str]
    cuts: list[list[float]]
    stumps: pd.DataFrame

    def importances(self) -> dict[str, float]:
        """Each feature's share of all gains."""
        gains = self.stumps.groupby("feature")["gain"].sum()
        total = gains.sum()
        return {f: float(gains.get(i, 0.0) / total) if total > 0 else 0.0 for i, f in enumerate(self.features)}

    def probabilities(self) -> list[Column]:
        """Each class's probability as an expression: the sum over features of a step function, as many steps as a feature has thresholds, whatever the number of bags."""
        bags, constant = len(self.stumps), np.zeros(len(self.labels))
        steps = {i: np.zeros((len(c) + 1, len(self.labels))) for i, c in enumerate(self.cuts)}
        for feature, cut, left, right in zip(*(self.stumps[c] for c in ("feature", "cut", "left", "right")), strict=True):
            if feature < 0:
                constant += left
                continue
            steps[feature][: cut + 1] += left
            steps[feature][cut + 1 :] += right
        used = sorted(set(self.stumps["feature"]) - {-1})
        bins = {i: F.coalesce(sum((F.col(self.features[i]) > c).cast("int") for c in self.cuts[i]), F.lit(len(self.cuts[i]))) for i in used}
        out = []
        for k in range(len(self.labels)):
            parts = [F.element_at(F.array(*[F.lit(float(x)) for x in steps[i][:, k]]), bins[i] + 1) for i in used]
            out.append((sum(parts, F.lit(float(constant[k])))) / bags)
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """df with `probability`, an array in the order of the labels, and `prediction`, the place of the first largest one. A null feature counts as large."""
        scored = df.withColumn("probability", F.array(*self.probabilities()))
        return scored.withColumn("prediction", (F.array_position("probability", F.array_max("probability")) - 1).cast("double"))


def counted(train: DataFrame, features: list[str], label: str, key: str, labels: list[str], cuts: list[list[float]], drawn: list[list[int]], seed: int = SEED) -> DataFrame:
    """(bag, feature, bin, class, n): rows of each bag by bin and class, for the features that the bag may split on.

    A task adds up its rows' weights for all bags by matrix products and returns sums only, bags * features of a bag * bins * classes at most; Spark adds up the tasks'.
    """
    bags, classes = len(drawn), len(labels)
    users = [[b for b, own in enumerate(drawn) if f in own] for f in range(len(features))]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = [np.zeros(((len(c) + 1) * classes, len(u))) for c, u in zip(cuts, users, strict=True)]
        for batch in batches:
            weights = bag_weights(batch["h"].to_numpy(np.int64), bags, seed).astype(float)
            kind = batch["k"].to_numpy(np.int64)
            for f, (c, u) in enumerate(zip(cuts, users, strict=True)):
                if c and u:
                    x = batch[f"x{f}"].to_numpy(float)
                    at = np.searchsorted(c, np.where(np.isnan(x), np.inf, x), side="left") * classes + kind
                    order = np.argsort(at, kind="stable")
                    first = np.flatnonzero(np.r_[True, np.diff(at[order]) > 0])
                    sums[f][at[order][first]] += np.add.reduceat(weights[order][:, u], first, axis=0)
        for f, (own, u) in enumerate(zip(sums, users, strict=True)):
            at, b = np.nonzero(own)
            yield pd.DataFrame({"bag": np.array(u, dtype=np.int64)[b] if len(b) else np.zeros(0, np.int64), "feature": f, "bin": at // classes, "class": at % classes, "n": own[at, b].astype(np.int64)})

    names = F.array(*map(F.lit, labels))
    ready = train.select(F.xxhash64(key).alias("h"), (F.array_position(names, F.col(label).cast("string")) - 1).alias("k"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)])
    return ready.mapInPandas(run, "bag long, feature long, bin long, class long, n long").groupBy("bag", "feature", "bin", "class").agg(F.sum("n").alias("n"))


def best_stumps(counts: DataFrame, cuts: list[list[float]], drawn: list[list[int]], classes: int) -> pd.DataFrame:
    """Each bag's best split by Gini gain of Laplace-smoothed class shares; ties go to the feature drawn first, then to the lower threshold. The counts are as many as bags, features and bins make, not as rows."""
    table = [np.zeros((len(own), max(map(len, cuts), default=0) + 1, classes)) for own in drawn]
    for bag, feature, b, k, n in counts.collect():
        table[bag][drawn[bag].index(feature), b, k] = n
    share = lambda n: (n + 1) / (n.sum(axis=-1, keepdims=True) + classes)
    gini = lambda p: 1 - (p**2).sum(axis=-1)
    rows = []
    for own, n in zip(drawn, table, strict=True):
        used = [j for j, f in enumerate(own) if n[j].sum()]
        every = n[used[0]].sum(axis=0) if used else np.zeros(classes)
        best = {"feature": -1, "cut": -1, "threshold": 0.0, "left": share(every), "right": share(every), "gain": 0.0}
        for j in used:
            left = n[j].cumsum(axis=0)[: len(cuts[own[j]])]
            right = every - left
            a, b = left.sum(axis=1), right.sum(axis=1)
            gain = np.where((a > 0) & (b > 0), gini(share(every)) - (a * gini(share(left)) + b * gini(share(right))) / every.sum(), 0)
            for cut in np.flatnonzero(gain > best["gain"] + 1e-15):
                if gain[cut] > best["gain"] + 1e-15:
                    best = {"feature": own[j], "cut": int(cut), "threshold": cuts[own[j]][cut], "left": share(left[cut]), "right": share(right[cut]), "gain": float(gain[cut])}
        rows.append(best)
    return pd.DataFrame(rows)


def fit(train: DataFrame, features: list[str], label: str, key: str, bags: int = BAGS, most: int = THRESHOLDS, seed: int = SEED) -> Stumps:
    """Bagged stumps over the training rows: Poisson bootstrap by the rows' keys, a draw of features and nine thresholds a bag, every stump read from one aggregate of counts.

    Thresholds are those of all training rows, not of each bag. Null features count as larger than any threshold; rows without a label take no part.
    """
    train = train.where(F.col(label).isNotNull())
    labels = sorted(r[0] for r in train.select(F.col(label).cast("string")).distinct().collect())
    if not labels:
        raise ValueError("no rows to fit on")
    cuts, drawn = thresholds(train, features, most), bag_features(len(features), bags, seed=seed)
    counts = counted(train, features, label, key, labels, cuts, drawn, seed)
    return Stumps(features, labels, cuts, best_stumps(counts, cuts, drawn, len(labels)))
