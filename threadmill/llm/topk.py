"""Exact top-k inner-product search with ball trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .frames import written

LEAF = 128
#: Vectors of a shard and queries of a block: what one task holds. Blocks that one task takes in turn.
SHARD_ROWS, BLOCK_ROWS, BLOCKS = 16_384, 4_096, 16


class BallTree:
    """Balls over vectors: a node's children halve its vectors along its widest direction; leaves hold LEAF vectors or equal ones."""

    def __init__(self, vectors: np.ndarray, leaf: int = LEAF) -> None:
        self.order = np.arange(len(vectors))
        self.first: list[int] = []
        self.last: list[int] = []
        self.left: list[int] = []
        self.right: dict[int, int] = {}
        centres, radii = [], []
        todo = [(0, len(vectors), -1)]
        while todo:
            a, b, parent = todo.pop()
            own = vectors[self.order[a:b]]
            centre = own.mean(axis=0)
            away = own - centre
            far = float(np.sqrt((away**2).sum(axis=1).max()))
            node = len(self.first)
            self.first.append(a)
            self.last.append(b)
            self.left.append(-1)
            centres.append(centre)
            radii.append(far)
            if parent >= 0 and self.left[parent] < 0:
                self.left[parent] = node
            elif parent >= 0:
                self.right[parent] = node
            if b - a > leaf and far > 0:
                pole = own[(away**2).sum(axis=1).argmax()]
                along = own @ (pole - centre)
                middle = (b - a) // 2
                self.order[a:b] = self.order[a:b][np.argpartition(along, middle)]
                todo += [(a + middle, b, node), (a, a + middle, node)]
        self.centres, self.radii = np.array(centres), np.array(radii)


def search(tree: BallTree, vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int, floor: np.ndarray, whole: type = float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per query the best k (scores, ids), best first; of them all that may beat floor[query], the kth score known so far.

    Best first: each query goes on with the open node of the highest bound, centre . query + radius * |query|, and stops when that is under its kth score. A
    node's children are opened with bounds no higher than its own, a leaf's vectors are scored, which raises the kth score. Queries that are at the same node take the step together.

    `whole` is the type that scores are exact in: float, np.int64 or object. With the latter two, doubles find what may be good enough, with room for their errors, and its scores are worked out anew.
    """
    scores = [np.zeros(0, object if whole is object else np.int64) for _ in queries]
    ints = None if whole is float else (np.array([[int(x) for x in v] for v in vectors], object) if whole is object else vectors.astype(np.int64))
    found = [np.zeros(0, np.int64) for _ in queries]
    kth = floor.astype(float) if whole is float else np.nextafter(floor.astype(float), -np.inf)
    longest = np.sqrt((vectors.astype(float) ** 2).sum(axis=1).max(initial=0))
    norms = np.sqrt((queries.astype(float) ** 2).sum(axis=1))
    opened = np.full((len(queries), len(tree.first)), -np.inf)

    def bound(who: np.ndarray, node: int) -> np.ndarray:
        got = queries[who] @ tree.centres[node] + tree.radii[node] * norms[who]
        return got + 1e-9 * np.abs(got) + 1e-6 + 1e-11 * norms[who] * longest  # above any rounding error

    live = np.arange(len(queries))
    opened[:, 0] = bound(live, 0)
    while len(live):
        best = opened[live].argmax(axis=1)
        top = opened[live, best]
        go = (top >= kth[live]) & (top > -np.inf)
        live, best, top = live[go], best[go], top[go]
        order = np.argsort(best, kind="stable")
        cuts = np.flatnonzero(np.diff(best[order])) + 1
        for at in np.split(order, cuts) if len(order) else []:
            node, who = int(best[at[0]]), live[at]
            opened[who, node] = -np.inf
            if tree.left[node] >= 0:
                for child in (tree.left[node], tree.right[node]):
                    opened[who, child] = np.minimum(bound(who, child), top[at])
                continue
            rows = tree.order[tree.first[node] : tree.last[node]]
            for q, line in zip(who, queries[who] @ vectors[rows].T, strict=True):
                room = 0 if whole is float else 1e-11 * norms[q] * longest
                good = np.flatnonzero((line >= kth[q] - room) & (ids[rows] != own[q]))
                if not len(good):
                    continue
                if whole is float:
                    new = line[good].astype(np.int64)
                else:
                    new = ints[rows[good]] @ np.array([int(x) for x in queries[q]], whole)
                s = np.concatenate([scores[q], new])
                v = np.concatenate([found[q], ids[rows[good]]])
                first = np.array(sorted(range(len(s)), key=lambda i: (-s[i], v[i]))[:k]) if whole is object else np.lexsort((v, -s))[:k]
                scores[q], found[q] = s[first], v[first]
                if len(first) == k:
                    last = float(s[first[-1]])
                    kth[q] = max(kth[q], last if whole is float else np.nextafter(last, -np.inf))
    return list(zip(scores, found, strict=True))


def searched(k: int, block_rows: int, whole: type = float):
    """Searches groups of rows (grp, kind, id, v, low) that come one after the other: a shard's vectors (kind 0), of which one tree is built, then its queries, some at a time."""

    def result(ids: list, got: list[tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
        sizes = [len(s) for s, _ in got]
        table = {"query_id": np.repeat(np.array(ids, dtype=np.int64), sizes)}
        table |= {"vec_id": np.concatenate([v for _, v in got]), "score": np.concatenate([s for s, _ in got]).astype(np.int64)}
        return pd.DataFrame(table)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held, asked, tree = None, [], [], None

        def answers() -> pd.DataFrame:
            nonlocal tree, asked
            if tree is None:
                matrix = np.stack([v for _, v in held])
                tree = (BallTree(matrix), matrix, np.array([i for i, _ in held], dtype=np.int64))
            own = [i for i, _, _ in asked]
            got = search(*tree, np.stack([v for _, v, _ in asked]), np.array(own, dtype=np.int64), k, np.array([low for _, _, low in asked]), whole)
            asked = []
            return result(own, got)

        for batch in batches:
            for group, kind, ident, v, low in zip(*(batch[c] for c in ("grp", "kind", "id", "v", "low")), strict=True):
                if group != now:
                    if asked and held:
                        yield answers()
                    now, held, asked, tree = group, [], [], None
                if kind == 0:
                    held.append((ident, v))
                    continue
                asked.append((ident, v, low))
                if len(asked) == block_rows and held:
                    yield answers()
        if asked and held:
            yield answers()

    return run


def scaled(embedding: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component; null for a vector that is null, empty or holds a null or non-finite component."""
    wide = embedding.cast("array<double>")
    fit = (F.size(wide) > 0) & F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = lambda y: F.when(F.abs(y) < F.lit(2.0**52), F.floor(y).cast("double")).otherwise(y)  # noqa: E731  larger doubles have no fraction, and may be no longs
    return F.when(fit, F.transform(wide, lambda x: whole(x * F.lit(float(scale)))))


def top_k(df: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The k best candidates of each query by inner product of scaled vectors: query_id, rank, vec_id, score.

    Candidates are dealt to shards by id. A task builds the ball tree of one shard once and runs all queries, or BLOCKS blocks of them, through it, a block at a time.
    Shards are searched in waves of 1, 2, 4, ... shards, and each wave starts from the kth scores that all waves before have left, so most of a late shard's nodes are never opened. Each task returns at most k rows a query.

    A query's own id is no candidate; ties go to the smaller id. Rows with a null id, and vectors that are null, empty or hold null or
    non-finite components, take no part. A vector is compared with vectors of its own length only. Of rows that repeat an id, each is a candidate, and
    the first by vector order is the query. Where scores may reach 2 ** 53, which doubles don't hold exactly, they are worked out in whole numbers; only a score among a query's best that is no long is an error. Other columns of df aren't carried. An empty table gives an empty table.
    """
    spark = df.sparkSession
    vectors = written(
        df.select(F.col(f"`{id_col}`").cast("long").alias("id"), scaled(F.col(f"`{vector_col}`")).alias("v"), is_query.alias("q"))
        .where("id is not null and v is not null")
        .withColumn("d", F.size("v")),
        "vectors",
    )
    sums = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("most")).first()
    most = sums["most"] or 0
    whole = float if most < 2.0**53 else np.int64 if most < 2.0**62 else object
    shards = max(1, -(-sums["n"] // shard_rows))
    base = vectors.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")).select("id", "v", "d", "shard")
    asked = written(vectors.where("q").groupBy("id", "d").agg(F.min("v").alias("v")), "asked")
    parts = max(1, -(-asked.count() // (BLOCKS * block_rows)))
    nothing = F.lit(float("-inf"))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")

    def wave(first: int, last: int, queries: DataFrame) -> DataFrame:
        """What the shards from `first` to before `last` have for the queries."""
        group = F.xxhash64("d", "shard", "part").alias("grp")
        copies = base.where(F.col("shard").between(first, last - 1)).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        sent = queries.withColumns({"shard": F.explode(F.sequence(F.lit(first), F.lit(last - 1))), "part": F.pmod(F.xxhash64("id", F.lit(5)), F.lit(parts)).cast("int")})
        rows = copies.select(group, F.lit(0).alias("kind"), "id", "v", nothing.alias("low")).unionByName(sent.select(group, F.lit(1).alias("kind"), "id", "v", "low"))
        dealt = rows.repartition((last - first) * parts, "grp").sortWithinPartitions("grp", "kind")
        return dealt.mapInPandas(searched(k, block_rows, whole), "query_id long, vec_id long, score long")

    found = spark.createDataFrame([], "query_id long, vec_id long, score long")
    first, width = 0, 1
    while True:
        known = found.groupBy(F.col("query_id").alias("id")).agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
        low = F.when(F.col("n") >= k, F.col("least").cast("double")).otherwise(nothing)
        queries = asked.join(known, "id", "left").select("id", "d", "v", low.alias("low"))
        last = min(shards, first + width)
        ranked = found.unionByName(wave(first, last, queries)).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        if last == shards:
            return ranked.select("query_id", "rank", "vec_id", "score")
        found = written(ranked.drop("rank"), "wave")
        first, width = last, 2 * width
