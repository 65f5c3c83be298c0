"""Near duplicates: BagMinHash signatures over five-word shingles, banding, exact multiset overlap."""

from __future__ import annotations

import hashlib
import re
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .frames import drop_table, fresh, release_memory, small, small_batches, text_of, written

SHINGLE = 5
SIMILAR = 0.8
#: 32 bands of 5 registers: two texts of similarity 0.8 share no band with a chance of 3 in a million.
BANDS, ROWS = 32, 5
#: Texts, and shingles, of a block: what one group of comparisons takes of each of its two sides, about.
BLOCK_TEXTS, BLOCK_SHINGLES = 512, 400_000
#: Texts of one class in a bucket from which on they have blocks of their own, which aren't compared with one another.
BIG = 64
#: Distinct shingles that are signed together, and shingles of texts just compared that a worker remembers (8 bytes each).
BATCH_SHINGLES, HELD_SHINGLES = 60_000, 1_000_000
_WORD = re.compile(r"\w+")
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class WordKeys(dict):
    """64-bit keys of words, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        got = self[word] = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        return got


_keys = WordKeys()


def stir(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing function (shift, multiply), element by element."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def shingles(text: str | None, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a text's k-word shingles, ascending, and how often each occurs. A text of fewer words is one shingle."""
    found = _WORD.findall((text or "").lower())
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    words = np.fromiter(map(_keys.__getitem__, found), dtype=np.uint64, count=len(found))
    width = min(k, len(words))
    n = len(words) - width + 1
    keys = np.full(n, width, dtype=np.uint64)
    for i in range(width):
        keys = stir(keys * _GOLDEN + words[i : i + n])
    return np.unique(keys, return_counts=True)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets: sum of the smaller counts over sum of the larger ones."""
    total = int(a[1].sum() + b[1].sum())
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    return both / (total - both) if total else 0.0


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], registers: int = BANDS * ROWS) -> np.ndarray:
    """BagMinHash signatures of non-empty multisets, a row each.

    Every shingle carries a Poisson process of points over time and weight. The weight axis is cut into
    dyadic intervals [0,1), [1,2), [2,4), ...: an interval's points come at a rate of its length, each with a
    uniform place in it, and count only if that lies below the shingle's weight. A point falls on one
    register; a register keeps its earliest point. So two multisets agree in a register with the probability
    of their weighted Jaccard similarity. Points are made only up to the time by which all registers are
    surely filled, and once more, for longer, where one isn't.
    """
    out = np.zeros((len(bags), registers), dtype=np.uint64)
    todo = np.arange(len(bags))
    slack = 6.0
    while len(todo):
        weight = np.array([bags[d][1].sum() for d in todo], dtype=float)
        until = registers / weight * (np.log(registers) + slack)
        owner, key, length, low, count = [], [], [], [], []
        for at, d in enumerate(todo):
            keys, counts = bags[d]
            top = int(counts.max())
            j = 0
            while (0 if j == 0 else 1 << (j - 1)) < top:
                floor = 0 if j == 0 else 1 << (j - 1)
                own = counts > floor
                n = int(own.sum())
                owner.append(np.full(n, at))
                key.append(stir(keys[own] ^ stir(np.array([j + 1]))))
                length.append(np.full(n, float(1 if j == 0 else floor)))
                low.append(np.full(n, float(floor)))
                count.append(counts[own])
                j += 1
        owner, key, length, low, count = map(np.concatenate, (owner, key, length, low, count))
        time, limit = np.zeros(len(key)), until[owner]
        at_reg, at_time, at_point = [], [], []
        step = 0
        while len(key):
            step += 1
            h = stir(key ^ stir(np.array([step])))
            time = time - np.log(((h >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)) / length
            live = time < limit
            key, time, limit, owner, length, low, count, h = (x[live] for x in (key, time, limit, owner, length, low, count, h))
            point = stir(h ^ np.uint64(0xA0761D6478BD642F))
            place = low + length * ((point >> np.uint64(40)).astype(float) / (1 << 24))
            held = np.floor(place) < count
            at_reg.append(owner[held] * registers + (point[held] % np.uint64(registers)).astype(np.int64))
            at_time.append(time[held])
            at_point.append(stir(point[held]))
        reg, time, point = map(np.concatenate, (at_reg, at_time, at_point))
        order = np.argsort(-time, kind="stable")
        flat = np.zeros(len(todo) * registers, dtype=np.uint64)
        full = np.zeros(len(todo) * registers, dtype=bool)
        flat[reg[order]] = point[order]
        full[reg] = True
        flat, full = flat.reshape(-1, registers), full.reshape(-1, registers)
        out[todo] = flat
        todo = todo[~full.all(axis=1)]
        slack *= 3
    return out


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A key for each band of each signature; keys of different bands differ."""
    keys = np.zeros((len(signature), bands), dtype=np.uint64) + np.arange(bands, dtype=np.uint64)
    for r in range(rows):
        keys = stir(keys * _GOLDEN + signature[:, r::rows][:, :bands])
    return keys.view(np.int64)


def elements(bag: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """A multiset as a set: the i-th copy of a shingle is an element of its own, so shared elements are the sum of the smaller counts."""
    keys, counts = bag
    rank = (np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)).astype(np.uint64)
    return np.where(rank > 0, stir(np.repeat(keys, counts) + rank * _GOLDEN), np.repeat(keys, counts))


def _signed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        digest = np.zeros((len(texts), 2), dtype=np.int64)
        weight = np.zeros(len(texts), dtype=np.int64)
        bands: list = [None] * len(texts)
        held: list[tuple[int, tuple[np.ndarray, np.ndarray]]] = []
        size = 0

        def flush() -> None:
            keys = band_keys(signatures([b for _, b in held]))
            for (i, _), row in zip(held, keys, strict=True):
                bands[i] = row

        # Texts of like length together: short ones need many points a shingle.
        for i in sorted(range(len(texts)), key=lambda i: len(texts.iat[i] or "")):
            bag = shingles(texts.iat[i])
            if not len(bag[0]):
                continue
            digest[i] = np.frombuffer(hashlib.blake2b(bag[0].tobytes() + bag[1].tobytes(), digest_size=16).digest(), dtype="<i8")
            weight[i] = bag[1].sum()
            held.append((i, bag))
            size += len(bag[0])
            if size >= BATCH_SHINGLES:
                flush()
                held, size = [], 0
        if held:
            flush()
        yield pd.DataFrame({"d1": digest[:, 0], "d2": digest[:, 1], "weight": weight, "bands": bands})
    _keys.clear()
    release_memory()


def joined(first: list[np.ndarray], second: list[np.ndarray] | None, class_of: list[int]) -> list[tuple[int, int]]:
    """Pairs of places, first and then second, that link texts of different classes and that no links so far have joined.

    Texts are sets of elements. Each of `first` is compared with each of `second`, or, where that is None, with those of `first` before it.
    """
    every = first + (second or [])
    size = np.array([len(x) for x in every])
    _, at = np.unique(np.concatenate(every), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(size)])
    mark = np.zeros(int(at.max()) + 1, dtype=np.int32)
    up: dict[int, int] = {}

    def top(c: int) -> int:
        while c in up:
            c = up[c]
        return c

    found = []
    for i in range(len(first)):
        low, high = (len(first), len(every)) if second is not None else (0, i)
        if low == high:
            continue
        own = at[starts[i] : starts[i + 1]]
        mark[own] = 1
        both = np.add.reduceat(mark[at[starts[low] : starts[high]]], starts[low:high] - starts[low])
        mark[own] = 0
        for j in np.flatnonzero(both >= SIMILAR * (size[i] + size[low:high] - both)) + low:
            a, b = top(class_of[i]), top(class_of[j])
            if a != b:
                up[a] = b
                found.append((i, int(j)))
    return found


def _linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of groups of rows (group, side, node, label, text) that come one after the other: sides 0 and 1 are compared, or side 0 with itself."""
    kept: OrderedDict[int, np.ndarray] = OrderedDict()
    size = 0

    def bag(node: int, text: str) -> np.ndarray:
        nonlocal size
        if node in kept:
            kept.move_to_end(node)
            return kept[node]
        got = kept[node] = elements(shingles(text))
        size += len(got)
        while size > HELD_SHINGLES and len(kept) > 1:
            size -= len(kept.popitem(last=False)[1])
        return got

    now, rows = None, []

    def links_of() -> list[tuple[int, int]]:
        rows.sort(key=lambda r: r[0])
        first = [x for side, _, _, x in rows if side == 0]
        second = [x for side, _, _, x in rows if side == 1]
        pairs = joined(first, second or None, [label for _, _, label, _ in rows]) if first else []
        return [(min(a, b), max(a, b)) for a, b in ((rows[i][1], rows[j][1]) for i, j in pairs)]

    for batch in batches:
        found = []
        for group, side, node, label, text in zip(*(batch[c].tolist() for c in ("group", "side", "node", "label", "text")), strict=True):
            if group != now:
                found += links_of()
                now, rows = group, []
            rows.append((side, node, label, bag(node, text)))
        yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")
    yield pd.DataFrame(links_of(), columns=["a", "b"], dtype="int64")
    kept.clear()
    _keys.clear()
    release_memory()


def _compared(work: DataFrame, table: DataFrame) -> DataFrame:
    """Links (a, b) within the groups of work(group, side, node, label), written. Only texts that some group needs are shuffled."""
    work = written(work, "work")
    need = small(written(work.select("node").distinct(), "need"))
    texts = table.join(need, "node", "left_semi")
    parts = int(work.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    full = work.join(texts, "node").repartition(parts, "group").sortWithinPartitions("group", "side")
    return written(full.select("group", "side", "node", "label", "text").mapInPandas(_linked, "a long, b long"), "links")


def _stars(hits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """hits(key, node, weight, n) with each bucket's leader, written; and the groups that compare leaders with the other texts of their buckets.

    A leader is the text that shares most buckets with most texts. Of a text and a leader that meet in several buckets one comparison is made, and the
    texts of a leader are dealt out to groups of about BLOCK_TEXTS.
    """
    score = hits.groupBy("node").agg(F.sum("n").alias("score"))
    lead = hits.join(score, "node").groupBy("key").agg(F.max(F.struct("score", "node", "weight")).alias("s"))
    led = written(hits.join(lead.select("key", F.col("s.node").alias("lead"), F.col("s.weight").alias("lead_weight")), "key"), "led")
    fits = F.least("weight", "lead_weight") >= SIMILAR * F.greatest("weight", "lead_weight")
    pairs = written(led.where((F.col("node") != F.col("lead")) & fits).groupBy("node", "lead").agg(F.first("weight").alias("weight")), "pairs")
    many = pairs.groupBy("lead").agg(_blocks().alias("many"))
    dealt = written(pairs.join(many, "lead").select("lead", "node", F.pmod(F.xxhash64("node"), "many").alias("part")), "dealt")
    group = F.xxhash64("lead", "part")
    others = dealt.select(group.alias("group"), F.lit(1).alias("side"), "node", F.col("node").alias("label"))
    heads = dealt.select("lead", "part").distinct().select(group.alias("group"), F.lit(0).alias("side"), F.col("lead").alias("node"), F.col("lead").alias("label"))
    return led, heads.unionByName(others)


def _blocks() -> Column:
    """How many blocks the rows of a group need."""
    return F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS), F.ceil(F.sum("weight") / BLOCK_SHINGLES))


def _rest(led: DataFrame, label: DataFrame) -> DataFrame:
    """Groups that compare all other texts of a bucket, but for those that are in one class already.

    Buckets of the same texts count once. A bucket's texts are dealt out to blocks, those of a class with BIG texts or more to blocks of its own; a group compares two blocks, or the
    texts of a block of small classes.
    """
    own = led.where("node != lead").join(label, "node", "left").select("key", "node", "weight", F.coalesce("label", "node").alias("label"))
    sums = [F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("s1"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("s2")]
    live = own.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), *sums).where("low != high")
    live = live.groupBy("n", "s1", "s2").agg(F.min("key").alias("key")).select("key")
    own = written(own.join(live, "key", "left_semi"), "open")
    classes = own.groupBy("key", "label").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") >= BIG).select("key", "label", F.col("label").alias("big"))
    own = own.join(classes, ["key", "label"], "left").withColumns({"alone": F.col("big").isNotNull(), "big": F.coalesce("big", F.lit(0).cast("long"))})
    own = written(own, "parts")
    kind = ["key", "alone", "big"]
    many = written(own.groupBy(*kind).agg(_blocks().cast("long").alias("many")), "many")
    own = own.join(many, kind).withColumn("block", F.xxhash64("alone", "big", F.pmod(F.xxhash64("node"), "many")))
    blocks = many.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("many") - 1))).select(*kind, F.xxhash64("alone", "big", "i").alias("block"))
    x = blocks.select("key", *[F.col(c).alias(f"x_{c}") for c in ("alone", "big", "block")])
    y = blocks.select("key", *[F.col(c).alias(f"y_{c}") for c in ("alone", "big", "block")])
    differ = ~F.col("x_alone") | ~F.col("y_alone") | (F.col("x_big") != F.col("y_big"))
    pairs = x.join(y, "key").where((F.col("x_block") <= F.col("y_block")) & differ)
    group = F.xxhash64("key", "x_block", "y_block")
    sides = F.when(F.col("x_block") == F.col("y_block"), F.array(F.struct(F.lit(0).alias("side"), F.col("x_block").alias("block")))).otherwise(
        F.array(F.struct(F.lit(0).alias("side"), F.col("x_block").alias("block")), F.struct(F.lit(1).alias("side"), F.col("y_block").alias("block")))
    )
    asked = pairs.select("key", group.alias("group"), F.explode(sides).alias("s")).select("key", "group", "s.side", "s.block")
    return own.join(asked, ["key", "block"]).select("group", "side", "node", "label")


def classes_of(multisets: DataFrame, table: DataFrame) -> DataFrame:
    """(node, label) of the multisets of multisets(node, weight, bands) that have a link, written: the components of all links between texts that share a band.

    table(node, text) has their texts. First the leader of each bucket is compared with its other texts; then, where the others are still in more than one class, all
    the rest are compared block by block. So every pair that shares a band is compared unless other links join it already.
    """
    each = multisets.select("node", "weight", F.explode("bands").alias("key"))
    shared = small(written(each.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared"))
    hits = written(each.join(shared, "key"), "buckets")
    led, work = _stars(hits)
    found = _compared(work, table)
    label = components(found)
    more = _compared(_rest(led, label), table)
    drop_table(hits), drop_table(led)
    if more.limit(1).count() == 0:
        return label
    return components(found.unionByName(more))


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of the nodes of edges (a, b): the smallest node of each component.

    Each round gives a node the smallest label next to it, then that label's own label, so that paths shrink by halves.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    label = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    while True:
        around = both.join(label.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("next"))
        step = label.join(around, F.col("node") == F.col("a")).select("node", "label", F.least("label", "next").alias("next"))
        own = label.select(F.col("node").alias("next"), F.col("label").alias("far"))
        new = written(step.join(own, "next", "left").select("node", F.col("label").alias("old"), F.least("next", F.coalesce("far", "next")).alias("label")), "labels")
        moved = new.where("old != label").limit(1).count()
        drop_table(label)
        label = new.select("node", "label")
        if not moved:
            return label


def near_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of df with class_id, class_size, n_links and kept added.

    Texts are multisets of five-word shingles (lower-cased runs of letters, digits and underscores; a shorter
    text is one shingle). Texts with equal multisets are copies. Different ones are linked if their weighted Jaccard
    similarity is 0.8 or more: BagMinHash signatures are banded, and candidates' multisets are compared in full.
    Copies and links make classes; class_id is a class's smallest id, whose row is the one kept. n_links counts the different multisets that a text's links join it
    to, directly or through others: those of its class, without its own.

    Texts without a word (null, empty) are classes of their own. Very long texts are compared whole. Null ids rank last. Rows that repeat an id are
    separate rows, of which one is kept per class. Columns of df named like an added one are replaced. An empty table gives an empty table.
    """
    out = ["class_id", "class_size", "n_links", "kept"]
    df = df.drop(*[c for c in df.columns if c.lower() in out and c not in (id_col, text_col)])
    signed = F.pandas_udf(_signed, "d1 long, d2 long, weight long, bands array<long>")
    (row, sig, lab, best, size, links) = fresh(df, "nd_row", "nd_sig", "nd_label", "nd_best", "nd_size", "nd_links")
    d1, d2, node = fresh(df, "nd_d1", "nd_d2", "nd_node")
    with small_batches(df.sparkSession):
        table = written(df.withColumn(row, F.monotonically_increasing_id()).withColumn(sig, signed(text_of(text_col))), "signed")
        worded = table.where(F.col(f"{sig}.weight") > 0)
        least = F.min(F.struct(F.col(row).alias("node"), F.col(f"{sig}.weight").alias("weight"), F.col(f"{sig}.bands").alias("bands")))
        digests = worded.groupBy(F.col(f"{sig}.d1").alias(d1), F.col(f"{sig}.d2").alias(d2)).agg(least.alias("s"), F.count(F.lit(1)).alias("n"))
        multisets = written(digests.select(d1, d2, F.col("s.node").alias("node"), F.col("s.weight").alias("weight"), F.col("s.bands").alias("bands"), "n"), "multisets")
        label = classes_of(multisets.select("node", "weight", "bands"), table.select(F.col(row).alias("node"), text_of(text_col).alias("text")))
    known = multisets.join(label, "node", "left").where("n > 1 or label is not null")
    notes = small(written(known.select(d1, d2, F.col("node").alias(node), F.coalesce("label", "node").alias(lab)), "notes"))

    # Rows that aren't in a class of two or more have keys of their own, so they don't meet in one task.
    ident, alone = F.col(f"`{id_col}`"), -F.col(row) - 1
    keyed = table.withColumns({d1: F.when(F.col(f"{sig}.weight") > 0, F.col(f"{sig}.d1")).otherwise(alone), d2: F.when(F.col(f"{sig}.weight") > 0, F.col(f"{sig}.d2"))})
    rows = keyed.withColumn(d2, F.coalesce(d2, F.lit(0).cast("long"))).join(notes, [d1, d2], "left")
    first = F.min(F.struct(ident.isNull().alias("no"), ident.alias("id"), F.col(row).alias("row")))
    classes = rows.where(F.col(lab).isNotNull()).groupBy(lab).agg(first.alias(best), F.count(F.lit(1)).alias(size), (F.count_if(F.col(row) == F.col(node)) - 1).alias(links))
    classes = small(written(classes, "classes"))
    return rows.withColumn(lab, F.coalesce(F.col(lab), alone)).join(classes, lab, "left").select(
        *[F.col(f"`{c}`") for c in df.columns if c.lower() not in out],
        F.when(F.col(best).isNull(), ident).otherwise(F.col(f"{best}.id")).alias("class_id"),
        F.coalesce(size, F.lit(1)).cast("long").alias("class_size"),
        F.coalesce(links, F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(F.col(f"{best}.row") == F.col(row), F.lit(True)).alias("kept"),
    )
