"""Frequent event sequences under gap and span limits, by associative summaries of time segments."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .frames import written

#: Events of a leaf chunk, and summaries that one task joins in a round of the tree.
CHUNK_ROWS, FAN = 32_768, 32
#: Widths of time cells that a round may choose from, as powers of two of a microsecond; the last one is all of time.
LEVELS = [*range(0, 62, 2), 62]
PREFIX, SUFFIX, INFIX = 0, 1, 2
SUMMARY = "client long, first long, last long, edge boolean, whole array<long>, frontiers array<long>"


class Limits:
    """Gap and span in microseconds, the number of kinds, and the longest pattern. Patterns are numbered: by length, then as numbers to the base of the kinds."""

    def __init__(self, gap: int, span: int, kinds: int, longest: int) -> None:
        self.gap, self.span, self.kinds, self.longest = gap, span, kinds, longest
        self.base = [0, 0]
        for m in range(1, longest + 1):
            self.base.append(self.base[-1] + kinds**m)

    def length(self, pattern: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.base[1 : self.longest + 1], pattern, side="right")

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Numbers of the patterns that go on from left to right; what would be too long is -1."""
        m, n = self.length(left), self.length(right)
        base = np.array([*self.base[: self.longest + 1], *[0] * self.longest])
        number = (left - base[m]) * self.kinds**n + right - base[n]
        return np.where(m + n <= self.longest, base[m + n] + number, -1)

    def reversed(self, pattern: np.ndarray) -> np.ndarray:
        m = self.length(pattern)
        base = np.array(self.base)
        rest, out = pattern - base[m], np.zeros_like(pattern)
        for i in range(self.longest):
            out = np.where(i < m, out * self.kinds + rest % self.kinds, out)
            rest = rest // self.kinds
        return base[m] + out


def latest_starts(t: np.ndarray, kind: np.ndarray, first: np.ndarray, tie: np.ndarray, lim: Limits, longest: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each length m: (m, kind before the last, starts, valid), a row per event and a column per pattern before these two.

    starts[i, p] is the latest start of an occurrence that ends at event i. The latest one is enough: of two occurrences the later places, one by one, are an
    occurrence too. So an event looks back to the latest event of each kind at which an occurrence ends, in its own client's events (from row first[i]) and before its own time (row tie[i]).
    """
    n = len(t)
    starts, valid = t[:, None], np.ones((n, 1), bool)
    yield 1, -1, starts, valid
    own = [np.flatnonzero(kind == c) for c in range(lim.kinds)]
    before = [np.searchsorted(rows, tie) - 1 for rows in own]  # place in its kind's rows of the last event before
    for m in range(2, longest + 1):
        parts = []
        for c in range(lim.kinds):
            rows = own[c]
            if not len(rows):
                got = np.zeros((n, starts.shape[1]), np.int64)
                yes = np.zeros(got.shape, bool)
            else:
                last = np.maximum.accumulate(np.where(valid[rows], rows[:, None], -1), axis=0)
                j = np.where((before[c] >= 0)[:, None], last[before[c]], -1)
                near = (j >= first[:, None]) & (t[:, None] - t[j] <= lim.gap)
                got = np.take_along_axis(starts, np.where(near, j, 0), axis=0)
                yes = near & (t[:, None] - got <= lim.span)
            yield m, c, got, yes
            if m < longest:
                parts.append((got, yes))
        if m < longest:
            starts = np.stack([x for x, _ in parts], axis=2).reshape(n, -1)
            valid = np.stack([x for _, x in parts], axis=2).reshape(n, -1)


def ties(client: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each event the first row of its client, and the first row of its time."""
    at = np.arange(len(t))
    fresh = np.r_[True, client[1:] != client[:-1]]
    moved = fresh | np.r_[True, t[1:] != t[:-1]]
    return np.maximum.accumulate(np.where(fresh, at, 0)), np.maximum.accumulate(np.where(moved, at, 0))


def whole_patterns(t: np.ndarray, kind: np.ndarray, first: np.ndarray, tie: np.ndarray, run: np.ndarray, runs: int, lim: Limits) -> list[np.ndarray]:
    """The numbers of all patterns that occur in each run of rows."""
    order = np.argsort(run * lim.kinds + kind, kind="stable")
    key = (run * lim.kinds + kind)[order]
    cuts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    ends = key[cuts]
    owner, number = [], []
    for m, c, _, valid in latest_starts(t, kind, first, tie, lim, lim.longest):
        seg, p = np.nonzero(np.logical_or.reduceat(valid[order], cuts, axis=0))
        owner.append(ends[seg] // lim.kinds)
        number.append(lim.base[m] + (p if c < 0 else p * lim.kinds + c) * lim.kinds + ends[seg] % lim.kinds)
    owner, number = np.concatenate(owner), np.concatenate(number)
    by = np.lexsort((number, owner))
    return np.split(number[by], np.searchsorted(owner[by], np.arange(1, runs)))


def latest_of_all(t: np.ndarray, kind: np.ndarray, lim: Limits) -> np.ndarray:
    """Rows (pattern, start, end): for each pattern short enough to go on, its occurrence with the latest start and end, which is one and the same."""
    first, tie = ties(np.zeros(len(t)), t)
    out = []
    for m, c, starts, valid in latest_starts(t, kind, first, tie, lim, lim.longest - 1):
        for z in range(lim.kinds):
            rows = np.flatnonzero(kind == z)[::-1]
            if len(rows):
                yes = valid[rows]
                p = np.flatnonzero(yes.any(axis=0))
                at = rows[yes.argmax(axis=0)[p]]
                out.append(np.stack([lim.base[m] + (p if c < 0 else p * lim.kinds + c) * lim.kinds + z, starts[at, p], t[at]], axis=1))
    return np.concatenate(out) if out else np.zeros((0, 3), np.int64)


def infixes(t: np.ndarray, kind: np.ndarray, lim: Limits) -> np.ndarray:
    """Rows (pattern, start, end): for each start of a pattern that may go on at both sides, its latest end."""
    out, n = [], len(t)
    if lim.longest < 3:
        return np.zeros((0, 3), np.int64)
    ends, valid = t[:, None], np.ones((n, 1), bool)
    own = [np.flatnonzero(kind == c) for c in range(lim.kinds)]
    far = [np.searchsorted(t[rows], t + lim.gap, side="right") - 1 for rows in own]
    for m in range(1, lim.longest - 1):
        for c, rows in enumerate(own):
            i, p = np.nonzero(valid[rows])
            out.append(np.stack([lim.base[m] + c * lim.kinds ** (m - 1) + p, t[rows[i]], ends[rows[i], p]], axis=1))
        if m == lim.longest - 2:
            break
        new_ends, new_valid = [], []
        for c, rows in enumerate(own):
            if not len(rows):
                new_ends.append(np.zeros_like(ends))
                new_valid.append(np.zeros_like(valid))
                continue
            last = np.maximum.accumulate(np.where(valid[rows], rows[:, None], -1), axis=0)
            j = np.where((far[c] >= 0)[:, None], last[far[c]], -1)
            yes = (j >= 0) & (t[j] > t[:, None])
            new_ends.append(np.take_along_axis(ends, np.where(yes, j, 0), axis=0))
            new_valid.append(yes)
        ends, valid = np.concatenate(new_ends, axis=1), np.concatenate(new_valid, axis=1)
    return np.concatenate(out)


def pareto(rows: np.ndarray) -> np.ndarray:
    """Of rows (pattern, start, end) those for which no other has no later start and no earlier end; by pattern, start and end rising."""
    if not len(rows):
        return rows
    rows = rows[np.lexsort((-rows[:, 2], rows[:, 1], rows[:, 0]))]
    kept, low = np.zeros(len(rows), bool), np.flatnonzero(np.r_[True, rows[1:, 0] != rows[:-1, 0]])
    for a, b in zip(low, [*low[1:], len(rows)], strict=True):
        best = np.maximum.accumulate(rows[a:b, 2])
        kept[a:b] = np.r_[True, rows[a + 1 : b, 2] > best[:-1]]
    return rows[kept]


def pruned(role: int, rows: np.ndarray, first: int, last: int, lim: Limits) -> np.ndarray:
    """Rows that events after `last` (and before `first`) can still go on from."""
    start, end = rows[:, 1], rows[:, 2]
    if role == PREFIX:
        return rows[(end >= last - lim.gap) & (start >= last - lim.span)]
    if role == SUFFIX:
        return rows[(start <= first + lim.gap) & (end <= first + lim.span)]
    return rows[(start <= first + lim.gap) & (end >= last - lim.gap)] if last - first <= lim.span else rows[:0]


class Summary:
    """What a segment of a client's time has to tell its neighbours: the patterns that occur in it, and per infix the frontiers of starts and ends by which it goes on.

    Extended to the right only (a prefix), the latest start and end are best, and to the left only (a suffix) the earliest ones: one occurrence has both. Extended at both sides
    (an infix), an early start and a late end are best: a Pareto frontier. Infixes of a segment longer than the span have no use.
    """

    def __init__(self, first: int, last: int, whole: np.ndarray, frontiers: list[np.ndarray]) -> None:
        self.first, self.last, self.whole, self.frontiers = first, last, whole, frontiers

    @classmethod
    def of_events(cls, t: np.ndarray, kind: np.ndarray, whole: np.ndarray, lim: Limits) -> Summary:
        first, last = int(t[0]), int(t[-1])
        a, b = np.searchsorted(t, last - lim.span), np.searchsorted(t, first + lim.span, side="right")
        prefix = latest_of_all(t[a:], kind[a:], lim)
        back = latest_of_all(-t[:b][::-1], kind[:b][::-1], lim)
        suffix = np.stack([lim.reversed(back[:, 0]), -back[:, 2], -back[:, 1]], axis=1)
        infix = infixes(t, kind, lim) if last - first <= lim.span else np.zeros((0, 3), np.int64)
        three = [pruned(role, rows, first, last, lim) for role, rows in enumerate((prefix, suffix, infix))]
        return cls(first, last, whole, [*three[:INFIX], pareto(three[INFIX])])

    @classmethod
    def read(cls, first: int, last: int, whole, frontiers) -> Summary:
        rows = np.asarray(frontiers, np.int64).reshape(-1, 4)
        return cls(int(first), int(last), np.asarray(whole, np.int64), [rows[rows[:, 0] == role, 1:] for role in (PREFIX, SUFFIX, INFIX)])

    def flat(self) -> np.ndarray:
        return np.concatenate([np.insert(rows, 0, role, axis=1) for role, rows in enumerate(self.frontiers)]).ravel()

    def then(self, other: Summary, lim: Limits) -> Summary:
        """The summary of this segment and the next one, all of whose times are later."""
        first, last = self.first, other.last
        (p, s, mid), (p2, s2, mid2) = self.frontiers, other.frontiers
        whole = [self.whole, other.whole]
        if len(p) and len(s2):
            fits = (s2[None, :, 1] - p[:, None, 2] <= lim.gap) & (s2[None, :, 2] - p[:, None, 1] <= lim.span)
            i, j = np.nonzero(fits)
            number = lim.joined(p[i, 0], s2[j, 0])
            whole.append(number[number >= 0])
        prefix, suffix, infix = [p, p2], [s, s2], [mid, mid2]
        for q, own in blocks(mid2):  # starts and ends rise together in a block
            at = np.searchsorted(own[:, 1], p[:, 2] + lim.gap, side="right") - 1
            prefix.append(with_ids(p[:, 0], q, p[:, 1], own[at, 2], at >= 0, lim))
        for q, own in blocks(mid):
            at = np.searchsorted(own[:, 2], s2[:, 1] - lim.gap)
            suffix.append(with_ids(np.full(len(s2), q), s2[:, 0], own[np.minimum(at, len(own) - 1), 1], s2[:, 2], at < len(own), lim))
            if last - first <= lim.span:
                for q2, own2 in blocks(mid2):
                    at = np.searchsorted(own2[:, 1], own[:, 2] + lim.gap, side="right") - 1
                    infix.append(with_ids(np.full(len(own), q), q2, own[:, 1], own2[at, 2], at >= 0, lim))
        rows = [pruned(role, np.concatenate(x), first, last, lim) for role, x in enumerate((prefix, suffix, infix))]
        goes_on = lim.length(rows[INFIX][:, 0]) <= lim.longest - 2
        ends = [x[lim.length(x[:, 0]) <= lim.longest - 1] for x in rows[:INFIX]]
        return Summary(first, last, np.unique(np.concatenate(whole)), [furthest(ends[0], 1), furthest(ends[1], -1), pareto(rows[INFIX][goes_on])])


def blocks(rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    if not len(rows):
        return
    cuts = np.flatnonzero(np.r_[True, rows[1:, 0] != rows[:-1, 0]])
    for a, b in zip(cuts, [*cuts[1:], len(rows)], strict=True):
        yield int(rows[a, 0]), rows[a:b]


def with_ids(left: np.ndarray, right, start: np.ndarray, end: np.ndarray, yes: np.ndarray, lim: Limits) -> np.ndarray:
    number = lim.joined(left, np.broadcast_to(right, left.shape))
    return np.stack([number, start, end], axis=1)[yes & (number >= 0)]


def furthest(rows: np.ndarray, sign: int) -> np.ndarray:
    """Of each pattern the row with the latest (sign 1) or earliest (-1) start and end."""
    if not len(rows):
        return rows
    rows = rows[np.lexsort((-sign * rows[:, 1], -sign * rows[:, 2], rows[:, 0]))]
    return rows[np.r_[True, rows[1:, 0] != rows[:-1, 0]]]


def summarised(lim: Limits, chunk_rows: int):
    """Summaries of sorted events (client, t, kind), a chunk after the other; a chunk holds whole clients and, at its ends, parts of two. Those two may go on in another chunk (edge)."""

    def chunk(client: np.ndarray, t: np.ndarray, kind: np.ndarray) -> pd.DataFrame:
        first, tie = ties(client, t)
        heads = np.unique(first)
        tails = np.r_[heads[1:], len(t)]
        run = np.searchsorted(heads, first)
        whole = whole_patterns(t, kind, first, tie, run, len(heads), lim)
        edge = np.zeros(len(heads), bool)
        edge[[0, -1]] = True
        fronts = [Summary.of_events(t[a:b], kind[a:b], w, lim).flat() if e else np.zeros(0, np.int64) for a, b, w, e in zip(heads, tails, whole, edge, strict=True)]
        return pd.DataFrame({"client": client[heads], "first": t[heads], "last": t[tails - 1], "edge": edge, "whole": whole, "frontiers": fronts})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.zeros((0, 3), np.int64)
        for batch in batches:
            held = np.concatenate([held, batch[["client", "t", "kind"]].to_numpy(np.int64)])
            held = held[np.r_[True, (held[1:] != held[:-1]).any(axis=1)]] if len(held) else held
            while len(held) > chunk_rows:
                cut = chunk_rows
                same = (held[:, :2] == held[cut, :2]).all(axis=1)  # events of one time stay together; they are as many as kinds at most
                cut = int(same.argmax())
                if cut == 0:
                    break
                yield chunk(*held[:cut].T)
                held = held[cut:]
        if len(held):
            yield chunk(*held.T)

    return run


def folded(lim: Limits):
    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("first")
        parts = [Summary.read(*x) for x in zip(rows["first"], rows["last"], rows["whole"], rows["frontiers"], strict=True)]
        one = reduce(lambda a, b: a.then(b, lim), parts)
        return pd.DataFrame({"client": rows["client"].iloc[:1], "first": [one.first], "last": [one.last], "edge": [True], "whole": [one.whole], "frontiers": [one.flat()]})

    return fold


def cell(level: int) -> Column:
    return F.lit(0).cast("long") if level == LEVELS[-1] else F.shiftright("first", level)


def client_patterns(coded: DataFrame, lim: Limits, chunk_rows: int = CHUNK_ROWS, fan: int = FAN) -> DataFrame:
    """(client, whole): the numbers of all patterns that each client of coded events (client, t, kind) supports.

    Events are range-partitioned by client and time, so that a busy client lies in many partitions, and each partition is cut into chunks that are summed up alone. Clients
    that lie within a chunk are done. The other summaries are joined in a tree: in each round the widest cells of time that hold at most `fan` summaries of a client each become one summary.
    """
    if fan < 4:
        raise ValueError("a round joins at least four neighbouring cells")
    dealt = coded.repartitionByRange("client", "t").sortWithinPartitions("client", "t", "kind")
    leaves = written(dealt.mapInPandas(summarised(lim, chunk_rows), SUMMARY), "segments")
    done, open_ = leaves.where("not edge"), leaves.where("edge")
    levels = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), cell(k).alias("cell")) for k in LEVELS]))
    while True:
        sizes = open_.select("client", levels.alias("x")).groupBy("client", "x").agg(F.count(F.lit(1)).alias("n")).groupBy("x.level").agg(F.max("n").alias("most"))
        level = sizes.where(F.col("most") <= fan).agg(F.max("level")).first()[0]
        level = LEVELS[-1] if level is None else level
        joined = open_.groupBy("client", cell(level).alias("cell")).applyInPandas(folded(lim), SUMMARY)
        if level == LEVELS[-1]:
            return done.unionByName(joined).select("client", "whole")
        open_ = written(joined, "segments")


def micros(time: Column) -> Column:
    """Microseconds of a timestamp with or without a zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), time.cast("timestamp_ntz"))


def frequent(events: DataFrame, gap: int, span: int, longest: int = 4, least_clients: int = 2, least_share: int = 30, chunk_rows: int = CHUNK_ROWS, fan: int = FAN) -> DataFrame:
    """Patterns of up to `longest` kinds that at least `least_clients` clients and `least_share` % of all clients support: pattern, kinds, length, support, clients_crc, n_wider, closed.

    events: client long, t long (microseconds), kind string. A client supports a pattern if it has events of these kinds in order, others between them allowed, each more than
    0 and at most `gap` microseconds after the one before, and at most `span` from first to last. `pattern` joins the kinds by `>`; `kinds` is the array.

    First the kinds that are frequent alone are found, as no other can be in a frequent pattern; they are at most 100 / least_share times the kinds of an average client, so
    the driver may hold their names. Time and memory grow with their number to the power longest - 1.

    Rows with a null client, time or kind take no part; repeated events count once; events of equal time don't follow each other; other columns are
    ignored. Clients whose events are all of rare kinds count among all clients. Without events the result is empty.
    """
    spark = events.sparkSession
    events = events.select("client", "t", "kind").where("client is not null and t is not null and kind is not null")
    pairs = written(events.select("client", "kind").distinct(), "kinds")
    clients = pairs.select("client").distinct().count()
    enough = lambda n: (n >= least_clients) & (n * 100 >= least_share * clients)
    alone = pairs.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).where(enough(F.col("n")))
    kinds = sorted(r["kind"] for r in alone.collect())
    lim = Limits(gap, span, len(kinds), longest)
    if not kinds:
        return spark.createDataFrame([], "pattern string, kinds array<string>, length int, support long, clients_crc long, n_wider long, closed boolean")
    names = F.array(*map(F.lit, kinds))
    coded = events.select("client", "t", (F.array_position(names, F.col("kind")) - 1).alias("kind")).where("kind >= 0")
    each = client_patterns(coded, lim, chunk_rows, fan).select("client", F.explode("whole").alias("number"))
    sums = each.groupBy("number").agg(F.count(F.lit(1)).alias("support"), F.sum(F.crc32(F.col("client").cast("string").cast("binary"))).alias("clients_crc"))
    length = sum((F.col("number") >= lim.base[m]).cast("int") for m in range(1, longest + 1))
    place = F.col("number") - F.element_at(F.array(*[F.lit(b).cast("long") for b in lim.base[1:]]), F.col("length"))
    digit = lambda i: F.pmod(F.floor(F.col("place") / F.pow(F.lit(float(len(kinds))), F.col("length") - i)), F.lit(len(kinds))).cast("int")
    kept = sums.where(enough(F.col("support"))).withColumn("length", length).withColumn("place", place)
    kept = written(kept.withColumn("kinds", F.transform(F.sequence(F.lit(1), "length"), lambda i: F.element_at(names, digit(i) + 1))).drop("place", "number"), "patterns")
    parts = F.explode(F.filter(F.sequence(F.lit(1), F.shiftleft(F.lit(1), longest) - 1), lambda x: x < F.shiftleft(F.lit(1), longest)))
    bit = lambda x, i: F.pmod(F.floor(x / F.pow(F.lit(2.0), i)), F.lit(2)) == 1
    some = kept.select("support", F.col("kinds").alias("wider"), parts.alias("x")).where(F.col("x") < F.pow(F.lit(2.0), F.size("wider")) - 1)
    shorter = some.select("support", "wider", F.filter("wider", lambda _, i: bit(F.col("x"), i)).alias("kinds")).distinct()
    wider = shorter.join(kept.select("support", "kinds"), ["support", "kinds"]).groupBy("kinds").agg(F.count(F.lit(1)).alias("n_wider"))
    out = kept.join(wider, "kinds", "left").withColumn("n_wider", F.coalesce("n_wider", F.lit(0).cast("long")))
    return out.select(F.array_join("kinds", ">").alias("pattern"), "kinds", "length", "support", "clients_crc", "n_wider", (F.col("n_wider") == 0).alias("closed"))
