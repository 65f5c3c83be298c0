"""Best-fit packing by length patterns fitted with non-negative least squares."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import compress, repeat, takewhile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from .frames import release_memory, small_batches, text_of, written

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
END_ID = 0
#: Pieces of one length are numbered in groups side by side: so many groups in all at most, besides one a length, and rows that a group has at least.
RANK_GROUPS, GROUP_ROWS = 16_384, 256
#: Words a worker remembers the ids of (and sixteen times as many ids), and bytes of text that are split at once.
MEMORY, SLICE_BYTES = 250_000, 2_000_000
OUT = ("piece", "start", "length", "ids_crc32", "sequence_id", "offset")
PIECE_SCHEMA = "piece int, start long, length long, ids_crc32 long"

# Letters that the vocabulary's normaliser turns into letters only, one by one.
LETTERS = "a-zÀ-ÖØ-öø-įı-ſА-яЁё"
#: What ends in a plain letter or digit and then marks (those of ASCII): the marks are a word of their own.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
CLOSED = f"[{LETTERS}0-9][[:punct:]]+$"
PLAIN = f"^[{LETTERS}]+$"
#: Special tokens are found before a text is split; these control characters split words here but not there.
WHOLE = "<\\||[\x1c-\x1f]"


class WordIds:
    """Ids of words, remembered up to MEMORY words; those that few batches used are forgotten first.

    The vocabulary's word pattern never crosses white space, so a text's ids are those of its chunks between white space, joined. A batch of
    texts is split and its distinct chunks found in Arrow's own code; only those that aren't remembered reach the tokenizer, words of plain letters many at a time.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        for token, number in vocabulary.items():
            self.ends[number] = token.endswith("</w>")
        self.place: dict[str, int] = {}
        self.flat = np.zeros(0, dtype=np.uint32)
        self.first, self.count, self.used = (np.zeros(0, dtype=np.int64) for _ in range(3))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of plain letters, encoded as one text, and how many each word has: its last id is a word's end."""
        ids = np.array(self.encode([" ".join(words)])[0], dtype=np.uint32)
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(words):
            raise ValueError("the vocabulary doesn't end each word once")
        return ids, np.diff(stops, prepend=0)

    def forget(self) -> None:
        """Keeps the half of the words that most batches used, later ones first; older uses count half from now on."""
        keep = np.zeros(len(self.first), dtype=bool)
        keep[np.lexsort((-np.arange(len(self.used)), -self.used))[: MEMORY // 2]] = True
        self.place = dict(zip(compress(self.place, keep), range(MEMORY), strict=False))
        self.flat = self.flat[np.repeat(keep, self.count)]
        self.count, self.used = self.count[keep], self.used[keep] // 2
        self.first = np.cumsum(self.count) - self.count

    def learn(self, words: list[str], plain: int) -> None:
        """Appends words that aren't known; the first `plain` of them are of plain letters."""
        flat, counts = [self.flat], [self.count]
        for at in range(0, plain, 4096):
            ids, n = self.encode_plain(words[at : min(at + 4096, plain)])
            flat.append(ids), counts.append(n)
        for at in range(plain, len(words), 4096):
            got = self.encode(words[at : at + 4096])
            flat.append(np.fromiter((i for x in got for i in x), dtype=np.uint32)), counts.append(np.array([len(x) for x in got], dtype=np.int64))
        self.place.update(zip(words, range(len(self.count), len(self.count) + len(words)), strict=True))
        self.flat, self.count = np.concatenate(flat), np.concatenate(counts)
        self.used = np.concatenate([self.used, np.zeros(len(words), dtype=np.int64)])
        self.first = np.cumsum(self.count) - self.count

    def places(self, words: pa.Array) -> np.ndarray:
        """Where the ids of each of the distinct words begin in the memory."""
        names = words.to_pylist()
        got = np.fromiter(map(self.place.get, names, repeat(-1)), dtype=np.int64, count=len(names))
        new = np.flatnonzero(got < 0)
        if len(new):
            plain = pc.match_substring_regex(words.take(pa.array(new)), PLAIN).to_numpy(zero_copy_only=False)
            new = np.concatenate([new[plain], new[~plain]])
            got[new] = len(self.count) + np.arange(len(new))
            self.learn([names[i] for i in new], int(plain.sum()))
        self.used[got] += 1
        return got

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, joined, and how many each text has."""
        whole = pc.match_substring_regex(texts, WHOLE).to_numpy(zero_copy_only=False)
        special = {int(i): np.array(x, dtype=np.uint32) for i, x in zip(np.flatnonzero(whole), self.encode(texts.filter(pa.array(whole)).to_pylist()), strict=True)}
        lists = pc.utf8_split_whitespace(pc.if_else(pa.array(whole), "", texts))
        chunks = lists.flatten()
        # Blanks at the ends of a text give empty chunks, which have no ids.
        distinct = chunks.dictionary_encode()
        low = pc.ascii_lower(distinct.dictionary)
        core = pc.if_else(pc.match_substring_regex(low, CLOSED), pc.utf8_rtrim(low, MARKS), low)
        tail = pc.if_else(pc.equal(core, low), "", pc.replace_substring_regex(low, r"(?s)^.*?([[:punct:]]+)$", r"\1"))
        words = pa.concat_arrays([core, tail]).dictionary_encode()
        at = self.places(words.dictionary)
        pairs = at[words.indices.to_numpy()].reshape(2, -1).T  # core and tail of each distinct chunk
        stream = pairs[distinct.indices.to_numpy()].ravel()
        counts = self.count[stream]
        ids = self.flat[np.repeat(self.first[stream] - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))]
        ends = np.concatenate([[0], np.cumsum(counts)])[2 * lists.offsets.to_numpy()]
        sizes = np.diff(ends)
        if special:
            parts = np.split(ids, ends[1:-1])
            for i, x in special.items():
                parts[i], sizes[i] = x, len(x)
            ids = np.concatenate(parts)
        # No word of this batch is needed any more, so what is remembered can be cut back.
        if len(self.flat) > 16 * MEMORY:
            self.place, self.flat, self.first, self.count, self.used = {}, self.flat[:0], self.first[:0], self.count[:0], self.used[:0]
        elif len(self.place) > MEMORY:
            self.forget()
        return ids, sizes


_known: dict[str, WordIds] = {}


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of texts (first, last + 1) of at most `most` bytes, or of one longer text."""
    size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) if len(texts) else np.zeros(0)
    first = 0
    while first < len(texts):
        done = size[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(size, done + most, side="right")))
        yield first, last
        first = last


def cut_pieces(ids: np.ndarray, sizes: np.ndarray, capacity: int, end: int) -> tuple[np.ndarray, ...]:
    """Per text its pieces of `capacity` ids but for the last: text, piece, start, length, crc32 of the ids with the end id."""
    sizes = sizes + 1
    whole = np.insert(ids, np.cumsum(sizes - 1), end).astype("<u4")
    many = -(-sizes // capacity)
    text = np.repeat(np.arange(len(sizes)), many)
    piece = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    start = piece * capacity
    length = np.minimum(capacity, sizes[text] - start)
    at = (np.cumsum(sizes) - sizes)[text] + start
    data = memoryview(whole).cast("B")
    crc = np.fromiter((zlib.crc32(data[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist(), strict=True)), dtype=np.int64, count=len(at))
    return text, piece.astype(np.int32), start, length, crc


def token_pieces(df: DataFrame, id_col: str, text_col: str, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """A row per piece: ident, piece, start, length, ids_crc32. A null text is empty: its one id is the end id.

    What is known of letters and closing marks holds for the vocabulary of TOKENIZER; another file must have its normaliser and word pattern.
    """
    path = tokenizer or tokenizer_path()
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _known:
            _known[path] = WordIds(path)
        for batch in batches:
            texts = batch.column("text")
            for first, last in slices(texts):
                text, *columns = cut_pieces(*_known[path].of(texts.slice(first, last - first)), capacity, END_ID)
                own = batch.column("ident").slice(first, last - first).take(pa.array(text))
                yield pa.RecordBatch.from_arrays([own, *map(pa.array, columns)], names=["ident", "piece", "start", "length", "ids_crc32"])
        release_memory()

    slim = df.select(F.col(f"`{id_col}`").alias("ident"), text_of(text_col).alias("text"))
    return slim.mapInArrow(run, f"ident {kind}, {PIECE_SCHEMA}")


def nnls(columns: np.ndarray, uses: np.ndarray, goal: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """Non-negative x that minimises |A x - goal|; A's column j has `uses[j]` (k of them) at rows columns[j].

    Coordinate descent: each step solves one variable exactly, clipped at zero.
    """
    x, left = np.zeros(len(columns)), goal.astype(float).copy()
    norm = (uses**2).sum(axis=1).astype(float)
    for _ in range(sweeps):
        moved = 0.0
        for j in range(len(columns)):
            rows, n = columns[j], uses[j]
            step = max(-x[j], float((n * left[rows]).sum()) / norm[j])
            if step:
                x[j] += step
                left[rows] -= n * step
                moved = max(moved, abs(step))
        if moved < 0.01:
            break
    return x


def patterns(counts: np.ndarray, capacity: int) -> list[tuple[int, ...]]:
    """Patterns of two to four lengths that fill a sequence exactly or nearly, from the lengths that occur, long ones first."""
    there = np.flatnonzero(counts)
    below = np.zeros(capacity + 1, dtype=int)  # the largest length that occurs, up to each room
    last = 0
    for room in range(1, capacity + 1):
        last = room if counts[room] else last
        below[room] = last
    found: set[tuple[int, ...]] = set()
    for a in there[::-1]:
        if a == capacity:
            continue
        room = capacity - a
        b = below[room]
        if b:
            found.add(tuple(sorted((int(a), int(b)), reverse=True)))
        for share in (2, 3, 4):
            c = below[room // share] if room // share else 0
            if not c:
                continue
            rest, got = room, [int(a)]
            got.append(int(c))
            rest -= int(c)
            if share == 4 and below[rest // 2]:
                got.append(int(below[rest // 2]))
                rest -= got[-1]
            if below[rest]:
                got.append(int(below[rest]))
            found.add(tuple(sorted(got, reverse=True)))
    return sorted(found, reverse=True)


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns with repeat counts for all of a histogram: longest first, each room filled by the longest that fits."""
    counts, made = counts.copy(), []
    while True:
        there = np.flatnonzero(counts)
        if not len(there):
            return made
        used: dict[int, int] = {}
        room, item = capacity, int(there[-1])
        while item:
            used[item] = used.get(item, 0) + 1
            room -= item
            fit = there[: np.searchsorted(there, room, side="right")]
            item = next((int(x) for x in fit[::-1] if counts[x] > used.get(int(x), 0)), 0)
        times = min(int(counts[k]) // n for k, n in used.items())
        for k, n in used.items():
            counts[k] -= times * n
        made.append((tuple(sorted((k for k, n in used.items() for _ in range(n)), reverse=True)), times))


def plan_patterns(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, repeats) that hold every piece of the histogram counts[length] exactly once.

    Few-piece patterns are fitted to the histogram by non-negative least squares and their repeats rounded down as
    far as pieces last; what is left is packed by best fit. If best fit alone needs fewer sequences, its plan is returned.
    """
    counts = counts.astype(np.int64)
    made: list[tuple[tuple[int, ...], int]] = []
    left = counts.copy()
    if left[capacity]:
        made.append(((capacity,), int(left[capacity])))
        left[capacity] = 0
    whole = best_fit(left, capacity)
    found = [p for p in patterns(left, capacity) if capacity - sum(p) <= capacity // 64]
    fitted: list[tuple[tuple[int, ...], int]] = []
    if found:
        width = max(map(len, found))
        columns, uses = np.zeros((len(found), width), dtype=int), np.zeros((len(found), width))
        for j, p in enumerate(found):
            for k, item in enumerate(dict.fromkeys(p)):
                columns[j, k], uses[j, k] = item, p.count(item)
        x = nnls(columns, uses, left)
        for j in np.argsort(-x, kind="stable"):
            need = {k: found[j].count(k) for k in found[j]}
            times = min(int(round(x[j])), *(int(left[k]) // n for k, n in need.items()))
            if times > 0:
                fitted.append((found[j], times))
                for k, n in need.items():
                    left[k] -= times * n
    fitted += best_fit(left, capacity)
    return made + min(fitted, whole, key=lambda plan: sum(n for _, n in plan))


def slots(plan: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank + 1, sequence of the first, offset): where the pieces of a length go, by rank."""
    rank: dict[int, int] = {}
    out, base = [], 0
    for pattern, times in plan:
        offset = 0
        for item in pattern:
            first = rank.get(item, 0)
            out.append((item, first, first + times, base, offset))
            rank[item] = first + times
            offset += item
        base += times
    return out


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """All texts as token pieces packed into sequences of at most `capacity` ids: a row per piece.

    Texts get the end id, and only longer ones are cut. Pieces are counted by length (at most `capacity`
    counts reach the driver, at any input size); patterns of few lengths are fitted to that histogram by non-negative
    least squares, rounded, and the rest packed by best fit. Pieces of one length are interchangeable, so
    each is numbered among its length, in groups side by side, and its number gives sequence and offset.

    Null and empty texts are one id. Null and repeated ids are kept as they are: every row is packed. A very long text is cut
    into as many pieces as it needs. Other columns of df aren't carried; an id column that is named like one of the result's comes back with "_id" added. An
    empty table gives an empty table.
    """
    spark = df.sparkSession
    with small_batches(spark):
        pieces = written(token_pieces(df, id_col, text_col, capacity, tokenizer), "pieces")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():  # `capacity` rows at most
        counts[r["length"]] = r["n"]
    share = max(GROUP_ROWS, -(-int(counts.sum()) // RANK_GROUPS))
    many = np.maximum(1, -(-counts // share))
    groups = F.element_at(F.array(*[F.lit(int(n)) for n in many]), (F.col("length") + 1).cast("int"))
    group = F.pmod(F.xxhash64("ident", "piece", "ids_crc32"), groups).cast("long")
    table: dict[int, dict[int, int]] = {}
    for r in pieces.groupBy("length", group.alias("group")).agg(F.count(F.lit(1)).alias("n")).collect():  # RANK_GROUPS + capacity rows at most
        table.setdefault(r["length"], {})[r["group"]] = r["n"]
    # A group's ranks run from the sum of those before it; split the slots where groups meet, so that each slot row is for one group.
    rows = []
    at: dict[int, list[tuple[int, int, int, int]]] = {}
    for length, first, end, base, offset in slots(plan_patterns(counts, capacity)):
        at.setdefault(length, []).append((first, end, base, offset))
    for length, own in at.items():
        high, k = 0, 0
        for g, n in sorted(table[length].items()):
            low, high = high, high + n
            while k < len(own) and own[k][1] <= low:
                k += 1
            for a, b, s, o in takewhile(lambda x: x[0] < high, own[k:]):
                rows.append((length, g, max(a, low) - low, min(b, high) - low, s + max(a, low) - a, o))
    plan = spark.createDataFrame(rows, "length long, group long, low long, high long, base long, at long")
    order = Window.partitionBy("length", "group").orderBy(F.col("ident").asc_nulls_last(), "piece", "ids_crc32", "start")
    ranked = pieces.withColumn("group", group).withColumn("rank", F.row_number().over(order) - 1)
    # The plan's rows come in order of rank within (length, group): the last that begins at or before a piece's rank is its own.
    merged = ranked.select("length", "group", "rank", F.lit(1).alias("kind"), *[F.col(c) for c in ("ident", "piece", "start", "ids_crc32")], *[F.lit(None).cast("long").alias(c) for c in ("low", "base", "at")]).unionByName(
        plan.select("length", "group", F.col("low").alias("rank"), F.lit(0).alias("kind"), F.col("low"), "base", "at"), allowMissingColumns=True
    )
    along = Window.partitionBy("length", "group").orderBy("rank", "kind")
    slot = F.last(F.when(F.col("kind") == 0, F.struct("low", "base", "at")), ignorenulls=True).over(along)
    return (
        merged.withColumn("slot", slot)
        .where(F.col("kind") == 1)
        .select(
            F.col("ident").alias(f"{id_col}_id" if id_col.lower() in OUT else id_col),
            "piece",
            "start",
            "length",
            "ids_crc32",
            (F.col("slot.base") + F.col("rank") - F.col("slot.low")).alias("sequence_id"),
            F.col("slot.at").alias("offset"),
        )
    )
