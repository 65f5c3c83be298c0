"""Toxicity: gradient-boosted trees over dense features of a text, calibrated by isotonic regression."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .frames import fresh, release_memory, small_batches, text_of, written

#: Labelled rows that the lexicon, the trees and the calibration are fitted on, at most: those with the smallest digests of their ids.
TRAIN_ROWS = 20_000
#: Of a term of the learned lexicon: toxic documents it must occur in, log odds, and these over their standard error.
SUPPORT, ODDS, SURE = 4, 1.5, 2.5
THRESHOLD = 0.3
TREES, DEPTH, RATE, BINS = 60, 3, 0.15, 32
#: Chunks between white space whose look a worker remembers, and terms that it counts before it passes the counts on.
SEEN, COUNTED = 150_000, 150_000
#: Words between an insult and a word of address that count as near.
NEAR = 6

# Insults and words of address in English, French, German and Spanish.
INSULTS = frozenset(
    """
    idiot idiots idiotic moron morons stupid dumb dumbass fool foolish loser losers clown clowns scum trash garbage pathetic worthless
    disgusting jerk creep freak imbecile cretin bastard bitch asshole shit shitty crap fuck fucking damn whore slut dick prick pig vermin
    idiote idiots imbécile crétin connard connasse abruti débile salaud salope ordure minable pourriture merde pute ducon
    idiotisch dumm dummkopf trottel depp arschloch scheiße scheisse abschaum versager widerlich erbärmlich hurensohn wichser schwachkopf
    estúpido estúpida imbécil tonto tonta basura asqueroso asquerosa patético patética inútil mierda puta cabrón gilipollas escoria perdedor
    """.split()
)
ADDRESS = frozenset(
    """
    you your yours yourself yourselves u ur thou thee thy
    tu te toi ton ta tes vous votre vos
    du dich dir dein deine deiner deinen ihr euch euer eure sie
    tú ti tus usted ustedes vosotros vuestro vuestra os
    """.split()
)
LEET = str.maketrans("013457@$!|+", "oieastasiit")

_STRIP = re.compile(r"^[^\w@$]+|[^\w@$!]+$")
_CORE = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_REPEATED = re.compile(r"(.)\1{3}")
_WIDE = re.compile(r"[^\x00-\x7f]")
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
FEATURES = (
    "insult_density", "insult_any", "learned_density", "learned_any", "stem_density", "stem_any", "strength_mean", "strength_max", "hidden_density",
    "near_address", "address_density", "capitals", "capital_words", "exclaim", "question", "punctuation", "mixed_words", "repeats", "length",
)
INSULT, WORD, STEM, ADDRESSED, CAPS, MIXED, HIDDEN, REPEAT, LETTER = (1 << i for i in range(9))
STEMS = (4, 5, 6)


def capitals(text: str) -> int:
    data = text.encode("utf-8", "surrogatepass")
    wide = 0 if text.isascii() else sum(map(str.isupper, _WIDE.findall(text)))
    return len(data) - len(data.translate(None, _CAPITALS)) + wide


def terms_of(word: str) -> list[str]:
    """The word itself and, for longer words, the stems that the lexicon may learn."""
    return [word, *(f"{word[:n]}-" for n in STEMS if len(word) > n)]


class Reader:
    """Reads texts into features; what it has seen of a chunk between white space is remembered."""

    def __init__(self, learned: dict[str, float], most: int = SEEN) -> None:
        self.learned, self.most = learned, most
        self.seen: dict[str, int] = {}
        self.strong: dict[str, float] = {}  # of seen chunks, those with a learned term
        # Every term that a word may match begins with the word's own first letters.
        self.starts = {t.rstrip("-")[: STEMS[0]] for t in (*learned, *INSULTS, *ADDRESS)}

    def matches(self, words: list[str]) -> tuple[int, float]:
        code, strength = 0, 0.0
        for w in words:
            if w[: STEMS[0]] not in self.starts:
                continue
            if w in INSULTS:
                code |= INSULT
            if w in ADDRESS:
                code |= ADDRESSED
            for t in terms_of(w):
                got = self.learned.get(t)
                if got is not None:
                    code |= STEM if t.endswith("-") else WORD
                    strength = max(strength, got)
        return code, strength

    def look(self, chunk: str) -> tuple[int, float]:
        bare = chunk if chunk.isalnum() else _STRIP.sub("", chunk)
        low = bare.lower()
        if bare.isalpha() and low.isalpha():  # one plain word
            code, strength = self.matches([low])
            if len(bare) == 1:
                code |= LETTER
            elif bare.isupper():
                code |= CAPS
            return (code | REPEAT, strength) if _REPEATED.search(low) else (code, strength)
        words = _CORE.findall(low)
        code, strength = self.matches(words)
        letters = sum(c.isalpha() for c in bare)
        if letters >= 2 and bare.isupper():
            code |= CAPS
        if letters and letters < len(bare) and not words[1:] and any(not c.isalpha() for c in bare[1:-1] if c not in "'’-"):
            code |= MIXED
        if letters >= 2 and (len(words) > 1 or code & MIXED):
            plain = "".join(c for c in low.translate(LEET) if c.isalpha())
            if plain not in words and (plain in INSULTS or plain in self.learned):
                code |= HIDDEN
        if _REPEATED.search(low):
            code |= REPEAT
        if len(bare) == 1 and letters:
            code |= LETTER
        return code, strength

    def read(self, text: str) -> list[float]:
        chunks = text.split()
        n = len(chunks)
        if not n:
            return [0.0] * len(FEATURES)
        if len(self.seen) > self.most:
            self.seen.clear()
            self.strong.clear()
        seen, strong = self.seen, self.strong
        for c in set(chunks).difference(seen):
            seen[c], strength = self.look(c)
            if strength:
                strong[c] = strength
        codes = np.fromiter(map(seen.__getitem__, chunks), dtype=np.int32, count=n)
        hits = np.flatnonzero(codes & (INSULT | WORD | STEM | HIDDEN))
        strength = [strong.get(chunks[i], 0.0) for i in hits]
        count = lambda bit: int(np.count_nonzero(codes & bit))
        hidden = count(HIDDEN)
        if count(LETTER) >= 4:  # words written letter by letter
            for run in re.findall(r"(?:\b\w[ .*_-]+){3,}\w\b", text):
                word = "".join(c for c in run.lower() if c.isalnum())
                hidden += word in INSULTS or word in self.learned
        address = np.flatnonzero(codes & ADDRESSED)
        near = 0
        if len(hits) and len(address):
            at = np.searchsorted(address, hits)
            left = hits - address[np.maximum(at - 1, 0)]
            right = address[np.minimum(at, len(address) - 1)] - hits
            near = int(np.count_nonzero((np.where(left >= 0, left, NEAR + 1) <= NEAR) | (np.where(right >= 0, right, NEAR + 1) <= NEAR)))
        size = len(text)
        upper = 0 if text.islower() else capitals(text)
        marks = [text.count(c) for c in "!?.,;:*#%&$\"'()"]
        ins, wrd, stm = count(INSULT), count(WORD), count(STEM)
        return [
            ins / n, min(ins, 8), wrd / n, min(wrd, 8), stm / n, min(stm, 8), sum(strength) / n, max(strength, default=0.0), hidden / n,
            near / n, len(address) / n, upper / size, count(CAPS) / n, marks[0] / n, marks[1] / n, sum(marks) / size, count(MIXED) / n, count(REPEAT) / n, np.log1p(n),
        ]


@dataclass
class Trees:
    """Boosted regression trees for the logistic loss; a node without children has column -1."""

    base: float
    column: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for column, cut, value in zip(self.column, self.cut, self.value, strict=True):
            at = np.zeros(len(x), dtype=int)
            for _ in range(DEPTH):
                c = column[at]
                go = c >= 0
                right = x[np.arange(len(x)), np.maximum(c, 0)] > cut[at]
                at = np.where(go, 2 * at + 1 + right, at)
            out += value[at]
        return out


def grow(x: np.ndarray, y: np.ndarray) -> Trees:
    """Fits the trees: each takes the cuts (of BINS quantiles a column) that lower the second-order loss most."""
    rate = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(rate / (1 - rate)))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T, strict=True)], axis=1)
    f = np.full(len(y), base)
    size = 2 ** (DEPTH + 1) - 1
    columns, limits, values = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-f))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        column, cut, value = np.full(size, -1), np.zeros(size), np.zeros(size)
        rows = {0: np.arange(len(y))}
        for node in range(size):
            own = rows.pop(node, None)
            if own is None:
                continue
            G, H = g[own].sum(), h[own].sum()
            value[node] = RATE * G / (H + 1.0)
            best = (1e-3, -1, 0)
            if 2 * node + 2 < size and len(own) >= 20:
                for j in range(x.shape[1]):
                    if not len(cuts[j]):
                        continue
                    left_g = np.bincount(binned[own, j], g[own], BINS + 1).cumsum()[: len(cuts[j])]
                    left_h = np.bincount(binned[own, j], h[own], BINS + 1).cumsum()[: len(cuts[j])]
                    gain = left_g**2 / (left_h + 1) + (G - left_g) ** 2 / (H - left_h + 1) - G**2 / (H + 1)
                    gain[(left_h < 0.5) | (H - left_h < 0.5)] = 0
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (float(gain[k]), j, k)
            if best[1] >= 0:
                column[node], cut[node] = best[1], cuts[best[1]][best[2]]
                right = binned[own, best[1]] > best[2]
                rows[2 * node + 1], rows[2 * node + 2] = own[~right], own[right]
            else:
                f[own] += value[node]
        columns.append(column), limits.append(cut), values.append(value)
    return Trees(base, np.array(columns), np.array(limits), np.array(values))


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: the points (mean score, rate) of a rising fit of y on score."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []
    for s, v in zip(score[order], y[order], strict=True):
        blocks.append([s, v, 1.0])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            s2, v2, n2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s2, blocks[-1][1] + v2, blocks[-1][2] + n2]
    # A block's rate is drawn towards the whole rate by one row, so that no score is quite 0 or 1.
    prior = y.mean() if len(y) else 0.0
    return np.array([s / n for s, _, n in blocks]), np.array([(v + prior) / (n + 1) for _, v, n in blocks])


@dataclass
class Model:
    learned: dict[str, float]
    trees: Trees | None
    points: tuple[np.ndarray, np.ndarray]
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.prior)
        return np.clip(np.interp(self.trees.margin(x), *self.points), 0.0, 1.0)


def _terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per fold, in how many toxic and other texts of this partition each term occurs."""
    count: Counter = Counter()
    table = lambda got: pd.DataFrame([(*k, n) for k, n in got.items()], columns=["term", "fold", "toxic", "n"])
    for batch in batches:
        for text, fold, toxic in zip(batch["text"], batch["fold"], batch["toxic"], strict=True):
            count.update((t, fold, toxic) for t in {t for w in set(_CORE.findall(text.lower())) for t in terms_of(w)})
            if len(count) > COUNTED:
                yield table(count)
                count.clear()
    if count:
        yield table(count)
    count.clear()
    release_memory()


def lexicon(table: np.ndarray, terms: list[str], rows: np.ndarray) -> dict[str, float]:
    """Terms with the log odds of being toxic; table[term, toxic] counts documents, rows[toxic] all of them."""
    toxic, clean = table[:, 1], table[:, 0]
    odds = np.log((toxic + 0.5) / (rows[1] + 1)) - np.log((clean + 0.5) / (rows[0] + 1))
    sure = odds / np.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
    good = (toxic >= SUPPORT) & (sure > SURE) & (odds > ODDS)
    return {terms[i]: float(odds[i]) for i in np.flatnonzero(good)}


def telling(toxic: Column, clean: Column, sizes: np.ndarray) -> Column:
    """Whether a term that so many toxic and other documents hold belongs in a lexicon, as `lexicon` says, with a margin for rounding."""
    odds = F.log((toxic + 0.5) / F.lit(float(sizes[1] + 1))) - F.log((clean + 0.5) / F.lit(float(sizes[0] + 1)))
    sure = odds / F.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
    return (toxic >= SUPPORT) & (sure > SURE - 1e-6) & (odds > ODDS - 1e-6)


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "toxic", rows: int = TRAIN_ROWS) -> Model:
    """Fits a model on labelled rows whose crc32(id) mod 4 isn't 2.

    At most `rows` of those that have a text are used, with the smallest digests of their ids, so the sample is bounded whatever the input. Texts stay on
    the executors: the driver gets the counts of the terms that belong in a lexicon and the dense features of the sample.
    Features of a row use a lexicon learned without its fold, and the calibration uses scores of trees that haven't seen it.
    Null labels, and labels without a text, are left out; an id labelled twice counts by its largest label, and an id with several texts by the smallest of them.
    Without rows of both labels (empty tables) there are no trees, and every score is the share of toxic rows, 0 if there is none.
    """
    own = df.select(F.col(f"`{id_col}`").cast("string").alias("ident"), text_of(text_col).alias("text")).where("ident is not null and crc32(ident) % 4 != 2")
    known = (
        labels.select(F.col(f"`{label_id}`").cast("string").alias("ident"), F.col(f"`{label_col}`").cast("int").alias("toxic"))
        .where("ident is not null and toxic is not null and crc32(ident) % 4 != 2")
        .groupBy("ident")
        .agg(F.max("toxic").alias("toxic"))
        .join(own.select("ident"), "ident", "left_semi")
        .orderBy(F.md5("ident"))
        .limit(rows)
    )
    rank = {0: 0, 1: 1, 3: 2}
    fold = F.element_at(F.create_map(*[F.lit(x) for kv in rank.items() for x in kv]), (F.crc32("ident") % 4).cast("int"))
    # Bounded by `rows`, and read three times: written once, so that the documents are.
    with small_batches(df.sparkSession):
        sample = written(
            own.join(F.broadcast(written(known, "known")), "ident")
            .groupBy("ident")
            .agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
            .select("ident", "text", fold.alias("fold"), F.when(F.col("toxic") > 0, 1).otherwise(0).alias("toxic")),
            "sample",
        )
        return fit_sample(sample)


def fit_sample(sample: DataFrame) -> Model:
    """A model from sample(ident, text, fold, toxic)."""
    terms = sample.mapInPandas(_terms, "term string, fold int, toxic int, n long")
    held = [F.sum(F.when((F.col("fold") == f) & (F.col("toxic") == t), F.col("n")).otherwise(0)).alias(f"n{f}{t}") for f in range(3) for t in range(2)]
    sizes = np.zeros((3, 2))
    for r in sample.groupBy("fold", "toxic").count().collect():
        sizes[r["fold"], r["toxic"]] = r["count"]
    prior = float(sizes[:, 1].sum() / sizes.sum()) if sizes.sum() else 0.0
    if not sizes[:, 0].sum() or not sizes[:, 1].sum():
        return Model({}, None, (np.zeros(1), np.zeros(1)), prior)
    whole = [F.col("n00") + F.col("n10") + F.col("n20"), F.col("n01") + F.col("n11") + F.col("n21")]
    wanted = telling(whole[1], whole[0], sizes.sum(axis=0))
    for f in range(3):
        wanted |= telling(whole[1] - F.col(f"n{f}1"), whole[0] - F.col(f"n{f}0"), sizes.sum(axis=0) - sizes[f])
    counted = terms.groupBy("term").agg(*held).where(wanted).orderBy("term").collect()
    names = [r["term"] for r in counted]
    table = np.array([[[r[f"n{f}{t}"] for t in range(2)] for f in range(3)] for r in counted]).reshape(len(names), 3, 2)
    own = [lexicon(table.sum(axis=1) - table[:, f], names, sizes.sum(axis=0) - sizes[f]) for f in range(3)]
    learned = lexicon(table.sum(axis=1), names, sizes.sum(axis=0))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        readers = [Reader(x, SEEN // 3) for x in own]
        for batch in batches:
            x = [readers[f].read(t) for f, t in zip(batch["fold"], batch["text"], strict=True)]
            yield pd.DataFrame({"ident": batch["ident"], "fold": batch["fold"], "toxic": batch["toxic"], "x": x})
        readers.clear()
        release_memory()

    got = sample.mapInPandas(features, "ident string, fold int, toxic int, x array<double>").toPandas().sort_values(["ident", "x"], key=lambda c: c.map(str), kind="stable")
    x, y, fold_of = np.stack(got["x"].to_numpy()), got["toxic"].to_numpy().astype(float), got["fold"].to_numpy()
    apart = np.zeros(len(y))
    for f in range(3):
        rest = fold_of != f
        if rest.any() and not rest.all():
            apart[~rest] = grow(x[rest], y[rest]).margin(x[~rest])
    return Model(learned, grow(x, y), isotonic(apart, y), prior)


def toxic_score(df: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """df with the model's score (0 to 1) of each whole text; a null text is empty, and an empty one scores as a text without any sign."""
    held = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Reader(held.value.learned)
        for texts in batches:
            x = np.array([reader.read(t) for t in texts], dtype=float).reshape(-1, len(FEATURES))
            yield pd.Series(held.value.score(x))
        release_memory()

    return df.withColumn(name, F.pandas_udf(run, "double")(text_of(text_col)))


def classify(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Rows of df with held_out, score and predicted added (columns of df so named are replaced). Null ids aren't held out.

    Every whole text is scored, however long; null and empty ones as texts without any sign. Rows that repeat an id or a text are scored each. An empty table gives an empty table.
    """
    df = df.drop(*[c for c in df.columns if c.lower() in ("held_out", "score", "predicted")])
    model = fit(df, labels, id_col, text_col)
    held = F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    return toxic_score(df, model, text_col).withColumns({"held_out": held, "predicted": (F.col("score") >= threshold).cast("int")})


def keep_civil(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Rows of df whose text scores under the threshold, with df's own columns."""
    (name,) = fresh(df, "tx_score")
    return toxic_score(df, fit(df, labels, id_col, text_col), text_col, name).where(F.col(name) < threshold).drop(name)
