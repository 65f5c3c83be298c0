"""Staged matching of candidates to dated trends: exact, then fuzzy, then semantic.

candidates: candidate_id, uri, key (ASCII alnum), candidate_date. trends: trend_id, key, trend_date, counts, name.
Keys are scored once per distinct pair, and pairs are found by equi-joins: no stage compares all candidates with all trends. The fuzzy stage finds pairs by an index of
rare pairs of letters, the semantic one by tokens. What a candidate may match is its stage pool: the trends of its dates that share a token outside the stopwords with it; all trends of its
dates if none anywhere does; the largest ones if it has only stopwords. Pools are cut by the largest counts, from lists that are bounded per day and token.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as Y

from threadmill.functions.text import semantic_score, sequence_ratio, tokens
from threadmill.sources.tables import stored

# Stopwords of lexical blocking, and defaults of the match contract.
BLOCK_STOPWORDS = """a an and are as at be but by for from he her his i in is it its me my of on or our she that the their them they this
to us we what when where which who why with you your""".split()
WINDOW_DAYS, FUZZY, SEMANTIC, POOL, SEMANTIC_POOL = 3, 0.88, 0.60, 5000, 250
STAGES = {"exact": 0, "fuzzy": 1, "semantic": 2, "unmatched": 3}


def temporal_mode(candidates: DataFrame, trends: DataFrame, days: int = WINDOW_DAYS) -> DataFrame:
    """Candidates with `mode`: date_window, or a global fallback where there is no date or no trend near it.

    The window is widened on the trend dates, of which there are few, and met by an equi-join.
    """
    near = trends.select(F.explode(F.sequence(F.date_sub("trend_date", days), F.date_add("trend_date", days))).alias("candidate_date")).distinct()
    marked = candidates.join(near.withColumn("_near", F.lit(True)), "candidate_date", "left")
    mode = F.when(F.col("candidate_date").isNull(), "global_fallback_no_candidate_date").when(F.col("_near"), "date_window").otherwise("global_fallback_no_date_overlap")
    return marked.withColumn("mode", mode).drop("_near")


def in_pool(days: int = WINDOW_DAYS):
    return (F.col("mode") != "date_window") | (F.abs(F.datediff("trend_date", "candidate_date")) <= days)


def exact_pairs(candidates: DataFrame, trends: DataFrame, days: int = WINDOW_DAYS) -> DataFrame:
    return candidates.where("key != ''").join(trends, "key").where(in_pool(days)).select("candidate_id", "trend_id", F.lit("exact").alias("stage"), F.lit(1.0).alias("score"))


#: Stands for the pool of all trends where a candidate has no dates of its own.
ALL_DAYS = "0001-01-01"


def pool_day():
    return F.when(F.col("mode") == "date_window", F.col("candidate_date")).otherwise(F.lit(ALL_DAYS).cast("date")).alias("day")


def trend_days(trends: DataFrame, days: int) -> DataFrame:
    """A row per trend and day whose pool has it, and one for the pool of all: at most 2 * days + 2 a trend."""
    near = F.when(F.col("trend_date").isNotNull(), F.sequence(F.date_sub("trend_date", days), F.date_add("trend_date", days))).otherwise(F.array().cast("array<date>"))
    return trends.select("trend_id", F.col("key").alias("tkey"), "counts", "name", F.explode(F.array_append(near, F.lit(ALL_DAYS).cast("date"))).alias("day"))


def _first(df: DataFrame, group: list[str], order: list, most) -> DataFrame:
    """The first rows of each group. Spark keeps no more than that of a group in any task before it deals them out."""
    return df.withColumn("_place", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("_place") <= most).drop("_place")


def _largest() -> list:
    return [F.col("counts").desc_nulls_last(), F.col("name").asc_nulls_last(), "trend_id"]


class Pools:
    """The stage pools of (ckey, day), for keys that aren't matched yet. `keys` may repeat."""

    def __init__(self, keys: DataFrame, trends: DataFrame, days: int, most: int) -> None:
        self.most = most
        # Whether any trend shares a token, whatever its date.
        every = stored(trends.select(F.explode(tokens(F.col("key"))).alias("token")).distinct(), "trend-tokens")
        each = keys.select("ckey", "day", F.explode_outer(own_tokens()).alias("token")).join(every.withColumn("known", F.lit(True)), "token", "left")
        hit = F.max(F.when(F.col("token").isNotNull(), F.coalesce("known", F.lit(False))))
        kind = F.when(F.col("hit").isNull(), "bare").when(F.col("hit"), "blocked").otherwise("open")
        self.keys = stored(each.groupBy("ckey", "day").agg(hit.alias("hit")).select("ckey", "day", kind.alias("kind")), "pool-keys")
        self.trends = stored(trend_days(trends.where("key != ''"), days).join(self.keys.select("day").distinct(), "day", "left_semi"), "trend-days")
        self.words = self.trends.select("*", F.explode(F.array_distinct(tokens(F.col("tkey")))).alias("token"))
        self.listed = _first(self.words, ["day", "token"], _largest(), 4 * most)  # of each day and token no more than a pool may hold

    def sizes(self, some: DataFrame) -> DataFrame:
        """(ckey, day, size) of the given (ckey, day): how many trends a pool has before it is cut, at most; shared ones count once a token."""
        keys = self._some(some)
        of_day = self.trends.groupBy("day").agg(F.count(F.lit(1)).alias("size"))
        of_token = self.words.groupBy("day", "token").agg(F.count(F.lit(1)).alias("size"))
        blocked = keys.where("kind = 'blocked'").withColumn("token", F.explode(own_tokens())).join(of_token, ["day", "token"]).groupBy("ckey", "day").agg(F.sum("size").alias("size"))
        return blocked.unionByName(keys.where("kind != 'blocked'").join(of_day, "day").select("ckey", "day", "size"))

    def _some(self, some: DataFrame) -> DataFrame:
        return self.keys.join(some.select("ckey", "day").distinct(), ["ckey", "day"], "left_semi")

    def rows(self, some: DataFrame) -> DataFrame:
        """The pools of the given (ckey, day), cut by counts: at most 4 * most trends each, `most` for keys of stopwords."""
        keys = self._some(some)
        columns = ["ckey", "day", "kind", "trend_id", "tkey", "counts", "name"]
        blocked = keys.where("kind = 'blocked'").withColumn("token", F.explode(own_tokens())).join(self.listed, ["day", "token"]).select(columns).distinct()
        day = _first(self.trends, ["day"], _largest(), 4 * self.most)
        others = keys.where("kind != 'blocked'").join(day, "day").select(columns)
        return _first(blocked.unionByName(others), ["ckey", "day"], _largest(), F.when(F.col("kind") == "bare", self.most).otherwise(4 * self.most))

    def near(self, fuzzy: float | None, semantic: float | None) -> DataFrame:
        """Distinct pairs (ckey, tkey) that share a token and may have a sequence ratio of `fuzzy` or have a semantic score of `semantic`; None asks for no such pairs.

        Blocked keys meet the listed trends of their days by tokens outside the stopwords, the others by stopwords, as these share nothing else. What can't reach either score goes as it is met,
        so that no table and no shuffle has a row per pair that shares a token.
        """
        words = [
            of.select("day", "token", "tkey", letter_marks("tkey").alias("tmarks"), distinct_tokens("tkey").alias("tn"))
            for of in (self.listed, self.words)
        ]
        keys = self.keys.select("*", letter_marks("ckey").alias("cmarks"), distinct_tokens("ckey").alias("cn"))
        like = (F.col("ckey") != F.col("tkey")) & may_be_alike(fuzzy) if fuzzy is not None else F.lit(False)
        score = may_score(semantic) & (semantic_score(F.col("ckey"), F.col("tkey")) >= semantic) if semantic is not None else F.lit(False)
        met = keys.where("kind = 'blocked'").withColumn("token", F.explode(own_tokens())).join(words[0], ["day", "token"]).where(like | score).select("ckey", "tkey")
        if semantic is not None:
            plain = F.array_intersect(tokens(F.col("ckey")), F.array(*map(F.lit, BLOCK_STOPWORDS)))
            met = met.unionByName(keys.where("kind != 'blocked'").withColumn("token", F.explode(plain)).join(words[1], ["day", "token"]).where(score).select("ckey", "tkey"))
        return stored(met.distinct(), "near-keys")

    def within(self, pairs: DataFrame) -> DataFrame:
        """Rows (ckey, day, tkey, trend_id, counts, name, score) of key pairs whose trend is in the pool."""
        full = pairs.join(self.keys, "ckey").join(self.trends, ["day", "tkey"])
        plain = F.array(*map(F.lit, BLOCK_STOPWORDS))
        shares = F.size(F.array_except(F.array_intersect(tokens(F.col("ckey")), tokens(F.col("tkey"))), plain)) > 0
        full = stored(full.where((F.col("kind") != "blocked") | shares), "pairs-of-days")
        wide = self.sizes(full).where(F.col("size") > self.most)
        narrow = full.join(wide, ["ckey", "day"], "left_anti")
        cut = full.join(wide, ["ckey", "day"], "left_semi")
        kept = cut.join(self.rows(cut).select("ckey", "day", "trend_id"), ["ckey", "day", "trend_id"], "left_semi")
        return narrow.unionByName(kept.select(narrow.columns))


def own_tokens():
    """The distinct tokens of ckey outside the stopwords."""
    return F.array_except(tokens(F.col("ckey")), F.array(*map(F.lit, BLOCK_STOPWORDS)))


def distinct_tokens(key: str):
    """The number of a key's tokens if none is repeated, else 0."""
    n = F.size(tokens(F.col(key)))
    return F.when(F.size(F.array_distinct(tokens(F.col(key)))) == n, n).otherwise(0)


def may_score(least: float):
    """Whether what ckey and tkey share of their cn and tn tokens allows a semantic score of `least`. No more is known of keys that repeat a token."""
    shared = F.size(F.array_intersect(F.split("ckey", " "), F.split("tkey", " ")))
    return (F.col("cn") == 0) | (F.col("tn") == 0) | (0.7 * shared / F.sqrt(F.col("cn") * F.col("tn")) + 0.3 >= least - 1e-9)


def _numbered(items) -> list:
    """Each item with how many equal ones come before it."""
    seen: dict = {}
    out = []
    for x in items:
        n = seen.get(x, 0)
        seen[x] = n + 1
        out.append((x, n))
    return out


def _letter_pairs(key: str) -> list[tuple[str, int]]:
    return _numbered(map("".join, zip(key, key[1:], strict=False)))


@F.pandas_udf(Y.ArrayType(Y.StringType()))
def letter_pairs(keys: pd.Series) -> pd.Series:
    """Neighbouring letters of a key, each with its number among equal ones: what two keys share of these is counted with repeats."""
    return keys.map(lambda k: [f"{x}\u0001{n}" for x, n in _letter_pairs(k)])


@F.pandas_udf(Y.IntegerType())
def shared_letter_pairs(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([len(set(_letter_pairs(x)).intersection(_letter_pairs(y))) for x, y in zip(a, b, strict=True)], dtype="int32")


def _marks(key: str) -> int:
    bits = 0
    for x, n in _numbered(key):
        bits |= 1 << ((ord(x) * 37 + n * 11) & 63)
    return bits - (1 << 64) if bits >> 63 else bits


@F.pandas_udf(Y.LongType())
def letter_marks(keys: pd.Series) -> pd.Series:
    """64 marks of a key's letters, each letter with its number among equal ones: a mark that another key lacks is a letter that it lacks."""
    return pd.Series([_marks(k) for k in keys], dtype="int64")


def alike_in_length(least: float):
    """Whether the lengths of ckey and tkey allow a ratio of `least`, and how many letters it leaves unmatched at most."""
    n, m = F.length("ckey"), F.length("tkey")
    unmatched = F.floor((1 - least) * (n + m) + F.lit(1e-9))
    return F.abs(n - m) <= unmatched, unmatched


def may_be_alike(least: float):
    """Whether the lengths and marks of ckey and tkey allow a ratio of `least`: of the letters that it leaves unmatched each key has half, and half of what it is longer by."""
    n, m = F.length("ckey"), F.length("tkey")
    fits, unmatched = alike_in_length(least)
    lacks = lambda a, b: F.bit_count(F.col(a).bitwiseAND(F.bitwise_not(F.col(b))))
    return fits & (2 * lacks("cmarks", "tmarks") <= unmatched + n - m) & (2 * lacks("tmarks", "cmarks") <= unmatched + m - n)


def similar_keys(ckeys: DataFrame, tkeys: DataFrame, least: float) -> DataFrame:
    """Distinct pairs (ckey, tkey) of different keys that may have a sequence ratio of `least` or more; none that has is left out.

    Such a pair leaves at most (1 - least) * (letters of both) letters unmatched, and each takes two letter pairs with it, so it shares at least longer - 1 - 2 * unmatched of them. Hence
    their rarest letter pairs, 2 * floor(2 * (1 - least) * letters) + 2 of each key, have one in common, and its places differ by no more than the unmatched letters: only such pairs are joined.
    """
    if least <= 0.75:
        raise ValueError("below a ratio of 0.75 keys may share no letter pair")
    c = ckeys.select(F.col("ckey").alias("key"), F.lit(0).alias("side"))
    asked = c.unionByName(tkeys.select(F.col("tkey").alias("key"), F.lit(1).alias("side"))).distinct()
    each = asked.select("key", "side", F.posexplode(letter_pairs("key")).alias("at", "gram"))
    often = stored(each.groupBy("gram").agg(F.count(F.lit(1)).alias("n")), "letter-pairs")
    ranked = each.join(often, "gram").groupBy("key", "side").agg(F.array_sort(F.collect_list(F.struct("n", "gram", "at"))).alias("by"))  # as long as the key
    count = (2 * F.floor(2 * (1 - least) * F.length("key") + F.lit(1e-9)) + 2).cast("int")
    rare = stored(ranked.select("key", "side", letter_marks("key").alias("marks"), F.explode(F.slice("by", 1, count)).alias("x")).select("key", "side", "marks", "x.gram", "x.at"), "rare-pairs")
    left = rare.where("side = 0").select(F.col("key").alias("ckey"), F.col("marks").alias("cmarks"), "gram", "at")
    right = rare.where("side = 1").select(F.col("key").alias("tkey"), F.col("marks").alias("tmarks"), "gram", F.col("at").alias("there"))
    _, unmatched = alike_in_length(least)
    near = may_be_alike(least) & (F.col("ckey") != F.col("tkey")) & (F.abs(F.col("at") - F.col("there")) <= unmatched)
    met = left.join(right, "gram").where(near).select("ckey", "tkey").distinct()
    return met.where(shared_letter_pairs("ckey", "tkey") >= F.greatest(F.length("ckey"), F.length("tkey")) - 1 - 2 * unmatched)


def fuzzy_rows(pools: Pools, near: DataFrame, least: float = FUZZY) -> DataFrame:
    """Rows of the pools with a sequence ratio of `least` or more, the `most` best of each. Keys that share a token are among `near`, the others are met by their letters."""
    fits, _ = alike_in_length(least)
    others = similar_keys(pools.keys.where("kind != 'blocked'").select("ckey"), pools.trends.select("tkey"), least)
    pairs = near.where(fits & (F.col("ckey") != F.col("tkey"))).unionByName(others).distinct()
    scored = stored(pairs.withColumn("score", sequence_ratio("ckey", "tkey")).where(F.col("score") >= least), "fuzzy-keys")
    return _first(pools.within(scored), ["ckey", "day"], [F.col("score").desc(), *_largest()], pools.most)


def semantic_rows(pools: Pools, near: DataFrame, least: float = SEMANTIC, pool: int = SEMANTIC_POOL) -> DataFrame:
    """Rows with a semantic score of `least` or more among the `pool` trends of each pool that are nearest by sequence ratio.

    Without a shared token a score is 0.3 at most, so all such pairs are among `near`.
    """
    if least <= 0.3:
        raise ValueError("pairs without a shared token can score 0.3")
    scored = stored(near.withColumn("score", semantic_score(F.col("ckey"), F.col("tkey"))).where(F.col("score") >= least), "semantic-keys")
    hits = stored(pools.within(scored), "semantic-hits")
    wide = stored(hits.select("ckey", "day").distinct().join(pools.sizes(hits).where(F.col("size") > pool), ["ckey", "day"], "left_semi"), "wide-pools")
    ratios = pools.rows(wide).withColumn("ratio", sequence_ratio("ckey", "tkey"))
    nearest = _first(ratios, ["ckey", "day"], [F.col("ratio").desc(), *_largest()], pool)
    narrow = hits.join(wide, ["ckey", "day"], "left_anti")
    kept = hits.join(nearest.select("ckey", "day", "trend_id"), ["ckey", "day", "trend_id"], "left_semi")
    return narrow.unionByName(kept.select(narrow.columns))


def _to_rows(found: DataFrame, candidates: DataFrame, stage: str) -> DataFrame:
    own = candidates.select("candidate_id", F.col("key").alias("ckey"), pool_day())
    return own.join(found, ["ckey", "day"]).select("candidate_id", "trend_id", F.lit(stage).alias("stage"), "score")


def pools_of(candidates: DataFrame, trends: DataFrame, days: int = WINDOW_DAYS, most: int = POOL) -> Pools:
    keys = candidates.where("key != ''").select(F.col("key").alias("ckey"), pool_day())
    return Pools(keys, trends, days, most)


def fuzzy_pairs(candidates: DataFrame, trends: DataFrame, least: float = FUZZY, days: int = WINDOW_DAYS, most: int = POOL) -> DataFrame:
    pools = pools_of(candidates, trends, days, most)
    return _to_rows(fuzzy_rows(pools, pools.near(least, None), least), candidates, "fuzzy")


def semantic_pairs(candidates: DataFrame, trends: DataFrame, least: float = SEMANTIC, days: int = WINDOW_DAYS, pool: int = SEMANTIC_POOL, most: int = POOL) -> DataFrame:
    pools = pools_of(candidates, trends, days, most)
    return _to_rows(semantic_rows(pools, pools.near(None, least), least, pool), candidates, "semantic")


def match(candidates: DataFrame, trends: DataFrame, days: int = WINDOW_DAYS, most: int = POOL, pool: int = SEMANTIC_POOL) -> DataFrame:
    """All match rows: each candidate's pairs of the first stage that has any, ranked in the stage, with an ambiguity flag; else one unmatched row.

    Each stage's rows are written as a table, and the next stage sees the candidates that are left; a pool is the trends' and the key's own, so both scoring stages share the pools of
    what isn't exact. candidate_id may be of any type that has an order.
    """
    timed, trends = stored(temporal_mode(candidates, trends, days), "candidates"), stored(trends, "trends")
    exact = stored(exact_pairs(timed, trends, days), "exact")
    rest = timed.where("key != ''").join(exact, "candidate_id", "left_anti")
    pools = pools_of(rest, trends, days, most)
    near = pools.near(FUZZY, SEMANTIC)
    fuzzy = stored(_to_rows(fuzzy_rows(pools, near), rest, "fuzzy"), "fuzzy")
    last = rest.join(fuzzy, "candidate_id", "left_anti")
    semantic = stored(_to_rows(semantic_rows(pools, near, pool=pool), last, "semantic"), "semantic")
    found = exact.unionByName(fuzzy).unionByName(semantic).join(trends.select("trend_id", "counts", "name"), "trend_id")
    order = Window.partitionBy("candidate_id").orderBy(F.col("score").desc(), *_largest())
    every = Window.partitionBy("candidate_id")
    ranked = found.withColumns({"stage_rank": F.row_number().over(order), "ambiguity_count": F.count(F.lit(1)).over(every)})
    place = [c for c in ("candidate_rank_in_post",) if c in timed.columns]
    return (
        timed.select("candidate_id", "uri", "key", "mode", *place)
        .join(ranked, "candidate_id", "left")
        .withColumns({"stage": F.coalesce("stage", F.lit("unmatched")), "is_matched": F.col("trend_id").isNotNull(), "is_ambiguous": F.coalesce(F.col("ambiguity_count") > 1, F.lit(False))})
    )


def best_per_post(matches: DataFrame) -> DataFrame:
    """One row per uri: stage, score, counts (null last), name, then the candidate's rank in its post where that is known, its phrase, and its number."""
    stage = F.create_map(*[F.lit(x) for kv in STAGES.items() for x in kv])[F.col("stage")]
    rank = [F.col(c).asc_nulls_last() for c in ("candidate_rank_in_post",) if c in matches.columns]
    w = Window.partitionBy("uri").orderBy(stage, F.col("score").desc_nulls_last(), F.col("counts").desc_nulls_last(), F.col("name").asc_nulls_last(), *rank, "key", "candidate_id", F.col("trend_id").asc_nulls_last())
    return matches.withColumn("_best", F.row_number().over(w)).where("_best = 1").drop("_best")


def best_per_candidate(matches: DataFrame) -> DataFrame:
    """One row per candidate: stage, its rank in the stage, then trend."""
    stage = F.create_map(*[F.lit(x) for kv in STAGES.items() for x in kv])[F.col("stage")]
    w = Window.partitionBy("candidate_id").orderBy(stage, F.col("stage_rank").asc_nulls_last(), F.col("trend_id").asc_nulls_last())
    return matches.withColumn("_best", F.row_number().over(w)).where("_best = 1").drop("_best")
