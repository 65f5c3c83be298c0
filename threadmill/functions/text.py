"""Text functions. Java's \\w and \\s are ASCII only, so patterns name Unicode classes."""

from __future__ import annotations

import difflib
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, functions as F, types as Y

WORD = r"[\p{L}\p{N}_]"
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]+"

# Patterns of the text contract.
POST_SEPARATORS = r'[&\-/_,.;:!?(){}\[\]"`]+'
TREND_SEPARATORS = r"[&\-.,/_]+"
POST_URL = r"(?i)((https?://\S+)|(www\.\S+)|(\b(?:[a-z0-9-]+\.)+[a-z]{2,}(?:/\S*)?\b))"
TREND_URL = r"(?i)(https?://\S+|www\.\S+|\b[a-z0-9-]+\.[a-z]{2,}\b)"
SPECIAL = r"[^A-Za-z0-9\s]"
NON_ASCII = r"[^\x00-\x7F]"


@F.pandas_udf(Y.StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """Unicode compatibility form; Spark has no function for it."""
    return texts.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t))


@F.pandas_udf(Y.StringType())
def nfkc_casefold(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: t if t is None else t.lower() if t.isascii() else unicodedata.normalize("NFKC", t).casefold())


@F.pandas_udf(Y.StringType())
def casefold(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: t if t is None else t.casefold())


@F.pandas_udf(Y.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity of a with b (not symmetric); the standard library's matcher defines it."""
    return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype=float)


def once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is worked out once, however often f uses it."""
    return F.transform(F.array(value), f)[0]


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, SPACE, " "))


def straight(c: Column) -> Column:
    return F.regexp_replace(c, "[‘’]", "'")


def tokens(c: Column) -> Column:
    return F.filter(F.split(c, " "), lambda t: t != "")


def post_text(raw: Column) -> Column:
    """Struct of a post's normalised text and flags; a null text is empty."""
    raw = F.coalesce(raw, F.lit(""))

    def fields(x: Column) -> Column:
        clean, base = x["clean"], x["base"]
        return F.struct(
            raw.alias("post_text_raw"),
            clean.alias("post_text_clean"),
            squeeze(F.regexp_replace(clean, r"[^a-z0-9\s]", " ")).alias("post_text_alnum"),
            F.size(tokens(clean)).cast("long").alias("post_token_count"),
            F.length(clean).cast("long").alias("post_char_count"),
            base.rlike(rf"(?<!{WORD})#{WORD}+").alias("has_hashtag"),
            base.rlike(POST_URL).alias("has_url"),
            base.rlike(rf"(?<!{WORD})@{WORD}+").alias("has_mention"),
            base.rlike(SPECIAL).alias("has_special_chars"),
            base.rlike(NON_ASCII).alias("has_non_ascii"),
        )

    base = F.regexp_replace(straight(nfkc(raw)), r"[\r\n\t]", " ")
    both = lambda b: F.struct(b.alias("base"), squeeze(F.regexp_replace(F.lower(b), POST_SEPARATORS, " ")).alias("clean"))
    return once(base, lambda b: once(both(b), fields))


def _core(folded: Column, separators: str) -> Column:
    spaced = F.regexp_replace(F.regexp_replace(folded, separators, " "), "'", " ")
    return squeeze(F.regexp_replace(spaced, r"[^\p{L}\p{N}_\s\x1c-\x1f\x85\p{Z}#$]", " "))


def _alnum(c: Column) -> Column:
    return squeeze(F.regexp_replace(c, r"[^a-z0-9\s]", " "))


def trend_name(raw: Column) -> Column:
    """Struct of a trend name's normalised keys and flags; null and blank names have empty keys. One leading # or $ goes before punctuation does, so that of `-#a` stays."""
    raw = F.coalesce(raw.cast("string"), F.lit(""))

    def fields(low: Column) -> Column:
        with_hash = _core(low, TREND_SEPARATORS)
        no_hash = _core(F.regexp_replace(low, r"^#", ""), TREND_SEPARATORS)
        return once(F.struct(with_hash.alias("with_hash"), no_hash.alias("no_hash")), named)

    def named(x: Column) -> Column:
        with_hash, no_hash = x["with_hash"], x["no_hash"]
        no_dollar = F.trim(F.regexp_replace(no_hash, r"^\$", ""))
        return F.struct(
            raw.alias("trend_name_raw"),
            with_hash.alias("trend_name_clean"),
            no_hash.alias("trend_name_clean_no_hash"),
            no_dollar.alias("trend_name_clean_no_dollar"),
            with_hash.alias("normalized_key_with_hash"),
            no_hash.alias("normalized_key_no_hash"),
            no_dollar.alias("normalized_key_no_dollar"),
            _alnum(no_hash).alias("trend_name_alnum"),
            F.size(tokens(no_hash)).cast("long").alias("trend_name_token_count"),
            F.length(no_hash).cast("long").alias("trend_name_char_count"),
            (squeeze(raw) == "").alias("is_blank_raw"),
            squeeze(raw).startswith("#").alias("is_hashtag"),
            raw.rlike(SPECIAL).alias("has_special_chars"),
            raw.rlike(NON_ASCII).alias("has_non_ascii"),
            raw.rlike(TREND_URL).alias("has_url_like"),
        )

    return once(squeeze(nfkc_casefold(straight(raw))), fields)


def candidate_phrase(raw: Column) -> Column:
    """Struct of a candidate phrase's raw, clean, alnum and hash-free forms; tokens are counted on alnum, characters on clean."""
    folded = F.regexp_replace(straight(nfkc_casefold(raw)), r"[\r\n\t]", " ")
    clean = _core(folded, POST_SEPARATORS)
    alnum = _alnum(clean)
    return F.struct(
        F.coalesce(raw, F.lit("")).alias("candidate_phrase_raw"),
        clean.alias("candidate_phrase_clean"),
        alnum.alias("candidate_phrase_alnum"),
        F.trim(F.regexp_replace(clean, r"^#", "")).alias("candidate_phrase_no_hash"),
        F.size(tokens(alnum)).cast("long").alias("candidate_token_count"),
        F.length(clean).cast("long").alias("candidate_char_count"),
        alnum.rlike("[0-9]").alias("candidate_contains_digit"),
    )


def token_cosine(a: Column, b: Column) -> Column:
    """Cosine of the token counts of two token arrays; 0 if either is empty."""

    def count(t: Column, of: Column) -> Column:
        return F.size(F.filter(of, lambda x: x == t))

    dot = F.aggregate(F.array_intersect(a, b), F.lit(0.0), lambda acc, t: acc + count(t, a) * count(t, b))
    norm = lambda x: F.sqrt(F.aggregate(F.array_distinct(x), F.lit(0.0), lambda acc, t: acc + F.pow(count(t, x), 2)))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(dot / (norm(a) * norm(b)))


def trigrams(c: Column) -> Column:
    short = F.when(F.length(c) == 0, F.array().cast("array<string>")).otherwise(F.array(c))
    return F.when(F.length(c) < 3, short).otherwise(
        F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(c) - 2)), lambda i: F.substring(c, i, F.lit(3))))
    )


def trigram_jaccard(a: Column, b: Column) -> Column:
    x, y = trigrams(a), trigrams(b)
    return F.when((F.size(x) == 0) | (F.size(y) == 0), 0.0).otherwise(F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y)))


def semantic_score(a: Column, b: Column) -> Column:
    return 0.7 * token_cosine(tokens(a), tokens(b)) + 0.3 * trigram_jaccard(a, b)


def post_shape(raw: Column, alnum: Column, token_count: Column) -> list[Column]:
    """Counts of a post's raw text: distinct tokens and their ratio, ! and ?, capitals among letters."""
    distinct = F.size(F.array_distinct(tokens(alnum))).cast("long")
    letters = F.regexp_count(raw, F.lit(r"\p{L}"))
    return [
        distinct.alias("post_unique_token_count"),
        F.when(token_count > 0, distinct / token_count).otherwise(0.0).alias("post_unique_token_ratio"),
        (F.length(raw) - F.length(F.replace(raw, F.lit("!")))).cast("long").alias("raw_exclamation_count"),
        (F.length(raw) - F.length(F.replace(raw, F.lit("?")))).cast("long").alias("raw_question_count"),
        F.when(letters > 0, F.regexp_count(raw, F.lit(r"\p{Lu}")) / letters).otherwise(0.0).alias("raw_uppercase_ratio"),
    ]


def time_parts(ts: Column) -> list[Column]:
    """Hour, day of week (Monday 0), weekend and month in UTC; 0 for an unknown time."""
    day = F.coalesce(F.weekday(ts), F.lit(0)).cast("int")
    return [
        F.coalesce(F.hour(ts), F.lit(0)).alias("post_hour_utc"),
        day.alias("post_day_of_week"),
        day.isin(5, 6).alias("post_is_weekend"),
        F.coalesce(F.month(ts), F.lit(0)).alias("post_month"),
    ]


def key_normal(raw: Column) -> Column:
    """A match key: trimmed, case-folded, runs of white space as one blank."""
    return squeeze(casefold(F.coalesce(raw, F.lit(""))))


def simple_key(raw: Column) -> Column:
    """The lexical key of a name: compatibility form in lower case, without anything but letters, digits and single blanks."""
    return squeeze(F.regexp_replace(F.lower(nfkc(raw)), r"[^\p{L}\p{N}\s]", " "))


def text_tests(raw: Column, stopwords: list[str], short: int = 3) -> dict[str, Column]:
    """Tests of a name: emoji, repeated separators, white space at its ends, shortness, little information, mostly stopwords."""
    words = tokens(squeeze(F.lower(raw)))
    stops = F.size(F.filter(words, lambda w: w.isin(*stopwords)))
    return {
        "has_emoji": raw.rlike(r"[\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}]"),
        "has_repeated_separator": raw.rlike(r"[-_.,/&]{2,}"),
        "has_edge_space": raw.rlike(r"^\s|\s$"),
        "is_short": F.length(F.trim(raw)) < short,
        "is_low_information": ~raw.rlike(r"[\p{L}]"),
        "is_mostly_stopwords": (F.size(words) > 0) & (stops * 2 > F.size(words)),
    }


def iso_time(value: Column) -> Column:
    """An ISO time as a timestamp: Z is UTC, a time without a zone is UTC too (the session's zone must be), what doesn't parse is null."""
    return F.try_to_timestamp(F.regexp_replace(F.trim(value), "Z$", "+00:00"))


def file_matches(staged: Column, name: Column) -> Column:
    """Whether a staged file's path is a name, or ends in it after a slash."""
    return (staged == name) | staged.endswith(F.concat(F.lit("/"), name))


def human_bytes(n: Column) -> Column:
    """Bytes with a unit, one decimal."""
    units = ("B", "KB", "MB", "GB")
    out = F.format_string("%.1f TB", n / 1024.0**4)
    for i in reversed(range(len(units))):
        out = F.when(n < 1024.0 ** (i + 1), F.format_string(f"%.1f {units[i]}", n / 1024.0**i)).otherwise(out)
    return out
