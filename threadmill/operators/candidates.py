"""Topic candidates of posts: hashtags, word n-grams and a fallback to single words.

A post's candidates are drawn lazily in rank order and stop at the limit, which Spark's array functions can't do: they would filter every
n-gram of the text. So this is one Arrow function over the normalised text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from threadmill.sources.tables import bound_batches

# Word lists of the candidate contract.
STOPWORDS = """a an and are as at be but by for from has have he her his i if in is it its me my not of on or our she that the their them
they this to too us was we were what when where which who why will with you your""".split()
STOPSET = frozenset(STOPWORDS)
ARTIFACTS = frozenset("http https www com net org app profile shorts bsky".split())
BLOCKED = ["macro"]
ID_LIKE = re.compile(r"^(?=.*[a-z])(?=.*\d)[a-z0-9]{10,}$")
_TAG = re.compile(r"(?<!\w)#\w+")
COLUMNS = """candidate_source_type string, candidate_start_index int, candidate_phrase_raw string, candidate_phrase_clean string, candidate_phrase_alnum string,
candidate_token_count bigint, candidate_char_count bigint, candidate_contains_digit boolean, candidate_rank_in_post int"""


def usable(clean: str, words: list[str], is_hashtag: bool) -> bool:
    """Whether a phrase may be a candidate."""
    if not 1 <= len(words) <= 4 or not 3 <= len(clean) <= 64 or STOPSET.issuperset(words):
        return False
    if len(words) == 1:
        return len(words[0]) >= 3 and words[0] not in ARTIFACTS and words[0] not in BLOCKED and (is_hashtag or not ID_LIKE.match(words[0]))
    # N-grams only: a hashtag may begin or end with a stopword.
    if not is_hashtag and (words[0] in STOPSET or words[-1] in STOPSET):
        return False
    links = sum(w in ARTIFACTS for w in words)
    return links < 2 and links / len(words) < 0.5 and (is_hashtag or not any(ID_LIKE.match(w) for w in words))


def in_order(clean: str, words: list[str]) -> Iterator[tuple[str, int, str, str, str, int]]:
    """Usable candidates by source, start and length: source, start (hashtags: character, n-grams: word), raw, clean, alnum, tokens."""
    longer = False
    for m in _TAG.finditer(clean):
        folded = m[0].casefold()
        own = " ".join(re.sub(r"[^a-z0-9]", " ", folded).split())
        if usable(folded, own.split(), True):
            longer = True
            yield "hashtag", m.start(), m[0], folded, own, len(own.split())
    for n in (4, 3, 2):
        for i in range(len(words) - n + 1):
            phrase = " ".join(words[i : i + n])
            if usable(phrase, words[i : i + n], False):
                longer = True
                yield f"ngram_{n}", i, phrase, phrase, phrase, n
    if not longer:
        for i, w in enumerate(words):
            if usable(w, [w], False):
                yield "unigram_fallback", i, w, w, w, 1


def ranked(clean: str, words: list[str], most: int) -> list[tuple]:
    """The first `most` candidates, one per alnum phrase."""
    out: dict[str, tuple] = {}
    for c in in_order(clean, words):
        if c[4] not in out:
            out[c[4]] = (*c, len(c[3]), any(x.isdigit() for x in c[4]), len(out) + 1)
            if len(out) == most:
                break
    return list(out.values())


def generate(posts: DataFrame, most: int = 20) -> DataFrame:
    """Up to `most` ranked candidates per post(uri, post_text_clean, post_text_alnum).

    Candidates that the filters leave are deduplicated by alnum phrase, the first in the order of source, start and tokens staying, and ranked in that
    order. Single words come in only where no longer phrase or hashtag is left. N-grams consist of plain words, so they are their own normal form. A row
    at a time, without a shuffle.
    """

    bound_batches(posts.sparkSession)

    def run(clean: pd.Series, alnum: pd.Series) -> pd.Series:
        return pd.Series([ranked(c, a.split(), most) for c, a in zip(clean, alnum, strict=True)])

    found = F.pandas_udf(run, f"array<struct<{COLUMNS.replace(' ', ':').replace(',:', ',').replace(chr(10), '')}>>")
    return posts.select("uri", F.explode(found("post_text_clean", "post_text_alnum")).alias("c")).select("uri", "c.*")
