"""Quality rules, lines first: lines that fail are removed, and documents that lose too much of their text are rejected."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .frames import fresh, release_memory, small_batches, text_of

LEAST_WORDS, MOST_REPEATED, MOST_LOST = 50, 50, 40
# What a word and a symbol is.
WORD, SYMBOL = r"[^\x20\x09-\x0D]+", r"[#*$%&|<>]"
#: Line rules: marks of code and markup per 100 words, capitals per 100 letters, runs of marks per 100 words, separators per 100 words; each counts from so many on.
MARKUP, MOST_MARKUP = r"[#*$%&<>{}~^=\\]", 30
CAPITAL, LETTER, MOST_CAPITALS, LEAST_CAPITALS = r"\p{Lu}", r"\p{L}", 60, 12
RUN, MOST_RUNS = r"[!?]{2,}|\.{4,}|-{4,}|_{4,}", 20
SEPARATOR, MOST_SEPARATORS = r"[|»›•·→]", 25
FROM = 3
#: A line that ends in none of these and has fewer words than this is a heading or part of a menu.
CLOSED, HEADING_WORDS = r"[.!?…:;,。！？][\"'”’»)\]]*[\x20\x09-\x0D]*$", 6
#: Phrases of page furniture, looked for in lines of at most FURNITURE_WORDS words.
FURNITURE_WORDS = 30
FURNITURE = [
    "accept cookies", "accept all cookies", "we use cookies", "uses cookies", "cookie policy", "privacy policy", "terms of use", "terms of service", "terms and conditions", "all rights reserved", "enable javascript", "javascript is disabled",
    "sign in", "sign up", "log in", "subscribe to our", "subscribe now", "newsletter", "click here", "read more", "skip to content", "back to top", "share this", "follow us", "lorem ipsum", "add to cart", "leave a comment",
    "alle rechte vorbehalten", "nutzungsbedingungen", "datenschutzerklärung", "cookies akzeptieren", "jetzt anmelden", "weiterlesen", "zum inhalt springen",
    "tous droits réservés", "politique de confidentialité", "accepter les cookies", "conditions d'utilisation", "lire la suite", "abonnez-vous", "cliquez ici",
    "todos los derechos reservados", "política de privacidad", "aceptar cookies", "aviso legal", "leer más", "suscríbete", "haga clic aquí",
]
PHRASE = r"(^|[^\p{L}\p{N}])(" + "|".join(FURNITURE) + r")($|[^\p{L}\p{N}])"

_word, _symbol, _capital, _letter = re.compile(WORD), re.compile(SYMBOL), regex.compile(CAPITAL), regex.compile(LETTER)
_markup, _run, _separator, _closed, _phrase = regex.compile(MARKUP), regex.compile(RUN), regex.compile(SEPARATOR), regex.compile(CLOSED), regex.compile(PHRASE)
_odd = regex.compile(f"{MARKUP}|{RUN}|{SEPARATOR}")


def failed_rule(line: str, words: int) -> str | None:
    """The first rule that a line with words fails: markup, shouting, marks, navigation, boilerplate or heading."""
    if _odd.search(line):
        for name, pattern, most in (("markup", _markup, MOST_MARKUP), ("marks", _run, MOST_RUNS), ("navigation", _separator, MOST_SEPARATORS)):
            n = len(pattern.findall(line))
            if n >= FROM and n * 100 > most * words:
                return name
    capitals = len(_capital.findall(line))
    if capitals >= LEAST_CAPITALS and capitals * 100 > MOST_CAPITALS * len(_letter.findall(line)):
        return "shouting"
    if words <= FURNITURE_WORDS:
        low = line.lower().replace("’", "'")
        if any(x in low for x in FURNITURE) and _phrase.search(low):
            return "boilerplate"
    if words < HEADING_WORDS and not _closed.search(line):
        return "heading"
    return None


def repeated_words(words: list[str]) -> int:
    """Words that lie in a window of three words that the text has twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    n, upto = 0, 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            n += i + 3 - max(i, upto)
            upto = i + 3
    return n


def measured(text: str) -> tuple:
    """The measures of RULES for one text, and the text that its lines leave."""
    n_words, chars, dups, lost, seen, left, words = 0, 0, 0, 0, set(), [], []
    for line in text.split("\n"):
        own = _word.findall(line)
        if own:
            dups += line in seen
            seen.add(line)
            words += own
            if failed_rule(line, len(own)):
                lost += len(own)
                continue
        left.append(line)
    n_words = len(words)
    chars = sum(map(len, words))
    repeats = repeated_words(words)
    base = n_words < LEAST_WORDS or 100 * repeats > MOST_REPEATED * n_words
    return n_words, chars, len(_symbol.findall(text)), dups, repeats, lost, base, not base and lost * 100 <= MOST_LOST * n_words, "\n".join(left)


RULES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lost_words long, base_failed boolean, kept boolean, clean_text string"


def cleaned(docs: DataFrame, text_col: str = "text", with_text: bool = True) -> DataFrame:
    """docs with the columns of RULES; columns of docs with such a name are replaced, and clean_text comes only with `with_text`.

    Each line that has a word is held against the rules for markup, shouting, runs of marks, navigation, boilerplate and headings, and goes if it fails one. A document fails if it is short or repeats itself (base_failed),
    or if the removed lines hold more than MOST_LOST % of its words. Documents are looked at one by one in Arrow batches; nothing is shuffled.

    Null and empty texts have no words and fail. Rows are kept as they are, repeated ones and null ids too. An empty table gives an empty table.
    """
    names = [x.split()[0] for x in RULES.split(", ")]
    names = names if with_text else names[:-1]
    rest = [c for c in docs.columns if c.lower() not in names or c == text_col]
    (own,) = fresh(docs, "qr_text")
    schema = docs.select([F.col(f"`{c}`") for c in rest]).schema
    for part in RULES.split(", ")[: len(names)]:
        schema = schema.add(*part.split())
    size = len(rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measured(x) for x in batch.column(size).to_pylist()]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 9
            kinds = [pa.int64()] * 6 + [pa.bool_(), pa.bool_(), pa.string()]
            added = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)][: len(names)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:size], *added], names=[*rest, *names])
        release_memory()

    return docs.select(*[F.col(f"`{c}`") for c in rest], text_of(text_col).alias(own)).mapInArrow(run, schema)


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that pass, with their lines cleaned and the columns of docs."""
    done = cleaned(docs.withColumn("qr_own", text_of(text_col)), "qr_own").where("kept")
    rest = [c for c in docs.columns if c != text_col]
    row = F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.lit(None).cast("string")
    done = cleaned(docs.select(row.alias("qr_row"), text_of(text_col).alias("qr_own")), "qr_own").where("kept")
    return done.select(*[F.col("clean_text").alias(c) if c == text_col else F.col("qr_row").getField(c).alias(c) for c in docs.columns])


def _count(pattern: str, of: str) -> str:
    return f"len(regexp_extract_all({of}, '{pattern.replace("'", "''")}'))"


def _too_many(pattern: str, most: int) -> str:
    return f"({_count(pattern, 'line')} >= {FROM} AND {_count(pattern, 'line')} * 100 > {most} * n)"


RULES_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT row, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM (SELECT row, regexp_extract_all(text, '{WORD}') AS ws FROM d)),
t AS (SELECT row, i, w || ' ' || lead(w) OVER o || ' ' || lead(w, 2) OVER o AS gram FROM w WINDOW o AS (PARTITION BY row ORDER BY i)),
r AS (SELECT row, i FROM t WHERE gram IS NOT NULL QUALIFY count(*) OVER (PARTITION BY row, gram) > 1),
n AS (SELECT row, count(DISTINCT i + k) AS repeated FROM r, range(3) s(k) GROUP BY row),
l AS (SELECT row, line, {_count(WORD, 'line')} AS n FROM (SELECT row, unnest(string_split(text, chr(10))) AS line FROM d)),
f AS (SELECT row, line, n, {_too_many(MARKUP, MOST_MARKUP)} OR {_too_many(RUN, MOST_RUNS)} OR {_too_many(SEPARATOR, MOST_SEPARATORS)}
  OR ({_count(CAPITAL, 'line')} >= {LEAST_CAPITALS} AND {_count(CAPITAL, 'line')} * 100 > {MOST_CAPITALS} * {_count(LETTER, 'line')})
  OR (n <= {FURNITURE_WORDS} AND regexp_matches(replace(lower(line), '’', ''''), '{PHRASE.replace("'", "''")}'))
  OR (n < {HEADING_WORDS} AND NOT regexp_matches(line, '{CLOSED.replace("'", "''")}')) AS failed FROM l WHERE n > 0),
g AS (SELECT row, CAST(sum(n) AS BIGINT) AS n_words, count(*) - count(DISTINCT line) AS n_dup_lines, CAST(coalesce(sum(n) FILTER (failed), 0) AS BIGINT) AS lost FROM f GROUP BY row),
e AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars, CAST({_count(SYMBOL, 'text')} AS BIGINT) AS n_symbols,
  coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(repeated, 0) AS n_repeat_words, coalesce(lost, 0) AS lost FROM d LEFT JOIN g USING (row) LEFT JOIN n USING (row)),
b AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM e)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND lost * 100 <= {MOST_LOST} * n_words AS kept FROM b"""
