"""Main text of web pages: page structure, then a suffix table per host."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .frames import release_memory, small, small_batches, text_of, written

#: Tokens of the shortest substring that counts as boilerplate, and distinct pages of a host that must share it.
RUN, PAGES = 8, 3

# Elements of HTML by what they mean for the main text.
SILENT = frozenset("script style noscript template svg math canvas iframe object embed audio video map head title datalist".split())
APART = frozenset("nav footer aside form dialog menu button select option textarea input label fieldset legend".split())
MAIN = frozenset("article main".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6
    header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split()
)
APART_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tablist".split())
APART_WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertising adsbygoogle banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus
    footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices overlay paywall popup promo promoted promotion related recommended
    respond share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget widgets""".split()
)
#: Of these, what may also name a part of an article; and what may stand at an article element that isn't the page's own.
PAGE_ONLY = frozenset("header masthead banner widget widgets".split())
OTHERS = frozenset("ad ads advert advertisement comment comments promo promoted promotion related recommended sponsor sponsored".split())
IN_MAIN = APART_WORDS - PAGE_ONLY
#: Class names of several parts count by their last part, or by their first if the last is one of PARTS or a number, unless a part says that the element merely has or lacks the thing.
PARTS = frozenset("list item items box bar area wrap wrapper container section block slot links buttons inner content body thread respond reply form meta author brand".split())
HAVING = frozenset("has have no not non with without is hide hidden show layout single".split())
#: A start of one of these ends an open paragraph; an item or cell ends its open sibling.
ENDS_P = BLOCK - {"body", "html", "caption", "td", "th", "tr", "tbody", "thead", "tfoot"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


def named_apart(value: str, words: frozenset[str]) -> bool:
    """Whether one of the names in a class or id attribute names a thing that `words` has: as a whole, or as a name of several parts that says so."""
    for name in value.lower().split():
        if name in words:
            return True
        parts = [p for p in re.split(r"[-_]+", name) if p]
        if len(parts) > 1 and not HAVING & set(parts) and (parts[-1] in words or (parts[0] in words and (parts[-1] in PARTS or parts[-1].isdigit()))):
            return True
    return False


class Blocks(HTMLParser):
    """Text blocks of a page: (text, whether the block stands in the main element)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, bool]] = []  # name, set apart, main
        self.found: list[tuple[str, bool]] = []
        self.now: list[str] = []

    def close_block(self) -> None:
        text = " ".join("".join(self.now).split())
        if text:
            self.found.append((text, bool(self.stack) and self.stack[-1][2]))
        self.now = []

    def pop_to(self, at: int) -> None:
        if any(name in BLOCK for name, _, _ in self.stack[at:]):
            self.close_block()
        del self.stack[at:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("html", "body"):
            return
        if tag in ENDS_P:
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] == "p":
                    self.pop_to(i)
                    break
                if self.stack[i][0] in BLOCK:
                    break
        if tag in SIBLINGS:
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] in SIBLINGS[tag]:
                    self.pop_to(i)
                    break
                if self.stack[i][0] in ("ul", "ol", "dl", "table", "tbody", "thead", "tfoot", "select"):
                    break
        if tag in BLOCK:
            self.close_block()
        if tag == "br":
            self.now.append(" ")
        if tag in VOID:
            return
        apart, main = self.stack[-1][1:] if self.stack else (False, False)
        given = dict(attrs)
        names = f"{given.get('class') or ''} {given.get('id') or ''}"
        role = (given.get("role") or "").lower()
        inner = tag in MAIN or role in ("main", "article")
        hidden = "hidden" in given or (given.get("aria-hidden") or "").lower() == "true" or "display:none" in (given.get("style") or "").replace(" ", "").lower()
        apart = (
            apart
            or tag in SILENT
            or tag in APART
            or (tag == "header" and not main)
            or role in APART_ROLES
            or hidden
            # Names of inline elements are often about looks, and their text is part of a sentence.
            or (tag in BLOCK and named_apart(names, OTHERS if inner else IN_MAIN if main else APART_WORDS))
        )
        self.stack.append((tag, apart, main or (inner and not apart)))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.now.append(" ")
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                self.pop_to(i)
                return
            if self.stack[i][0] in ("article", "main", "table", "td") and tag not in BLOCK:
                return

    def handle_data(self, data: str) -> None:
        if self.stack and self.stack[-1][1]:
            return
        self.now.append(data)


def all_blocks(html: str) -> list[tuple[str, bool]]:
    """Blocks of a page outside elements set apart, in order, each with whether it stands in the main element."""
    parser = Blocks()
    parser.feed(html)
    parser.close()
    parser.pop_to(0)
    parser.close_block()
    return parser.found


def page_blocks(html: str) -> list[tuple[str, bool]]:
    """Blocks of a page outside elements set apart, in order. With a main element, only its blocks stay."""
    found = all_blocks(html)
    return [b for b in found if b[1]] or found


def _parsed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for pages in batches:
        rows = [all_blocks(h) for h in pages]
        main = [any(m for _, m in r) for r in rows]
        inner = [[t for t, m in r if m or not own] for r, own in zip(rows, main, strict=True)]
        outer = [[t for t, m in r if own and not m] for r, own in zip(rows, main, strict=True)]
        yield pd.DataFrame({"blocks": inner, "main": main, "outside": outer})
    release_memory()


def uncovered(blocks: list[str], starts: list[int], run: int) -> list[str]:
    """Blocks without the tokens that substrings of `run` tokens from the given positions (from 1, over all blocks) cover."""
    split = [b.split(" ") for b in blocks]
    edge = np.zeros(sum(map(len, split)) + run + 1, dtype=int)
    first = np.asarray(starts, dtype=int) - 1
    edge[first] += 1
    edge[first + run] -= 1
    free = (edge.cumsum() == 0).tolist()
    out, at = [], 0
    for tokens in split:
        left = " ".join(t for t, keep in zip(tokens, free[at : at + len(tokens)], strict=True) if keep)
        at += len(tokens)
        if left:
            out.append(left)
    return out


def runs(least: int):
    """Of a partition's suffixes (host, head, stream), in that order: heads of `least` streams or more, and those of the first and last run, which may go on in
    the partitions beside it, with the number of their streams and of those that are articles (odd)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, last, n, inner, first = None, None, 0, 0, True
        for batch in batches:
            found = []
            for host, head, stream in zip(batch["host"].tolist(), batch["head"].tolist(), batch["stream"].tolist(), strict=True):
                if (host, head) != now:  # neighbours compared in full
                    if now is not None and (first or n >= least):
                        found.append((*now, n, inner))
                    first = first and now is None
                    now, last, n, inner = (host, head), stream, 1, stream % 2
                elif stream != last:
                    last, n, inner = stream, n + 1, inner + stream % 2
            yield pd.DataFrame(found, columns=["host", "head", "n", "inner"])
        if now is not None:
            yield pd.DataFrame([(*now, n, inner)], columns=["host", "head", "n", "inner"])

    return run


def repeated_starts(streams: DataFrame, run: int = RUN, least: int = PAGES) -> DataFrame:
    """(stream, starts) of streams(host, stream, tokens), each stream a different text, those of articles odd: the places, from 1, from which `run` tokens occur in `least` streams of
    the host or more, one of them outside an article; in an article, those that another article has too.

    The suffix array of each host: every suffix by its first `run` tokens, which is all that decides whether it begins a long repeated substring. Splitters sampled from the data deal
    the sorted suffixes out by host, tokens and stream, so neither a host nor a sentence on all its pages has to fit into a task; tasks sort externally, and neighbours are
    compared in full. A run of equal suffixes that goes on in the next task is summed.
    """
    spots = F.sequence(F.lit(1), F.size("tokens") - run + 1)
    suffix = F.transform(spots, lambda i: F.struct(i.alias("at"), F.array_join(F.slice("tokens", i, run), " ").alias("head")))
    array = streams.where(F.size("tokens") >= run).select("host", "stream", F.explode(suffix).alias("s")).select("host", "s.head", "stream", "s.at")
    array = written(array, "suffixes")
    ordered = array.select("host", "head", "stream").repartitionByRange("host", "head", "stream").sortWithinPartitions("host", "head", "stream")
    ends = ordered.mapInPandas(runs(least), "host string, head string, n long, inner long")
    sums = ends.groupBy("host", "head").agg(F.sum("n").alias("n"), F.sum("inner").alias("inner"))
    repeated = sums.where((F.col("n") >= least) & (F.col("n") > F.col("inner"))).select("host", "head", (F.col("inner") > 1).alias("articles"))
    found = array.join(small(written(repeated, "repeated")), ["host", "head"]).where("stream % 2 = 0 OR articles")
    return found.groupBy("stream").agg(F.collect_set("at").alias("starts"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", run: int = RUN, least: int = PAGES) -> DataFrame:
    """page_id, url, text and n_chars of every page: the blocks of its article, joined by line feeds.

    Structure first: scripts, menus, page headers, footers, sidebars, forms, notices, adverts and comments go, by element, role, class or id. A page
    with an article or main element gives that element's blocks.

    Then the suffix array of each host that has text outside articles, over every page of it, inside and outside: substrings of `run` or more tokens that `least` or more distinct
    texts share, one of them outside an article, are boilerplate, and every token that they cover goes. An article loses them only where another article has them too, so that a teaser
    elsewhere doesn't cut the article it is taken from; what only articles share is their own and stays. Texts that are equal as a whole count as one, and a page that would lose all its
    text keeps it, so that copies of an article don't remove each other.

    Null html is empty; an empty page has an empty text. Null urls share one host. Very long pages are parsed whole. Repeated rows give a row each. Null ids are kept. Other columns of pages
    aren't carried. An empty table gives an empty table.
    """
    parse = F.pandas_udf(_parsed, "blocks array<string>, main boolean, outside array<string>")
    read = pages.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), parse(text_of(html_col)).alias("p"))
    with small_batches(pages.sparkSession):
        base = written(read.select("row", "page_id", "url", "p.*"), "blocks")
        text = lambda blocks: F.array_join(blocks, "\n").alias("text")
        out = base.select("page_id", "url", text("blocks"))
        host = F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))
        loose = (~F.col("main") & (F.size("blocks") > 0)) | (F.size("outside") > 0)
        if base.where(loose).limit(1).count():
            parts = F.array(F.struct(F.col("main").cast("int").alias("article"), F.col("blocks").alias("own")), F.struct(F.lit(0).alias("article"), F.col("outside").alias("own")))
            hosts = small(written(base.where(loose).select(host.alias("host")).distinct(), "hosts"))
            each = base.select("row", host.alias("host"), F.posexplode(parts).alias("part", "x")).where(F.size("x.own") > 0).join(hosts, "host", "left_semi")
            opened = each.select("row", "host", "part", "x.article", F.flatten(F.transform("x.own", lambda b: F.split(b, " "))).alias("tokens"))
            opened = written(opened.withColumn("digest", F.sha2(F.array_join("tokens", " "), 256)), "open")
            # A page's own text and what stands outside its article have numbers of their own; those of articles are odd.
            number = F.col("row") * 4 + F.col("part") * 2 + F.col("article")
            streams = opened.groupBy("host", "digest", "article").agg(F.min(number).alias("stream"))
            first = opened.withColumn("stream", number).join(streams.select("stream"), "stream", "left_semi")
            starts = repeated_starts(first.select("host", "stream", "tokens"), run, least)
            # Only pages that hold something repeated are shuffled for it.
            covered = opened.where("part = 0").select("row", "host", "digest", "article").join(streams, ["host", "digest", "article"]).join(starts, "stream").select("row", "starts")
            covered = small(written(covered, "covered"))
            cut = F.pandas_udf(lambda blocks, starts: pd.Series([uncovered(b, s, run) for b, s in zip(blocks, starts, strict=True)]), "array<string>")
            kept = base.join(covered, "row").withColumn("kept", cut("blocks", "starts"))
            kept = kept.select("page_id", "url", text(F.when(F.size("kept") == 0, F.col("blocks")).otherwise(F.col("kept"))))
            out = base.join(covered, "row", "left_anti").select("page_id", "url", text("blocks")).unionByName(kept)
    return out.withColumn("n_chars", F.length("text").cast("long"))
