"""Page structure, and the host suffix array against a plain count of all windows."""

import random

import pytest

from threadmill.llm import html_text
from threadmill.llm.html_text import page_blocks


def text(html):
    return "\n".join(t for t, _ in page_blocks(html))


@pytest.mark.parametrize(
    "html, want",
    [
        ('<div id="page" class="site has-sidebar"><article><p>All of it.</p></article></div>', "All of it."),
        ('<article class="post no-comments"><p>One.</p><p>Two.</p></article>', "One.\nTwo."),
        ('<main><div class="entry share-enabled"><p>Stays.</p></div></main>', "Stays."),
        ('<article><p>A <span class="social">social</span> animal.</p></article>', "A social animal."),
        ('<article><p>Text.</p><div class="share-buttons">Tweet</div><div class="site-footer">F</div><div class="ad">Buy</div></article>', "Text."),
        ('<div class="main-nav">Menu</div><div id="cookie_banner">Cookies</div><p>Body &amp; soul</p>', "Body & soul"),
        ('<article><div class="post-header"><h1>Title</h1></div><p>x<br>y</p></article><footer>F</footer>', "Title\nx y"),
        ("<article><p>a\xa0 b\n\tc</p><script>var x = '</p>';</script></article>", "a b c"),
        ("", ""),
        ("<nav>only a menu</nav>", ""),
    ],
)
def test_structure(html, want):
    assert text(html) == want


@pytest.mark.parametrize("name", "post-comments article-comments page-comments comment-respond comment-thread comment-1 entry-share cookie-notice site-notice notice navbar-brand respond".split())
@pytest.mark.parametrize("attribute", ["class", "id"])
def test_comments_notices_and_shares_inside_an_article_go(name, attribute):
    assert text(f'<article class="post"><p>Text.</p><section {attribute}="{name}"><p>Not this.</p></section><p>More.</p></article>') == "Text.\nMore."


@pytest.mark.parametrize("name", ["article-sidebar", "post-footer", "page-sidebar"])
def test_furniture_goes_whatever_owner_its_name_has(name):
    assert text(f'<p>Text.</p><div class="{name}"><p>Not this.</p></div>') == "Text."


@pytest.mark.parametrize("name", ["page-with-sidebar", "has-comments", "no-sidebar", "is-sponsored", "post-without-comments"])
def test_states_stay(name):
    assert text(f'<div class="{name}"><p>Text.</p></div>') == "Text."


def covered_by_hand(pages, run, least):
    """Tokens of each (host, tokens) page that no window of `run` tokens on `least` distinct pages of its host covers."""
    seen = {}
    for host, tokens in pages:
        for i in range(len(tokens) - run + 1):
            seen.setdefault((host, *tokens[i : i + run]), set()).add(tuple(tokens))
    out = []
    for host, tokens in pages:
        free = [True] * len(tokens)
        for i in range(len(tokens) - run + 1):
            if len(seen[(host, *tokens[i : i + run])]) >= least:
                free[i : i + run] = [False] * run
        left = [t for t, f in zip(tokens, free) if f]
        out.append(" ".join(left or tokens))
    return out


def test_suffix_array_against_all_windows(spark):
    rng = random.Random(3)
    parts = [[rng.choice("abcdefg") + str(rng.randrange(5)) for _ in range(rng.randrange(3, 14))] for _ in range(12)]
    pages = []
    for k in range(90):
        own = [f"u{k}x{i}" for i in range(rng.randrange(0, 20))]
        tokens = [*rng.choice(parts), *own, *rng.choice(parts), *rng.choice(parts)]
        pages.append((f"h{min(k % 5, 2)}.example", tokens))  # one host has most of the pages
    pages += [pages[0], pages[0], ("h9", ["lone"])]
    rows = [(i, f"http://{h}/{i}", f"<div>{' '.join(t)}</div>", "x", 1) for i, (h, t) in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, row int")
    got = {r["page_id"]: r["text"] for r in html_text.main_text(df, run=4).collect()}
    assert [got[i] for i in range(len(pages))] == covered_by_hand(pages, 4, html_text.PAGES)
    assert sum(len(got[i].split()) < len(t) for i, (_, t) in enumerate(pages)) > 20


def test_null_ids_repeated_rows_empty_tables_long_pages(spark):
    long = "<article><p>" + "word " * 300_000 + "</p></article>"
    rows = [(None, None, "<p>x</p>"), (None, None, "<p>x</p>"), (7, "http://h/", long), (8, "http://h/", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r["page_id"] or 0, r["n_chars"]) for r in html_text.main_text(df).collect())
    assert got == [(0, 1), (0, 1), (7, 300_000 * 5 - 1), (8, 0)]
    assert html_text.main_text(df.limit(0)).count() == 0


def test_articles_lose_what_also_stands_outside_of_them(spark):
    notice = "all rights reserved please ask before you reprint this text"  # in two articles and outside one
    shared = "the club plays its home games in the old stadium"  # in four articles and nowhere else
    teaser = "a storm took the roof of the old town hall"  # of one article, shown beside three others
    own = [f"story {i} has words of its own number {i}" for i in range(6)]
    page = lambda i, inside="", outside="": f"<article><p>{own[i]}</p><p>{inside}</p></article><div>{outside}</div>"
    html = [page(0, notice), page(1, notice), page(2, shared, notice), *[page(i, shared, f"{teaser} {i}") for i in (3, 4, 5)], f"<article><p>{teaser}</p></article>"]
    df = spark.createDataFrame([(i, f"http://h.example/{i}", h) for i, h in enumerate(html)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.main_text(df).collect()}
    assert [got[i] for i in range(7)] == [own[0], own[1], *[f"{own[i]}\n{shared}" for i in (2, 3, 4, 5)], teaser]
