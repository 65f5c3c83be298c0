"""Line rules one by one, measures against a plain count, and odd tables."""

import random
from collections import Counter

import pytest

from threadmill.llm import quality_rules as Q

PROSE = "This is a plain sentence of a clean document, which holds number {} and ends as it should."


def clean(n, start=0):
    return "\n".join("The " + " ".join(f"word{i}x{k}" for k in range(12)) + "." for i in range(start, start + n))


@pytest.mark.parametrize(
    ("line", "rule"),
    [
        ("Home | About | Products | Contact | Imprint", "navigation"),
        ("Home » Shop » Shoes » Boots", "navigation"),
        ("var x = {a: 1}; if (x > 2) { y <= 3 } ~ $z", "markup"),
        ("BUY NOW WHILE STOCKS LAST AND SAVE", "shouting"),
        ("wow!! great!! now!! here", "marks"),
        ("We use cookies to give you a better service.", "boilerplate"),
        ("© 2024 Some Company. Alle Rechte vorbehalten.", "boilerplate"),
        ("Related posts", "heading"),
        ("She said: “Come in.”", None),
        ("NASA and ESA signed the agreement in PARIS last week.", None),
        ("The price rose by 5% to $20 & stayed there for the rest of the year.", None),
        ("He did not sign in the book, which was lying open.", "boilerplate"),
        ("Kurz.", None),
    ],
)
def test_rules(line, rule):
    assert Q.failed_rule(line, len(Q._word.findall(line))) == rule


def plain_repeats(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = {w for w, n in Counter(windows).items() if n > 1}
    return len({i + k for i, w in enumerate(windows) if w in many for k in range(3)})


def test_repeated_words_against_positions():
    rng = random.Random(5)
    for _ in range(300):
        words = rng.choices("abcd", k=rng.randrange(0, 60))
        assert Q.repeated_words(words) == plain_repeats(words)


def test_documents(spark):
    menu = "\n".join(" | ".join(f"Item{i}{c}" for c in "abcdefg") for i in range(8))
    rows = [(1, clean(8)), (2, clean(8) + "\n" + "Menu"), (3, menu + "\n" + clean(4)), (4, None), (5, ""), (6, "short."), (7, "\n".join([PROSE] * 9)), (8, clean(8)), (8, clean(8)), (None, clean(8)), (9, clean(20_000))]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as kept", "2 as N_WORDS", "'x' as qr_text")
    got = Q.cleaned(df).collect()
    assert sorted((r["doc_id"] or 0, r["kept"]) for r in got) == sorted([(1, True), (2, True), (3, False), (4, False), (5, False), (6, False), (7, False), (8, True), (8, True), (0, True), (9, True)])
    by = {r["doc_id"]: r for r in got}
    assert by[2]["clean_text"] == clean(8) and by[2]["n_lost_words"] == 1
    assert by[7]["n_dup_lines"] == 8 and by[7]["base_failed"] and by[7]["n_repeat_words"] == by[7]["n_words"]
    assert by[4]["n_words"] == 0 and by[3]["base_failed"] is False and "|" not in by[3]["clean_text"]
    kept = Q.keep_good(df)
    assert kept.columns == df.columns and kept.count() == 6
    assert Q.cleaned(df.limit(0)).collect() == []


def test_white_space_is_what_the_contract_says(spark):
    text = "a b c d\te\x1cf\r\ng"
    r = Q.cleaned(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (r["n_words"], r["word_chars"]) == (4, 10)
