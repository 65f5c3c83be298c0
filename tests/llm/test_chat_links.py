"""Quotation linking on made conversations, against a plain linker that compares texts themselves."""

import random
import re

from threadmill.llm import chat

MARK = re.compile(r"^[ \t]*>[ \t>]*")


def normal(text):
    return " ".join(re.sub(r"[\W_]+", " ", text.lower()).split())


def made(rng, convs=25):
    """Conversations whose messages quote earlier ones at one to three levels, in whole or by a line, or quote nothing that was written."""
    rows, truth = [], {}
    vocab = [f"word{i}" for i in range(60)]
    for conv in range(convs):
        said = []
        for turn in range(rng.randrange(1, 12)):
            own = "\n".join(" ".join(rng.choices(vocab, k=rng.randrange(1, 7))).capitalize() + "." for _ in range(rng.randrange(1, 4)))
            text = own
            if said and rng.random() < 0.7:
                first = rng.randrange(len(said))
                quote = said[first].split("\n")
                if rng.random() < 0.4:
                    quote = [rng.choice(quote)]
                lines = [f"> {x}" for x in quote]
                if first and rng.random() < 0.5:
                    lines = [f"> > {x.upper()}" for x in said[rng.randrange(first)].split("\n")] + [">"] + lines
                if rng.random() < 0.1:
                    lines = ["> nobody ever wrote this line"]
                intro = ["Somebody wrote:"] if rng.random() < 0.5 else []
                text = "\n".join(intro + lines + own.split("\n"))
            said.append(own)
            truth[conv, turn] = own
            rows.append((conv, turn, "user", text))
    return rows, truth


def linked_by_hand(rows):
    """(conv, turn) -> parent: the earlier message whose own text holds most of what is quoted, first at the outermost level."""
    own, parsed = {}, {}
    for conv, turn, _, text in rows:
        lines = text.split("\n")
        keep = [x for i, x in enumerate(lines) if not MARK.match(x) and not (x == "Somebody wrote:" and i + 1 < len(lines) and MARK.match(lines[i + 1]))]
        own[conv, turn] = "\n".join(keep)
        marked = [(len(re.sub("[^>]", "", (MARK.match(x) or [""])[0])), normal(MARK.sub("", x))) for x in lines]
        parsed[conv, turn] = [(n, x) for n, x in marked if n == 0 or x]
    parents = {}
    for (conv, turn), lines in parsed.items():
        runs = []
        for level, body in lines:
            if runs and runs[-1][0] == level:
                runs[-1][1].append(body)
            else:
                runs.append((level, [body]))
        units = [(level, " ".join(x)) for level, x in runs if level] + [(n, x) for n, x in lines if n]
        held = {}
        for level, body in units:
            for t in range(turn):
                texts = [normal(own[conv, t])] + [normal(x) for x in own[conv, t].split("\n")]
                if body in texts:
                    held[level, t] = held.get((level, t), 0) + len(body)
                    break
        if held:
            parents[conv, turn] = min(held, key=lambda k: (k[0], -held[k], k[1]))[1]
    return parents


def test_links_and_threads(spark):
    rng = random.Random(11)
    rows, truth = made(rng)
    parents = linked_by_hand(rows)
    assert len(parents) > 40
    got = chat.reply_order(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)).collect()
    assert {(r["conv_id"], r["turn"]): r["parent_turn"] for r in got if r["parent_turn"] is not None} == parents
    assert {(r["conv_id"], r["turn"]): r["body"] for r in got} == truth

    def root(conv, turn):
        return root(conv, parents[conv, turn]) if (conv, turn) in parents else turn

    assert all(r["thread"] == root(r["conv_id"], r["turn"]) for r in got)
    assert [(r["conv_id"], r["thread"], r["turn"]) for r in got] == sorted((r["conv_id"], r["thread"], r["turn"]) for r in got)


def test_empty_tables_long_texts_and_other_columns(spark):
    rows = [(1, 0, "u", "A line that is long enough. " * 20_000, 5), (1, 1, "u", "> A line that is long enough.\n" + "x " * 100_000, 5)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, thread int")
    assert chat.reply_order(df).count() == 2 and chat.reply_order(df.limit(0)).count() == 0


def test_short_lines_and_ids_of_any_type(spark):
    rows = [("x-1", "0", "u", "OK then\nlet us meet"), ("x-1", "1", "v", "> OK then\nfine"), ("y", "0", "u", "OK then"), (None, "z", "u", "> OK then"), ("x-1", None, "u", "> OK then")]
    got = chat.reply_order(spark.createDataFrame(rows, "conv_id string, turn string, role string, text string")).collect()
    assert len(got) == 5 and [(r["conv_id"], r["turn"], r["parent_turn"]) for r in got if r["parent_turn"] is not None] == [("x-1", 1, 0)]
