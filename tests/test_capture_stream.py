"""The capture stream: equal to the batch, restarts without a second row, stops at a number, forgets after a time."""

import json
import time

import pytest

from threadmill.operators.relational import first_by_key
from threadmill.streaming import capture


def frame(seq, uri):
    op = {"action": "create", "path": f"app.bsky.feed.post/{uri}", "cid": f"c{seq}", "record": {"text": f"t{seq}"}}
    return json.dumps({"t": "#commit", "seq": seq, "time": "2024-01-01", "repo": "did:1", "ops": [op]})


@pytest.fixture
def folder(tmp_path):
    """Three files, of which a trigger takes one: uris repeat within and over files."""
    (tmp_path / "in").mkdir()
    seq = 0
    for f in range(3):
        lines = []
        for i in range(20):
            seq += 1
            lines.append(frame(seq, (i * 7 + f * 5) % 23))
        path = tmp_path / "in" / f"{f}.jsonl"
        path.write_text("\n".join(reversed(lines)) + "\nnot json\n")
        import os

        os.utime(path, (1_700_000_000 + f, 1_700_000_000 + f))
    return tmp_path


def run(spark, folder, target=None, ttl=None, name="a", files=1):
    posts = capture.posts_of(capture.frame_stream(spark, str(folder / "in"), files), "cap_1")
    first = capture.first_per_key(posts, "uri", ["seq"], ttl)
    n = capture.collect_until(first, str(folder / name / "out"), str(folder / name / "checkpoint"), target, ["seq"])
    return n, sorted(map(tuple, capture.collected(spark, str(folder / name / "out")).select("uri", "seq", "record").collect()))


def wanted(spark, folder):
    posts = capture.posts_of(spark.read.text(str(folder / "in")), "cap_1")
    return sorted(map(tuple, first_by_key(posts, ["uri"], ["seq"]).select("uri", "seq", "record").collect()))


def test_triggers_equal_the_batch_and_restarts_add_nothing(spark, folder):
    want = wanted(spark, folder)
    n, got = run(spark, folder)
    assert n == len(want) == 23 and got == want
    assert run(spark, folder) == (n, got)
    (folder / "in" / "later.jsonl").write_text(frame(900, 1) + "\n" + frame(901, "new") + "\n")
    n, again = run(spark, folder)
    assert n == 24 and set(again) - set(got) == {("at://did:1/app.bsky.feed.post/new", 901, '{"text":"t901"}')}


def test_stops_at_the_target(spark, folder):
    want = sorted(wanted(spark, folder), key=lambda r: r[1])[:21]
    n, got = run(spark, folder, target=21)
    assert n == 21 and sorted(got, key=lambda r: r[1]) == want
    assert run(spark, folder, target=21) == (21, got)


def test_a_key_is_forgotten_after_its_time(spark, folder):
    n, _ = run(spark, folder, ttl=1, name="b")
    (folder / "in" / "later.jsonl").write_text(frame(900, 1) + "\n")
    time.sleep(0.1)
    assert run(spark, folder, ttl=1, name="b")[0] == n + 1


def test_without_a_time_to_live_no_row_goes_through_python(spark, folder):
    posts = capture.posts_of(capture.frame_stream(spark, str(folder / "in"), 1), "cap_1")
    plan = capture.first_per_key(posts, "uri", ["seq"])._jdf.queryExecution().analyzed().toString()
    assert "Python" not in plan and "TransformWithState" not in plan
