"""Counters of the capture stream: over triggers and restarts they are those of all frames."""

import json
import os

from threadmill.streaming import capture, counters


def frame(seq, uri, **more):
    op = {"action": "create", "path": f"app.bsky.feed.post/{uri}", "cid": f"c{seq}", "record": {"text": "t"}}
    return json.dumps({"t": "#commit", "seq": seq, "time": "2024-01-01", "repo": "did:1", "ops": [op]} | more)


def put(folder, number, lines):
    folder.mkdir(exist_ok=True)
    path = folder / f"{number}.jsonl"
    path.write_text("\n".join(lines) + "\n")
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def run(spark, at):
    with counters.counting(spark, str(at / "counters")):
        capture.collect_until(counters.counted_posts(capture.frame_stream(spark, str(at / "in"), 1), "cap_1"), str(at / "out"), str(at / "checkpoint"))
    return {r["counter"]: r["n"] for r in counters.counters(spark, str(at / "counters")).collect()}


def test_counters_go_on_over_triggers_and_restarts(spark, tmp_path):
    assert counters.counters(spark, str(tmp_path / "counters")).collect() == []
    put(tmp_path / "in", 1, [frame(1, "a"), frame(2, "a"), frame(3, "b"), "", "not json", "[1]"])
    put(tmp_path / "in", 2, [frame(4, "b"), frame(5, "c"), frame(6, "d", repo=None), frame(7, "e", ops={}), frame(8, "f", t="#info")])
    want = {"frames": 11, "blank_lines": 1, "decode_errors": 2, "commits": 7, "extract_errors": 2, "creates": 5, "unique_posts": 3, "duplicates": 2}
    assert run(spark, tmp_path) == want
    assert run(spark, tmp_path) == want
    put(tmp_path / "in", 3, [frame(9, "c"), frame(10, "z"), "{"])
    assert run(spark, tmp_path) == want | {"frames": 14, "decode_errors": 3, "commits": 9, "creates": 7, "unique_posts": 4, "duplicates": 3}
