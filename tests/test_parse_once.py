"""Frames are parsed once, a commit is read once, and what comes out is the plain rule's."""

import json

from threadmill.plans.registry import QUERIES
from threadmill.sources import events
from threadmill.streaming import capture

DATA = "/root/testdata/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_frame_is_parsed_once_and_its_maps_are_read_once(spark):
    frames = spark.createDataFrame([("{}",)], "value string")
    for df in (QUERIES["extract_creates"](spark, DATA), events.extract(events.decode(frames)), capture.posts_of(frames, "cap_1")):
        plan = physical(df)
        assert plan.count("parseJson") == 1
        assert plan.count("MapType(StringType,VariantType,true)") == 2  # blocks and records_by_cid, in one read


def test_many_operations_and_odd_frames(spark):
    ops = [{"action": "create", "path": f"/app.bsky.feed.post/{i}/", "cid": f"c{i}"} for i in range(40)]
    ops[3]["record"], ops[4]["value"], ops[5]["record"] = {"own": 1}, {"own": 2}, [1]
    blocks = {f"c{i}": {"block": i} for i in range(30)}
    mapped = {f"c{i}": ({"mapped": i} if i % 2 else None) for i in range(20, 40)}
    rows = [json.dumps({"t": "#commit", "seq": 1, "repo": "d", "ops": [None, *ops, 5], "blocks": blocks, "records_by_cid": mapped})]
    rows += [json.dumps({"t": "#commit", "seq": 2, "ops": ops}), json.dumps({"t": "#commit", "seq": 3, "repo": "d", "ops": {}}), json.dumps({"t": "#commit", "seq": 4, "repo": "d", "blocks": 5, "ops": ops[2:6]})]
    rows += ["", "  ", None, "[1]", "no json", '{"t":"#identity","ops":[]}']
    decoded = events.decode(spark.createDataFrame([(r,) for r in rows], "value string"))
    assert sorted((r["event_type"], r["decode_error"]) for r in decoded.collect()) == [("commit", False)] * 4 + [("identity", False)] + [("unknown", True)] * 2

    def record(i):
        return {3: {"own": 1}, 4: {"own": 2}}.get(i) or blocks.get(f"c{i}") or mapped.get(f"c{i}")

    want = [(1, f"at://d/app.bsky.feed.post/{i}", record(i), None) for i in range(40) if record(i)]
    want += [(2, None, None, "commit without repo"), (3, None, None, "commit without a list of ops")] + [(4, f"at://d/app.bsky.feed.post/{i}", record(i), None) for i in (3, 4)]
    got = [(r["seq"], r["uri"], json.loads(r["record"].toJson()) if r["record"] is not None else None, r["extract_error"]) for r in events.extract(decoded).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
