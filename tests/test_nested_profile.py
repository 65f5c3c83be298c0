"""Nested profiles against a plain walk, ordered inserts, and columns of a contract on their own table."""

import json
from collections import Counter

from threadmill.operators import features, models, state, summaries


def walk(path, value, out):
    kind = {dict: "object", list: "array", str: "string", bool: "boolean", type(None): "null"}.get(type(value), "number")
    out[path, kind] += 1
    for k, x in value.items() if isinstance(value, dict) else ():
        walk(f"{path}.{k}" if k.isalnum() else f'{path}."{k}"', x, out)
    for x in value if isinstance(value, list) else ():
        walk(f"{path}[]", x, out)


def test_nested_profile_is_the_plain_walk(spark):
    deep = {"a": 1}
    for i in range(12):
        deep = {"down": [deep, i], "é": None}
    values = [deep, {}, [], [[[]], [1, "x", True]], {"a b": {"a.b": 2.5}, "x": "1"}, 5, "s", None, {"a": 10**25}, {"long": "y" * 50_000}] * 3
    lines = [json.dumps(v) for v in values] + [None, "", "{", "{'a': 1}"]
    want = Counter()
    for v in values:
        walk("$", v, want)
    # Only letters a to z, digits and underscores go without quotes.
    want = Counter({(p.replace(".é", '."é"'), k): n for (p, k), n in want.items()})
    want["$", "missing"] += 1
    want["$", "invalid"] += 3
    rows = spark.createDataFrame([(x, 1, "a") for x in lines], "line string, v int, path string").repartition(3)
    assert {(r["path"], r["kind"]): r["n"] for r in summaries.nested_profile(rows, "line").collect()} == want


def test_nested_profile_of_nothing_is_empty(spark):
    assert summaries.nested_profile(spark.createDataFrame([], "line string"), "line").collect() == []


def test_insert_takes_the_first_row_of_new_keys(spark):
    rows = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early"), ("a", None, "none"), ("b", 1, "held"), (None, 1, "lost"), ("c", 5, "only"), ("c", 5, "only")], "k string, at int, what string")
    held = spark.createDataFrame([("b", 9), (None, 3)], "k string, own int")
    for parts in (1, 3):
        got = state.insert_new(held, rows.repartition(parts), "k", ["at", "what"]).collect()
        assert sorted((r["k"], r["what"]) for r in got) == [("a", "none"), ("c", "only")]


def test_contract_columns_count_the_tables_own_nulls(spark):
    rows = spark.createDataFrame([("u", None, 1.0, None), ("w", "x", None, None)], "uri string, trend_name_clean string, same_day_trend_match double, `odd.name` int")
    got = {(r["name"], r["kind"], r["ablation"], r["nulls"]) for r in features.contract_columns(rows, models.ablation_groups).collect()}
    assert got == {
        ("uri", "debug_columns", None, 0),
        ("trend_name_clean", "debug_columns", "trend_match", 1),
        ("same_day_trend_match", "model_feature_columns", "trend_match", 1),
        ("same_day_trend_match", "model_feature_columns", "temporal", 1),
        ("odd.name", "model_feature_columns", None, 2),
    }


def test_dates_of_a_contract_without_a_match_are_empty_words(spark):
    rows = spark.sql("SELECT 1 AS uri, CAST(NULL AS DATE) AS trend_date UNION ALL SELECT 2, DATE '2024-01-02'")
    assert sorted((r["uri"], r["trend_date"]) for r in features.final_types(rows).collect()) == [(1, ""), (2, "2024-01-02")]
