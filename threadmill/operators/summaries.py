"""Summaries of candidates, matches, trends, datasets and files, mostly as rows (measure, key, value)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from threadmill.functions import text as T
from threadmill.sources.tables import stored


def measures(df: DataFrame, named: dict[str, Column]) -> DataFrame:
    """Aggregates of one pass as rows (measure, key, value)."""
    one = df.agg(*[c.cast("double").alias(f"m{i}") for i, c in enumerate(named.values())])
    rows = F.array(*[F.struct(F.lit(name).alias("measure"), F.lit("").alias("key"), F.col(f"m{i}").alias("value")) for i, name in enumerate(named)])
    return one.select(F.explode(rows).alias("s")).select("s.*")


def counts(df: DataFrame, measure: str, key: Column, most: int | None = None) -> DataFrame:
    """Rows per value, as rows (measure, key, value); with `most`, the largest ones, ties by value."""
    out = df.groupBy(key.cast("string").alias("key")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    out = out if most is None else out.orderBy(F.col("value").desc(), F.col("key").asc_nulls_last()).limit(most)
    return out.select(F.lit(measure).alias("measure"), "key", "value")


def together(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def candidate_summary(posts: DataFrame, candidates: DataFrame, top: int = 20) -> DataFrame:
    """Posts with and without candidates, candidates a post, sources, token counts and the `top` phrases."""
    per_post = candidates.groupBy("uri").agg(F.count(F.lit(1)).alias("n"))
    sizes = posts.agg(F.count(F.lit(1)).alias("posts")).crossJoin(per_post.agg(F.count(F.lit(1)).alias("held"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")))
    mean = lambda n: F.coalesce(F.max(F.when(F.col(n) > 0, F.col("rows") / F.col(n))), F.lit(0.0))
    whole = measures(
        sizes,
        {
            "total_posts": F.max("posts"),
            "posts_with_candidates": F.max("held"),
            "posts_without_candidates": F.max(F.col("posts") - F.col("held")),
            "total_candidate_rows": F.max("rows"),
            "avg_candidates_per_post": mean("posts"),
            "avg_candidates_per_post_with_candidates": mean("held"),
        },
    )
    return together(whole, counts(candidates, "source_type", F.col("candidate_source_type")), counts(candidates, "token_count", F.col("candidate_token_count")), counts(candidates, "top_phrase", F.col("candidate_phrase_alnum"), top))


def match_summary(matches: DataFrame, per_candidate: DataFrame, per_post: DataFrame, top: int = 20) -> DataFrame:
    """Stages by candidate, post and row, matched and ambiguous shares, pool modes, and each stage's `top` trends."""
    share = lambda part, n: F.when(n > 0, part / n).otherwise(0.0)
    n, hits = F.count(F.lit(1)), F.count_if(F.col("is_matched"))
    posts = measures(per_post, {"unique_posts": n, "post_matched_rate": share(hits, n)})
    odd = F.count_if(F.col("is_ambiguous"))
    people = measures(per_candidate, {"unique_candidates": n, "ambiguous_candidates": odd, "ambiguous_candidate_rate": share(odd, n)})
    tops = [counts(matches.where((F.col("stage") == s) & F.col("name").isNotNull()), f"top_{s}_trend", F.col("name"), top) for s in ("exact", "fuzzy", "semantic")]
    return together(
        measures(matches, {"candidate_rows": n}), posts, people, counts(per_candidate, "candidate_stage", F.col("stage")), counts(per_post, "post_stage", F.col("stage")),
        counts(matches, "row_stage", F.col("stage")), counts(per_candidate, "pool_mode", F.col("mode")), *tops,
    )


def first_stages(matches: DataFrame, stages: dict[str, int]) -> DataFrame:
    """How many candidates reach each stage first."""
    order = F.create_map(*[F.lit(x) for kv in stages.items() for x in kv])
    first = matches.groupBy("candidate_id").agg(F.min_by("stage", order[F.col("stage")]).alias("stage"))
    return counts(first, "first_stage", F.col("stage"))


def trend_profile(df: DataFrame, name: str, day: str, top: int = 25) -> DataFrame:
    """Rows, names and days of a trend table, rows a day, repeated rows and names, the `top` names and hashtags."""
    names = df.groupBy(F.col(name).alias("name")).agg(F.count(F.lit(1)).alias("n"))
    days = df.groupBy(F.col(day).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    pairs = df.groupBy(day, name).agg(F.count(F.lit(1)).alias("n"))
    rows = df.groupBy(F.xxhash64(*df.columns).alias("h"), F.sha2(F.to_json(F.struct(*df.columns)), 256).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    tags = df.select(F.explode(F.regexp_extract_all(name, F.lit("#[A-Za-z0-9_]+"), F.lit(0))).alias("tag"))
    whole = measures(df, {"row_count": F.count(F.lit(1)), "hashtag_rows": F.count_if(F.col(name).contains("#"))})
    spread = {"unique_dates": F.count("day"), "rows_per_day_min": F.min("n"), "rows_per_day_max": F.max("n"), "rows_per_day_median": F.median("n"), "rows_per_day_mean": F.avg("n")}
    again = F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
    return together(
        whole, measures(days.where("day is not null"), spread), measures(names, {"unique_topics": F.count("name"), "repeated_topics_ge_2": F.count_if((F.col("n") >= 2) & F.col("name").isNotNull()), "repeated_topics_ge_10": F.count_if((F.col("n") >= 10) & F.col("name").isNotNull())}),
        measures(rows, {"duplicate_rows": again}), measures(pairs, {"duplicate_date_name_rows": again}), measures(tags.distinct(), {"unique_hashtags": F.count("tag")}),
        counts(df.where(F.col(name).isNotNull()), "top_topic", F.col(name), top), counts(tags, "top_hashtag", F.col("tag"), top),
    )


def duplicate_variants(df: DataFrame, day: str, key: str, raw: str, order: str, examples: int = 20, most: int = 8) -> DataFrame:
    """The `examples` normalised keys a day with most raw forms: day, key, variants, n, and the first `most` forms in order of `order`."""
    forms = df.where(F.col(raw).isNotNull()).groupBy(day, key, raw).agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("m"))
    groups = forms.groupBy(day, key).agg(F.count(F.lit(1)).alias("variants"), F.sum("m").alias("n")).where("variants > 1")
    top = groups.orderBy(F.col("variants").desc(), F.col("n").desc(), day, key).limit(examples)
    shown = Window.partitionBy(day, key).orderBy("first", raw)
    some = forms.join(F.broadcast(top), [day, key]).withColumn("_place", F.row_number().over(shown)).where(F.col("_place") <= most)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("_place", raw))), lambda s: s[raw])
    return some.groupBy(day, key, "variants", "n").agg(listed.alias("examples"))


def sample_agrees(full: DataFrame, sample: DataFrame, order: list[str], rows: int = 1000) -> DataFrame:
    """Whether a sample is the first `rows` rows of a table in a total order: expected and found rows, and rows that differ as text, place by place."""
    text = lambda df: F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in full.columns])
    def placed(df: DataFrame) -> DataFrame:
        # Bounded by `rows`, so one task numbers them.
        return df.orderBy(*order).limit(rows).select(F.row_number().over(Window.orderBy(*order)).alias("place"), text(df).alias("line"))

    both = placed(full).withColumnRenamed("line", "a").join(placed(sample).withColumnRenamed("line", "b"), "place", "full")
    return both.agg(F.count("a").alias("expected_rows"), F.count("b").alias("sample_rows"), F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("rows_that_differ")).withColumn("matches", F.col("rows_that_differ") == 0)


def dataset_profile(rows: DataFrame, line: str, file: str, required: list[str], spread: list[str], top: int = 10) -> DataFrame:
    """Files, rows, rows that lack a required field, lacking and null required fields, the `top` keys, and the `top` values of some fields, of JSON object rows."""
    keys = F.json_object_keys(line)
    lacks = {f: ~F.coalesce(F.array_contains(keys, f), F.lit(False)) for f in required}
    value = lambda f: F.coalesce(F.get_json_object(line, f"$.{f}"), F.lit("null"))
    named = {"files_count": F.countDistinct(file), "rows_count": F.count(F.lit(1)), "missing_required_rows": F.count_if(reduce(Column.__or__, lacks.values()))}
    named |= {f"missing:{f}": F.count_if(c) for f, c in lacks.items()} | {f"null:{f}": F.count_if(~c & F.get_json_object(line, f"$.{f}").isNull()) for f, c in lacks.items()}
    each = rows.select(F.explode(keys).alias("k"))
    return together(measures(rows, named), counts(each, "key", F.col("k"), top), *[counts(rows, f"value:{f}", value(f), top) for f in spread])


def json_kind(v: Column) -> Column:
    """What a variant holds: object, array, string, boolean, number or null."""
    held = F.schema_of_variant(v)
    named = F.when(held.startswith("OBJECT"), "object").when(held.startswith("ARRAY"), "array")
    return named.when(held == "STRING", "string").when(held == "BOOLEAN", "boolean").when(held == "VOID", "null").otherwise("number")


def nested_profile(rows: DataFrame, line: str) -> DataFrame:
    """Every path of JSON texts with the kinds of values at it: rows (path, kind, n).

    `$` is a text itself, `.name` a field (in double quotes where it isn't letters, digits and underscores), `[]` any element of an array. At `$` there are
    also `invalid` (no JSON, an empty text) and `missing` (null). One level after another is opened by a lateral join and written, with the values that have
    levels below; it ends where no such value is left. The driver learns only whether one is.
    """
    v, kind, key = F.col("v"), F.col("kind"), F.col("key")
    parsed = F.try_parse_json(F.col(f"`{line}`"))
    level = rows.select(F.lit("$").alias("path"), F.when(F.col(f"`{line}`").isNull(), "missing").when(parsed.isNull(), "invalid").otherwise(json_kind(parsed)).alias("kind"), parsed.alias("v"))
    deeper, counted = kind.isin("object", "array"), []
    name = F.when(key.isNull(), "[]").when(key.rlike("^[A-Za-z0-9_]+$"), F.concat(F.lit("."), key)).otherwise(F.concat(F.lit('."'), key, F.lit('"')))
    while True:
        held = stored(level.withColumn("v", F.when(deeper, v)), "nested-profile")
        counted.append(held.groupBy("path", "kind").agg(F.count(F.lit(1)).alias("n")))
        nested = held.where(deeper)
        if nested.isEmpty():
            return together(*counted)
        each = nested.select("path", "v").lateralJoin(rows.sparkSession.tvf.variant_explode(v.outer()))
        level = each.select(F.concat("path", name).alias("path"), json_kind(F.col("value")).alias("kind"), F.col("value").alias("v"))


def file_listing(rows: DataFrame, file: str, size: str) -> DataFrame:
    """Rows and bytes per file, and a row `(all)` for the whole."""
    each = rows.groupBy(F.col(file).alias("file")).agg(F.count(F.lit(1)).alias("rows"), F.max(size).alias("bytes"))
    return each.unionByName(each.agg(F.lit("(all)").alias("file"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes")))


def run_manifest(rows: DataFrame, families: list[str]) -> DataFrame:
    """Files, rows, bytes and run ids per dataset family of rows(family, run_id, file, file_bytes); families without files are there with zeros."""
    files = rows.groupBy("family", "run_id", "file").agg(F.count(F.lit(1)).alias("rows"), F.max("file_bytes").alias("bytes"))
    per = files.groupBy("family").agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), F.array_sort(F.collect_set("run_id")).alias("run_ids"))
    every = rows.sparkSession.createDataFrame([(f,) for f in families], "family string")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return F.broadcast(every).join(per, "family", "left").select("family", zero("files"), zero("rows"), zero("bytes"), F.coalesce("run_ids", F.array().cast("array<string>")).alias("run_ids"))


def schema_profile(df: DataFrame) -> DataFrame:
    """Rows, columns and columns per type."""
    kinds: dict[str, int] = {}
    for _, kind in df.dtypes:
        kinds[kind] = kinds.get(kind, 0) + 1
    types = df.sparkSession.createDataFrame([("columns", "", float(len(df.columns)))] + [("type", k, float(n)) for k, n in kinds.items()], "measure string, key string, value double")
    return together(measures(df, {"rows": F.count(F.lit(1))}), types)


def preflight(posts: DataFrame, key: str, captured: str, cutoff: Column, size: Column, target: int) -> DataFrame:
    """Rows, repeated keys, mature and immature rows, and the bytes that `target` rows would take."""
    groups = posts.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(captured) <= cutoff).alias("ripe"), F.sum(size).alias("bytes"))
    n = F.sum("n")
    return measures(groups, {"rows": n, "duplicate_keys": F.count_if(F.col("n") > 1), "mature": F.sum("ripe"), "immature": n - F.sum("ripe"), "bytes_per_row": F.sum("bytes") / n, "projected_bytes": F.sum("bytes") / n * target})


def wrong_pairs(df: DataFrame, true: str, predicted: str) -> DataFrame:
    """Pairs of a true and another predicted class, with their rows."""
    return df.where(~F.col(true).eqNullSafe(F.col(predicted))).groupBy(true, predicted).agg(F.count(F.lit(1)).alias("n"))


def class_table(df: DataFrame, true: str, predicted: str) -> DataFrame:
    """Per class its support, precision, recall and F1, 0 where undefined."""
    cells = df.groupBy(true, predicted).agg(F.count(F.lit(1)).alias("n"))
    sides = cells.select(F.explode(F.array(F.struct(F.col(true).alias("c"), F.col("n").alias("support"), F.lit(0).cast("long").alias("named")), F.struct(F.col(predicted).alias("c"), F.lit(0).cast("long").alias("support"), F.col("n").alias("named")))).alias("s"), F.when(F.col(true) == F.col(predicted), F.col("n")).otherwise(0).alias("hit"))
    each = sides.groupBy("s.c").agg(F.sum("s.support").alias("support"), F.sum("s.named").alias("named"), F.sum(F.when(F.col("s.support") > 0, F.col("hit")).otherwise(0)).alias("hits"))
    p, r = (F.when(F.col(n) > 0, F.col("hits") / F.col(n)).otherwise(0.0) for n in ("named", "support"))
    return each.select(F.col("c").alias("class"), "support", p.alias("precision"), r.alias("recall"), F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0).alias("f1"))


def simple_key_collisions(df: DataFrame, column: str) -> DataFrame:
    """Lexical keys that several raw forms fall into: key, forms."""
    forms = df.where(F.col(column).isNotNull()).select(F.col(column).alias("raw")).distinct()
    return forms.groupBy(T.simple_key(F.col("raw")).alias("simple_key")).agg(F.count(F.lit(1)).alias("forms")).where("forms > 1")


