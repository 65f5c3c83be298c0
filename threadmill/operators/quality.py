"""Profiles, checks and summaries. Each is one or two aggregates; none collects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from threadmill.operators.relational import quantiles


def describe(df: DataFrame, column: str) -> DataFrame:
    p = quantiles(df, column, [0.5, 0.9, 0.95, 0.99])
    c = F.col(column)
    one = df.agg(F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).alias("min"), F.max(c).alias("max"))
    return one.crossJoin(F.broadcast(p)).select("n", "mean", "std", "min", *[F.col("q")[i].alias(n) for i, n in enumerate(("p50", "p90", "p95", "p99"))], "max")


def iqr_outliers(df: DataFrame, column: str) -> DataFrame:
    """Bounds 1.5 interquartile ranges beyond the quartiles, and the rows outside."""
    q = quantiles(df, column, [0.25, 0.75])
    reach = 1.5 * (F.col("q")[1] - F.col("q")[0])
    bounds = q.select((F.col("q")[0] - reach).alias("lower_bound"), (F.col("q")[1] + reach).alias("upper_bound"))
    out = (F.col(column) < F.col("lower_bound")) | (F.col(column) > F.col("upper_bound"))
    return df.crossJoin(F.broadcast(bounds)).groupBy("lower_bound", "upper_bound").agg(F.count_if(out).alias("outliers"), (F.count_if(out) / F.count(F.lit(1))).alias("outlier_ratio"))


def missingness(df: DataFrame) -> DataFrame:
    """A row per column with its null and blank values, from one pass."""
    blank = lambda c: F.count_if(F.trim(F.col(c).cast("string")) == "")
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[x for c in df.columns for x in (F.count_if(F.col(c).isNull()).alias(f"null:{c}"), blank(c).alias(f"blank:{c}"))])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`null:{c}`").alias("nulls"), F.col(f"`blank:{c}`").alias("blanks"), F.col("_n").alias("n")) for c in df.columns])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def case_collisions(df: DataFrame, column: str) -> DataFrame:
    """Texts that only differ in case, counted by their digests, so whole texts aren't shuffled."""
    digest = lambda c: F.sha2(c, 256)
    groups = df.groupBy(digest(F.lower(column)).alias("k")).agg(F.countDistinct(digest(F.col(column))).alias("variants"))
    return groups.agg(F.count_if(F.col("variants") > 1).alias("collisions"))


def temporal_coverage(df: DataFrame, day: Column, sparse: tuple[int, ...] = (50, 100)) -> DataFrame:
    """First and last day, days with rows, days of the range without, and days with few rows."""
    daily = df.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n")).where("day is not null")
    span = F.datediff(F.max("day"), F.min("day")) + 1
    return daily.agg(
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        F.count(F.lit(1)).alias("days"),
        (span - F.count(F.lit(1))).cast("long").alias("missing_days"),
        *[F.count_if(F.col("n") < s).alias(f"days_under_{s}") for s in sparse],
    )


def missing_days(df: DataFrame, day: Column) -> DataFrame:
    seen = df.select(day.alias("day")).where("day is not null").distinct()
    span = seen.agg(F.sequence(F.min("day"), F.max("day")).alias("d")).select(F.explode("d").alias("day"))
    return span.join(seen, "day", "left_anti")


def duplicate_impact(df: DataFrame, keys: list[str], raw: str, day: str) -> DataFrame:
    """Duplicates by day and text before and after normalising: a row per group of normalised keys that more than one raw form falls into, and a row `level` all.

    `duplicates_before` and `duplicates_after` are the rows that repeat an earlier (day, raw) or (day, keys); a group's keys are functions of its raw
    forms, so both are sums over groups. A null raw form is no variant, but repeats count. In the row of all, the keys are null and `variants`
    and `n` are those of all groups.
    """
    forms = F.countDistinct(raw)
    groups = df.groupBy(day, *keys).agg(forms.alias("variants"), F.count(F.lit(1)).alias("n"), F.count_if(F.col(raw).isNull()).alias("_nulls"))
    groups = groups.select(day, *keys, "variants", "n", (F.col("n") - F.col("variants") - (F.col("_nulls") > 0).cast("long")).alias("duplicates_before"), (F.col("n") - 1).alias("duplicates_after"))
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("variants", "n", "duplicates_before", "duplicates_after")]
    total = groups.agg(*sums).withColumn("level", F.lit("all"))
    return groups.where("variants > 1").withColumn("level", F.lit("group")).unionByName(total, allowMissingColumns=True)


def text_noise(df: DataFrame, column: str) -> DataFrame:
    """Counts of rows by what their text holds."""
    c = F.col(column)
    tests = {"hash": "#", "ampersand": "&", "apostrophe": "'", "hyphen": "-", "comma": ",", "period": r"\.", "digit": "[0-9]", "dollar": r"\$", "non_ascii": r"[^\x00-\x7F]", "multi_word": r"\S\s+\S"}
    return df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c.rlike(p)).alias(f"with_{k}") for k, p in tests.items()])


def parity(left: DataFrame, right: DataFrame, family: str, key: str) -> DataFrame:
    """Rows and distinct keys of two copies per family, and whether they agree."""
    count = lambda df, side: df.groupBy(family).agg(F.count(F.lit(1)).alias(f"{side}_rows"), F.countDistinct(key).alias(f"{side}_keys"))
    both = count(left, "local").join(count(right, "landing"), family, "full")
    same = F.col("local_rows").eqNullSafe(F.col("landing_rows")) & F.col("local_keys").eqNullSafe(F.col("landing_keys"))
    return both.withColumn("agrees", same)


def confusion(df: DataFrame, true: str, predicted: str) -> DataFrame:
    return df.groupBy(true, predicted).agg(F.count(F.lit(1)).alias("n"))


def class_metrics(df: DataFrame, true: str, predicted: str) -> DataFrame:
    """Accuracy, macro precision, recall and F1 (classes of either column; 0 where undefined)."""
    cells = confusion(df, true, predicted)
    by_true = cells.groupBy(F.col(true).alias("c")).agg(F.sum("n").alias("support"))
    by_pred = cells.groupBy(F.col(predicted).alias("c")).agg(F.sum("n").alias("named"))
    right = cells.where(F.col(true) == F.col(predicted)).select(F.col(true).alias("c"), F.col("n").alias("hits"))
    each = by_true.join(by_pred, "c", "full").join(right, "c", "left").na.fill(0)
    p = F.when(F.col("named") > 0, F.col("hits") / F.col("named")).otherwise(0.0)
    r = F.when(F.col("support") > 0, F.col("hits") / F.col("support")).otherwise(0.0)
    f1 = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0)
    return each.agg((F.sum("hits") / F.sum("support")).alias("accuracy"), F.avg(p).alias("macro_precision"), F.avg(r).alias("balanced_accuracy"), F.avg(f1).alias("macro_f1"))


def required_fields(rows: DataFrame, line: str, required: list[str]) -> DataFrame:
    """Per required field, the JSON rows that lack it (a null value is there) and those where it is null."""
    keys = F.json_object_keys(line)
    tests = [
        F.struct(
            F.lit(f).alias("field"),
            F.count_if(~F.coalesce(F.array_contains(keys, f), F.lit(False))).alias("missing"),
            F.count_if(F.coalesce(F.array_contains(keys, f), F.lit(False)) & F.get_json_object(line, f"$.{f}").isNull()).alias("nulls"),
        )
        for f in required
    ]
    one = rows.agg(*[t.alias(f"f{i}") for i, t in enumerate(tests)])
    return one.select(F.explode(F.array(*[f"f{i}" for i in range(len(tests))])).alias("r")).select("r.*")
