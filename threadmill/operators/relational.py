"""Deduplication, joins and rankings that the datasets are built from."""

from __future__ import annotations

from functools import reduce
from math import ceil, floor, isnan

from pyspark.sql import Column, DataFrame, Window, functions as F


def require_columns(df: DataFrame, columns: list[str], name: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{name} lacks columns: {', '.join(missing)}")


def one_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given (total) order; Spark keeps only that row per key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def latest_by_key(df: DataFrame, keys: list[str], newest: list[str]) -> DataFrame:
    """Latest load per key: every column of `newest` descending, nulls first (as the warehouse sorts them)."""
    return one_per_key(df, keys, [F.col(c).desc_nulls_first() for c in newest])


def first_by_key(df: DataFrame, keys: list[str], position: list[str]) -> DataFrame:
    """First seen per key, in file order."""
    return one_per_key(df, keys, [F.col(c).asc() for c in position])


def freshest_by_key(df: DataFrame, keys: list[str], times: list[str]) -> DataFrame:
    """Row with the greatest times per key, nulls last."""
    return one_per_key(df, keys, [F.col(c).desc_nulls_last() for c in times])


def null_safe_total(columns: list[str]) -> Column:
    total = F.lit(0)
    for c in columns:
        total = total + F.coalesce(F.col(c), F.lit(0))
    return total


def curated(raw: DataFrame, hydrated: DataFrame, actors: DataFrame, key: str, fallback: str, actor: str) -> DataFrame:
    """raw left join hydrated on key, left join actors on coalesce(hydrated's actor, raw's fallback)."""
    joined = raw.join(hydrated, key, "left").withColumn("join_actor", F.coalesce(F.col(actor), F.col(fallback)))
    return joined.join(actors, joined["join_actor"] == actors["actor_key"], "left").drop("actor_key")


def left_with_hit(left: DataFrame, right: DataFrame, keys: list[str], hit: str, spread: str | None = None) -> DataFrame:
    """Left join that marks rows that found a partner. Rows with a null key find none; where there may be many, `spread` is a column of theirs that deals them out, else they are one task's."""
    marked = right.withColumn(hit, F.lit(True))
    if spread is not None:
        missing = F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))
        left, marked = left.withColumn("_spread", F.when(missing, F.xxhash64(spread)).otherwise(F.lit(0).cast("long"))), marked.withColumn("_spread", F.xxhash64(*keys) % 1)  # 0, but no constant, which Spark would take out of the join's keys
        keys = [*keys, "_spread"]
    return left.join(marked, keys, "left").withColumn(hit, F.coalesce(F.col(hit), F.lit(False))).drop("_spread")


def coverage(df: DataFrame, hits: list[str]) -> DataFrame:
    """One row: rows, and per marked join the number and share of rows that found a partner."""
    n = F.count(F.lit(1))
    many = [c for h in hits for c in (F.count_if(F.col(h)).alias(f"{h}_both"), (n - F.count_if(F.col(h))).alias(f"{h}_left_only"))]
    return df.agg(n.alias("rows"), *many)


def top_counts(df: DataFrame, column: str, k: int) -> DataFrame:
    return df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col("value").asc_nulls_last()).limit(k)


def numbered(df: DataFrame, key: str, parts: int = 200, name: str = "surrogate_id") -> DataFrame:
    """df with each row's place in order of a distinct numeric key, from 0: keys are cut into ranges at approximate quantiles, and a row's place in its range is added to the rows before it."""
    cuts = df.agg(F.percentile_approx(key, F.array(*[F.lit(i / parts) for i in range(1, parts)])).alias("q")).first()["q"] or []  # `parts` numbers
    cuts = sorted(set(cuts))
    part = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda q: q < F.col(key))) if cuts else F.lit(0)
    dealt = df.withColumn("_part", part)
    sizes = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_part").orderBy(key)) - 1
    return dealt.withColumn("_rank", rank).join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_rank")).drop("_part", "_rank", "_before")


#: Bits of a double's fraction, the offset of its exponent, its least normal magnitude, and the factor whose square makes the magnitudes below that whole numbers.
FRACTION, OFFSET, LEAST_NORMAL, HALF_SCALE = 52, 1023, 2.0**-1022, 2.0**537
#: Bits of an ordered image that one pass of `quantiles` settles.
DIGIT = 16


def with_image(df: DataFrame, value: str, name: str) -> DataFrame:
    """df with a double's 64 bits as a long that sorts as the double does: both zeros are 0, NaN comes after infinity, null stays null."""
    v, a, near, e, power = F.col(value), F.col("_a"), F.col("_near"), F.col("_e"), F.col("_power")
    # A logarithm may be one off beside a power of two. Each step is a column, so that none is worked out twice.
    steps = df.withColumn("_a", F.abs(v)).withColumn("_near", F.least(F.floor(F.log2(a)).cast("double"), F.lit(float(OFFSET)))).withColumn("_power", F.pow(F.lit(2.0), near))
    steps = steps.withColumn("_e", F.when(a < power, near - 1).when(a - power >= power, near + 1).otherwise(near))
    steps = steps.withColumn("_power", F.when(e < near, power / 2).when(e > near, power * 2).otherwise(power))
    normal = (e + OFFSET).cast("long") * F.lit(1 << FRACTION) + ((a / power - 1) * float(1 << FRACTION)).cast("long")
    top = 2047 << FRACTION
    bits = F.when(F.isnan(v), top + 1).when(a == float("inf"), top).when(a < LEAST_NORMAL, (a * HALF_SCALE * HALF_SCALE).cast("long")).otherwise(normal)
    return steps.withColumn("_bits", bits).withColumn(name, F.when(v.isNotNull(), F.when(v < 0, -F.col("_bits")).otherwise(F.col("_bits")))).drop("_a", "_near", "_e", "_power", "_bits")


def quantiles(df: DataFrame, column: str, shares: list[float]) -> DataFrame:
    """One row with `q`, the exact quantiles of a numeric column (between two values in proportion, nulls left out; nulls for a column without values).

    Selection by histograms. Values have longs of the same order, of which a pass settles 16 bits: it counts the rows by their next digit, with each digit's
    least and greatest value, and every wanted place goes on into the digit that it falls in, until a digit holds one value; that takes four passes at most,
    and the later ones read only what lies between those two values, a filter that reaches the scan. Rows are counted before the shuffle already, a task puts in
    order 65,536 counts at most, and the driver gets a row per place, two a share, whatever the rows, ties and skew.
    """
    some = df.select(F.col(column).cast("double").alias("v")).where("v is not null")
    n, end = F.col("n"), F.col("end")
    holds = lambda rank: (end > rank) & (end - n <= rank)

    def counted(rows: DataFrame, shift: int) -> DataFrame:
        digits = with_image(rows, "v", "k").groupBy(F.shiftright("k", shift).alias("g"))
        each = digits.agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        # The first digits, which have a sign, are one sequence.
        up = F.lit(0) if shift + DIGIT == 64 else F.shiftright("g", DIGIT)
        return each.withColumn("up", up).withColumn("end", F.sum("n").over(Window.partitionBy("up").orderBy("g")))

    shift = 64 - DIGIT
    place = [F.lit(float(p)) * (F.col("total") - 1) for p in shares]
    first = counted(some, shift).withColumn("total", F.sum("n").over(Window.partitionBy("up")))
    rows = first.where(reduce(Column.__or__, [holds(f(x)) for x in place for f in (F.floor, F.ceil)])).collect()  # two a share at most
    spots = [p * (rows[0]["total"] - 1) for p in shares] if rows else []
    found = {rank: (rank, next(r for r in rows if r["end"] - r["n"] <= rank < r["end"])) for x in spots for rank in (floor(x), ceil(x))}
    while True:
        inside = {rank: (at - r["end"] + r["n"], r) for rank, (at, r) in found.items() if not (r["low"] == r["high"] or isnan(r["low"]))}
        if not inside:
            break
        shift -= DIGIT
        own = some.where(reduce(Column.__or__, [F.col("v").between(low, high) for low, high in {(r["low"], r["high"]) for _, r in inside.values()}]))
        wanted = [(F.col("up") == r["g"]) & holds(F.lit(at)) for at, r in inside.values()]
        rows = counted(own, shift).where(reduce(Column.__or__, wanted)).collect()  # a row per place at most
        found |= {rank: (at, next(x for x in rows if x["up"] == r["g"] and x["end"] - x["n"] <= at < x["end"])) for rank, (at, r) in inside.items()}

    def between(x: float) -> float:
        lo, hi = found[floor(x)][1]["low"], found[ceil(x)][1]["low"]
        return lo if lo == hi else (ceil(x) - x) * lo + (x - floor(x)) * hi

    q = [between(x) for x in spots] or [None] * len(shares)
    return df.sparkSession.range(0, 1, 1, 1).select(F.array(*[F.lit(x).cast("double") for x in q]).alias("q"))


def places(df: DataFrame, group: str, digest: Column, key: str) -> DataFrame:
    """df with `_rank`, each row's place (from 1) in its group by a hexadecimal digest and then key, and `_n`, the group's rows.

    A group is cut by its digests' first three digits, 4096 even parts in order, and a row's place in its part is added to the rows of the parts before
    it: a group of any size is shared among tasks. Null is a group.
    """
    dealt = df.withColumn("_digest", digest).withColumn("_part", F.substring("_digest", 1, 3))
    sizes = dealt.groupBy(F.col(group).alias("_group"), F.col("_part").alias("_own")).agg(F.count(F.lit(1)).alias("_size"))
    upto = Window.partitionBy("_group").orderBy("_own").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_group", "_own", F.coalesce(F.sum("_size").over(upto), F.lit(0)).alias("_before"), F.sum("_size").over(Window.partitionBy("_group")).alias("_n"))
    within = F.row_number().over(Window.partitionBy(group, "_part").orderBy("_digest", key))
    joined = dealt.withColumn("_within", within).join(before, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_own")))
    return joined.withColumn("_rank", F.col("_before") + F.col("_within")).select(*df.columns, "_rank", "_n")
