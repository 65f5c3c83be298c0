"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .frames import fresh, small, text_of, written

#: What separates words: blank, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: Words of a block; a source's take differs from its target by about half a block.
BLOCK_WORDS = 8
#: Weights of the sources in order, repeating.
WEIGHTS = (1, 2, 3)
#: A source's target is at most so many times its size, and so is what a document gives.
MOST_REPEATS = 3
#: Documents of a shard, about.
SHARD_ROWS = 1000
SEED = 17


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Targets of the sources (source, source_size): the total size shared by weight, none above `most` times its size.

    Sources take the weights in turn in code-point order, null last. The excess of a source at its
    limit goes to the others by weight until none is above: with sources in order of size per weight, those
    at their limit are the leading ones, so running sums give the fixed point at once.
    """
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sources.withColumn("place", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int"))
    )
    by_limit = Window.partitionBy(F.lit(0)).orderBy(F.col("source_size") / F.col("weight"), "place")
    everything = Window.partitionBy(F.lit(0))
    levels = ranked.withColumns(
        {
            "held": F.coalesce(F.sum(most * F.col("source_size")).over(by_limit.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "open": F.sum("weight").over(by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
            "total": F.sum("source_size").over(everything),
            "at": F.row_number().over(by_limit),
        }
    ).withColumn("level", (F.col("total") - F.col("held")) / F.col("open"))
    free = most * F.col("source_size") >= F.col("level") * F.col("weight")
    first = F.min(F.when(free, F.struct("at", "level"))).over(everything)
    return levels.withColumn("first", first).select(
        "place",
        "source",
        "source_size",
        "docs",
        F.when(F.col("at") < F.col("first.at"), (most * F.col("source_size")).cast("double"))
        .otherwise(F.col("first.level") * F.col("weight"))
        .alias("target"),
    )


def apportion(shares: DataFrame, group: str, member: str, share: str, seats: str) -> DataFrame:
    """Sainte-Laguë: the `seats` of each group dealt to its members by the highest quotients share / (2k + 1).

    A divisor rounds every share to the nearest integer. With n members and s seats it lies between
    sum / (s + n/2) and sum / (s - n/2), which bounds each member's seats from below and above; only the
    quotients between those bounds, about two a member, are ranked. Ties go to the smaller member.
    Adds column `quota`; a group whose shares are all zero gets none.
    """
    by_group = Window.partitionBy(group)
    unit = F.when(F.col("ap_sum") > 0, F.col(share) / F.col("ap_sum")).otherwise(F.lit(0.0))
    half = F.col("ap_n") / 2.0
    bounds = (
        shares.withColumns({"ap_sum": F.sum(share).over(by_group), "ap_n": F.count(F.lit(1)).over(by_group)})
        .withColumns(
            {
                "ap_low": F.greatest(F.lit(0), F.floor(unit * (F.col(seats) - half) + 0.5) - 1).cast("long"),
                "ap_high": F.greatest(F.lit(0), F.floor(unit * (F.col(seats) + half) + 0.5) + 1).cast("long"),
            }
        )
        .withColumn("ap_left", F.col(seats) - F.sum("ap_low").over(by_group))
    )
    ranked = Window.partitionBy(group).orderBy(F.col("ap_q").desc(), member, "ap_k")
    return (
        bounds.withColumn("ap_k", F.explode(F.sequence(F.col("ap_low"), F.greatest("ap_low", F.col("ap_high") - 1))))
        .withColumn("ap_q", F.when(F.col("ap_k") < F.col("ap_high"), F.col(share) / (2 * F.col("ap_k") + 1)).otherwise(F.lit(0.0)))
        .withColumn("ap_won", ((F.row_number().over(ranked) <= F.col("ap_left")) & (F.col("ap_q") > 0)).cast("long"))
        .groupBy(*shares.columns, "ap_low")
        .agg(F.sum("ap_won").alias("ap_won"))
        .select(*shares.columns, (F.col("ap_low") + F.col("ap_won")).alias("quota"))
    )


def seed_key(ident: Column, seed: int = SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit(""))))


def mix(
    df: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    size_col: str = "size",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_REPEATS,
    block: int = BLOCK_WORDS,
    shard_rows: int = SHARD_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """Rows of df with source_size, target, copies, part and taken added: what a mix at target weights takes of each.

    The mix has as many blocks of `block` words as there are words in all. Sainte-Laguë apportionment
    deals them to the sources by target, then a source's blocks to its shards by size. A shard
    (documents of one source by seeded digest, about `shard_rows`) lays its documents end to end in seeded
    order, gives all of it as often as its quota holds that, then the blocks that lead the order.
    So a document gives `copies` whole copies and its first `part` words: taken = copies * size + part.

    Null sources form one source, last in order. Empty documents and null ids take part with what
    size they have. Rows that repeat an id are separate documents. A very long document counts with its whole size, and a block may cut it
    anywhere. Columns of df named like an added one are replaced. An empty table gives an empty table.
    """
    source, size, ident = F.col(f"`{source_col}`"), F.col(f"`{size_col}`"), F.col(f"`{id_col}`")
    drop = ["source_size", "target", "copies", "part", "taken"]
    df = df.drop(*[c for c in df.columns if c.lower() in drop])
    slim = written(df.select(seed_key(ident, seed).alias("key"), source.alias("source"), size.alias("size")), "mix")
    sources = slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    seats = F.round(F.sum("target").over(Window.partitionBy(F.lit(0))) / block).cast("long")
    targets = source_targets(sources, weights, most).withColumns({"all": F.lit(0), "seats": seats})
    quotas = small(written(apportion(targets, "all", "place", "target", "seats").drop("all", "seats"), "quotas"))

    place, shard, key, whole, start, asked, blocks, at = fresh(df, "mx_place", "mx_shard", "mx_key", "mx_whole", "mx_start", "mx_asked", "mx_blocks", "mx_at")
    number = F.conv(F.substring(F.col("key"), 1, 8), 16, 10).cast("long")
    shards = F.ceil(F.col("docs") / F.lit(shard_rows)).cast("long")
    slices = (
        slim.join(quotas.withColumnRenamed("source", "its"), F.col("source").eqNullSafe(F.col("its")))
        .groupBy("place", (number % shards).alias("shard"))
        .agg(F.sum("size").alias("words"), F.first("quota").alias("seats"))
    )
    dealt = small(
        written(
            apportion(slices, "place", "shard", "words", "seats").select(
                F.col("place").alias(place), F.col("shard").alias(shard), F.col("quota").alias(blocks)
            ),
            "shards",
        )
    )
    named = quotas.select(F.col("source").alias(at), F.col("place").alias(place), F.col("docs").alias(asked), "source_size", "target")
    rows = (
        df.withColumn(key, seed_key(ident, seed))
        .join(named, source.eqNullSafe(F.col(at)))
        .withColumn(shard, F.conv(F.substring(F.col(key), 1, 8), 16, 10).cast("long") % F.ceil(F.col(asked) / F.lit(shard_rows)).cast("long"))
    )
    others = [F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]
    within = Window.partitionBy(place, shard).orderBy(key, size, *others)
    laid = rows.withColumns(
        {
            start: F.sum(size).over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - size,
            whole: F.sum(size).over(within.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        }
    ).join(dealt, [place, shard])
    wanted = F.least(F.col(blocks) * block, most * F.col(whole))
    copies = F.when(F.col(whole) > 0, F.floor(wanted / F.col(whole))).otherwise(F.lit(0)).cast("long")
    return (
        laid.withColumn(asked, wanted)
        .withColumn("copies", copies)
        .withColumn("part", F.greatest(F.lit(0), F.least(size, F.col(asked) - F.col("copies") * F.col(whole) - F.col(start))).cast("long"))
        .select(
            *[F.col(f"`{c}`") for c in df.columns],
            "source_size",
            "target",
            "copies",
            "part",
            (F.col("copies") * size + F.col("part")).alias("taken"),
        )
    )


def take_mix(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The mixed corpus itself, with df's columns: a row per whole copy, and a row with the first words of a text that a block cuts.

    Texts without words come once for each whole pass over their shard.
    """
    size, copy = fresh(df, "mx_size", "mx_copy")
    text = text_of(text_col)
    mixed = mix(df.withColumn(size, words(text)), id_col, source_col, size)
    times = F.col("copies") + (F.col("part") > 0).cast("long")
    rows = mixed.where(times > 0).withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), times)))
    cut = (F.col(copy) > F.col("copies")) & (F.col("part") < F.col(size))
    head = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(rf"{WORD}[\x20\x09-\x0D]*"), F.lit(0)), F.lit(1), F.col("part").cast("int")), "")
    done = rows.withColumn(text_col, F.when(cut, head).otherwise(F.col(f"`{text_col}`")))
    if length_col in df.columns:
        done = done.withColumn(length_col, F.when(cut, F.length(f"`{text_col}`").cast("long")).otherwise(F.col(f"`{length_col}`")))
    return done.select(*[F.col(f"`{c}`") for c in df.columns])
