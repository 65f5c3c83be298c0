"""Exact duplicates by content sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .frames import fresh, text_of

#: Characters of a text that the sampled splitters see. The sort itself compares whole texts.
SPLITTER_CHARS = 32
#: A text with more copies than rows / (HOT_SHARE * partitions) is dealt out over several partitions.
HOT_SHARE = 2
HOT_ROWS = 64


def mark_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", normalise=None) -> DataFrame:
    """Every row of df with keep_id, group_size, kept and text_sha256 added.

    Content sort: splitters sampled from the data range-partition the texts by their first
    characters and a digest (so passages at the start of many texts don't gather them), each
    partition sorts its whole texts externally, and neighbours that compare equal in full form a
    group. Of a group the row with the smallest (`keep="min"`) or largest id stays.

    A text with very many copies is found beforehand by counting digests. Its rows carry a salt as the
    last part of the sort key, so they lie in several partitions, and its size and smallest or
    largest id come from partial sums made before any shuffle.

    `normalise` maps the text column to what is compared; without it texts are equal only if
    identical. Null texts count as empty, and all empty texts are copies of one another. Null ids
    rank last: such a row stays only if its group has no other id. Of rows that repeat an id
    within a group one stays. Columns of df named like an added one are replaced. An empty table gives
    an empty table.
    """
    spark = df.sparkSession
    out = ["keep_id", "group_size", "kept", "text_sha256"]
    df = df.drop(*[c for c in df.columns if c.lower() in out and c not in (id_col, text_col)])
    text: Column = text_of(text_col) if normalise is None else normalise(text_of(text_col))
    head, digest, salts, salt, rank, near, count, far, total, sha = fresh(
        df, "cs_head", "cs_digest", "cs_salts", "cs_salt", "cs_rank", "cs_near", "cs_count", "cs_far", "cs_total", "cs_sha"
    )
    ident = F.col(f"`{id_col}`")
    best = F.min if keep == "min" else F.max

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = max(HOT_ROWS, df.count() // (HOT_SHARE * parts))
    # More than `most` rows each: at most HOT_SHARE * partitions digests, so this may be broadcast at any input size.
    hot = (
        df.select(F.xxhash64(text).alias(digest))
        .groupBy(digest)
        .agg(F.ceil(F.count("*") / F.lit(most)).cast("int").alias(salts))
        .where(F.col(salts) > 1)
    )
    keyed = (
        df.withColumns({head: F.substring(text, 1, SPLITTER_CHARS), digest: F.xxhash64(text)})
        .join(F.broadcast(hot), digest, "left")
        .withColumn(salt, F.coalesce(F.pmod(F.xxhash64(ident, F.lit(11)), F.col(salts)), F.lit(0)))
    )
    groups = (
        keyed.where(F.col(salts) > 1)
        .groupBy(F.sha2(text, 256).alias(sha))
        .agg(best(ident).alias(far), F.count("*").alias(total))
    )
    order = ident.asc_nulls_last() if keep == "min" else ident.desc_nulls_last()
    key = Window.partitionBy(head, digest, salt, text).orderBy(order)
    whole = key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranged = keyed.repartitionByRange(head, digest, salt)
    marked = ranged.withColumns(
        {rank: F.row_number().over(key), near: F.first(ident).over(whole), count: F.count(F.lit(1)).over(whole)}
    ).withColumn(sha, F.sha2(text, 256))
    joined = marked.join(F.broadcast(groups), sha, "left").withColumns(
        {near: F.when(F.col(total).isNull(), F.col(near)).otherwise(F.col(far)), count: F.coalesce(total, count)}
    )
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns if c.lower() not in out],
        F.col(near).alias("keep_id"),
        F.col(count).alias("group_size"),
        ((F.col(rank) == 1) & ident.eqNullSafe(F.col(near))).alias("kept"),
        F.col(sha).alias("text_sha256"),
    )
