"""Work-queue transitions as functions from one state table to the next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from threadmill.operators.relational import one_per_key

# States and limits of the queue contract.
READY = ("pending", "retryable")
MAX_UNRESOLVED, CLAIM_ROWS, CLAIM_SECONDS, MATURITY_HOURS = 3, 200, 300, 24


def mature(captured: Column, now: Column, hours: int = MATURITY_HOURS) -> Column:
    return captured <= now - F.make_interval(hours=F.lit(hours))


def insert_new(state: DataFrame, rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Rows whose key the state doesn't hold yet, of each key the first in a total order (nulls first). A row without a key isn't inserted."""
    first = one_per_key(rows.where(F.col(key).isNotNull()), [key], [F.col(c).asc_nulls_first() for c in order])
    return first.join(state.select(key), key, "left_anti")


def release_expired(state: DataFrame, now: Column) -> DataFrame:
    out = (F.col("status") == "claimed") & (F.col("claim_expires") <= now)
    return state.withColumns({"status": F.when(out, "pending").otherwise(F.col("status")), "claim_expires": F.when(out, F.lit(None).cast("timestamp")).otherwise(F.col("claim_expires"))})


def claim(state: DataFrame, now: Column, key: str, captured: str = "captured_at", rows: int = CLAIM_ROWS, hours: int = MATURITY_HOURS) -> DataFrame:
    """State after the `rows` oldest mature ready rows were claimed: a top-k, of which the keys come back by broadcast."""
    ready = state.where(F.col("status").isin(*READY) & mature(F.col(captured), now, hours))
    picked = ready.orderBy(captured, key).limit(rows).select(key, F.lit(True).alias("_picked"))
    joined = state.join(F.broadcast(picked), key, "left")
    return joined.withColumns(
        {
            "status": F.when(F.col("_picked"), "claimed").otherwise(F.col("status")),
            "attempts": F.col("attempts") + F.coalesce(F.col("_picked").cast("int"), F.lit(0)),
            "claim_expires": F.when(F.col("_picked"), now + F.make_interval(secs=F.lit(CLAIM_SECONDS))).otherwise(F.col("claim_expires")),
        }
    ).drop("_picked")


def classify_outcomes(claims: DataFrame, responses: DataFrame, key: str, most: int = MAX_UNRESOLVED) -> DataFrame:
    """Claims with `outcome`: returned are hydrated; transport errors, 429 and 5xx retryable; other codes failed; unreturned missing after `most` attempts."""
    code = F.col("response_code")
    joined = claims.join(responses.select(key, "response_code").withColumn("_answered", F.lit(True)), key, "left")
    outcome = (
        F.when(F.col("_answered").isNull() & (F.col("attempts") >= most), "missing")
        .when(F.col("_answered").isNull(), "retryable")
        .when(code == 200, "hydrated")
        .when((code == 429) | (code >= 500) | code.isNull(), "retryable")
        .otherwise("failed")
    )
    return joined.withColumn("outcome", outcome).drop("_answered")


def mark(state: DataFrame, outcomes: DataFrame, key: str) -> DataFrame:
    """State after outcomes: hydrated and retryable only from claimed, missing and failed from claimed or retryable."""
    joined = state.join(outcomes.select(key, "outcome"), key, "left")
    legal = (F.col("outcome").isin("hydrated", "retryable") & (F.col("status") == "claimed")) | (F.col("outcome").isin("missing", "failed") & F.col("status").isin("claimed", "retryable"))
    return joined.withColumn("status", F.when(legal, F.col("outcome")).otherwise(F.col("status"))).drop("outcome")


def completion_gate(state: DataFrame, now: Column, captured: str = "captured_at") -> DataFrame:
    """One row: whether all is mature, nothing mature is left to do and nothing is claimed. An empty state passes."""
    left = F.count_if(F.col("status").isin(*READY) & mature(F.col(captured), now))
    held = F.count_if(F.col("status") == "claimed")
    ripe = F.coalesce(mature(F.max(captured), now), F.lit(True))
    return state.agg(ripe.alias("is_mature"), left.alias("mature_unresolved"), held.alias("claimed"), (ripe & (left == 0) & (held == 0)).alias("passes"))


def seed_actors(known: DataFrame, hydrated: DataFrame, captured: DataFrame, did: str) -> DataFrame:
    """New actors with their source: hydrated posts first, then all captured ones."""
    both = hydrated.select(did, F.lit(0).alias("s")).unionByName(captured.select(did, F.lit(1).alias("s")))
    seeds = both.where(F.trim(did) != "").groupBy(did).agg(F.min("s").alias("s"))
    return seeds.join(known.select(did), did, "left_anti").select(did, F.when(F.col("s") == 0, "hydrated").otherwise("captured").alias("seed_source"))


def backoff_seconds(attempt: Column, base: float = 1.0, most: float = 30.0) -> Column:
    return F.least(base * F.pow(F.lit(2.0), attempt - 1), F.lit(most))


def claim_rank(state: DataFrame, key: str, captured: str, per: str) -> DataFrame:
    """Ready rows ranked per worker group, oldest first."""
    return state.where(F.col("status").isin(*READY)).withColumn("claim_rank", F.row_number().over(Window.partitionBy(per).orderBy(captured, key)))
