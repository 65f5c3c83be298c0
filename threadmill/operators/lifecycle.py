"""Lifecycles of runs, batch files and claims as functions from one small state table to the next, and the loop that drains a queue."""

from __future__ import annotations

import random
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F

# Run kinds by the prefix of their ids, and the moves that a run or a batch file may make.
PREFIXES = {"capture": "cap", "hydrate": "hyd", "actor": "act"}
MOVES = {"running": ("completed", "failed"), "open": ("closed", "failed")}


def run_id(kind: str, now: datetime | None = None) -> str:
    """A new id: the kind's prefix, the time in UTC and eight hexadecimal digits."""
    when = (now or datetime.now(timezone.utc)).astimezone(timezone.utc)
    return f"{PREFIXES[kind]}_{when:%Y%m%dT%H%M%SZ}_{uuid.uuid4().hex[:8]}"


def wait_seconds(attempt: int, base: float = 1.0, most: float = 30.0, seed: int | None = None) -> float:
    """The wait before an attempt: doubled each time up to `most`, with a tenth more or less."""
    wait = min(base * 2 ** (attempt - 1), most)
    return wait * random.Random(seed).uniform(0.9, 1.1)


def finish(runs: DataFrame, key: str, ident: str, to: str, now: Column, status: str = "status", ended: str = "ended_at") -> DataFrame:
    """The table after a run or batch file was finished. Finishing it the same way again changes nothing; any other move is an error, when the rows are read."""
    froms = [a for a, ends in MOVES.items() if to in ends]
    own = F.col(key) == ident
    moves = own & F.col(status).isin(*froms)
    illegal = F.raise_error(F.concat(F.lit(f"{ident} can't become {to} from "), F.coalesce(F.col(status), F.lit("null")))).cast("string")
    state = F.when(moves, to).when(own & (F.col(status) != to), illegal).otherwise(F.col(status))
    return runs.withColumns({ended: F.when(moves, now).otherwise(F.col(ended)), status: state})


def add_counters(runs: DataFrame, key: str, ident: str, add: dict[str, int]) -> DataFrame:
    """Counters of a running run raised; those of a finished one stay."""
    live = (F.col(key) == ident) & (F.col("status") == "running")
    return runs.withColumns({c: F.when(live, F.coalesce(F.col(c), F.lit(0)) + n).otherwise(F.col(c)) for c, n in add.items()})


def rates(runs: DataFrame, counters: list[str]) -> DataFrame:
    """A run's counters a second, 0 for a run without length."""
    seconds = F.unix_timestamp("ended_at") - F.unix_timestamp("started_at")
    return runs.withColumns({f"{c}_per_second": F.when(seconds > 0, F.col(c) / seconds).otherwise(0.0) for c in counters})


def open_file(files: DataFrame, path: str, family: str, now: Column) -> DataFrame:
    """Files with a new open batch file; a path that is there already is an error when the rows are read."""
    seen = files.withColumn("status", F.when(F.col("path") == path, F.raise_error(F.lit(f"{path} is there already")).cast("string")).otherwise(F.col("status")))
    new = files.sparkSession.range(1).select(F.lit(path).alias("path"), F.lit(family).alias("family"), F.lit("open").alias("status"), now.alias("opened_at"), F.lit(None).cast("timestamp").alias("ended_at"))
    return seen.unionByName(new)


def latest_run(runs: DataFrame, started: str = "started_at", key: str = "run_id") -> DataFrame:
    """The run that started last."""
    return runs.orderBy(F.col(started).desc_nulls_last(), F.col(key).desc()).limit(1)


def mark_with_errors(state: DataFrame, outcomes: DataFrame, key: str) -> DataFrame:
    """State after outcomes(key, outcome, error): hydrated and retryable only from claimed, missing and failed also from retryable.

    A row that changes loses its claim. Its last_error goes on success and on a retry is the new one; missing and failed ones keep the old one where there is no new.
    """
    joined = state.join(outcomes.select(key, "outcome", F.col("error").alias("_error")), key, "left")
    legal = (F.col("outcome").isin("hydrated", "retryable") & (F.col("status") == "claimed")) | (F.col("outcome").isin("missing", "failed") & F.col("status").isin("claimed", "retryable"))
    moved = F.coalesce(legal, F.lit(False))
    error = F.when(F.col("outcome") == "hydrated", F.lit(None)).when(F.col("outcome") == "retryable", F.col("_error")).otherwise(F.coalesce("_error", "last_error"))
    kind = dict(state.dtypes)
    gone = {c: F.when(moved, F.lit(None).cast(kind[c])).otherwise(F.col(c)) for c in ("claim_expires", "claimed_by") if c in kind}
    return joined.withColumns({"status": F.when(moved, F.col("outcome")).otherwise(F.col("status")), "last_error": F.when(moved, error).otherwise(F.col("last_error")), **gone}).select(*state.columns)


def release_on_shutdown(state: DataFrame, worker: str, reason: str = "shutdown") -> DataFrame:
    """A worker's claims back to retryable when it ends."""
    own = (F.col("status") == "claimed") & (F.col("claimed_by") == worker)
    return state.withColumns(
        {
            "last_error": F.when(own, reason).otherwise(F.col("last_error")),
            "claim_expires": F.when(own, F.lit(None).cast("timestamp")).otherwise(F.col("claim_expires")),
            "status": F.when(own, "retryable").otherwise(F.col("status")),
            "claimed_by": F.when(own, F.lit(None).cast("string")).otherwise(F.col("claimed_by")),
        }
    )


def only_retries(outcomes: DataFrame) -> DataFrame:
    """One row: whether a cycle only put rows off, so that going on at once would try them in a loop."""
    done = F.count_if(F.col("outcome") != "retryable")
    return outcomes.agg((F.count_if(F.col("outcome") == "retryable") > 0).alias("_some"), (done == 0).alias("_none")).select((F.col("_some") & F.col("_none")).alias("ends_run"))


def has_data(streams: DataFrame, rows: str, stream: str = "stream") -> DataFrame:
    """Per stream whether it holds rows that weren't taken yet."""
    return streams.groupBy(stream).agg((F.coalesce(F.sum(rows), F.lit(0)) > 0).alias("has_data"))


def load_status(files: DataFrame, history: DataFrame, landing: DataFrame) -> DataFrame:
    """Pending files(path, local_rows) with what the copy history(file_name, status, row_count) and landing(file_name, rows) say: loaded, failed or pending, and the rows: history's, else landing's, else the file's own."""
    last = history.groupBy("file_name").agg(F.max_by(F.struct("status", "row_count"), "load_time").alias("h"))
    joined = files.join(last, F.col("path") == F.col("file_name"), "left").drop("file_name").join(landing.withColumnRenamed("rows", "landed"), F.col("path") == F.col("file_name"), "left")
    status = F.when(F.lower("h.status") == "loaded", "loaded").when(F.lower("h.status").contains("fail"), "failed").otherwise("pending")
    return joined.select("path", status.alias("status"), F.when(status == "loaded", F.coalesce("h.row_count", "landed", "local_rows")).alias("rows"))


def copy_history(history: DataFrame, tag: str, now: Column, hours: int = 24) -> DataFrame:
    """The last hours' history of files under a tag, latest first."""
    return history.where(F.col("file_name").ilike(f"%/{tag}/%") & (F.col("load_time") >= now - F.make_interval(hours=F.lit(hours)))).orderBy(F.col("load_time").desc(), "file_name")


def drain(cycle: Callable[[int], bool], most: int = 100) -> int:
    """Runs cycles until one says that the gate has passed, or `most` have run; how many ran."""
    for n in range(1, most + 1):
        if cycle(n):
            return n
    return most


def lookup(df: DataFrame, key: str, fetch: Callable[[list[str]], list[dict]], schema: str, batch: int = 25) -> DataFrame:
    """Each distinct id asked once, `batch` a request: the first answer per id as JSON text, null where none came (the id is missing). `fetch` is given by the caller and runs on the executors."""
    import json
    from collections.abc import Iterator

    import pandas as pd

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            ids = rows[key].tolist()
            for at in range(0, len(ids), batch):
                own = ids[at : at + batch]
                found: dict[str, dict] = {}
                for answer in fetch(own):
                    if answer.get(key) in own:
                        found.setdefault(answer[key], answer)
                yield pd.DataFrame({key: own, "answer": [json.dumps(found[i], sort_keys=True) if i in found else None for i in own]})

    return df.select(key).where(F.col(key).isNotNull()).distinct().mapInPandas(run, schema)
