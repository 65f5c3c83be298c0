"""Importance resampling of documents towards the texts of a target, by hashed n-grams that DuckDB counts in each partition."""

from __future__ import annotations

import inspect
import tempfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from .frames import release_memory, small_batches, text_of, written

BUCKETS, LONGEST, LEAST_WORDS, SHARE, SEED = 10_000, 3, 20, 5, 42
# Letters that are lowered, and what a word is made of.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Memory of a worker's DuckDB, beyond which it uses a temporary folder of its task.
MEMORY = "250MB"
COUNTED = "doc_id long, total boolean, n_words long, n_features long, buckets array<int>, counts array<int>"


def bucket_function(buckets: int, longest: int):
    """CRC-32 modulo buckets of a word, of it with the next one, and so on; later words come with their blank, and none is empty. -1 stands for a run that the text is too short for."""

    def of(*words: pa.Array) -> pa.Array:
        columns = [(w.combine_chunks() if isinstance(w, pa.ChunkedArray) else w).cast(pa.binary()) for w in words]
        out = np.empty((len(columns[0]), len(columns)), np.int64)
        crc = None
        for i, column in enumerate(columns):
            own = column.to_numpy(zero_copy_only=False)
            crc = list(map(zlib.crc32, own) if crc is None else map(zlib.crc32, own, crc))
            out[:, i] = crc
            out[:, i] %= buckets
            if i:
                out[np.asarray(pc.binary_length(column)) == 0, i] = -1
        ends = np.arange(0, out.size + 1, len(columns), dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(out.ravel().astype(np.int32)))

    # DuckDB looks at how many arguments a function takes.
    of.__signature__ = inspect.Signature([inspect.Parameter(f"w{i}", inspect.Parameter.POSITIONAL_ONLY) for i in range(longest)])
    return of


def counting_sql(longest: int) -> str:
    """A row per document of `batch`, and one with the sums of all: bucket counts of the runs of 1 to `longest` words."""
    later = "".join(f", coalesce(' ' || lead(w0, {i}) OVER o, '') AS w{i}" for i in range(1, longest))
    runs = ", ".join(f"w{i}" for i in range(longest))
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORD}') AS words FROM batch),
w AS (SELECT row, unnest(words) AS w0, generate_subscripts(words, 1) AS i FROM d),
g AS (SELECT row, w0{later} FROM w WINDOW o AS (PARTITION BY row ORDER BY i)),
f AS (SELECT row, unnest(crc_buckets({runs})) AS bucket FROM g),
n AS MATERIALIZED (SELECT row, bucket, CAST(count(*) AS INTEGER) AS n FROM f WHERE bucket >= 0 GROUP BY ALL),
each AS (SELECT row, CAST(sum(n) AS BIGINT) AS n_features, list(bucket) AS buckets, list(n) AS counts FROM n GROUP BY row),
every AS (SELECT CAST(sum(n) AS BIGINT) AS n_features, list(bucket) AS buckets, list(n) AS counts FROM (SELECT bucket, CAST(sum(n) AS INTEGER) AS n FROM n GROUP BY bucket))
SELECT doc_id, false AS total, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_features, 0) AS n_features, buckets, counts FROM d LEFT JOIN each USING (row)
UNION ALL SELECT NULL, true, NULL, n_features, buckets, counts FROM every"""


def counted(buckets: int, longest: int):
    """Runs the counting SQL over each batch (doc_id, text), in a DuckDB of the task's own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        with tempfile.TemporaryDirectory() as folder, duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": folder}) as con:
            con.create_function("crc_buckets", bucket_function(buckets, longest), ["VARCHAR"] * longest, "INTEGER[]", type="arrow")
            for batch in batches:
                con.register("batch", pa.Table.from_batches([batch]))
                yield from con.sql(counting_sql(longest)).to_arrow_table().to_batches()
                con.unregister("batch")
        release_memory()

    return run


def bucket_counts(docs: DataFrame, id_col: str, text_col: str, buckets: int, longest: int) -> DataFrame:
    """Bucket counts of each document, and of each batch, spilled to Parquet in the shared folder."""
    with small_batches(docs.sparkSession, 1000, 4_000_000):
        return written(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(counted(buckets, longest), COUNTED), "buckets")


def totals(spilled: DataFrame, buckets: int) -> np.ndarray:
    """The sum of each bucket: as many numbers as there are buckets, whatever the input."""
    each = spilled.where("total").select(F.explode(F.arrays_zip("buckets", "counts")).alias("x"))
    rows = each.groupBy("x.buckets").agg(F.sum(F.col("x.counts").cast("long")).alias("n")).collect()
    out = np.zeros(buckets)
    for bucket, n in rows:
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) of each bucket."""
    n = float(len(corpus))
    return np.floor(1000 * np.log((target + 1) * (corpus.sum() + n) / ((corpus + 1) * (target.sum() + n)))).astype(np.int64)


def weighed(gain: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = {name: batch.column(name) for name in ("doc_id", "n_words", "n_features")}
            lists = batch.column("buckets")
            own = gain[lists.flatten().to_numpy()] * batch.column("counts").flatten().to_numpy().astype(np.int64)
            sizes = np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
            upto = np.r_[0, np.cumsum(own)]
            ends = np.cumsum(sizes)
            table["weight"] = pa.array(upto[ends] - upto[ends - sizes])
            yield pa.RecordBatch.from_pydict(table)

    return run


def noise(ident: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln((h + 0.5) / 2 ** 32))), h from the id's SHA-256."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def importance(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int = SHARE, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, longest: int = LONGEST, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every row of docs; the target's texts are in its column `text`.

    In each partition DuckDB takes the words of whole texts, forms runs of 1 to `longest` words by a window and counts them by hashed bucket. The counts are spilled to
    Parquet; Spark sums up the buckets of all documents and of the target, weighs each document by the gains of its runs, adds seeded Gumbel noise, and draws the
    floor(share * N / 100) highest scores of the N documents with at least `least_words` words. Their rank goes from 1; ties go to the smaller id. The ranking is by ranges of the score, no task sees all.

    Null texts count as empty; texts without words have weight 0. Null ids count as an empty text in the noise and come last in ties. Rows that repeat an id are documents of
    their own. Other columns are ignored. An empty table gives an empty table, an empty target is one without any run.
    """
    spilled = bucket_counts(docs, id_col, text_col, buckets, longest)
    gain = gains(totals(spilled, buckets), totals(bucket_counts(target.select(F.lit(0).alias("id"), "text"), "id", "text", buckets, longest), buckets))
    weights = spilled.where("not total").select("doc_id", "n_words", "n_features", "buckets", "counts").mapInArrow(weighed(gain), "doc_id long, n_words long, n_features long, weight long")
    scored = weights.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "n_features", "weight"]
    fit = F.col("n_words") >= least_words
    with small_batches(docs.sparkSession, 500, 4_000_000):
        ranged = written(scored.repartitionByRange(fit.desc(), *order).withColumn("part", F.spark_partition_id()), "scores")
    sizes = ranged.where(fit).groupBy("part").agg(F.count(F.lit(1)).alias("size"))  # a row per partition
    before = sizes.select("part", F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"), F.sum("size").over(Window.partitionBy()).alias("all"))
    placed = ranged.withColumn("within", F.row_number().over(Window.partitionBy("part").orderBy(fit.desc(), *order))).join(before, "part", "left")
    rank = F.col("before") + F.col("within")
    drawn = fit & (rank <= F.expr(f"`all` * {share} div 100"))
    return placed.select("doc_id", "n_words", "n_features", "weight", "score", F.when(drawn, rank).alias("rank"))


def draw(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **more) -> DataFrame:
    """The drawn rows of docs with their columns; a drawn id brings all its rows."""
    ids = importance(docs, target, id_col, **more).where("rank is not null").select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(ids, id_col, "left_semi")
