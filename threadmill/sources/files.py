"""Files: JSON lines, stage scans with lineage, and sinks."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

SOURCE_ROOT = "THREADMILL_SOURCE_ROOT"
DEFAULT_ROOT = "data"
BATCH_ROWS = 10_000


def source_root(given: str | None = None) -> str:
    """Argument, else environment, else `data`."""
    return given or os.environ.get(SOURCE_ROOT) or DEFAULT_ROOT


def data_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path, bytes) of all *.jsonl and *.jsonl.gz files under a folder (never *.tmp), or of one such file, by path. A missing path, one of another kind and a folder without any are errors."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at):
        raise FileNotFoundError(path)
    one = fs.getFileStatus(at)
    if one.isFile():
        if not path.endswith((".jsonl", ".jsonl.gz")):
            raise ValueError(f"not a JSON lines file: {path}")
        return [(one.getPath().toString(), one.getLen())]
    found, each = [], fs.listFiles(at, True)
    while each.hasNext():
        f = each.next()
        name = f.getPath().toString()
        if name.endswith((".jsonl", ".jsonl.gz")):
            found.append((name, f.getLen()))
    if not found:
        raise FileNotFoundError(f"no JSON lines files under {path}")
    return sorted(found)


def scan_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of all JSON lines files under a path: value, file, file_bytes, line (its number in the file, from 1) and row_index (its number among all lines that aren't blank, files by path, from 1).

    Lines are numbered within each block as a task reads it; what comes before a block is added from the blocks' counts.
    """
    read = spark.read.text([f for f, _ in data_files(spark, path)])
    lines = read.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("file_bytes"), F.col("_metadata.file_block_start").alias("block"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, line, row = None, 0, 0
        for batch in batches:
            at = zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), batch.column("value").to_pylist(), strict=True)
            numbers = []
            for file, block, value in at:
                if (file, block) != now:
                    now, line, row = (file, block), 0, 0
                line, row = line + 1, row + bool(value.strip())
                numbers.append((line, row))
            columns = [pa.array(x, pa.int64()) for x in zip(*numbers, strict=True)] if numbers else [pa.array([], pa.int64())] * 2
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, "line", "row_index"])

    numbered = lines.mapInArrow(number, "value string, file string, file_bytes long, block long, line long, row_index long")
    blocks = numbered.groupBy("file", "block").agg(F.max("line").alias("lines"), F.max("row_index").alias("rows"))
    earlier = lambda *by: Window.partitionBy(*by).orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.select("file", "block", F.coalesce(F.sum("lines").over(earlier("file")), F.lit(0)).alias("_lines"), F.coalesce(F.sum("rows").over(earlier(F.lit(0))), F.lit(0)).alias("_rows"))
    full = numbered.join(before, ["file", "block"])
    return full.select("value", "file", "file_bytes", (F.col("line") + F.col("_lines")).alias("line"), (F.col("row_index") + F.col("_rows")).alias("row_index"))


def scan_json(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Rows as variants with file lineage; blank lines go. Bad rows are null or, if strict, an error that names the file and line, as is a row that is no object."""
    lines = scan_lines(spark, path).where(F.trim("value") != "")
    parsed = F.try_parse_json("value")
    if strict:
        good = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
        parsed = F.when(good, parsed).otherwise(F.raise_error(F.concat(F.lit("not a JSON object at "), "file", F.lit(":"), F.col("line").cast("string"))).cast("variant"))
    return lines.withColumn("row", parsed)


def scan_stage(spark: SparkSession, path: str, pattern: str = ".*") -> DataFrame:
    """Stage rows: payload, relative file name, row number in the file, run tag (the first folder) and load time. Rows that don't parse go, as a load that continues on errors does."""
    lines = scan_json(spark, path).where(F.col("row").isNotNull())
    root = path.rstrip("/").removeprefix("file:")
    name = F.regexp_replace(F.col("file"), f"^(file:)?/*{root.lstrip('/')}/", "")
    named = lines.withColumn("source_filename", name).where(F.col("source_filename").rlike(pattern))
    return named.select(F.split_part("source_filename", F.lit("/"), F.lit(1)).alias("source_run_tag"), "source_filename", F.col("line").alias("source_file_row_number"), F.current_timestamp().alias("loaded_at"), F.col("row").alias("raw_payload"))


def scan_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A CSV file with a header; types are inferred unless a schema is given."""
    read = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"')
    return read.csv(path, schema=schema) if schema else read.option("inferSchema", "true").csv(path)


def sql_snapshot(rows: DataFrame, path: str, order: list[str], sample: int = 1000) -> int:
    """A source table written once as Parquet with a CSV sample and a summary; how many rows it has. `rows` may come from any reader of Spark, such as a database's."""
    write_with_sample(rows, path, order, sample)
    return rows.sparkSession.read.parquet(f"{path}/full").count()


def snapshot(df: DataFrame, name: str = "name", day: str = "date") -> DataFrame:
    """A trend snapshot with its date parsed (null if it can't be) and its name trimmed."""
    return df.withColumns({day: F.try_to_timestamp(F.col(day).cast("string")).cast("date"), name: F.trim(F.coalesce(F.col(name).cast("string"), F.lit("")))})


def write_jsonl(df: DataFrame, path: str, rows: int = BATCH_ROWS) -> int:
    """Gzip JSON lines in files of at most `rows` rows, added to a folder; how many rows. The commit protocol publishes whole files only, and files that are there stay."""
    spark = df.sparkSession
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = lambda: {f.getPath().toString() for f in fs.listStatus(at) if f.getPath().getName().startswith("part-")} if fs.exists(at) else set()
    before = names()
    df.write.mode("append").option("maxRecordsPerFile", rows).option("compression", "gzip").json(path)
    new = sorted(names() - before)
    return spark.read.text(new).count() if new else 0


def write_with_sample(df: DataFrame, path: str, order: list[str], rows: int = 1000) -> None:
    """The table as Parquet, its first rows in a stable order as Parquet and CSV, and a summary as JSON."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{path}/full")
    full = spark.read.parquet(f"{path}/full")
    sample = full.orderBy(*order).limit(rows)
    sample.write.mode("overwrite").parquet(f"{path}/sample_parquet")
    sample.select(*[csv_cell(sample, c).alias(c) for c in sample.columns]).write.mode("overwrite").option("header", "true").csv(f"{path}/sample")
    kinds = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(k).alias("kind")) for c, k in df.dtypes])
    full.agg(F.count(F.lit(1)).alias("rows")).select("rows", F.least("rows", F.lit(rows)).alias("sample_rows"), kinds.alias("columns")).coalesce(1).write.mode("overwrite").json(f"{path}/summary")


def write_model(path: str, metrics: DataFrame, importances: DataFrame, predictions: DataFrame, confusion: DataFrame) -> None:
    """What a model run leaves: metrics as JSON, importances and predictions as Parquet, the confusion table as CSV."""
    metrics.coalesce(1).write.mode("overwrite").json(f"{path}/metrics")
    importances.write.mode("overwrite").parquet(f"{path}/importances")
    predictions.write.mode("overwrite").parquet(f"{path}/predictions")
    confusion.coalesce(1).write.mode("overwrite").option("header", "true").csv(f"{path}/confusion")


def csv_cell(df: DataFrame, column: str) -> Column:
    """Null as empty, nested values as JSON."""
    kind = dict(df.dtypes)[column]
    nested = kind.startswith(("array", "map", "struct"))
    return F.coalesce(F.to_json(column) if nested else F.col(column).cast("string"), F.lit(""))


def stage_copy(df: DataFrame, path: str) -> None:
    """Adds rows to a landing folder laid out by run tag and family."""
    df.write.mode("append").partitionBy("run_tag", "family").option("compression", "gzip").json(path)


def stage_put(spark: SparkSession, files: list[str], stage: str, tag: str, family: str, run: str) -> list[tuple[str, str]]:
    """Copies files to stage/tag/family/run/name: (name, copied or skipped). What is there already stays."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    done = []
    for file in files:
        source = jvm.org.apache.hadoop.fs.Path(file)
        target = jvm.org.apache.hadoop.fs.Path(f"{stage.rstrip('/')}/{tag}/{family}/{run}/{source.getName()}")
        out = target.getFileSystem(conf)
        there = out.exists(target)
        if not there:
            jvm.org.apache.hadoop.fs.FileUtil.copy(source.getFileSystem(conf), source, out, target, False, False, conf)
        done.append((source.getName(), "skipped" if there else "copied"))
    return done


def cycle_rows(df: DataFrame, key: str, rows: int) -> DataFrame:
    """Exactly `rows` rows by going round the source in key order; an empty source is an error when the rows are read.

    Only the first `rows` of the source in key order are ever numbered, so the numbering is bounded by the fixture's size.
    """
    one = df.orderBy(key).limit(rows).withColumn("_i", F.row_number().over(Window.orderBy(key)) - 1)
    none = F.raise_error(F.lit("no rows to make a fixture from")).cast("long")
    count = df.agg(F.count(F.lit(1)).alias("_c")).select(F.when(F.col("_c") > 0, F.col("_c")).otherwise(none).alias("_c"))
    spots = df.sparkSession.range(rows).crossJoin(F.broadcast(count)).select(F.col("id").alias("fixture_row"), (F.col("id") % F.col("_c")).alias("_i"))
    return spots.join(one, "_i", "left").drop("_i")


def head_rows(df: DataFrame, order: list[Column], rows: int) -> DataFrame:
    return df.orderBy(*order).limit(rows)


def tail_rows(df: DataFrame, index: str, rows: int) -> DataFrame:
    """The last rows by an index, in its order."""
    return df.orderBy(F.col(index).desc()).limit(rows).orderBy(index)


def export_sample(spark: SparkSession, path: str, out: str, rows: int, tail: bool = False) -> int:
    """The first or last rows of JSON lines files as one .json (a list, indented) or .jsonl file; how many. Bounded by `rows`, so the driver writes it."""
    import json

    if not out.endswith((".json", ".jsonl")):
        raise ValueError("the output must end in .json or .jsonl")
    lines = scan_json(spark, path, strict=True)
    picked = (tail_rows(lines, "row_index", rows) if tail else lines.orderBy("row_index").limit(rows)).where(F.col("row").isNotNull())
    found = [json.loads(r["value"]) for r in picked.select("value").collect()]
    os.makedirs(os.path.dirname(out) or ".", exist_ok=True)
    with open(out, "w", encoding="utf-8") as f:
        if out.endswith(".json"):
            f.write(json.dumps(found, ensure_ascii=False, indent=2) + "\n")
        else:
            f.writelines(json.dumps(x, ensure_ascii=False, separators=(",", ":")) + "\n" for x in found)
    return len(found)


def top_of_lines(spark: SparkSession, path: str, out: str, rows: int = 25) -> int:
    """The first rows of JSON lines files, written again as a JSON list and as gzip JSON lines beside it."""
    import gzip
    import json

    n = export_sample(spark, path, f"{out}.json", rows)
    with open(f"{out}.json", encoding="utf-8") as f, gzip.open(f"{out}.jsonl.gz", "wt", encoding="utf-8") as packed:
        packed.writelines(json.dumps(x, ensure_ascii=False) + "\n" for x in json.load(f))
    return n
