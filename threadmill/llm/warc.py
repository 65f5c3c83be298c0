"""WARC archives through a chunked record table."""

from __future__ import annotations

import base64
import gzip
import hashlib
import os
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import quote, urlsplit

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .frames import new_path, small, small_batches, text_of, written

#: Bytes of a payload that a row of the chunk table holds, on the way out and back.
CHUNK = 1 << 18
#: Equal payloads of at least so many bytes are archived once.
REVISIT_BYTES = 1000
VERSION = b"WARC/1.1\r\n"
RECORD_SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
CHUNK_SCHEMA = "record_id string, chunk_number int, start long, data binary, running_digest string, page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, ended boolean"


def open_file(path: str, mode: str):
    """A file of the shared folder, whatever store its address names; a path without a scheme is local."""
    if "://" not in path and not path.startswith("file:"):
        return open(path, mode)
    parts = urlsplit(path)
    if parts.scheme == "file":
        return open(parts.path, mode)
    from pyarrow import fs

    store, at = fs.FileSystem.from_uri(path)
    return store.open_output_stream(at) if "w" in mode else store.open_input_stream(at)


def publish(draft: str, final: str) -> None:
    """Moves a finished file to its name; a second attempt of a task replaces it with the same content."""
    if draft.startswith("file:") or "://" not in draft:
        os.replace(urlsplit(draft).path, urlsplit(final).path)
        return
    from pyarrow import fs

    store, at = fs.FileSystem.from_uri(draft)
    store.move(at, fs.FileSystem.from_uri(final)[1])


def make_folder(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(at)


def record_head(record_type: str, record_id: str, url: str, when: str, payload_bytes: int, digest: str, block: int, page: int | None, refers: int | None) -> bytes:
    """Header block of a record. The payload's true size stands in it too, as a revisit holds no payload."""
    coded = base64.b32encode(bytes.fromhex(digest)).decode()
    lines = [
        f"WARC-Type: {record_type}",
        f"WARC-Record-ID: <urn:uuid:{record_id}>",
        f"WARC-Date: {when}",
        f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~-._')}",
        f"WARC-Payload-Digest: sha1:{coded}",
        f"WARC-Page-Payload-Length: {payload_bytes}",
        f"Content-Length: {block}",
    ]
    if page is not None:
        lines.append(f"WARC-Page-ID: {page}")
    if record_type == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Page-Refers-To: {'' if refers is None else refers}"]
    else:
        lines.append("Content-Type: application/http; msgtype=response")
    return VERSION + "\r\n".join(lines).encode() + b"\r\n\r\n"


HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = REVISIT_BYTES) -> DataFrame:
    """Pages with the record each becomes: columns id, url, html and payload_bytes, payload_digest, record_type, refers_to.

    Only digests are shuffled to find equal payloads; what is known of the repeated ones comes back by broadcast while that table is small,
    else by a join that Spark can split.
    """
    payload = text_of(payload_col)
    full = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), text_of(url_col).alias("url"), payload.alias("html"))
    sized = full.withColumns({"payload_bytes": F.octet_length("html").cast("long"), "payload_digest": F.sha1(F.col("html").cast("binary"))})
    repeated = (
        sized.where(F.col("payload_bytes") >= least)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    known = small(written(repeated, "payloads"))
    other = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return sized.join(known, ["payload_digest", "payload_bytes"], "left").select(
        "page_id",
        "url",
        "html",
        "payload_bytes",
        "payload_digest",
        F.when(other, "revisit").otherwise("response").alias("record_type"),
        F.when(other, F.col("first")).alias("refers_to"),
    )


def chunk_rows(records: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Planned records as rows of a record identifier, a chunk number and at most `chunk` bytes, in order within a partition; a record's first row says what it is.

    A payload is cut in Spark's own memory, where a table's row is anyway; Python gets one chunk after the other. A revisit is one row without bytes.
    """
    data = F.when(F.col("record_type") == "response", F.col("html").cast("binary")).otherwise(F.lit("").cast("binary"))
    cut = records.withColumn("data", data).withColumn("record", F.monotonically_increasing_id())
    spots = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.octet_length("data") / F.lit(chunk)).cast("int") - 1))
    first = lambda c: F.when(F.col("chunk_number") == 0, F.col(c)).alias(c)
    return cut.withColumn("chunk_number", F.explode(spots)).select(
        "record",
        "chunk_number",
        F.substring("data", F.col("chunk_number") * chunk + 1, F.lit(chunk)).alias("data"),
        *[first(c) for c in ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")],
    )


class RecordWriter:
    """Writes chunk rows as gzip members of one WARC file; a payload's digest is carried from chunk to chunk and held against its header at the end."""

    def __init__(self, out, part: int, when: str) -> None:
        self.out, self.part, self.when = out, part, when
        self.count, self.now, self.member = 0, None, None

    def close(self) -> None:
        if self.member is None:
            return
        self.member.write(b"\r\n\r\n")
        self.member.close()
        self.member = None
        if self.whole and (self.digest.hexdigest() != self.told or self.size != self.bytes):
            raise ValueError("a payload's chunks differ from its digest")

    def begin(self, record: int, page: int | None, url: str, size: int, digest: str, record_type: str, refers: int | None) -> None:
        self.close()
        self.now, self.whole, self.told, self.bytes = record, record_type == "response", digest, size
        self.digest, self.size = hashlib.sha1(), 0
        self.member = gzip.GzipFile(fileobj=self.out, mode="wb", compresslevel=4, mtime=0)
        name = str(uuid.uuid5(uuid.NAMESPACE_URL, f"{self.part}/{self.count}/{page}"))
        self.member.write(record_head(record_type, name, url, self.when, size, digest, len(HTTP) + size if self.whole else 0, page, refers))
        if self.whole:
            self.member.write(HTTP)
        self.count += 1

    def add(self, data: bytes) -> None:
        self.digest.update(data)
        self.size += len(data)
        self.member.write(data)


def write_archives(records: DataFrame, folder: str, chunk: int = CHUNK) -> DataFrame:
    """Writes planned records as gzip members of a WARC file per partition: path and records of each file.

    Records go out as chunk rows, so a task holds a batch of chunks and never a payload. A task writes to a name of its own and renames it when done, so a task that is run again leaves one whole file.
    """
    when = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        draft, final = f"{folder}/draft-{part:06d}-{uuid.uuid4().hex}", f"{folder}/part-{part:06d}.warc.gz"
        with open_file(draft, "wb") as out:
            writer = RecordWriter(out, part, when)
            for batch in batches:
                names = batch.schema.names
                for row in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                    r = dict(zip(names, row, strict=True))
                    if r["record"] != writer.now:
                        writer.begin(r["record"], r["page_id"], r["url"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                    writer.add(r["data"])
            writer.close()
        publish(draft, final)
        yield pa.RecordBatch.from_arrays([pa.array([final]), pa.array([writer.count], pa.int64())], names=["path", "records"])

    return chunk_rows(records, chunk).mapInArrow(run, "path string, records long")


def read_records(stream, chunk: int = CHUNK) -> Iterator[dict]:
    """Chunk rows of a WARC stream, in order: record id, chunk number, data, digest so far; the last row of a record carries what the record is.

    Never holds more than a chunk of a payload. A payload whose digest or length differs from its header is an error.
    """
    while True:
        line = stream.readline()
        if not line:
            return
        if line.strip() == b"":
            continue
        if line != VERSION:
            raise ValueError(f"not the start of a WARC record: {line[:60]!r}")
        head: dict[str, str] = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode("utf-8").partition(":")
            head[name.lower()] = value.strip()
        left = int(head["content-length"])
        digest, start, number, pending = hashlib.sha1(), 0, 0, None
        kind = head["warc-type"]
        if kind == "response":
            while True:
                line = stream.readline()
                left -= len(line)
                if line in (b"\r\n", b""):
                    break
        base = {"record_id": head["warc-record-id"].strip("<>").removeprefix("urn:uuid:"), "page_id": None, "url": None, "payload_bytes": None, "payload_digest": None, "record_type": None, "refers_to": None, "ended": False}
        while left > 0:
            data = stream.read(min(chunk, left))
            if not data:
                raise ValueError("a record ends early")
            left -= len(data)
            digest.update(data)
            if pending:
                yield pending
            pending = base | {"chunk_number": number, "start": start, "data": data, "running_digest": digest.hexdigest()}
            start, number = start + len(data), number + 1
        last = pending or base | {"chunk_number": 0, "start": 0, "data": b"", "running_digest": digest.hexdigest()}
        told = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
        if kind == "response" and (digest.hexdigest() != told or start != int(head["warc-page-payload-length"])):
            raise ValueError(f"payload of record {base['record_id']} differs from its digest")
        page, refers = head.get("warc-page-id"), head.get("warc-page-refers-to")
        yield last | {
            "page_id": int(page) if page else None,
            "url": head["warc-target-uri"],
            "payload_bytes": start if kind == "response" else int(head["warc-page-payload-length"]),
            "payload_digest": digest.hexdigest() if kind == "response" else told,
            "record_type": kind,
            "refers_to": int(refers) if refers else None,
            "ended": True,
        }


def read_archives(files: DataFrame, chunk: int = CHUNK, data: bool = True) -> DataFrame:
    """The chunk table of archives (column path): a row per record and chunk, in order within a file. Without `data` the bytes are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in CHUNK_SCHEMA.split(", ")]

        def table(rows: list[dict]) -> pd.DataFrame:
            out = pd.DataFrame(rows, columns=columns)
            for c in ("page_id", "payload_bytes", "refers_to"):
                out[c] = out[c].astype("Int64")
            return out

        for batch in batches:
            for path in batch["path"]:
                rows, size = [], 0
                with open_file(path, "rb") as raw, gzip.GzipFile(fileobj=raw) as stream:
                    for row in read_records(stream, chunk):
                        size += len(row["data"]) + 200
                        rows.append(row if data else row | {"data": b""})
                        if size > 1 << 22:
                            yield table(rows)
                            rows, size = [], 0
                if rows:
                    yield table(rows)

    return files.select("path").mapInPandas(run, CHUNK_SCHEMA)


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Writes every page as a WARC record and reads the archives back: page_id, url, payload_bytes, payload_digest, record_type, refers_to, chunks.

    Of equal payloads of at least 1000 bytes the one with the largest id is the response, and the others refer to it; smaller payloads are all responses. A null
    payload is empty, a null url too. Rows that repeat an id have a record each; of equal payloads, every row with the largest id is a response. A null id is kept, and refers to the largest id.
    An empty table gives an empty table.
    """
    spark = pages.sparkSession
    folder = new_path(spark, "warc")
    make_folder(spark, folder)
    with small_batches(spark, 256, 4_000_000):
        files = written(write_archives(plan_records(pages, id_col, url_col, payload_col), folder), "files")
    spread = files.repartition(max(1, min(10_000, files.count())))
    return (
        read_archives(spread, data=False)
        .where("ended")
        .select("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", (F.col("chunk_number") + 1).alias("chunks"))
    )
