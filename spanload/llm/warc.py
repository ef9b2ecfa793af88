"""WARC archives: writing them from a table, and a splittable reader.

Writing: a record is a gzip member of its own; each task writes one file into a folder of
the job and returns a manifest row, so a file of a failed attempt is never listed.  A
payload that another record already holds becomes a ``revisit`` record without payload.

Reading: the files are cut into byte ranges.  A task scans its range for the gzip magic,
takes a place as a record's start only if the bytes from there inflate to a WARC header,
and then owns every record that starts inside its range, reading on past the range's end
for the last one.  So each record is read exactly once however the ranges fall.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanload.llm.common import small_batches, scratch_path, stage

MAGIC, VERSION = b"\x1f\x8b\x08", b"WARC/1.1\r\n"
PROBE = 4096  # bytes inflated to tell a record from chance
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"

MANIFEST = T.StructType([T.StructField("file", T.StringType()), T.StructField("bytes", T.LongType())])
RECORDS = T.StructType([
    T.StructField("record_type", T.StringType()), T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("refers_to", T.LongType()),
    T.StructField("payload", T.BinaryType())])


def _header_value(text: str) -> str:
    """One line: control characters and spaces are percent-encoded."""
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in text)


def record(page_id, url, payload: bytes, digest: str, refers_to=None, revisit: bool = False) -> bytes:
    """One gzip member."""
    block = b"" if revisit else HTTP % len(payload) + payload
    lines = [f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url} {digest}')}>",
             "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}",
             f"X-Payload-Length: {len(payload)}", f"Content-Length: {len(block)}"]
    if not revisit:
        lines.append("Content-Type: application/http; msgtype=response")
    else:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header_value(url)}")
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        lines.append(f"X-Refers-To-Page: {refers_to}")
    raw = VERSION + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def parse(raw: bytes) -> dict:
    """A record's headers and payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    kind = fields["WARC-Type"]
    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
    number = lambda k: int(fields[k]) if k in fields else None
    if payload is None:
        size, digest = number("X-Payload-Length"), fields["WARC-Payload-Digest"].partition(":")[2]
    else:
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
        if f"sha1:{digest}" != fields["WARC-Payload-Digest"]:
            raise ValueError(f"payload digest differs in record {fields['WARC-Record-ID']}")
    return {"record_type": kind, "page_id": number("X-Page-Id"), "url": fields.get("WARC-Target-URI"),
            "payload_bytes": size, "payload_digest": digest, "refers_to": number("X-Refers-To-Page"),
            "payload": payload}


def write(df: DataFrame, folder: str, page: str = "page_id", url: str = "url", payload: str = "html",
          revisit_from: int = 1000) -> DataFrame:
    """Archive every row under ``folder`` (any file system pyarrow opens); the manifest.

    The payload is the text in UTF-8 (null: empty).  Of records with equal payloads of at
    least ``revisit_from`` bytes, that with the largest page id is a response and the others
    revisit it; if that row is repeated, each repetition is a response.  Null page ids
    come last, as responses where no row has an id.  Extra columns are not archived.
    """
    small_batches(df.sparkSession, 512)
    rows = df.select(F.col(f"`{page}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"),
                     F.encode(F.coalesce(F.col(f"`{payload}`"), F.lit("")), "UTF-8").alias("payload"))
    marked = rows.withColumn("digest", F.sha1("payload"))
    first = (marked.select("page_id", "digest", F.octet_length("payload").alias("_n"))
             .where(F.col("_n") >= revisit_from).groupBy("digest")
             .agg(F.max("page_id").alias("_first"), F.count("*").alias("_copies"))
             .where("_copies > 1").select("digest", "_first"))
    # a payload's copies may be a third of all rows: adaptive execution splits that join
    linked = marked.join(first, "digest", "left").withColumn(
        "refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first"))).drop("_first")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        system, root = pafs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}.warc.gz"
        out, size = None, 0
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                if out is None:
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                number = lambda x: None if pd.isna(x) else int(x)
                refers = number(row.refers_to)
                size += out.write(record(number(row.page_id), row.url, row.payload, row.digest,
                                         refers, refers is not None))
        if out is not None:
            out.close()
            yield pd.DataFrame({"file": [f"{folder}/{name}"], "bytes": [size]})

    # ids as text: pandas would make floats of nullable longs
    linked = linked.withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})
    return stage(linked.select("page_id", "url", "payload", "digest", "refers_to").mapInPandas(run, MANIFEST),
                 "warc-manifest")


class _Bytes:
    """The bytes of a file from some place on, read in steps."""

    STEP = 1 << 18

    def __init__(self, handle, size: int, at: int):
        self.handle, self.size, self.start, self.data = handle, size, at, b""

    def upto(self, end: int) -> None:
        have = self.start + len(self.data)
        end = min(self.size, end)
        if have < end:
            self.handle.seek(have)
            self.data += self.handle.read(min(self.size, max(end, have + self.STEP)) - have)

    def drop(self, at: int) -> None:
        self.data, self.start = self.data[at - self.start:], at


def starts_record(data: bytes) -> bool:
    """Do these bytes inflate to a WARC header?"""
    try:
        return zlib.decompressobj(31).decompress(data, len(VERSION)).startswith(b"WARC/1.")
    except zlib.error:
        return False


def records_in(handle, size: int, start: int, end: int) -> Iterator[bytes]:
    """The inflated records that start in [start, end)."""
    source, at = _Bytes(handle, size, start), start
    while at < min(end, size):  # the first start
        source.upto(at + _Bytes.STEP)
        found = source.data.find(MAGIC, at - source.start)
        if found < 0:
            at = max(at + 1, source.start + len(source.data) - len(MAGIC) + 1)
            source.drop(min(at, source.start + len(source.data)))
            if source.start >= size:
                return
            continue
        at = source.start + found
        source.upto(at + PROBE)
        if at < end and starts_record(source.data[at - source.start: at - source.start + PROBE]):
            break
        at += 1
    else:
        return
    while at < min(end, size):  # from member to member
        source.drop(at)
        unpacker, raw, used = zlib.decompressobj(31), [], 0
        while not unpacker.eof:
            source.upto(at + used + 1)
            more = source.data[used:]
            if not more:
                raise ValueError(f"a record that starts at byte {at} is cut off")
            raw.append(unpacker.decompress(more))
            used = len(source.data) - len(unpacker.unused_data)
        yield b"".join(raw)
        at += used


def read(manifest: DataFrame, split_bytes: int = 4 << 20) -> DataFrame:
    """All records of the files (columns ``file, bytes``), whatever the size of a split."""
    small_batches(manifest.sparkSession, 512)
    ranges = (manifest.where("bytes > 0")
              .select("file", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1,
                                                            F.lit(split_bytes).cast("long"))).alias("start")))
    # a range is a unit of work, not a key: dealt out in turn to a stated number of tasks, which
    # adaptive execution doesn't put together, small as the rows are
    ranges = ranges.repartition(max(1, ranges.count()))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                system, path = pafs.FileSystem.from_uri(row.file)
                with system.open_input_file(path) as handle:
                    rows, held = [], 0
                    for raw in records_in(handle, row.bytes, row.start, row.start + split_bytes):
                        rows.append(parse(raw))
                        held += len(raw)
                        if held > 8 << 20:
                            yield _frame(rows)
                            rows, held = [], 0
                    if rows:
                        yield _frame(rows)

    return ranges.mapInPandas(run, RECORDS)


def _frame(rows: list[dict]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[f.name for f in RECORDS])
    return out.astype({c: "Int64" for c in ("page_id", "payload_bytes", "refers_to")})


def archive_folder(spark: SparkSession) -> str:
    """A fresh folder under the shared checkpoint folder."""
    path = scratch_path(spark, "warc")
    return path if "://" in path or path.startswith("file:") else f"file://{path}"
