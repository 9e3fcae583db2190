"""WARC archives and revisit resolution.

An archive is a folder of files of gzip members, one record a member:
response records with an HTTP head and the payload, and revisit records with
the head alone, which name the response of equal payload.

``deduplicate`` turns archives into archives in four steps:

1. The headers of all records are read (record id, place, payload digest).
2. Headers are shuffled by payload digest. Of the response records of one
   digest the least (page id, then record id) is the original; a digest met
   once needs none. The minimum combines map-side, so a payload of a third of
   all pages is one row a task.
3. Headers are joined with the originals of their digest: each is the
   original itself or revisits it. Both sides are saved tables, so AQE splits
   a hot digest.
4. The decisions of a file (no more than it has records) meet the file, and
   one task writes it anew, with fresh headers: payloads never leave the file
   they are in, and only whole compressed files are shuffled.

Files are written by Spark's text sink (one file a record of the sink; NUL
bytes after the last member are padding to gzip readers) to any store that
Spark writes to, and read with the ``binaryFile`` source.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aevia.llm.common import saved

FILE_BYTES = 8 << 20  # compressed bytes after which a file is closed
LEVEL = 6
CAPTURED = "2000-01-01T00:00:00Z"  # pages say no time of capture
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_FIELD = "X-Page-Id"
STEP = 1 << 16


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(*names) -> str:
    """An id that depends on the names alone, so a task that runs again
    writes the same records."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, '/'.join(map(str, names)))}>"


def _one_line(value: str) -> str:
    """A header value: line breaks, which would end it, percent-encoded."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


@dataclass
class Record:
    kind: str
    id: str
    page_id: int | None
    uri: str | None
    digest: str
    payload: bytes = b""
    refers_to: str | None = None
    refers_uri: str | None = None
    length: int = 0  # of the full payload, by the HTTP head

    def member(self) -> bytes:
        """The record as a gzip member, its headers made afresh."""
        head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {self.length}\r\n\r\n".encode()
        block = head + self.payload
        fields = [("WARC-Type", self.kind), ("WARC-Record-ID", self.id), ("WARC-Date", CAPTURED)]
        if self.uri is not None:
            fields.append(("WARC-Target-URI", _one_line(self.uri)))
        fields.append(("WARC-Payload-Digest", f"sha1:{self.digest}"))
        fields.append(("WARC-Block-Digest", f"sha1:{payload_digest(block)}"))
        if self.kind == "revisit":
            fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", self.refers_to or ""), ("WARC-Refers-To-Date", CAPTURED)]
            if self.refers_uri is not None:
                fields.append(("WARC-Refers-To-Target-URI", _one_line(self.refers_uri)))
        if self.page_id is not None:
            fields.append((PAGE_FIELD, str(self.page_id)))
        fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
        text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        return packer.compress(text.encode() + block + b"\r\n\r\n") + packer.flush()


def members(data) -> Iterator[bytes]:
    """The gzip members of a file; NUL padding may follow the last."""
    view, at = memoryview(data), 0
    while at < len(view) and view[at] != 0:
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            step = view[at: at + STEP]
            if not step:
                raise ValueError("cut gzip member")
            parts.append(unpacker.decompress(step))
            at += len(step)
        at -= len(unpacker.unused_data)
        yield b"".join(parts)


def parse(raw: bytes) -> Record:
    head, block = raw.split(b"\r\n\r\n", 1)
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    f = dict(line.split(": ", 1) for line in lines)
    block = block[: int(f["Content-Length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    length = next(int(x[16:]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length: "))
    page = f.get(PAGE_FIELD)
    return Record(
        f["WARC-Type"], f["WARC-Record-ID"], None if page is None else int(page), f.get("WARC-Target-URI"),
        f["WARC-Payload-Digest"].removeprefix("sha1:"), payload, f.get("WARC-Refers-To"), f.get("WARC-Refers-To-Target-URI"), length)


def _file(parts: list[bytes]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([b"".join(parts)], pa.binary())], names=["value"])


def _write_files(files: DataFrame, path: str) -> None:
    """Each binary ``value`` as a file under ``path``."""
    (files.select(F.col("value").cast("string")).write.option("maxRecordsPerFile", 1)
     .option("compression", "none").option("lineSep", "\0").text(path))


def write_responses(pages: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    """A response record for each row of ``pages(page_id, url, html)``, the
    html its payload.

    A null html is an empty payload; a null url leaves the target URI out, a
    null page_id the page field. Repeated rows are a record each; an empty
    table leaves no records; further columns are not read.
    """
    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, n, parts, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for page, url, html in zip(*(batch.column(i) for i in range(3))):
                payload = html.as_py() or b""
                parts.append(Record("response", record_id(path, partition, n), page.as_py(), url.as_py(),
                                    payload_digest(payload), payload, length=len(payload)).member())
                n, size = n + 1, size + len(parts[-1])
                if size >= file_bytes:
                    yield _file(parts)
                    parts, size = [], 0
        if parts:
            yield _file(parts)

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("binary"))
    _write_files(rows.mapInArrow(files, "value binary"), path)


def _contents(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.substring_index("path", "/", -1).alias("file"), "content")


HEADERS = "file string, at int, kind string, record_id string, page_id long, uri string, digest string, refers_to string"


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """The headers of an archive: the file and the number of a record in it,
    and its fields."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, data in zip(batch.column(0), batch.column(1)):
                found = [(file.as_py(), at, r.kind, r.id, r.page_id, r.uri, r.digest, r.refers_to)
                         for at, r in enumerate(map(parse, members(data.as_buffer())))]
                yield _batch(found, HEADERS)

    return _contents(spark, path).mapInArrow(rows, HEADERS)


_KINDS = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(c.split(" ") for c in schema.split(", ")))
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.record_batch([pa.array(c, _KINDS[k]) for c, k in zip(columns, kinds)], names=list(names))


def originals(headers: DataFrame) -> DataFrame:
    """Per digest of more than one record: its original (least page id, null
    last, then record id) as record_id and uri. A digest without a response
    record has none."""
    first = F.min(F.when(F.col("kind") == "response", F.struct(
        F.col("page_id").isNull().alias("unknown"), "page_id", "record_id", "uri")))
    found = headers.groupBy("digest").agg(F.count("*").alias("n"), first.alias("o"))
    return found.where("n > 1 and o is not null").select(
        "digest", F.col("o.record_id").alias("first_id"), F.col("o.uri").alias("first_uri"))


def deduplicate(spark: SparkSession, source: str, target: str, min_bytes: int = 0) -> None:
    """The archive at ``source`` written to ``target``: of records with equal
    payloads of at least ``min_bytes`` bytes one stays a response, the others
    become revisit records of it. Revisit records of the source are resolved
    to the original of their digest; one whose digest has no response stays
    as it is. An empty archive gives an empty one."""
    headers = saved(read_headers(spark, source), "warc-headers")
    first = saved(originals(headers), "warc-originals")
    decided = headers.join(first, "digest").where("record_id != first_id")
    by_file = decided.groupBy("file").agg(F.collect_list(F.struct("at", "first_id", "first_uri")).alias("revisits"))

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, found in zip(batch.column(0), batch.column(1)):
                revisits = {r["at"]: r for r in found.as_py() or []}
                parts = []
                for at, raw in enumerate(members(data.as_buffer())):
                    r, to = parse(raw), revisits.get(at)
                    if to is not None and (r.length >= min_bytes or r.kind == "revisit"):
                        r.kind, r.payload = "revisit", b""
                        r.refers_to, r.refers_uri = to["first_id"], to["first_uri"]
                    parts.append(r.member())
                yield _file(parts)

    joined = _contents(spark, source).join(by_file, "file", "left").select("content", "revisits")
    _write_files(joined.mapInArrow(files, "value binary"), target)


RECORDS = ("kind string, record_id string, page_id long, uri string, stated string, refers_to string, "
           "payload_bytes long, payload_digest string")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of an archive with their payloads measured: ``stated`` is
    the digest of the header; bytes and digest of a response are worked out
    from its payload, those of a revisit record are null."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(1):
                found = []
                for r in map(parse, members(data.as_buffer())):
                    full = r.kind == "response"
                    found.append((r.kind, r.id, r.page_id, r.uri, r.digest, r.refers_to, len(r.payload) if full else None,
                                  payload_digest(r.payload) if full else None))
                yield _batch(found, RECORDS)

    return _contents(spark, path).mapInArrow(rows, RECORDS)


def resolved(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archive: page_id, payload_bytes,
    payload_digest (both of the full payload), record_type, refers_to (the
    page id of the response that a revisit record names, else null), uri,
    record_id. A revisit record whose response is not there has null bytes
    and the digest that its header states."""
    records = saved(read_records(spark, path), "warc-records")
    response = records.where("kind = 'response'").select(
        F.col("record_id").alias("named"), F.col("page_id").alias("first"), F.col("payload_bytes").alias("n"),
        F.col("payload_digest").alias("d"))
    revisits = records.where("kind = 'revisit'").join(response, F.col("refers_to") == F.col("named"), "left")
    return records.where("kind = 'response'").select(
        "page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"),
        F.lit(None).cast("long").alias("refers_to"), "uri", "record_id",
    ).unionByName(revisits.select(
        "page_id", F.col("n").alias("payload_bytes"), F.coalesce("d", "stated").alias("payload_digest"),
        F.col("kind").alias("record_type"), F.col("first").alias("refers_to"), "uri", "record_id"))
