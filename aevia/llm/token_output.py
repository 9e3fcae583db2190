"""Token-id output: fixed-width packed binary files.

Every id takes the fewest bits that hold the vocabulary. A file is one shard
of consecutive documents (little-endian):

    magic 4s | bits u32 | partition u32 | documents u32 | blocks u32 |
    ids u64 | first id in the partition u64 |
    document ids i64[documents] | null flags u8[documents] |
    ids per document u64[documents] |
    per block: first document u32, first id u64, byte offset u64 |
    payload, each block starting at a byte

A block holds whole documents up to ``BLOCK_IDS`` ids (or one longer
document), so a document is read by unpacking one block; unpacking is a
numpy expression over the block, no loop over ids.

Files are written by Spark's text sink (one shard a record, one record a
file) to any store Spark writes to, and read with the ``binaryFile`` source.
Documents are range-partitioned by id, so file order is id order; a file's
partition and its first id in the partition give every document's global
start once the totals of the partitions (one row each) are summed up.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aevia.llm.common import read_bytes
from aevia.llm.units import encoder, slices

MAGIC = b"TIDP"
HEAD = struct.Struct("<4sIIIIQQ")
BLOCK = np.dtype([("document", "<u4"), ("id", "<u8"), ("byte", "<u8")])
BLOCK_IDS = 1 << 16
SHARD_IDS = 1 << 22
TABLE_UNITS = 1_200_000  # words a worker keeps: no other step shares it


def bits_for(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack_ids(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f">u{bits // 8}").tobytes()
    planes = np.unpackbits(ids.astype(">u4").view(np.uint8)).reshape(-1, 32)[:, 32 - bits:]
    return np.packbits(planes).tobytes()


def unpack_ids(data, n: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f">u{bits // 8}", n).astype(np.uint32)
    planes = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits).reshape(n, bits)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, 32 - bits:] = planes
    return np.packbits(wide).view(">u4").astype(np.uint32)


def pack_shard(doc_ids: list, counts: np.ndarray, ids: np.ndarray, bits: int, partition: int, first: int,
               block_ids: int = BLOCK_IDS) -> bytes:
    ends = np.cumsum(counts)
    starts = ends - counts
    blocks, payload, at, doc = [], [], 0, 0
    while doc < len(counts):
        stop = max(doc + 1, int(np.searchsorted(ends, starts[doc] + block_ids, "right")))
        packed = pack_ids(ids[starts[doc]: ends[stop - 1]], bits)
        blocks.append((doc, starts[doc], at))
        payload.append(packed)
        at, doc = at + len(packed), stop
    known = np.array([d is not None for d in doc_ids], np.uint8)
    return b"".join([
        HEAD.pack(MAGIC, bits, partition, len(counts), len(blocks), len(ids), first),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), known.tobytes(), counts.astype("<u8").tobytes(),
        np.array(blocks, BLOCK).tobytes(), *payload])


class Shard:
    """A packed file, opened over its bytes; nothing is unpacked until asked."""

    def __init__(self, data):
        view = memoryview(data)
        magic, self.bits, self.partition, n, m, self.ids, self.first = HEAD.unpack_from(view)
        if magic != MAGIC:
            raise ValueError("not a packed id file")
        at = HEAD.size
        self.doc_ids = np.frombuffer(view, "<i8", n, at)
        self.known = np.frombuffer(view, np.uint8, n, at + 8 * n)
        self.counts = np.frombuffer(view, "<u8", n, at + 9 * n).astype(np.int64)
        self.blocks = np.frombuffer(view, BLOCK, m, at + 17 * n)
        self.payload = view[at + 17 * n + BLOCK.itemsize * m:]
        self.starts = np.cumsum(self.counts) - self.counts

    def __len__(self) -> int:
        return len(self.counts)

    def block(self, k: int) -> np.ndarray:
        """All ids of block ``k``."""
        first = int(self.blocks["id"][k])
        stop = int(self.blocks["id"][k + 1]) if k + 1 < len(self.blocks) else self.ids
        return unpack_ids(self.payload[int(self.blocks["byte"][k]):], stop - first, self.bits)

    def document(self, i: int) -> np.ndarray:
        """Ids of the i-th document, from its block alone."""
        k = int(np.searchsorted(self.blocks["document"], i, "right")) - 1
        at = int(self.starts[i]) - int(self.blocks["id"][k])
        return self.block(k)[at: at + int(self.counts[i])]


def write_packed(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, vocabulary: int,
                 shard_ids: int = SHARD_IDS) -> None:
    """Packed files of ``docs(doc_id, text)`` under ``path``, ascending by
    id (null first, equal ids by text hash). A null text is empty: its ids
    are the end id alone. An empty table leaves no files."""
    tokenizer, bits = read_bytes(tokenizer_path), bits_for(vocabulary)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, "byte", end_id, TABLE_UNITS)
        partition = TaskContext.get().partitionId()
        first, doc_ids, counts, parts, size = 0, [], [], [], 0

        def done() -> pa.RecordBatch:
            data = pack_shard(doc_ids, np.concatenate(counts), np.concatenate(parts), bits, partition, first)
            return pa.record_batch([pa.array([data], pa.binary())], names=["value"])

        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at, run in slices(texts):
                ids, n = enc.encode(run)
                doc_ids += keys[at: at + len(run)]
                counts.append(n)
                parts.append(ids)
                size += len(ids)
                if size >= shard_ids:
                    yield done()
                    first, doc_ids, counts, parts, size = first + size, [], [], [], 0
        if doc_ids:
            yield done()

    tie = F.xxhash64("text")
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, "text")
    (ordered.mapInArrow(shards, "value binary").select(F.col("value").cast("string"))
     .write.option("maxRecordsPerFile", 1).option("compression", "none").text(path))


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                shard = Shard(data.as_buffer())
                sums = []
                for k in range(len(shard.blocks)):
                    ids = shard.block(k).astype("<u4")
                    stop = int(shard.blocks["document"][k + 1]) if k + 1 < len(shard.blocks) else len(shard)
                    for i in range(int(shard.blocks["document"][k]), stop):
                        at = int(shard.starts[i]) - int(shard.blocks["id"][k])
                        sums.append(zlib.crc32(ids[at: at + int(shard.counts[i])].tobytes()))
                yield pa.record_batch([
                    pa.array(shard.doc_ids, mask=shard.known == 0), pa.array(np.full(len(shard), shard.partition), pa.int32()),
                    pa.array(shard.first + shard.starts, pa.int64()), pa.array(shard.counts), pa.array(sums, pa.int64())],
                    names=["doc_id", "partition", "within", "n_tokens", "ids_crc32"])

    return files.mapInArrow(documents, "doc_id long, partition int, within long, n_tokens long, ids_crc32 long")


def with_starts(rows: DataFrame) -> DataFrame:
    """Adds up the partitions' totals, one row each, for the global starts."""
    totals = rows.groupBy("partition").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("partition", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(bases), "partition").select(
        "doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")
