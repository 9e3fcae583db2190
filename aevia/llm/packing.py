"""Best-fit packing of documents into sequences of a fixed length.

A document longer than a sequence is cut into full pieces; its last piece
and all other documents are packed whole. One packer runs per partition and
takes its pieces longest first: a piece goes into the open bin with the
least free space that holds it. Open bins are found in a bitset keyed by free
space (one shift and one lowest bit). At most ``OPEN_BINS`` bins are open;
beyond that the fullest closes, as the least is lost with it.

Texts are tokenized where they are read; only piece rows (a few numbers
each) are shuffled. The number of packers grows with the pieces; a packer's
share is small enough that its long pieces seldom close bins early.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aevia.llm.common import read_bytes, saved
from aevia.llm.units import encoder, slices

OPEN_BINS = 4_096
TABLE_UNITS = 1_200_000  # words a worker keeps if no other step shares its executor
PIECES_PER_PACKER = 20_000


class BestFit:
    """Bounded-space online best-fit: ``place`` gives (bin, offset)."""

    def __init__(self, capacity: int, open_bins: int = OPEN_BINS):
        self.capacity, self.open_bins = capacity, open_bins
        self.mask = 0  # bit f: some open bin has f free
        self.bins: dict[int, list[int]] = {}
        self.open = self.made = 0

    def _take(self, free: int) -> int:
        stack = self.bins[free]
        b = stack.pop()
        if not stack:
            del self.bins[free]
            self.mask ^= 1 << free
        self.open -= 1
        return b

    def place(self, length: int) -> tuple[int, int]:
        fits = self.mask >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            b = self._take(free)
        else:
            b, free = self.made, self.capacity
            self.made += 1
        left = free - length
        if left:
            self.bins.setdefault(left, []).append(b)
            self.mask |= 1 << left
            self.open += 1
            if self.open > self.open_bins:
                self._take((self.mask & -self.mask).bit_length() - 1)
        return b, self.capacity - free


def pieces_of(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int, table_units: int = TABLE_UNITS) -> DataFrame:
    """Per piece of ``docs(doc_id, text)``: doc_id, piece, start, length,
    ids_crc32. A null text is empty and has the end id alone. A worker keeps
    the ids of ``table_units`` words, which decides memory and time alone."""
    tokenizer = read_bytes(tokenizer_path)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, "word", end_id, table_units)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at, run in slices(texts):
                ids, counts = enc.encode(run)
                data = ids.astype("<u4")
                rows, begin = [], 0
                for key, n in zip(keys[at: at + len(run)], counts.tolist()):
                    for piece, start in enumerate(range(0, n, capacity)):
                        cut = data[begin + start: begin + min(n, start + capacity)]
                        rows.append((key, piece, start, len(cut), zlib.crc32(cut.tobytes())))
                    begin += n
                key, piece, start, length, crc = zip(*rows)
                yield pa.record_batch([
                    pa.array(key, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        pieces, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(pieces: DataFrame, capacity: int, open_bins: int = OPEN_BINS,
         pieces_per_packer: int = PIECES_PER_PACKER) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to
    ``capacity``. Order, and so the result, is fixed by the rows alone;
    equal rows get a place each. ``pieces`` is read twice: pass a saved
    table."""
    n = max(1, -(-pieces.count() // pieces_per_packer))
    order = [F.desc("length"), *[c for c in pieces.columns if c != "length"]]

    def packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, packer = TaskContext.get().partitionId() << 40, BestFit(capacity, open_bins)
        for frame in frames:
            places = np.array([packer.place(x) for x in frame["length"].tolist()], np.int64).reshape(-1, 2)
            yield frame.assign(sequence_id=first + places[:, 0], offset=places[:, 1])

    schema = ", ".join(f"{c} {t}" for c, t in pieces.dtypes) + ", sequence_id long, offset long"
    spread = F.xxhash64(*pieces.columns)
    return pieces.repartition(n, spread).sortWithinPartitions(*order).mapInPandas(packed, schema)


def best_fit_packing(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = 4096,
                     table_units: int = TABLE_UNITS) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset. Repeated rows are packed each; an empty table gives no rows;
    further columns are not read."""
    return pack(saved(pieces_of(docs, tokenizer_path, end_id, capacity, table_units), "op5-pieces"), capacity)
