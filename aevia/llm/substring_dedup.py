"""Substring dedup: words of long repeats are removed from later documents.

A window is ``size`` words in a row of one document. Every word under a
window that also starts in a document with a smaller id goes; windows are
judged on the input. The result is exact:

1. Texts of equal word sequences form a class; all but its least document
   lose every word (if there is a whole window), and only that one goes on.
2. Recompression names the runs and pairs of every document, and each window
   has an anchor that the same window has in any document (see
   ``recompression``): about one distinct anchor in sixteen words. An anchor
   of a single text clears all its windows.
3. Windows at anchors shared by different texts are the candidates, a small
   part of all. They are named by 128 bits, and the least document of each
   name decides.
4. Documents that lose words are rebuilt from their text.

Anchors and window names combine map-side, so a passage of a third of all
documents is one row a task; the joins back are merge joins between saved
tables at any size, which AQE splits. A document's windows stay with its own
row until then. Rows of single anchors and windows hold a hash of 64 bits
(``class``) in place of the digest: it tells apart the texts of one id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aevia.llm.common import saved
from aevia.llm.recompression import Batch, RangeHashes, anchors
from aevia.llm.shingles import word_hashes

WINDOW = 50
#: Words handled as one sequence of documents.
BATCH_WORDS = 400_000


def _sequences(column, words: int = BATCH_WORDS) -> Iterator[tuple[int, list[list[bytes]]]]:
    """Runs of documents of about ``words`` words: (first row, their words)."""
    first, run, n = 0, [], 0
    for i, text in enumerate(column):
        run.append((text.as_py() or b"").split())
        n += len(run[-1])
        if n >= words:
            yield first, run
            first, run, n = i + 1, [], 0
    if run:
        yield first, run


def _digest(words: list[bytes]) -> bytes:
    return hashlib.sha256(b" ".join(words)).digest()


def _lists(values: np.ndarray, doc: np.ndarray, n: int, kind) -> pa.Array:
    """List column of ``values`` by the row numbers in ``doc`` (ascending)."""
    ends = np.searchsorted(doc, np.arange(n + 1))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def anchored(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_words, digest of the words, distinct anchors."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, run in _sequences(batch.column(1)):
                b = Batch([word_hashes(w) for w in run])
                starts, doc = b.windows(size)
                names = anchors(b, starts, size)
                new = np.append(True, (names[1:] != names[:-1]) | (doc[1:] != doc[:-1]))[: len(names)]
                yield pa.record_batch([
                    batch.column(0).slice(first, len(run)), pa.array([len(w) for w in run], pa.int64()),
                    pa.array([_digest(w) for w in run], pa.binary()),
                    _lists(names[new].view(np.int64), doc[new], len(run), pa.int64())],
                    names=["doc_id", "n_words", "digest", "anchors"])

    return docs.mapInArrow(rows, "doc_id long, n_words long, digest binary, anchors array<long>")


def candidates(docs: DataFrame, size: int) -> DataFrame:
    """``docs(doc_id, digest, text, shared, copies)`` with the windows at
    shared anchors: their starts and the two halves of their names."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared = batch.column(3)
            for first, run in _sequences(batch.column(2)):
                # rows that repeat an id with another text are not the one meant
                meant = [_digest(w) == d.as_py() for w, d in zip(run, batch.column(1).slice(first, len(run)))]
                run = [w if m else [] for w, m in zip(run, meant)]
                b = Batch([word_hashes(w) for w in run])
                starts, doc = b.windows(size)
                mine = shared.slice(first, len(run)).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                keep = np.isin(anchors(b, starts, size), mine)
                starts, doc = starts[keep], doc[keep]
                one, two = (RangeHashes(b.words, second).of(starts, starts + size) for second in (False, True))
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(i).slice(first, len(run)) for i in (0, 1, 2, 4)),
                    _lists(starts - b.begin[doc], doc, len(run), pa.int32()),
                    _lists(one.view(np.int64), doc, len(run), pa.int64()),
                    _lists(two.view(np.int64), doc, len(run), pa.int64())],
                    names=["doc_id", "digest", "text", "copies", "starts", "one", "two"]).filter(pa.array(meant, pa.bool_()))

    return docs.mapInArrow(
        rows, "doc_id long, digest binary, text binary, copies long, starts array<int>, one array<long>, two array<long>")


def covered(n: int, starts: list[int], size: int) -> np.ndarray:
    """Which of ``n`` words lie under the windows at ``starts``."""
    step = np.zeros(n + 1, np.int64)
    at = np.unique(np.asarray(starts, np.int64))
    step[at] += 1
    np.subtract.at(step, at + size, 1)
    return np.cumsum(step[:-1]) > 0


def rebuilt(docs: DataFrame, size: int) -> DataFrame:
    """``docs(doc_id, digest, text, gone)`` without the words under the
    windows at ``gone``: n_removed, kept text."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, kept = [], []
            for text, gone in zip(batch.column(2), batch.column(3)):
                words = text.as_py().split()
                out = covered(len(words), gone.as_py(), size)
                removed.append(int(out.sum()))
                kept.append(b" ".join(w for w, o in zip(words, out.tolist()) if not o).decode("utf-8", "replace"))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                                  names=["doc_id", "digest", "n_removed", "kept"])

    return docs.mapInArrow(rows, "doc_id long, digest binary, n_removed long, kept string")


def find_repeats(docs: DataFrame, size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """What to remove from ``docs(doc_id, text)``: one row per row of
    ``docs`` (doc_id, n_words, digest, first: the least id of its word
    sequence), and one per id and word sequence that keeps a part, however
    many rows repeat them (doc_id, digest, n_removed, kept)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    rows = saved(anchored(docs, size), "op2-anchors")
    # of each word sequence the least id, and how many rows repeat both
    classes = saved(
        rows.where("doc_id is not null").groupBy("digest", "doc_id").agg(F.count("*").alias("n"))
        .groupBy("digest").agg(F.min(F.struct("doc_id", "n")).alias("least"))
        .select("digest", F.col("least.doc_id").alias("first"), F.col("least.n").alias("copies")), "op2-classes")
    spread = rows.where("doc_id is not null").select("doc_id", F.xxhash64("digest").alias("class"), F.explode("anchors").alias("anchor"))
    shared = saved(
        spread.groupBy("anchor").agg(F.min("class").alias("a"), F.max("class").alias("b")).where("a != b").select("anchor"),
        "op2-shared")
    firsts = classes.select("digest", F.xxhash64("digest").alias("class"), F.col("first").alias("doc_id"), "copies")
    # these grow with the texts: never broadcast, however small their files are
    held = spread.join(shared.hint("merge"), "anchor").groupBy("doc_id", "class").agg(F.collect_set("anchor").alias("shared"))
    held = held.join(firsts.hint("merge"), ["class", "doc_id"])
    windows = saved(candidates(
        docs.join(held, "doc_id").select("doc_id", "digest", "text", "shared", "copies"), size), "op2-windows")
    named = windows.withColumn("class", F.xxhash64("digest"))
    each = named.select("doc_id", "class", F.explode(F.arrays_zip("starts", "one", "two")).alias("w")).select("doc_id", "class", "w.*")
    least = saved(
        each.groupBy("one", "two").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        .where("least < most").drop("most"), "op2-least")
    gone = (
        each.join(least.hint("merge"), ["one", "two"]).where("least < doc_id")
        .groupBy("doc_id", "class").agg(F.collect_set("starts").alias("gone"))
    )
    # rows that repeat id and words are rebuilt once, for all of them
    once = named.where("copies = 1").select("doc_id", "digest", "class", "text").unionByName(
        named.where("copies > 1").groupBy("doc_id", "digest", "class").agg(F.min("text").alias("text")))
    parts = once.join(gone, ["doc_id", "class"]).select("doc_id", "digest", "text", "gone")
    return rows.drop("anchors").join(classes.drop("copies"), "digest", "left"), saved(rebuilt(parts, size), "op2-rebuilt")


def substring_dedup(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_words, n_removed,
    kept_sha256 (of the kept words joined by one space).

    Words are ``[^\\x20\\x09-\\x0D]+``; null and empty texts have none. Rows
    without an id lose nothing and take nothing away; rows that repeat an id
    are judged each, by their own text, and never against each other: as many
    rows come out as go in. An empty table gives an
    empty result; further columns are not read.
    """
    rows, parts = find_repeats(docs, size)
    whole = (F.col("first") < F.col("doc_id")) & (F.col("n_words") >= size)
    found = parts.select("doc_id", "digest", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("sha"))
    return rows.join(found, ["doc_id", "digest"], "left").select(
        "doc_id", "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(whole, F.sha2(F.lit("").cast("binary"), 256))
        .otherwise(F.coalesce("sha", F.lower(F.hex("digest")))).alias("kept_sha256"))
