"""Quality classifier: supervised subword embeddings.

A text is the average of learned vectors of its hashed features: every word,
and the character n-grams of the word with its borders marked, one feature
for a word that repeats the word before it (a word pair of one bucket), and
one that every text has. A softmax layer over the average gives the
label. Vectors and output layer are trained together by stochastic gradient
descent in numpy, on the driver, over a bounded sample of labelled rows
(``SAMPLE_ROWS`` at most, whatever the table); features of the sample are
made on the executors.

The score of a text only needs, for every word, the sum of its features'
projections on the output layer and their number (and which words repeat). Both are kept per worker
and word, so each whole text costs one lookup a word. The model that is
shipped is one number a bucket. Nothing is shuffled for scoring.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from aevia.llm.units import Grown, UnitTable, cached, slices

SAMPLE_ROWS = 4_000
BUCKETS = 1 << 17
DIM = 8
NGRAMS = (3, 4)
EPOCHS = 8
RATE = 0.3
EVERY_TEXT = 0  # the feature that every text has
SAMPLE_WORDS, SCORED_WORDS = 100_000, 400_000  # words kept by a worker while sampling, scoring
REPEATED = 1  # the feature of a word equal to the one before


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(3)) == 1, F.lit(False))


def word_features(word: str) -> list[int]:
    """Buckets of a word and of its character n-grams."""
    marked = f"<{word}>"
    grams = [marked, *(marked[i: i + n] for n in NGRAMS for i in range(len(marked) - n + 1))]
    return [2 + zlib.crc32(g.encode("utf-8", "surrogatepass")) % (BUCKETS - 2) for g in grams]


class FeatureTable(UnitTable):
    """Features of words, one after the other."""

    def reset(self) -> None:
        self.features, self.start, self.length = Grown(np.int32), Grown(np.int64), Grown(np.int64)

    def compute(self, units: list) -> None:
        found = [word_features(w) for w in units]
        length = np.fromiter(map(len, found), np.int64, len(found))
        self.start.add(self.features.n + np.cumsum(length) - length)
        self.length.add(length)
        self.features.add([f for x in found for f in x])

    def of(self, words: list[str]) -> np.ndarray:
        rows = self.rows(words)
        n, start = self.length.data[rows], self.start.data[rows]
        ends = np.cumsum(n)
        own = self.features.data[np.arange(n.sum()) + np.repeat(start - (ends - n), n)]
        again = np.full(np.count_nonzero(rows[1:] == rows[:-1]), REPEATED, np.int32)
        return np.concatenate((own, again, [EVERY_TEXT]))


def sample_features(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> list:
    """``(label, buckets, counts)`` of at most ``rows`` labelled documents
    that are not held out, chosen by hash of the id. Empty texts have the one
    feature that every text has; of an id that repeats, or has two labels,
    each row counts, within the bound."""
    chosen = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .select("doc_id", F.col("quality").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(rows)
    )

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = FeatureTable(SAMPLE_WORDS)
        for batch in batches:
            keys, texts, labels_ = (batch.column(i).to_pylist() for i in range(3))
            out = [np.unique(table.of((t or "").split()), return_counts=True) for t in texts]
            yield pa.record_batch([
                pa.array(keys, pa.int64()), pa.array(labels_, pa.int32()),
                pa.array([b.astype("<i4").tobytes() for b, _ in out], pa.binary()),
                pa.array([c.astype("<f4").tobytes() for _, c in out], pa.binary())],
                names=["doc_id", "label", "buckets", "counts"])

    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    # rows that repeat a chosen id count too, up to the same bound
    found = sample.select("doc_id", "text", "label").mapInArrow(
        features, "doc_id long, label int, buckets binary, counts binary").orderBy(
        F.xxhash64("doc_id"), "doc_id", "label", "buckets", "counts").limit(rows).collect()
    found.sort(key=lambda r: (r["doc_id"], r["label"], bytes(r["buckets"]), bytes(r["counts"])))
    return [(r["label"], np.frombuffer(r["buckets"], "<i4"), np.frombuffer(r["counts"], "<f4")) for r in found]


@dataclass(frozen=True)
class Model:
    """``weight[f]``: projection of feature f's vector on the difference of
    the two output rows; the softmax of two labels is the logistic of the
    average."""

    weight: np.ndarray

    def key(self) -> int:
        return zlib.crc32(self.weight.tobytes())


def train(sample: list, seed: int = 7, epochs: int = EPOCHS, rate: float = RATE) -> Model:
    """Stochastic gradient descent, one document a step, falling rate. An
    empty sample gives a model that scores every text one half."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    output = np.zeros((2, DIM), np.float32)
    steps, step = epochs * len(sample), 0
    for _ in range(epochs):
        for i in rng.permutation(len(sample)):
            label, buckets, counts = sample[i]
            share = counts / counts.sum()
            hidden = share @ vectors[buckets]
            z = output @ hidden
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            lr = rate * (1 - step / steps)
            back = p @ output
            output -= lr * np.outer(p, hidden)
            # as in the published method, each vector takes the whole step of the average
            vectors[buckets] -= (lr * np.minimum(1, share * len(share)))[:, None] * back
            step += 1
    return Model((vectors @ (output[1] - output[0])).astype(np.float32))


class WordScores(UnitTable):
    def __init__(self, weight: np.ndarray):
        self.weight = weight
        super().__init__(SCORED_WORDS)

    def reset(self) -> None:
        self.sum, self.number = Grown(np.float64), Grown(np.int64)

    def compute(self, units: list) -> None:
        found = [word_features(w) for w in units]
        n = np.fromiter(map(len, found), np.int64, len(found))
        flat = self.weight[[f for x in found for f in x]].astype(np.float64)
        self.sum.add(np.add.reduceat(flat, np.cumsum(n) - n))
        self.number.add(n)

    def score(self, texts: list[str]) -> np.ndarray:
        words, counts = [], []
        for t in texts:
            w = t.split()
            words += w
            counts.append(len(w))
        rows = self.rows(words)
        ends = np.cumsum(counts)
        begin = ends - counts
        again = np.zeros(len(rows), np.int64)
        again[1:] = rows[1:] == rows[:-1]
        again[begin[begin < len(rows)]] = 0  # the first word of a text has none before it

        def sums(values: np.ndarray) -> np.ndarray:
            out, full = np.zeros(len(counts), values.dtype), ends > begin
            if len(values):
                out[full] = np.add.reduceat(values, begin[full])
            return out

        projected = sums(self.sum.data[rows] + again * float(self.weight[REPEATED])) + float(self.weight[EVERY_TEXT])
        mean = projected / (sums(self.number.data[rows] + again) + 1)
        return 1 / (1 + np.exp(-np.clip(mean, -30, 30)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc, score)``: the whole input row in a struct and its score, for
    every row of ``docs`` (its ``text`` is all that is read). A null or
    empty text has the score of the feature that every text has."""
    weight, key = model.weight, model.key()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = cached(("op4-scores", key), lambda: WordScores(weight))
        for batch in batches:
            doc = batch.column(0)
            texts = doc.field("text").to_pylist()
            scores = [table.score(run) for _, run in slices(texts)]
            yield pa.record_batch([doc, pa.array(np.concatenate(scores) if scores else [], pa.float64())],
                                  names=["doc", "score"])

    rows = docs.select(F.struct(*docs.columns).alias("doc"))
    return rows.mapInArrow(scored, StructType([*rows.schema.fields, StructField("score", DoubleType())]))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    return train(sample_features(docs, labels, rows))


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document of ``docs(doc_id, text)``: doc_id, held_out,
    score, predicted. Repeated rows are judged each; a null id is not held
    out; an empty table gives an empty result; only id and text are read."""
    return score(docs.select("doc_id", "text"), model).select(
        "doc.doc_id", held_out(F.col("doc.doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
