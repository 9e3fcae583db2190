"""Quality rules: base counts and a hashed n-gram likelihood ratio.

The verdict compares two multinomials over hashed word n-grams (single words
and word pairs, ``BUCKETS`` buckets): the trusted target (documents labelled
good) and the raw corpus (all documents). A document's score is the mean log
ratio of its n-grams; documents below ``MIN_SCORE`` are rejected, all by the
same fixed threshold.

Only DataFrame functions. Counting explodes bucket numbers and combines them
map-side into at most ``BUCKETS`` rows a task; the log ratios (one double a
bucket, whatever the corpus) go back as a literal array, so scoring and the
base counts are one map-only pass over the text. Only documents that a bitmap
filter of the trusted ids lets through are shuffled, to meet these ids.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aevia.llm.common import bind, saved, words_of

BUCKETS = 1 << 16
PRIOR = 100
MIN_SCORE = -0.1
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The ids of all documents labelled good, each once, saved, so that the
    join with the documents can be split at a hot id."""
    return saved(labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct(), "op6-trusted")


def hashed(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def joined(hashes: Column, step: int) -> Column:
    """Hash of each element with the one ``step`` places on (past the end:
    of the element alone)."""
    return F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + step)))


def bucket(h: Column, buckets: int) -> Column:
    return F.pmod(h, F.lit(buckets)).cast("int")


#: Bits of the filter of trusted ids: 4 MB in all, whatever the corpus.
FILTER_BITS = 1 << 25
PIECE_BITS = 32_768  # of one bitmap of the SQL functions


def perhaps_trusted(docs: DataFrame, trusted: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """The rows of ``docs`` whose id may be trusted: all that are, and few
    others. The ids' hashes are set in bitmaps of a fixed total size (a proven
    bound, so they are broadcast), and the texts of other documents never
    leave their task."""
    def place(doc_id: Column) -> Column:
        return F.pmod(F.xxhash64(doc_id.cast("long")), F.lit(bits))

    at = place(F.col("doc_id"))
    pieces = trusted.select(at.alias("at")).groupBy(F.floor(F.col("at") / PIECE_BITS).alias("piece")).agg(
        F.bitmap_construct_agg((F.col("at") % PIECE_BITS).cast("long")).alias("bitmap"))
    rows = docs.select("doc_id", "text", at.alias("at")).withColumn("piece", F.floor(F.col("at") / PIECE_BITS))
    bit = (F.col("at") % PIECE_BITS).cast("int")
    byte = F.conv(F.hex(F.substring(F.col("bitmap"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    held = byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), bit % 8 + 1)) != 0
    return rows.join(F.broadcast(pieces), "piece").where(held).select("doc_id", "text")


def bucket_counts(texts: DataFrame, buckets: int) -> list[int]:
    """How many words and word pairs of ``texts(text)`` fall into each
    bucket."""
    grams = texts.select(hashed(words_of(F.col("text"))).alias("h")).select(
        F.explode(F.concat("h", joined(F.col("h"), 1))).alias("h"))
    out = [0] * buckets
    for b, n in grams.groupBy(bucket(F.col("h"), buckets).alias("b")).agg(F.count("*").alias("n")).collect():
        out[b] = n
    return out


def fit_log_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> list[float]:
    """log(target share / raw share) by bucket. ``PRIOR`` n-grams of the
    overall mix are added to every bucket, so buckets that are rarely met say
    little. All documents count as raw, all trusted ones as target."""
    raw = bucket_counts(docs, buckets)
    # a merge join at every size: both sides are split at a hot id
    # (an inner join with distinct ids: a semi join would be moved below the filter)
    good = perhaps_trusted(docs, trusted).join(trusted.select(F.col("doc_id").cast("long")).hint("merge"), "doc_id")
    target = bucket_counts(good, buckets)
    if not sum(target):
        return [0.0] * buckets
    share = sum(target) / sum(raw)
    return [math.log((t + PRIOR * share) / ((r + PRIOR) * share)) for t, r in zip(target, raw)]


def repeat_words(h4: Column, n: Column) -> Column:
    """Words inside an 8-word window that occurs twice or more in the text,
    from the hashes of its 4-word runs.

    Without a repeated 4-word run there is none, which settles most texts.
    Else: hash the windows, sort (hash, position), keep those with an equal
    neighbour and add up the union of their 8-word spans in order."""
    runs = F.slice(h4, 1, F.greatest(n - 3, F.lit(0)).cast("int"))
    windows = F.slice(joined(h4, 4), 1, F.greatest(n - 7, F.lit(0)).cast("int"))
    at = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twice(s: Column) -> Column:
        kept = F.filter(F.transform(s, lambda x, k: F.when(
            (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]), x["i"])), lambda i: i.isNotNull())
        return F.sort_array(kept)

    def union(p: Column) -> Column:
        return F.aggregate(
            F.transform(p, lambda i, k: F.least(F.coalesce(F.get(p, k + 1) - i, F.lit(WINDOW)), F.lit(WINDOW)).cast("long")),
            F.lit(0).cast("long"), lambda a, b: a + b)

    covered = bind(bind(at, twice), union)
    return F.when((n >= WINDOW) & (F.size(F.array_distinct(runs)) < F.size(runs)), covered).otherwise(F.lit(0).cast("long"))


def quality_rules(docs: DataFrame, log_ratios: list[float], min_score: float = MIN_SCORE, carry: bool = False) -> DataFrame:
    """One row per document of ``docs(doc_id, text)``: doc_id, n_words,
    word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    score.

    Null and empty texts have no words: every count is 0, base_failed is
    true, kept false, score 0. Repeated rows are judged each; an empty table
    gives an empty result; further columns are not read. With ``carry`` the whole
    input row comes along in a struct column ``doc``.
    """
    buckets = len(log_ratios)
    ratios = F.from_json(F.lit(json.dumps(log_ratios)), "array<double>")

    def total(hashes: Column) -> Column:
        return F.aggregate(hashes, F.lit(0.0), lambda a, h: a + F.element_at(ratios, bucket(h, buckets) + 1))

    def judge(words: Column) -> Column:
        n = F.size(words).cast("long")
        figures = bind(hashed(words), lambda h1: bind(joined(h1, 1), lambda h2: bind(joined(h2, 2), lambda h4: F.struct(
            n.alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            repeat_words(h4, n).alias("n_repeat_words"),
            F.when(n > 0, (total(h1) + total(h2)) / (2 * n)).otherwise(0.0).alias("score")))))
        return bind(figures, decide)

    def decide(f: Column) -> Column:
        failed = (f["n_words"] < MIN_WORDS) | (100 * f["n_repeat_words"] > MAX_REPEAT_PERCENT * f["n_words"])
        names = ["n_words", "word_chars", "n_repeat_words", "score"]
        return F.struct(*[f[c].alias(c) for c in names], failed.alias("base_failed"),
                        (~failed & (f["score"] >= min_score)).alias("kept"))

    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^ \\t-\\r]"))
    mine = [F.struct(*docs.columns).alias("doc")] if carry else []
    judged = docs.select(
        *mine, "doc_id", bind(words_of(text), judge).alias("v"),
        (F.length(text) - F.length(F.regexp_replace(text, "[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        bind(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"))
    return judged.select(
        *(["doc"] if carry else []), "doc_id", "v.n_words", "v.word_chars", "n_symbols", "n_dup_lines",
        "v.n_repeat_words", "v.base_failed", "v.kept", "v.score")
