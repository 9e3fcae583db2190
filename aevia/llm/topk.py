"""Exact top-k inner-product search by the threshold algorithm.

Candidates are dealt into shards and queries into blocks; one task holds one
(block, shard) cell of bounded size and answers it exactly, and the k best
of a query over its shards are the k best over all. Within a cell every
dimension has its list sorted by value. Sorted access goes down all lists
together (from the top for positive query weights, from the bottom for
negative ones); every row met is scored by random access against all
queries still open, as one matrix product. No unseen row can score more
than the product of the query with the values at the current depth, so a
query closes once its k-th score is above that bound. Rows met by any list
count as seen for all queries of the block, which only makes the seen set
larger. In many dimensions the bound often closes late; once most rows of a
shard are seen the rest are scored too, which is the end of the lists.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aevia.llm.common import saved

SHARD_ROWS = 16_384
BLOCK_ROWS = 4_096
FIRST_DEPTH = 8


def threshold_topk(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int):
    """The k best ``(query_id, vec_id, score)`` of each query among the rows
    ``x``, ties to the smaller id, a query's own id left out."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    n = len(ids)
    # products of whole numbers: float64 is exact below 2**53
    wide = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(1, x.shape[1]) >= 2.0**53
    kind = object if wide else np.float64
    x, q = x.astype(kind), q.astype(kind)
    if wide:
        x, q = (np.vectorize(int, otypes=[object])(a) if a.size else a for a in (x, q))
    lists = np.argsort(x, axis=0, kind="stable")
    up, down = np.where(q > 0, q, 0), np.where(q < 0, q, 0)
    seen, best = np.zeros(n, bool), [([], []) for _ in q]
    open_, depth = np.arange(len(q)), 0
    while len(open_) and not seen.all():
        depth = min(n, 4 * depth or FIRST_DEPTH)
        new = np.zeros(n, bool)
        new[lists[n - depth:].ravel()] = True
        new[lists[:depth].ravel()] = True
        new &= ~seen
        if depth == n or 2 * (seen.sum() + new.sum()) >= n:
            new = ~seen
        at = np.flatnonzero(new)
        seen |= new
        dims = np.arange(x.shape[1])
        bound = up[open_] @ x[lists[n - depth], dims] + down[open_] @ x[lists[depth - 1], dims]
        scores = q[open_] @ x[at].T
        closed = np.zeros(len(open_), bool)
        for j, row in enumerate(open_):
            s, w = scores[j], at
            own = ids[w] != query_ids[row]
            if not own.all():
                s, w = s[own], w[own]
            if len(s) > k and not wide:
                top = s >= np.partition(s, len(s) - k)[len(s) - k]
                s, w = s[top], w[top]
            pairs = sorted(zip([-v for v in s.tolist()] + best[row][0], w.tolist() + best[row][1]))[:k]
            best[row] = [p[0] for p in pairs], [p[1] for p in pairs]
            closed[j] = len(pairs) == k and -pairs[-1][0] > bound[j]
        open_ = open_[~closed]
    return [(int(query_ids[i]), int(ids[w]), -int(s)) for i, (ss, ws) in enumerate(best) for s, w in zip(ss, ws)]


def whole_vectors(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """``(vec_id, x)``: components times ``scale``, floored, as doubles.
    Rows without an id and vectors that are null or hold a null or
    non-finite component are left out."""
    sound = F.forall("embedding", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return (
        embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & sound)
        .select(F.col("vec_id").cast("long").alias("vec_id"),
                F.transform("embedding", lambda e: F.floor(e.cast("double") * scale).cast("double")).alias("x"))
    )


def distinct_vectors(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """``(vec_id, x, dim, is_query, copies)``, saved: rows that repeat both id
    and vector as one, with how many of them are candidates. No query can
    list more than ``k`` of equal rows, so these are at most ``k``."""
    rows = vectors.select("vec_id", "x", is_query.alias("is_query"))
    return saved(rows.groupBy("vec_id", "x").agg(
        F.bool_or("is_query").alias("is_query"), F.least(F.count("*"), F.lit(k)).cast("int").alias("copies"),
    ).select("vec_id", "x", F.size("x").alias("dim"), "is_query", "copies"), "op10-vectors")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, shard_rows: int = SHARD_ROWS,
          block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row of
    ``vectors(vec_id, x)`` where ``is_query`` holds, the ``k`` rows of other
    ids with the highest inner product (all, if fewer), ties to the smaller
    id. Vectors are compared with vectors of the same length only. Rows that
    repeat an id are candidates each and queries each (of rows that repeat the
    vector too, the ``k`` that a query can list are held); equal queries give
    their answer once. An empty table gives no rows."""
    vectors = distinct_vectors(vectors, is_query, k)
    n, n_queries = vectors.agg(F.coalesce(F.sum("copies"), F.lit(0)), F.count_if("is_query")).first()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-n_queries // block_rows))
    spread = F.xxhash64("vec_id", "x")
    each = vectors.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    rows = each.select(
        F.lit(False).alias("is_query"), "vec_id", "x", "dim", F.pmod(F.xxhash64("vec_id", "x", "copy"), F.lit(shards)).cast("int").alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    queries = vectors.where("is_query").select(
        F.lit(True).alias("is_query"), "vec_id", "x", "dim",
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        F.pmod(spread, F.lit(blocks)).cast("int").alias("block"))

    def cell(pdf: pd.DataFrame) -> pd.DataFrame:
        asked = pdf["is_query"].to_numpy(bool)
        dim = int(pdf["dim"].iloc[0])
        x = np.array(pdf["x"].tolist(), dtype=np.float64).reshape(len(pdf), dim)
        ids = pdf["vec_id"].to_numpy(np.int64)
        found = threshold_topk(ids[~asked], x[~asked], ids[asked], x[asked], k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    found = rows.unionByName(queries).groupBy("dim", "block", "shard").applyInPandas(
        cell, "query_id long, vec_id long, score long")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
