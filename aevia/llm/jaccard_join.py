"""N-gram Jaccard join by T-occurrence search.

Two documents link when ``100 |A & B| >= percent |A | B|`` over their sets
of word shingles. The result is the connected component of every document.

1. Documents of equal sets form a class (a 128-bit key); classes are what is
   joined, copies only inherit the component.
2. Signatures. Linked sets differ in at most ``k = (1 - j)/(1 + j)
   (|A| + |B|)`` elements. Sizes fall into bands; in a band the hash range is
   cut into more than ``k`` parts, so linked sets agree on whole parts, and
   the hash of a part's elements is a signature they share. Spare parts cover
   empty ones (which agree without saying anything), as many as the least set
   of the band is expected to leave; a set with more empty
   parts than spares is cut again by another hash, so every linked pair
   shares the signature of a part that holds elements. A set near the next
   band is signed in both. Unlike single shingles, parts are shared by near
   copies only, not by common phrases, and nothing depends on frequencies.
3. Cells. Every shared signature has a leader (the least class key); a class
   goes into the cell of each leader it meets. Both ends of a link share a
   signature, so they share a cell. Large cells are dealt into blocks.
4. In a block, members are first held against the cell's leader; those that
   link to it are one component and need not be compared with each other.
   The others are queries: T-occurrence search over inverted lists of
   shingles (``divide_skip``). Queries of a cell with several blocks are dealt
   into parts of a block's size, and every part is also held against every
   other block: a task has one block and one part, however large the cell.
5. Links (a spanning forest per block) are joined up into components by
   repeated least-neighbour contraction, one checkpointed table a round.

Only keys, signatures and the sets of documents that share a signature are
shuffled. Hot signatures combine map-side into one row a task; the join back
is between two saved tables, which AQE splits; a hot cell is many blocks.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aevia.llm.common import saved
from aevia.llm.shingles import mix, shingle_set, word_hashes

WORDS = 3
PERCENT = 90
#: Shingles in a block of a cell: 8 bytes each in a task's memory.
BLOCK_SHINGLES = 1 << 18
BAND = 1.6
MAX_CUTS = 64


def links(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def needed_overlap(n: np.ndarray, m, percent: int):
    """Least ``|A & B|`` of linked sets of ``n`` and ``m`` elements."""
    return -(-(percent * (n + m)) // (100 + percent))


def most_differences(n, percent: int):
    """Most elements in which linked sets of ``n`` elements together differ."""
    return n * (100 - percent) // (100 + percent)


@functools.cache
def parts_for(n: int, k: int) -> int:
    """The least number of parts, ``k + 1`` and spares, of which a set of
    ``n`` elements is expected to leave no more than the spares empty, with
    two standard deviations to go; at least ``2 + k // 32`` are spares. For
    sets too small for any number, that least."""
    least = k + 3 + k // 32

    def fits(parts: int) -> bool:
        load = n / parts
        empty = parts * np.exp(-load)
        spread = parts * max(0.0, np.exp(-load) - (1 + load) * np.exp(-2 * load))
        return empty + 2 * np.sqrt(spread) <= parts - k - 1

    low, high = least, max(least, 4 * n)
    if not fits(high):
        return least
    while low < high:  # more parts leave more of them filled
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid + 1, high)
    return low


def signatures(s: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Hashes such that any linked sets share one at least (equal sets
    aside, which are one class)."""
    n = len(s)
    if n == 0:
        return s
    own = int(np.floor(np.log(n) / np.log(BAND) + 1e-9))
    out = []
    for band in (own, own + 1):
        low, high = BAND**band, BAND ** (band + 1)
        # the larger set of a pair decides the band; it is at most 100/percent times as large
        if band > own and n * 100 < percent * np.floor(low):
            continue
        k = int(most_differences(2 * int(np.ceil(high)), percent))
        if k == 0:
            continue  # linked sets this small are equal
        parts = parts_for(-(-percent * int(np.floor(low)) // 100), k)
        spare = parts - k - 1
        for cut in range(MAX_CUTS):
            seed = np.uint64((band << 8 | cut) + 1)
            h = np.sort(mix(s ^ mix(np.full(1, seed, np.uint64))))
            part = ((h >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            begin = np.flatnonzero(np.diff(part, prepend=part[0] + np.uint64(1)))
            # a sum of mixed hashes names a set; the part and the cut are mixed in
            name = np.add.reduceat(mix(h), begin) + (part[begin] << np.uint64(14)) + seed
            out.append(mix(name))
            if parts - len(begin) <= spare:
                break
        else:
            # a set that never spreads (a handful of elements) also goes by its single elements
            out.append(mix(s + np.uint64(band)))
    return np.unique(np.concatenate(out)) if out else np.zeros(0, np.uint64)


def divide_skip(query: np.ndarray, lists: dict, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Rows whose set reaches the overlap that a link with ``query`` needs.

    ``lists``: sorted rows by shingle. The ``L`` longest lists are set aside;
    a row must then be in ``T - L`` of the short ones, which are merged and
    counted; only such rows are probed in the long ones by binary search.
    """
    found = [r for r in (lists.get(h) for h in query.tolist()) if r is not None]
    n = len(query)
    least = -(-(percent * n) // 100)  # the least overlap with any partner
    if len(found) < least:
        return np.zeros(0, np.int64)
    found.sort(key=len)
    # lists aside cost a probe a row, lists merged cost their length
    aside = min(int(least / (1 + 0.02 * np.log2(1 + len(found[-1])))), least - 1)
    short, long_ = found[: len(found) - aside], found[len(found) - aside:]
    rows, count = np.unique(np.concatenate(short), return_counts=True)
    fit = (100 * sizes[rows] >= percent * n) & (percent * sizes[rows] <= 100 * n)
    need = needed_overlap(n, sizes[rows], percent)
    fit &= count + aside >= need
    rows, count, need = rows[fit], count[fit], need[fit]
    for k, r in enumerate(reversed(long_)):
        if not len(rows):
            break
        at = np.minimum(np.searchsorted(r, rows), len(r) - 1)
        count = count + (r[at] == rows)
        fit = count + (aside - k - 1) >= need
        rows, count, need = rows[fit], count[fit], need[fit]
    return rows


class Forest:
    """Union-find over the rows of a block."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)
        return i != j


def search_block(sets: list[np.ndarray], queries: list[int], forest: Forest, percent: int) -> list[tuple[int, int]]:
    """Links that join two trees of ``forest``, from a T-occurrence search of
    each query row over all rows."""
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    rows = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, rows = flat[order], rows[order]
    begin = np.flatnonzero(np.diff(flat, prepend=flat[0] ^ np.uint64(1))) if len(flat) else np.zeros(0, int)
    ends = np.append(begin[1:], len(flat))
    several = ends - begin > 1  # a shingle of one set meets nobody
    lists = {h: rows[a:b] for h, a, b in zip(flat[begin[several]].tolist(), begin[several].tolist(), ends[several].tolist())}
    out = []
    for q in queries:
        for r in divide_skip(sets[q], lists, sizes, percent).tolist():
            if r != q and forest.root(q) != forest.root(r) and links(sets[q], sets[r], percent):
                forest.join(q, r)
                out.append((q, r))
    return out


_BLOCK = "leader binary, block int, blocks int, key binary, shingles binary, query boolean"


def _unpack(frame: pd.DataFrame) -> list[np.ndarray]:
    return [np.frombuffer(b, "<u8") for b in frame["shingles"]]


def _star_and_search(frame: pd.DataFrame, percent: int) -> pd.DataFrame:
    """A block of a cell: links found, and for cells of several blocks the
    members, marked as queries where they don't link to the leader."""
    frame = frame.drop_duplicates("key").sort_values("key", ignore_index=True)
    sets, keys = _unpack(frame), frame["key"].tolist()
    leader, forest, found = frame["leader"].iloc[0], Forest(len(frame)), []
    at = keys.index(leader)
    for i, s in enumerate(sets):
        if i != at and links(sets[at], s, percent):
            forest.join(at, i)
            found.append((at, i))
    apart = [forest.root(i) != forest.root(at) for i in range(len(sets))]
    queries = [i for i in range(len(sets)) if apart[i]]
    found += search_block(sets, queries, forest, percent)
    out = [(None, None, None, keys[i], None, None, keys[j]) for i, j in found]
    if frame["blocks"].iloc[0] > 1:
        block, blocks = int(frame["block"].iloc[0]), int(frame["blocks"].iloc[0])
        out += [(leader, block, blocks, keys[i], frame["shingles"].iloc[i], apart[i], None)
                for i in range(len(sets)) if i != at or block == 0]
    return pd.DataFrame(out, columns=["leader", "block", "blocks", "key", "shingles", "query", "other"])


def _search_other_blocks(frame: pd.DataFrame, percent: int) -> pd.DataFrame:
    """A part of the queries of other blocks against the members of this one."""
    frame = frame.drop_duplicates("key").sort_values(["query", "key"], ignore_index=True)
    sets, keys, asks = _unpack(frame), frame["key"].tolist(), frame["query"].tolist()
    forest = Forest(len(frame))
    queries = [i for i in range(len(sets)) if asks[i]]
    found = search_block(sets, queries, forest, percent)
    return pd.DataFrame([(keys[i], keys[j]) for i, j in found], columns=["key", "other"])


def shingle_rows(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, key of the set, its signatures."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, keys, signed = [], [], []
            for text in batch.column(1):
                s = shingle_set(word_hashes((text.as_py() or b"").lower().split()), words)
                n.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.astype("<u8").tobytes()) if len(s) else None)
                signed.append(signatures(s, percent).view(np.int64))
            yield pa.record_batch([
                batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(signed, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "key", "signatures"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(
        rows, "doc_id long, n_shingles long, key binary, signatures array<long>")


def cells_of(rows: DataFrame) -> DataFrame:
    """(leader, key, doc_id, n_shingles, blocks): classes by the leaders of
    the signatures that they share with another class."""
    signed = rows.where("doc_id is not null").select("key", "doc_id", "n_shingles", F.explode("signatures").alias("signature"))
    shared = saved(
        signed.groupBy("signature").agg(F.min("key").alias("leader"), F.max("key").alias("last"))
        .where("leader != last").drop("last"), "op3-shared")
    members = saved(
        signed.join(shared, "signature").groupBy("leader", "key")
        .agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles")), "op3-members")
    sizes = members.groupBy("leader").agg(F.sum("n_shingles").alias("size"))
    sizes = saved(sizes.select("leader", F.ceil(F.col("size") / BLOCK_SHINGLES).cast("int").alias("blocks")), "op3-cells")
    return members.join(sizes, "leader")


#: What a task of the second search holds: a block and a part of the queries.
SECOND_SEARCH = ["leader", "block", "part"]


def other_blocks(first: DataFrame) -> DataFrame:
    """(leader, block, part, key, shingles, query): the rows of the second
    search. Every query goes, with its part, to the other blocks of its cell,
    every member stays in its block, once a part."""
    members = first.where("other is null").drop("other")
    parts = F.ceil(F.sum(F.length("shingles")) / (8 * BLOCK_SHINGLES)).cast("int")
    asked = saved(members.where("query").groupBy("leader").agg(parts.alias("parts")), "op3-queries")
    part = F.pmod(F.xxhash64("key", F.lit("part")), F.col("parts")).cast("int")
    stay = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: F.struct(
        F.col("block").alias("block"), p.alias("part"), F.lit(False).alias("query")))
    others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: b != F.col("block"))
    go = F.transform(others, lambda b: F.struct(b.alias("block"), part.alias("part"), F.lit(True).alias("query")))
    return members.join(asked, "leader").select(
        "leader", "key", "shingles", F.explode(F.when(F.col("query"), F.concat(stay, go)).otherwise(stay)).alias("b"),
    ).select("leader", "key", "shingles", "b.*")


def find_links(docs: DataFrame, rows: DataFrame, words: int, percent: int) -> DataFrame:
    """(key, other): links that make up the components of the classes."""
    placed = (
        cells_of(rows)
        .withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
        # the leader is in every block of its cell
        .withColumn("block", F.explode(F.when(
            F.col("key") == F.col("leader"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))))
        .groupBy("doc_id", "key").agg(F.collect_list(F.struct("leader", "block", "blocks")).alias("cells"))
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, found = batch.column(1).to_pylist(), []
            for key, text in zip(keys, batch.column(2)):
                s = shingle_set(word_hashes((text.as_py() or b"").lower().split()), words).astype("<u8").tobytes()
                # rows that repeat an id with another text are not this class
                found.append(s if xxhash.xxh3_128_digest(s) == key else None)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(found, pa.binary())],
                                  names=["cells", "key", "shingles"])

    cell = "array<struct<leader:binary,block:int,blocks:int>>"
    members = (
        texts.join(placed, "doc_id").select("cells", "key", "text")
        .mapInArrow(sets, f"cells {cell}, key binary, shingles binary").where("shingles is not null")
        .select(F.explode("cells").alias("c"), "key", "shingles").select("c.*", "key", "shingles")
    )
    first = saved(members.groupBy("leader", "block").applyInPandas(
        lambda f: _star_and_search(f, percent),
        "leader binary, block int, blocks int, key binary, shingles binary, query boolean, other binary"), "op3-links")
    more = other_blocks(first).groupBy(*SECOND_SEARCH).applyInPandas(
        lambda f: _search_other_blocks(f, percent), "key binary, other binary")
    return first.where("other is not null").select("key", "other").unionByName(more)


def components(pairs: DataFrame) -> DataFrame:
    """(node, component) for every node in ``pairs(a, b)``: the least node
    that links lead to. Each round points every node at the least of its
    neighbourhood and carries the rest of the neighbourhood along (large
    star, small star), so chains shorten fast; a round is one saved table."""
    def table(edges: DataFrame) -> tuple[DataFrame, tuple]:
        edges = saved(edges.where("a != b").distinct(), "components")
        return edges, tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    edges, mark = table(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    while True:
        # large star: every larger neighbour of a node goes to the least of the neighbourhood
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = saved(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "components")
        large, _ = table(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        # small star: every smaller neighbour of a node goes, with it, to the least of them
        near = large.join(saved(large.groupBy("a").agg(F.min("b").alias("m")), "components"), "a")
        edges, after = table(near.select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")))
        if after == mark:
            break
        mark = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def keyed_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``jaccard_components`` with the key of each row's set (null for an
    empty one)."""
    rows = saved(shingle_rows(docs, words, percent), "op3-sets")
    classes = saved(rows.where("key is not null and doc_id is not null").groupBy("key").agg(F.min("doc_id").alias("least")), "op3-classes")
    pairs = find_links(docs, rows, words, percent)
    # a node is a class, by its least id; classes that rows of one id belong to stay apart
    ids = classes.select("key", F.struct("least", "key").alias("a"))
    pairs = pairs.join(ids, "key").join(ids.select(F.col("key").alias("other"), F.col("a").alias("b")), "other")
    found = components(pairs.select("a", "b")).select(F.col("node.key").alias("key"), F.col("component.least").alias("component"))
    named = saved(  # classes that link with no other are their own component
        classes.join(found, "key", "left").select("key", F.coalesce("component", "least").alias("component")), "op3-components")
    return rows.join(named, "key", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"), "key")


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_shingles,
    component_id (the least doc_id reachable by links, itself included).

    A-Z are lower-cased; words are ``[^\\x20\\x09-\\x0D]+``. Null or blank
    texts have an empty set and link with nothing; a text of fewer than
    ``words`` words has one shingle. Rows that repeat an id are judged each,
    by their own text; rows without an id link with nothing. An empty table gives an empty result; further columns
    are not read.
    """
    return keyed_components(docs, words, percent).drop("key")


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the
    document of least id stays, with all its columns.

    Every row is judged by its own text, also where ids repeat: of rows with
    the component's id the least set stays, of rows that repeat id and set the
    greatest row (null columns first, then in order of the columns). Rows
    without an id, and those without words, link with nothing and stay, as
    often as they come. An empty table gives an empty result.
    """
    found = saved(keyed_components(docs, words, percent).select("doc_id", "key", "component_id"), "op3-found")
    known = found.where("doc_id is not null and key is not null")
    ids = known.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("component_id").alias("least"))
    one = ids.where("n = 1 and least < doc_id").select("doc_id")
    # ids that several rows share: these rows are told apart by their sets
    shared = saved(ids.where("n > 1").select("doc_id"), "op3-shared-ids")
    left = known.where("component_id = doc_id").join(shared, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("key").alias("key"))

    @F.pandas_udf("binary")
    def set_key(texts: pd.Series) -> pd.Series:
        sets = (shingle_set(word_hashes((t or b"").lower().split()), words) for t in texts)
        return pd.Series([xxhash.xxh3_128_digest(s.astype("<u8").tobytes()) if len(s) else None for s in sets])

    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col("doc_id").cast("long").alias("doc_id"))
    plain = rows.join(one.unionByName(shared), "doc_id", "left_anti").select("doc.*")
    told = rows.join(shared, "doc_id", "left_semi").withColumn("key", set_key(F.col("doc.text").cast("binary")))
    chosen = told.join(left, ["doc_id", "key"]).groupBy("doc_id", "key").agg(F.max("doc").alias("doc"))
    return plain.unionByName(told.where("key is null").select("doc.*")).unionByName(chosen.select("doc.*"))
