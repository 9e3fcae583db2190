"""Cross-tokenizer alignment with inverted pair bitmaps.

Every text is encoded by two tokenizers, A and B. Byte offsets at which a
token of both ends cut it into groups; every A token of a group is linked to
every B token of it. A pair of ids counts once for each document that holds
it linked.

1. One pass over the texts encodes, cuts and digests them, and writes the
   index: documents are numbered within blocks of a bounded number of links,
   and each id pair of a block has a compressed bitmap of the documents that
   hold it, kept as planes: a document is in plane k if bit k of its number of
   links of the pair is set. Bitmaps of the runs of a block are OR-merged
   before they are written.
2. The document count of a pair is the popcount of its planes OR-merged,
   added up over blocks (which share no document) by a map-side combining sum.
   The highest count of an A id follows from the pairs' counts.
3. Counts go to the blocks that hold the pair, and the postings return scores:
   a block adds, for every pair and plane, count * 2**k to the documents of
   the plane. All sums of a document are complete in its block.

Tokenizers see a text in units that neither merges across (a blank between
two non-blanks starts a token of both), so a unit that comes again is looked
up and not encoded; a unit's groups are its own, as both tokens end with it.

A hot pair is one row a block; a hot text or source changes nothing. A block
is one row of the index, and no task holds more than a few blocks.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aevia.llm.common import read_bytes, saved
from aevia.llm.units import Grown, UnitTable, cached, slices

BLOCK_LINKS = 2_000_000  # distinct (pair, document) entries after which a block is closed
BLOCK_DOCS = 1 << 16  # positions in a block take 16 bits
SMALL_GROUP = 64  # links of a group that are listed one by one
UNITS = 300_000  # kept by a worker
SPELLED_BYTE = re.compile("<0x[0-9A-F]{2}>")
_WHOLE = re.compile(r"\S\Z")
_CUT = re.compile(r"(?<=\S)(?= +\S)")  # Python's blanks include those of both tokenizers


def _byte_alphabet() -> dict[str, int]:
    """Characters of byte-level vocabularies to the bytes they stand for:
    printable Latin-1 stands for itself, the others for 256 and up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Pair:
    """The two tokenizers and the bytes of their tokens."""

    def __init__(self, json_a: bytes, model_b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(json_a.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        alphabet = _byte_alphabet()
        size = self.a.get_vocab_size()
        self.bytes_a = [bytes(alphabet[c] for c in self.a.id_to_token(i)) if all(c in alphabet for c in self.a.id_to_token(i)) else b""
                        for i in range(size)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if SPELLED_BYTE.fullmatch(p) and self.b.is_byte(i)
                        else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.size_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], np.int64)

    def spell(self, text: str, raw: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of A and B of a text that starts with a blank; None if the
        bytes of either are not the text's."""
        x = self.a.encode(text, add_special_tokens=False).ids
        y = self.b.encode(text[1:], num_threads=1)
        sound = b"".join([self.bytes_a[i] for i in x]) == raw and b"".join([self.bytes_b[i] for i in y]) == raw
        return (np.array(x, np.int64), np.array(y, np.int64)) if sound else None


def group_links(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs and links of one group: a pair's number is the product
    of how often its ids stand in the group, so a long group costs its
    distinct ids, not its links."""
    ua, na = np.unique(x, return_counts=True)
    ub, nb = np.unique(y, return_counts=True)
    return (ua[:, None] << 32 | ub).ravel(), np.outer(na, nb).ravel()


class AlignedUnits(UnitTable):
    """Per unit: numbers of ids, groups and links, its groups as text, its
    pairs and their links."""

    RUN = 2_000  # units encoded as one text

    def __init__(self, pair: Pair, limit: int = UNITS):
        self.pair = pair
        super().__init__(limit)

    def reset(self) -> None:
        self.figures, self.text = Grown(np.int64), []  # n_a (-1: not sound), n_b, n_groups, n_links
        self.key, self.times = Grown(np.int64), Grown(np.int64)
        self.start, self.length = Grown(np.int64), Grown(np.int32)

    def compute(self, units: list[str]) -> None:
        # a unit that ends with a blank may not stand before another one
        alone = [len(u) > 1000 or not _WHOLE.search(u) for u in units]
        at = 0
        while at < len(units):
            stop = at + 1
            while not alone[at] and stop < len(units) and stop - at < self.RUN and not alone[stop]:
                stop += 1
            self.add(units[at:stop])
            at = stop

    def add(self, units: list[str]) -> None:
        text = "".join(units)
        raw = text.encode()
        ends = np.cumsum([len(u.encode()) for u in units])
        ids = self.pair.spell(text, raw)
        if ids is None and len(units) > 1:
            for u in units:
                self.add([u])
            return
        if ids is None:
            self.figures.add([-1, 0, 0, 0])
            self.text.append("")
            self.start.add([self.key.n])
            self.length.add([0])
            return
        x, y = ids
        end_a, end_b = np.cumsum(self.pair.size_a[x]), np.cumsum(self.pair.size_b[y])
        both = np.intersect1d(end_a, end_b, assume_unique=True)
        stop_a, stop_b = np.searchsorted(end_a, both) + 1, np.searchsorted(end_b, both) + 1
        p, q = np.diff(stop_a, prepend=0), np.diff(stop_b, prepend=0)
        unit = np.searchsorted(ends, both)  # units end where groups end
        small = p * q <= SMALL_GROUP  # all links of these at once, a pair as often as it comes
        m, n = (p * q)[small], q[small]
        nth = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
        first_a, first_b, n = np.repeat((stop_a - p)[small], m), np.repeat((stop_b - q)[small], m), np.repeat(n, m)
        keys, times, owner = [x[first_a + nth // n] << 32 | y[first_b + nth % n]], [np.ones(len(nth), np.int64)], [np.repeat(unit[small], m)]
        for g in np.flatnonzero(~small):
            k, n = group_links(x[stop_a[g] - p[g]: stop_a[g]], y[stop_b[g] - q[g]: stop_b[g]])
            keys.append(k)
            times.append(n)
            owner.append(np.full(len(k), unit[g]))
        owner = np.concatenate(owner)
        order = np.argsort(owner, kind="stable")
        length = np.bincount(owner, minlength=len(units))
        self.start.add(self.key.n + np.cumsum(length) - length)
        self.length.add(length)
        self.key.add(np.concatenate(keys)[order])
        self.times.add(np.concatenate(times)[order])
        n = [np.bincount(unit, w, len(units)) for w in (p, q, np.ones(len(p)), p * q)]
        self.figures.add(np.stack(n, axis=1).astype(np.int64).ravel())
        a, b = list(map(str, x.tolist())), list(map(str, y.tolist()))
        said = [f"{','.join(a[i - m: i])}|{','.join(b[j - n: j])}" for i, m, j, n in
                zip(stop_a.tolist(), p.tolist(), stop_b.tolist(), q.tolist())]
        cuts = np.searchsorted(unit, np.arange(len(units) + 1)).tolist()
        self.text += [";".join(said[i:j]) for i, j in zip(cuts, cuts[1:])]

    def align(self, texts: list[str]):
        """Of texts: figures (n, 4), digests, and the distinct (document,
        pair, links) in order of document, then pair. Unsound texts have no
        tokens."""
        units, counts = [], []
        for t in texts:
            u = _CUT.split(" " + t) if t else []
            units += u
            counts.append(len(u))
        rows = self.rows(units)
        doc = np.repeat(np.arange(len(texts)), counts)
        each = self.figures.data[: self.figures.n].reshape(-1, 4)[rows]
        sound = np.array([t != "" for t in texts], bool)
        sound[doc[each[:, 0] < 0]] = False
        figures = np.zeros((len(texts), 4), np.int64)
        held = sound[doc]
        np.add.at(figures, doc[held], each[held])
        ends = np.cumsum(counts)
        digests = ["" if not s else hashlib.sha256(";".join([self.text[r] for r in rows[e - n: e].tolist()]).encode()).hexdigest()
                   for s, e, n in zip(sound.tolist(), ends.tolist(), counts)]
        rows, doc = rows[held], doc[held]
        n = self.length.data[rows]
        stop = np.cumsum(n)
        at = np.arange(n.sum()) + np.repeat(self.start.data[rows] - (stop - n), n)
        return figures, digests, *_merged(np.repeat(doc, n), self.key.data[at], self.times.data[at])


def _merged(doc: np.ndarray, key: np.ndarray, times: np.ndarray):
    """Distinct (document, pair) in order, their links added up."""
    order = np.lexsort((key, doc))
    doc, key, times = doc[order], key[order], times[order]
    new = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (key[1:] != key[:-1]))) if len(doc) else np.zeros(0, np.int64)
    return doc[new], key[new], np.add.reduceat(times, new) if len(new) else times


# ---- bitmaps --------------------------------------------------------------
# A posting of a block is, per pair, its planes one after the other. A plane is
# (k, kind, bytes): kind 0 lists positions as u16, kind 1 is a bitset of the
# block's documents, whichever is shorter.

def planes(key: np.ndarray, position: np.ndarray, times: np.ndarray, documents: int):
    """Entries (in order of pair, then position) as planes: arrays of pair,
    k, kind and number of bytes, and the bytes."""
    found, parts, bits = [(key[:0], key[:0], key[:0] > 0, key[:0])], [], -(-documents // 8)
    for k in range(int(times.max(initial=0)).bit_length()):
        on = (times >> k) & 1 == 1
        own, place = key[on], position[on].astype("<u2")
        first = np.flatnonzero(np.append(True, own[1:] != own[:-1])[: len(own)])
        n = np.diff(np.append(first, len(own)))
        dense = 2 * n > bits
        found.append((own[first], np.full(len(first), k), dense, np.where(dense, bits, 2 * n)))
        data, at = place.tobytes(), 0
        for g in np.flatnonzero(dense):
            i, j = int(first[g]), int(first[g] + n[g])
            full = np.zeros(8 * bits, np.uint8)
            full[place[i:j]] = 1
            parts += [data[2 * at: 2 * i], np.packbits(full).tobytes()]
            at = j
        parts.append(data[2 * at:])
    return (*(np.concatenate(c) for c in zip(*found)), b"".join(parts))


def opened(key, k, kind, size, data: bytes, documents: int):
    """``planes`` back to entries: the plane, pair, k and position of every
    bit set."""
    start, listed = np.cumsum(size) - size, np.flatnonzero(~kind)
    n = size[listed] // 2
    at = np.repeat(start[listed] - 2 * (np.cumsum(n) - n), n) + 2 * np.arange(n.sum())
    raw = np.frombuffer(data, np.uint8)
    out = [(np.repeat(listed, n), raw[at].astype(np.int64) | raw[at + 1].astype(np.int64) << 8)]
    for i in np.flatnonzero(kind):
        place = np.flatnonzero(np.unpackbits(raw[start[i]: start[i] + size[i]], count=documents))
        out.append((np.full(len(place), i), place))
    plane, place = (np.concatenate(c) for c in zip(*out))
    return plane, key[plane], k[plane], place


INDEX = ("block long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
         "digests array<string>, pairs array<long>, plane array<short>, bitset array<boolean>, size array<int>, bits binary")


class _Block:
    """Documents of a block and their entries, run by run."""

    def __init__(self):
        self.doc_ids, self.figures, self.digests, self.entries, self.size = [], [], [], [], 0

    def add(self, ids, figures, digests, doc, key, times) -> None:
        self.entries.append((doc + len(self.doc_ids), key, times))
        self.doc_ids += ids
        self.figures.append(figures)
        self.digests += digests
        self.size += len(doc)

    def row(self, number: int) -> pa.RecordBatch:
        # the runs' bitmaps merged: entries by pair, then position
        doc, key, times = (np.concatenate(c) for c in zip(*self.entries))
        order = np.lexsort((doc, key))
        figures = np.concatenate(self.figures)
        pairs, k, kind, size, data = planes(key[order], doc[order], times[order], len(self.doc_ids))
        lists = [pa.array([x], pa.list_(t)) for x, t in (
            (self.doc_ids, pa.int64()), *((figures[:, i], pa.int64()) for i in range(4)), (self.digests, pa.string()),
            (pairs, pa.int64()), (k, pa.int16()), (kind, pa.bool_()), (size, pa.int32()))]
        return pa.record_batch([pa.array([number], pa.int64()), *lists, pa.array([data], pa.binary())],
                               names=[c.split(" ")[0] for c in INDEX.split(", ")])


def build_index(docs: DataFrame, json_path: str, model_path: str, block_links: int = BLOCK_LINKS,
                block_docs: int = BLOCK_DOCS) -> DataFrame:
    """A row for each block of ``docs(doc_id, text)``: its documents with
    their figures and digests, and the planes of its pairs."""
    json_a, model_b = read_bytes(json_path), read_bytes(model_path)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = cached((hash(json_a), hash(model_b), "alignment"), lambda: AlignedUnits(Pair(json_a, model_b)))
        number, block = TaskContext.get().partitionId() << 32, _Block()
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at, run in slices(texts, 500_000):
                for i in range(0, len(run), block_docs):
                    part = run[i: i + block_docs]
                    if block.size >= block_links or len(block.doc_ids) + len(part) > block_docs:
                        yield block.row(number)
                        number, block = number + 1, _Block()
                    block.add(keys[at + i: at + i + len(part)], *table.align(part))
        if block.doc_ids:
            yield block.row(number)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(blocks, INDEX)


def _column(batch: pa.RecordBatch, name: str, row: int):
    return batch.column(batch.schema.get_field_index(name))[row]


def _planes_of(batch: pa.RecordBatch, row: int):
    arrays = [_column(batch, c, row).values for c in ("pairs", "plane", "bitset", "size")]
    key, k, kind, size = (a.to_numpy(zero_copy_only=False) for a in arrays)
    return key, k.astype(np.int64), kind.astype(bool), size.astype(np.int64), _column(batch, "bits", row).as_py(), len(_column(batch, "doc_ids", row).values)


def block_counts(index: DataFrame) -> DataFrame:
    """(pair, held, links): per block and pair the popcount of the planes
    OR-merged, and the links by the planes' popcounts."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                *packed, documents = _planes_of(batch, r)
                _, key, k, place = opened(*packed, documents)
                pairs, own = np.unique(key, return_inverse=True)
                links = np.bincount(own, np.exp2(k), len(pairs)).astype(np.int64)
                # OR of the planes: a document counts once, whichever bits are set
                merged = np.unique(own * np.int64(documents or 1) + place)
                held = np.bincount(merged // (documents or 1), minlength=len(pairs))
                yield pa.record_batch([pa.array(pairs), pa.array(held.astype(np.int32)), pa.array(links)], names=["pair", "held", "links"])

    kept = ["doc_ids", "pairs", "plane", "bitset", "size", "bits"]
    return index.select(*kept).mapInArrow(rows, "pair long, held int, links long")


def pair_counts(counts: DataFrame) -> DataFrame:
    """(pair, a_id, b_id, documents, links, best): corpus-wide, ``best`` if
    no pair of the A id is in more documents."""
    a = F.shiftright("pair", 32).cast("int")
    pairs = saved(counts.groupBy("pair").agg(F.sum("held").alias("documents"), F.sum("links").alias("links")), "op13-pairs")
    pairs = pairs.withColumn("a_id", a).withColumn("b_id", F.col("pair").bitwiseAND(0xFFFFFFFF).cast("int"))
    # at most one row an A id: the size of a vocabulary
    top = pairs.groupBy("a_id").agg(F.max("documents").alias("most"))
    return pairs.join(F.broadcast(top), "a_id").select(
        "pair", "a_id", "b_id", "documents", "links", (F.col("documents") == F.col("most")).alias("best"))


def scored(index: DataFrame, pairs: DataFrame) -> DataFrame:
    """The documents of ``index`` with n_best and count_sum, which their
    block's postings return."""
    each = index.select("block", F.explode(F.array_distinct("pairs")).alias("pair"))
    told = each.join(pairs.select("pair", "documents", "best"), "pair")
    by_block = told.groupBy("block").agg(F.collect_list(F.struct("pair", "documents", "best")).alias("told"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                *packed, documents = _planes_of(batch, r)
                _, key, k, place = opened(*packed, documents)
                given = _column(batch, "told", r).values
                best, total = np.zeros(documents, np.int64), np.zeros(documents, np.int64)
                if given is not None and len(given):
                    name, n, top = (given.field(i).to_numpy(zero_copy_only=False) for i in range(3))
                    order = np.argsort(name)
                    own = order[np.searchsorted(name, key, sorter=order)]
                    times = np.left_shift(np.int64(1), k)
                    np.add.at(best, place, np.where(top[own].astype(bool), times, 0))
                    np.add.at(total, place, times * n[own].astype(np.int64))
                column = {c: _column(batch, c, r).values for c in ("doc_ids", "n_a", "n_b", "n_groups", "n_links", "digests")}
                yield pa.record_batch([
                    *(column[c] for c in ("doc_ids", "n_a", "n_b", "n_groups", "n_links")), pa.array(best), pa.array(total),
                    column["digests"]], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return index.join(by_block, "block", "left").mapInArrow(
        rows, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def align(docs: DataFrame, json_path: str, model_path: str, block_links: int = BLOCK_LINKS,
          block_docs: int = BLOCK_DOCS) -> tuple[DataFrame, DataFrame]:
    """Documents and pairs of ``docs(doc_id, text)``.

    Documents, one row per row: doc_id, n_a, n_b (ids of A and B), n_groups,
    n_links, n_best (links whose pair is in as many documents as any of its A
    id), count_sum (the pairs' document counts over all links),
    groups_sha256. A text that is null or empty, or that the tokens of A or B
    do not spell, has no tokens: zeros and an empty digest. Rows that repeat
    are documents each; an empty table gives empty results; further columns
    are not read.

    Pairs: a_id, b_id, documents, links, best.
    """
    index = saved(build_index(docs, json_path, model_path, block_links, block_docs), "op13-index")
    pairs = saved(pair_counts(block_counts(index)), "op13-counts")
    return scored(index, pairs), pairs
