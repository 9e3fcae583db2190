"""Byte-level BPE encoding and decoding with Spark higher-order functions.

Merging folds over the bytes of a word: the state is the list of pieces and
the rank of every neighbouring pair; each step merges the first pair of the
lowest rank and looks up the two pairs that this makes. Ranks come from a
literal map of the rank file, dealt by checksum into small maps so that a
lookup reads one or two entries. Byte strings are held as text of the code
points 0-255, one a byte.

Distinct words are folded once: the words of the whole corpus are counted,
and the most frequent (``TABLE_WORDS`` at most, some 64 bytes each) are
folded and broadcast with their ids. Arrow steps cut texts into words, put
the ids of known words in their places and number the other distinct words of
each document; these are folded, once a document, by the same expression, and
saved. The bound decides cost, never ids. The second step reads from there, so
that a task has one Python worker at a time. Decoding joins the byte pieces of
the ids. Documents are never shuffled.
"""

from __future__ import annotations

import base64
import json
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aevia.llm.common import bind, read_bytes, saved
from aevia.llm.units import Grown, UnitTable, byte_level_units, cached, slices

TABLE_WORDS = 600_000
RANK_BUCKETS = 1 << 14
CLASSES = 16  # classes of word counts to a doubling
COUNTED_UNITS = 300_000  # units that a task counts before it passes them on
TABLE_UNITS = 300_000  # units whose ids a worker keeps
STEP_ROWS = 256  # documents whose ids are put together at a time
#: White space as the pattern's engine has it; ``\\s`` of Python holds more.
WHITE = r" \t-\r\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"


def spelled_out(pattern: str) -> str:
    """The tokenizer's pattern with white space spelled out."""
    return (pattern.replace(r"[^\s", "[^" + WHITE).replace(r"(?!\S)", f"(?![^{WHITE}])")
            .replace(r"|\s+", f"|[{WHITE}]+"))


def word_finder(pattern: str):
    """A function from a unit (see ``byte_level_units``) to its words."""
    import regex

    find = regex.compile(pattern).findall
    return lambda unit: find(unit[0] if isinstance(unit, tuple) else " " + unit)


def literal_map(entries: dict, buckets: int, value_type: str) -> Column:
    """A constant map, dealt into small maps by the keys' checksums. It is
    parsed once per plan; bind it, so that a plan holds it once."""
    dealt: list[dict] = [{} for _ in range(buckets)]
    for key, value in entries.items():
        dealt[zlib.crc32(key.encode()) & (buckets - 1)][key] = value
    return parsed(json.dumps(dealt, separators=(",", ":")), value_type)


def parsed(text: str, value_type: str) -> Column:
    return F.from_json(F.lit(text), f"array<map<string,{value_type}>>")


def bucket_of(key: Column, buckets: int) -> Column:
    return F.crc32(key).bitwiseAND(F.lit(buckets - 1)).cast("int")


def look_up(table: Column, buckets: int, key: Column) -> Column:
    """The value of a key in such a map, null if absent."""
    return F.element_at(F.element_at(table, bucket_of(key, buckets) + 1), key)


def read_ranks(path: str) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, read_bytes(path).splitlines()) if a}


class WordIds(UnitTable):
    """Ids of units by the ids of known words; the n-th other word met is
    held as ``-1 - n``. Known words stay in their Arrow column and are found
    by hash; of two that share one, the second counts as another word."""

    def __init__(self, known: pa.Table, pattern: str):
        self.words = word_finder(pattern)
        known = known.combine_chunks()
        self.known = pa.concat_arrays(known["word"].chunks) if known.num_rows else pa.array([], pa.string())
        ids = pa.concat_arrays(known["ids"].chunks) if known.num_rows else pa.array([], pa.list_(pa.int32()))
        values, self.known_ends = flat(ids)
        self.known_ids = values.to_numpy()
        hashes = np.zeros(len(self.known), np.int64)
        for at in range(0, len(hashes), 50_000):
            part = self.known.slice(at, 50_000).to_pylist()
            hashes[at: at + len(part)] = list(map(hash, part))
        self.hashes, self.places = np.unique(hashes, return_index=True)
        super().__init__(TABLE_UNITS)

    def reset(self) -> None:
        self.ids, self.start, self.length = Grown(np.int32), Grown(np.int64), Grown(np.int64)
        self.others: dict[str, int] = {}
        self.other_words: list[str] = []

    def known_places(self, words: list[str]) -> list[int]:
        """The places of words among the known ones, -1 of others."""
        if not len(self.hashes):
            return [-1] * len(words)
        wanted = np.fromiter(map(hash, words), np.int64, len(words))
        at = np.minimum(np.searchsorted(self.hashes, wanted), len(self.hashes) - 1)
        places = self.places[at]
        same = self.known.take(pa.array(places)).to_pylist()
        return [p if w == k and h else -1
                for p, w, k, h in zip(places.tolist(), words, same, (self.hashes[at] == wanted).tolist())]

    def compute(self, units: list) -> None:
        found = [self.words(u) for u in units]
        places = iter(self.known_places([w for words in found for w in words]))
        ids: list[int] = []
        ends = [0]
        for words in found:
            for word in words:
                at = next(places)
                if at >= 0:
                    ids += self.known_ids[self.known_ends[at]: self.known_ends[at + 1]].tolist()
                    continue
                n = self.others.setdefault(word, len(self.others))
                if n == len(self.other_words):
                    self.other_words.append(word)
                ids.append(-1 - n)
            ends.append(len(ids))
        self.start.add(self.ids.n + np.array(ends[:-1], np.int64))
        self.length.add(np.diff(ends))
        self.ids.add(ids)

    def encode(self, texts: list[str]) -> tuple[pa.Array, pa.Array]:
        """Of each text its ids and its other words; the n-th of these is
        ``-1 - n`` among the ids."""
        units, counts = [], [0]
        for t in texts:
            u = byte_level_units(t)
            units += u
            counts.append(len(u))
        rows = self.rows(units)
        ids, ends = gather(self.ids.data, self.start.data[rows], self.length.data[rows])
        ends = ends[np.cumsum(counts)]
        at = np.flatnonzero(ids < 0)
        text = np.searchsorted(ends, at, "right") - 1
        # distinct (text, word) pairs in order, numbered within their text
        pairs, number = np.unique(np.stack([text, -1 - ids[at].astype(np.int64)]), axis=1, return_inverse=True)
        first = np.searchsorted(pairs[0], np.arange(len(texts) + 1))
        ids[at] = first[text] - number.reshape(-1) - 1
        others = pa.array([self.other_words[w] for w in pairs[1].tolist()], pa.string())
        return list_array(ends, pa.array(ids)), list_array(first, others)


def gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``data`` one after the other, and their ends after a 0."""
    ends = np.concatenate(([0], np.cumsum(lengths)))
    return data[np.arange(ends[-1]) + np.repeat(starts - ends[:-1], lengths)], ends


def list_array(ends: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def flat(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The elements of lists without nulls, and the lists' ends after a 0."""
    ends = lists.offsets.to_numpy().astype(np.int64)
    return lists.flatten(), ends - ends[0]


def with_others(ids: pa.Array, other_ids: pa.Array) -> pa.Array:
    """``ids`` of documents with those of their other words in place."""
    values, ends = flat(ids)
    words, word_ends = flat(other_ids)
    pieces, piece_ends = flat(words)
    values = values.to_numpy()
    at = np.flatnonzero(values < 0)
    document = np.searchsorted(ends, at, "right") - 1
    # one run an id: of the id itself, or of a word's ids behind all of them
    starts, lengths = np.arange(len(values)), np.ones(len(values), np.int64)
    word = word_ends[document] - 1 - values[at]
    starts[at], lengths[at] = len(values) + piece_ends[word], np.diff(piece_ends)[word]
    found, found_ends = gather(np.concatenate([values, pieces.to_numpy()]).astype(np.int32), starts, lengths)
    return list_array(found_ends[ends], pa.array(found))


def put_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, STEP_ROWS):
            batch = whole.slice(at, STEP_ROWS)
            ids = with_others(batch.column("ids"), batch.column("others"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])


class Pieces:
    """The bytes of ids."""

    def __init__(self, by_id: list[bytes]):
        self.data = np.frombuffer(b"".join(by_id), np.uint8)
        self.length = np.array([len(p) for p in by_id], np.int64)
        self.start = np.cumsum(self.length) - self.length

    def decode(self, ids: np.ndarray) -> bytes:
        return gather(self.data, self.start[ids], self.length[ids])[0].tobytes()


class ByteBpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = spelled_out(pattern)
        self.ranks = literal_map({piece.decode("latin-1"): r for piece, r in ranks.items()}, RANK_BUCKETS, "int")
        self.by_id = [b""] * (max(ranks.values(), default=-1) + 1)
        for piece, r in ranks.items():
            self.by_id[r] = piece

    def word_counts(self, docs: DataFrame) -> DataFrame:
        """``(word, n)`` of all texts."""
        pattern = self.pattern

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words = word_finder(pattern)

            def passed_on(units: Counter) -> pa.RecordBatch:
                found: Counter = Counter()
                for unit, n in units.items():
                    for word in words(unit):
                        found[word] += n
                return pa.RecordBatch.from_arrays(
                    [pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["word", "n"])

            units: Counter = Counter()
            for batch in batches:
                for text in batch.column(0):
                    units.update(byte_level_units(text.as_py() or ""))
                    if len(units) > COUNTED_UNITS:
                        yield passed_on(units)
                        units = Counter()
            yield passed_on(units)

        return docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))

    @staticmethod
    def fold(word: Column, ranks: Column) -> Column:
        """Ids of one word, by the bound rank map."""
        def rank(piece: Column) -> Column:
            return bind(piece, lambda key: look_up(ranks, RANK_BUCKETS, key))

        def merged(state: Column, at: Column) -> Column:
            p, r = state["p"], state["r"]
            none = F.array().cast("array<int>")
            around = F.struct(F.concat(F.get(p, at - 1), F.get(p, at)).alias("both"),
                              F.get(p, at - 2).alias("left"), F.get(p, at + 1).alias("right"))
            return bind(around, lambda x: F.struct(
                F.concat(F.slice(p, 1, at - 1), F.array(x["both"]), F.slice(p, at + 2, F.size(p))).alias("p"),
                F.concat(
                    F.slice(r, 1, F.greatest(at - 2, F.lit(0))),
                    F.when(x["left"].isNotNull(), F.array(rank(F.concat(x["left"], x["both"])))).otherwise(none),
                    F.when(x["right"].isNotNull(), F.array(rank(F.concat(x["both"], x["right"])))).otherwise(none),
                    F.slice(r, at + 2, F.size(r))).alias("r")))

        def step(state: Column, _: Column) -> Column:
            at = F.array_position(state["r"], F.array_min(state["r"])).cast("int")
            return bind(at, lambda i: F.when(i.isNull(), state).otherwise(merged(state, i)))

        def folded(data: Column) -> Column:
            return bind(F.slice(data, 2, F.size(data)), lambda rest: F.aggregate(
                rest, F.struct(data.alias("p"), F.transform(rest, lambda b, i: rank(F.concat(F.get(data, i), b))).alias("r")),
                step, lambda s: F.transform(s["p"], lambda x: rank(x))))

        def ids(data: Column) -> Column:
            return bind(rank(data), lambda whole: F.when(whole.isNotNull(), F.array(whole)).otherwise(
                bind(F.split(data, ""), folded)))

        return bind(F.decode(F.encode(word, "UTF-8"), "ISO-8859-1"), ids)

    def frequent_words(self, docs: DataFrame, limit: int) -> pa.Table:
        """``(word, ids)`` of the most frequent words of all documents: all
        words above the lowest class of counts that leaves ``limit`` of them
        at most (the driver reads one row a class, 1,024 at most, and then
        these words). Executors fold the words."""
        counts = saved(self.word_counts(docs).where("n > 1").select(
            "word", F.floor(CLASSES * F.log2("n")).cast("int").alias("class")), "op8-words")
        total, least = 0, None
        for c, words in sorted(counts.groupBy("class").agg(F.count("*")).collect(), reverse=True):
            if total + words > limit:
                break
            total, least = total + words, c
        ids = bind(self.ranks, lambda ranks: self.fold(F.col("word"), ranks))
        known = counts.where(F.lit(False) if least is None else F.col("class") >= least)
        return saved(known.select("word", ids.alias("ids")), "op8-known").toArrow()

    def marked(self, docs: DataFrame, table_words: int) -> DataFrame:
        """``(doc_id, ids, others)`` of ``docs``: the n-th of the other words
        of a document is ``-1 - n`` among its ids, ``others`` holds theirs."""
        sink = pa.BufferOutputStream()
        known = self.frequent_words(docs, table_words).cast(
            pa.schema([("word", pa.string()), ("ids", pa.list_(pa.int32()))]))
        with pa.ipc.new_stream(sink, known.schema) as out:
            out.write_table(known)
        table = docs.sparkSession.sparkContext.broadcast(sink.getvalue().to_pybytes())
        name, pattern, doc_id = uuid.uuid4().hex, self.pattern, docs.schema["doc_id"].dataType.simpleString()

        def look_up_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words = cached(("op8-known", name), lambda: WordIds(pa.ipc.open_stream(table.value).read_all(), pattern))
            for batch in batches:
                for first, texts in slices(batch.column("text").to_pylist()):
                    ids, others = words.encode(texts)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").slice(first, len(texts)), ids, others], ["doc_id", "ids", "others"])

        marked = docs.select("doc_id", "text").mapInArrow(
            look_up_words, f"doc_id {doc_id}, ids array<int>, others array<string>")
        others = bind(self.ranks, lambda ranks: F.transform("others", lambda w: self.fold(w, ranks)))
        return saved(marked.select("doc_id", "ids", others.alias("others")), "op8-marked")

    def encode(self, docs: DataFrame, table_words: int = TABLE_WORDS) -> DataFrame:
        """``(doc_id, ids)`` of ``docs``. Null and empty texts have none."""
        marked = self.marked(docs, table_words)
        return marked.mapInArrow(put_in, f"doc_id {marked.schema['doc_id'].dataType.simpleString()}, ids array<int>")

    def decode(self, encoded: DataFrame) -> DataFrame:
        """``(doc_id, ids)`` with ``bytes``, what the ids stand for, and
        ``ids_text``, the ids in decimal, joined by one space."""
        return encoded.mapInArrow(self.joiner(), self.decoded_schema(encoded))

    def encode_and_decode(self, docs: DataFrame, table_words: int = TABLE_WORDS) -> DataFrame:
        """``decode`` of ``encode`` in one step over the marked documents."""
        marked, join_pieces = self.marked(docs, table_words), self.joiner()
        return marked.mapInArrow(lambda batches: join_pieces(put_in(batches)), self.decoded_schema(marked))

    @staticmethod
    def decoded_schema(encoded: DataFrame) -> str:
        return f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, ids array<int>, bytes binary, ids_text string"

    def joiner(self):
        by_id, name = self.by_id, uuid.uuid4().hex

        def join_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # takes the place of the known words in a worker that is used again
            pieces, decimal = cached(("op8-pieces", name), lambda: (Pieces(by_id), [str(i) for i in range(len(by_id))]))
            for batch in batches:
                values, ends = flat(batch.column("ids"))
                values = values.to_numpy()
                runs = [values[a:b] for a, b in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("ids"), pa.array(map(pieces.decode, runs), pa.binary()),
                     pa.array([" ".join([decimal[i] for i in r.tolist()]) for r in runs], pa.string())],
                    ["doc_id", "ids", "bytes", "ids_text"])

        return join_pieces


def round_trip(docs: DataFrame, bpe: ByteBpe, table_words: int = TABLE_WORDS) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256.
    Repeated rows are encoded each; an empty table gives an empty result;
    only id and text are read."""
    return bpe.encode_and_decode(docs, table_words).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.col("ids_text").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("bytes"), 256).alias("decoded_sha256"))
