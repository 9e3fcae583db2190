"""Token output, token counts, BPE and packing against the libraries."""

import base64
import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from aevia.llm import byte_bpe, packing, token_counts, token_output, units
from aevia.llm.common import vocabulary_path

from .conftest import odd_texts, words_of

os.environ["TOKENIZERS_PARALLELISM"] = "false"


def tokenizer(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path(name))


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("level, name", [("byte", "byte_bpe_50k.json"), ("word", "word_bpe_49k.json")])
@pytest.mark.parametrize("limit", [5, 900_000])
def test_units_give_the_ids_of_whole_texts(level, name, limit):
    rng = random.Random(1)
    parts = ["a", "B", "the", "word", " ", " ", "  ", "\n", "\n\n", ",", ".", "'s", "'", "é", "İ", "Σ", "\u0301", "한", "1", "\t",
             "\r", "\u00a0", "\u2003", "\x1c", "\x85", "<|endoftext|>", "!", "😀", "\u0345", "ⅷ", "_"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    texts += [t or "" for _, t in odd_texts()]
    enc, library = units.Encoder(open(vocabulary_path(name), "rb").read(), level, 2, limit), tokenizer(name)
    for at, run in units.slices(texts, 2000):
        ids, counts = enc.encode(run)
        ends = np.cumsum(counts)
        for t, a, b in zip(run, ends - counts, ends):
            assert ids[a:b].tolist() == library.encode(t, add_special_tokens=False).ids + [2], repr(t)


@pytest.mark.parametrize("bits", [1, 7, 8, 11, 16, 17, 32])
def test_packed_ids_round_trip(bits):
    rng = np.random.default_rng(bits)
    ids = rng.integers(0, 2**bits, 1001, dtype=np.uint64).astype(np.uint32)
    packed = token_output.pack_ids(ids, bits)
    assert len(packed) == -(-1001 * bits // 8)
    assert (token_output.unpack_ids(packed, 1001, bits) == ids).all()


def test_shard_random_access():
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 50_257, n).astype(np.uint32) for n in (1, 90, 3, 200, 1, 1, 40)]
    data = token_output.pack_shard([5, None, 7, 8, 9, 10, 11], np.array([len(d) for d in docs]), np.concatenate(docs), 16, 3, 12,
                                   block_ids=100)
    shard = token_output.Shard(data)
    assert (shard.partition, shard.first, len(shard), len(shard.blocks)) == (3, 12, 7, 3)
    assert shard.known.tolist() == [1, 0, 1, 1, 1, 1, 1]
    for i, d in enumerate(docs):
        assert (shard.document(i) == d).all()
    assert token_output.bits_for(50_257) == 16 and token_output.bits_for(65_537) == 17


def test_token_output(llm, odd, empty, scratch):
    def run(docs, path):
        token_output.write_packed(docs, path, vocabulary_path("byte_bpe_50k.json"), 2, 50_257, shard_ids=2000)
        return sorted((tuple(r) for r in token_output.with_starts(token_output.read_packed(llm, path)).collect()),
                      key=lambda r: r[1])

    got, library, start = run(odd, scratch + "/a"), tokenizer("byte_bpe_50k.json"), 0
    assert [r[0] for r in got] == sorted((i for i, _ in odd_texts()), key=lambda i: (i is not None, i))
    left = Counter((i, crc(library.encode(t or "", add_special_tokens=False).ids + [2])) for i, t in odd_texts())
    for doc_id, at, n, c in got:
        assert at == start
        start += n
        left[doc_id, c] -= 1
    assert not any(left.values())
    assert run(empty, scratch + "/b") == []


def check_sequences(rows, capacity):
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_best_fit_packing(odd, empty):
    path, library = vocabulary_path("word_bpe_49k.json"), tokenizer("word_bpe_49k.json")
    rows = packing.best_fit_packing(odd, path, 1, 512).collect()
    want = Counter()
    for doc_id, t in odd_texts():
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        want.update((doc_id, k, a, len(ids[a: a + 512]), crc(ids[a: a + 512])) for k, a in enumerate(range(0, len(ids), 512)))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    total = sum(r["length"] for r in rows)
    assert check_sequences(rows, 512) <= 1.05 * total / 512 + 1
    assert packing.best_fit_packing(empty, path, 1, 512).collect() == []


def test_packing_keeps_the_words_of_a_worker(llm, monkeypatch):
    """A worker's share of a few hundred MB holds some million distinct words."""
    limits, frame = [], llm.createDataFrame([(1, "a")], "doc_id long, text string")
    monkeypatch.setattr(packing, "encoder", lambda *a: limits.append(a[-1]))
    monkeypatch.setattr(type(frame), "mapInArrow", lambda df, step, schema: list(step(iter([]))))
    packing.pieces_of(frame, vocabulary_path("word_bpe_49k.json"), 1, 512)
    assert limits == [packing.TABLE_UNITS] and packing.TABLE_UNITS > units.UNIT_LIMIT


def test_best_fit_bins():
    rng = random.Random(5)
    for open_bins in (1, 3, 10_000):
        packer, used = packing.BestFit(100, open_bins), defaultdict(int)
        for _ in range(2000):
            n = rng.randint(1, 100)
            free = [100 - used[b] for s in packer.bins.values() for b in s]
            b, at = packer.place(n)
            best = [f for f in free if f >= n]
            assert at == (100 - min(best) if best else 0) == used[b]
            used[b] += n
            assert packer.open <= open_bins and packer.open == sum(map(len, packer.bins.values()))
    packer = packing.BestFit(10, 2)
    assert [packer.place(n) for n in (6, 5, 8, 4, 5)] == [(0, 0), (1, 0), (2, 0), (0, 6), (1, 5)]  # the bin of 8 closed first


def test_pack_split_over_packers(llm):
    rows = llm.createDataFrame([(i % 7, 1 + i * 37 % 100) for i in range(3000)], "id long, length long")
    placed = packing.pack(rows, 100, pieces_per_packer=700).collect()
    assert len(placed) == 3000
    assert check_sequences(placed, 100) <= 1.05 * sum(r["length"] for r in placed) / 100


def greedy(word, pieces):
    n = at = 0
    while at < len(word):
        end = len(word)
        while word[at:end] not in pieces:
            end -= 1
            if end == at:
                return -1
        at, n = end, n + 1
    return n


def test_longest_match_automaton():
    rng = random.Random(2)
    for _ in range(60):
        pieces = {bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(1, 25))}
        automaton = token_counts.LongestMatch(sorted(pieces))
        for _ in range(60):
            word = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 15)))
            assert automaton.count(word) == greedy(word, pieces), (pieces, word)


def test_token_counts(odd, empty):
    path = vocabulary_path("byte_bpe_50k.tiktoken")
    pieces = set(token_counts.rank_pieces(open(path, "rb").read()))
    got = Counter(tuple(r)[:3] for r in token_counts.token_counts(odd, path).collect())
    want = Counter((i, len(words_of(t)), sum(greedy(b" " + w, pieces) for w in words_of(t))) for i, t in odd_texts())
    assert got == want
    assert token_counts.token_counts(empty, path).collect() == []


@pytest.mark.parametrize("table_words", [0, 40, 300_000])
def test_byte_bpe(odd, empty, table_words):
    import public_tokenizers
    import tiktoken

    ranks = byte_bpe.read_ranks(vocabulary_path("byte_bpe_50k.tiktoken"))
    assert ranks[base64.b64decode("IQ==")] == 0
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    bpe = byte_bpe.ByteBpe(ranks, public_tokenizers.PATTERN)
    want = Counter()
    for i, t in odd_texts():
        ids = library.encode_ordinary(t or "")
        want[i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in byte_bpe.round_trip(odd, bpe, table_words).collect()) == want
    decoded = bpe.decode(bpe.encode(odd, table_words)).collect()
    assert Counter((r["doc_id"], tuple(r["ids"]), bytes(r["bytes"])) for r in decoded) == Counter(
        (i, tuple(library.encode_ordinary(t or "")), (t or "").encode()) for i, t in odd_texts())
    if not table_words:
        assert byte_bpe.round_trip(empty, bpe).collect() == []


def test_a_task_of_byte_bpe_has_one_python_worker(odd):
    import public_tokenizers

    bpe = byte_bpe.ByteBpe(byte_bpe.read_ranks(vocabulary_path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    for df in (byte_bpe.round_trip(odd, bpe, 40), bpe.encode(odd, 40)):
        assert df._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_byte_level_units():
    """Units put together are the text; only plain texts are cut at line breaks."""
    rng = random.Random(6)
    odd = re.compile(r"[^\S \n]|[ \n][ \n]|\A[ \n]|[ \n]\Z")
    for _ in range(20_000):
        text = "".join(rng.choice("ab\u00e9 \n\t\u00a0\x1c") for _ in range(rng.randint(0, 8)))
        found = units.byte_level_units(text)
        assert "".join(u[0] if isinstance(u, tuple) else " " + u for u in found) == text
        if not odd.search(text):
            assert found.count(("\n",)) == text.count("\n")
