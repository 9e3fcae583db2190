"""Alignment against plain encoding of whole texts and dictionaries."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers

from aevia.llm import alignment
from aevia.llm.queries import op13_alignment

from .conftest import odd_texts, prose

SF = "/root/testdata/sf0.001"
A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def tokens(texts):
    """Per text the (id, bytes) of A and B, whole texts one by one."""
    import sentencepiece
    from tokenizers import Tokenizer, decoders

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    byte = {c: i for i, c in enumerate(map(chr, range(256)))}  # by the library's decoder, one token at a time
    level, known = decoders.ByteLevel(), {}

    def bytes_a(i):
        if i not in known:
            token = a.id_to_token(i)
            text = level.decode([token])
            known[i] = text.encode() if "�" not in text else bytes(alphabet[c] for c in token)
        return known[i]

    alphabet = alignment._byte_alphabet()
    assert sorted(alphabet.values()) == list(byte.values())

    def bytes_b(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    for t in texts:
        if not t:
            yield [], []
            continue
        x = [(i, bytes_a(i)) for i in a.encode(" " + t, add_special_tokens=False).ids]
        y = [(i, bytes_b(i)) for i in b.encode(t)]
        raw = (" " + t).encode()
        yield (x, y) if all(b"".join(v for _, v in z) == raw for z in (x, y)) else ([], [])


def brute(rows):
    docs, held = [], defaultdict(set)
    for n, (x, y) in enumerate(tokens([t for _, t in rows])):
        ends = [set(np.cumsum([len(v) for _, v in z]).tolist()) for z in (x, y)]
        cuts, groups = sorted(ends[0] & ends[1]), []
        for side, z in enumerate((x, y)):
            at, g, i = 0, [], 0
            for c in cuts:
                part = []
                while at < c:
                    part.append(z[i][0])
                    at, i = at + len(z[i][1]), i + 1
                g.append(part)
            groups.append(g)
        links = Counter((p, q) for g, h in zip(*groups) for p in g for q in h)
        for k in links:
            held[k].add(n)
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in zip(*groups))
        docs.append((rows[n][0], len(x), len(y), len(cuts), links, hashlib.sha256(text.encode()).hexdigest() if x else ""))
    count = {k: len(v) for k, v in held.items()}
    top = defaultdict(int)
    for (p, _), v in count.items():
        top[p] = max(top[p], v)
    out = Counter((i, a, b, g, sum(links.values()), sum(m for k, m in links.items() if count[k] == top[k[0]]),
                   sum(m * count[k] for k, m in links.items()), h) for i, a, b, g, links, h in docs)
    total = Counter()
    for d in docs:
        total.update(d[4])
    return out, {(p, q, count[p, q], total[p, q], count[p, q] == top[p]) for p, q in count}


def more_texts():
    rng = random.Random(8)
    spaces = " ".join("a" * rng.randrange(3) for _ in range(200))
    return [(60, " lead"), (61, "trail  "), (62, "  "), (63, " "), (64, "▁ mark"), (65, "<s> </s> <unk> <0x41> <|endoftext|>"), (66, "tab\t end"),
            (67, spaces), (68, "line\n\n  two \n three"), (69, "日本語のテキスト と 한국어 текст"), (70, "ab" * 4000), (71, "x " * 3000),
            (72, "é́   nb em \x1c sep"), (73, "don't DON'T 123456 $$$%%%"), (74, prose(rng, 50)), (74, "same id"),
            (75, "​ ﻿zero"), (None, "no id")]


def test_odd_texts(llm, odd, empty):
    from aevia.llm.common import use_package

    use_package(llm)
    extra = llm.createDataFrame(more_texts(), "doc_id long, text string")
    docs = odd.unionByName(extra, allowMissingColumns=True).repartition(3)
    want, pairs = brute(odd_texts() + more_texts())
    for links, size in ((2_000_000, 1 << 16), (50, 4)):
        found, counted = alignment.align(docs, A, B, block_links=links, block_docs=size)
        assert Counter(map(tuple, found.collect())) == want
        assert {tuple(r) for r in counted.select("a_id", "b_id", "documents", "links", "best").collect()} == pairs
    found, counted = alignment.align(empty, A, B)
    assert found.collect() == [] and counted.collect() == []


def test_query_on_its_table(llm):
    rows = [(r["doc_id"], r["text"]) for r in llm.read.parquet(SF + "/documents.parquet").collect()]
    assert Counter(map(tuple, op13_alignment(llm, SF).collect())) == brute(rows)[0]


def test_planes_round_trip():
    rng = np.random.default_rng(3)
    for documents in (1, 9, 300):
        entries = sorted({(int(k), int(p)): int(t) for k, p, t in zip(
            rng.zipf(1.3, 4000) % 50, rng.integers(0, documents, 4000), rng.zipf(1.5, 4000) % 1000 + 1)}.items())
        key, place, times = (np.array(c) for c in zip(*[(k, p, t) for (k, p), t in entries]))
        packed = alignment.planes(key, place, times, documents)
        _, key2, k, place2 = alignment.opened(*packed, documents)
        back = Counter()
        for a, b, c in zip(key2.tolist(), k.tolist(), place2.tolist()):
            back[a, c] += 1 << b
        assert back == dict(entries)
        assert documents < 300 or (packed[2].any() and not packed[2].all())


def test_bytes_of_the_vocabularies():
    import base64

    pair = alignment.Pair(open(A, "rb").read(), open(B, "rb").read())
    ranks = {int(b): base64.b64decode(a) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    assert all(pair.bytes_a[i] == v for i, v in ranks.items())
    assert len(re.findall(rb".", b"".join(pair.bytes_b[3:259]), re.S)) == 256
