"""Jaccard join and substring dedup against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from aevia.llm import jaccard_join, recompression, shingles, substring_dedup

from .conftest import odd_texts, prose, words_of


def brute_components(docs, n=3, percent=90):
    sets = []
    for i, t in docs:
        w = words_of(t.lower() if t and t.isascii() else None if t is None else "".join(c.lower() if c.isascii() else c for c in t))
        sets.append((i, frozenset([tuple(w[k: k + n]) for k in range(len(w) - n + 1)] or ([tuple(w)] if w else []))))
    up = {i: i for i, _ in sets if i is not None}

    def root(i):
        return i if up[i] == i else root(up[i])

    for a, x in sets:
        for b, y in sets:
            if a is not None and b is not None and a < b and x and y and 100 * len(x & y) >= percent * len(x | y):
                r, s = root(a), root(b)
                up[max(r, s)] = min(r, s)
    return Counter((i, len(x), None if i is None else root(i)) for i, x in sets)


def brute_dedup(docs, size=50):
    first = {}
    for i, t in docs:
        w = words_of(t)
        for k in range(len(w) - size + 1) if i is not None else ():
            key = tuple(w[k: k + size])
            first[key] = min(first.get(key, i), i)
    out = Counter()
    for i, t in docs:
        w = words_of(t)
        gone = set()
        for k in range(len(w) - size + 1) if i is not None else ():
            if first[tuple(w[k: k + size])] < i:
                gone.update(range(k, k + size))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out[i, len(w), len(gone), hashlib.sha256(kept).hexdigest()] += 1
    return out


def near_copies(seed, groups=4, copies=14):
    """Groups of copies with a few to many edits, some sharing passages."""
    rng = random.Random(seed)
    docs, passage = [], prose(rng, 80)
    for g in range(groups):
        base = prose(rng, rng.choice([4, 12, 60, 300])).split()
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, len(w) // 8])):
                at = rng.randrange(len(w))
                rng.choice([lambda: w.__setitem__(at, "new"), lambda: w.insert(at, "ins"), lambda: len(w) > 2 and w.pop(at)])()
            docs.append(" ".join(w) + (" " + passage if g % 2 and rng.random() < 0.4 else ""))
    rng.shuffle(docs)
    return list(enumerate(docs))


def test_odd_components(odd, empty):
    ids = [i for i, _ in odd_texts()]
    once = [i for i in ids if ids.count(i) == 1 or i is None]
    got = [tuple(r) for r in jaccard_join.jaccard_components(odd).collect()]
    want = brute_components(odd_texts())
    assert Counter(r for r in got if r[0] in once) == Counter({r: n for r, n in want.items() if r[0] in once})
    assert len(got) == len(ids)
    assert jaccard_join.jaccard_components(empty).collect() == []


@pytest.mark.parametrize("seed, block", [(1, 1 << 18), (2, 400)])
def test_near_copies(llm, monkeypatch, seed, block):
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", block)  # 400: cells of many blocks
    docs = near_copies(seed)
    got = jaccard_join.jaccard_components(llm.createDataFrame(docs, "doc_id long, text string"))
    assert Counter(tuple(r) for r in got.collect()) == brute_components(docs)


def test_second_search_holds_a_block_and_a_part(llm, monkeypatch):
    """A cell of which no member links to the leader: no task holds more than
    about two blocks, and every query meets every member of the other blocks."""
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 400)
    rng, blocks = np.random.default_rng(11), 16
    rows = [(b"leader", n % blocks, blocks, b"%04d" % n, rng.integers(0, 2**60, 20, dtype=np.uint64).tobytes(), True, None)
            for n in range(20 * blocks)]
    first = llm.createDataFrame(rows, "leader binary, block int, blocks int, key binary, shingles binary, query boolean, other binary")
    held = Counter()
    met = set()
    groups = {}
    for r in jaccard_join.other_blocks(first).collect():
        group = tuple(r[c] for c in jaccard_join.SECOND_SEARCH)
        held[group] += len(r["shingles"]) // 8
        groups.setdefault(group, ([], []))[r["query"]].append(bytes(r["key"]))
    assert max(held.values()) <= 3 * 400 and sum(len(r[4]) // 8 for r in rows) == 16 * 400
    for members, queries in groups.values():
        assert not set(members) & set(queries)
        met.update((q, m) for q in queries for m in members)
    home = {r[3]: r[1] for r in rows}
    assert met == {(q, m) for q in home for m in home if home[q] != home[m]}


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(4)
    for _ in range(3000):
        n = int(rng.integers(1, 60)) if rng.random() < 0.8 else int(rng.integers(60, 2500))
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        drop = int(rng.integers(0, max(1, n // 9) + 1))
        b = np.union1d(a[drop:], rng.integers(0, 2**63, int(rng.integers(0, max(1, n // 9) + 1)), dtype=np.uint64))
        if len(b) != len(a) or (a != b).any():
            if jaccard_join.links(a, b):
                assert len(np.intersect1d(jaccard_join.signatures(a), jaccard_join.signatures(b))), (len(a), len(b))


@pytest.mark.parametrize("percent", [80, 90])
def test_long_sets_need_few_cuts(percent):
    """No long set is posted under its single shingles, nor cut many times."""
    rng = np.random.default_rng(12)
    for n in (300, 1000, 1500, 2500, 5000, 8000, 10_000):
        for _ in range(5):
            s = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
            assert len(jaccard_join.signatures(s, percent)) <= 3 * n, n


def test_linked_sets_share_a_signature_at_80():
    rng = np.random.default_rng(13)
    for _ in range(1500):
        n = int(rng.integers(1, 60)) if rng.random() < 0.8 else int(rng.integers(60, 2500))
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        drop = int(rng.integers(0, max(1, n // 5) + 1))
        b = np.union1d(a[drop:], rng.integers(0, 2**63, int(rng.integers(0, max(1, n // 5) + 1)), dtype=np.uint64))
        if (len(b) != len(a) or (a != b).any()) and jaccard_join.links(a, b, 80):
            assert len(np.intersect1d(jaccard_join.signatures(a, 80), jaccard_join.signatures(b, 80))), (len(a), len(b))


def test_divide_skip():
    rng = np.random.default_rng(5)
    for _ in range(40):
        base = rng.integers(0, 2**60, 120, dtype=np.uint64)
        sets = [np.unique(np.concatenate((rng.choice(base, rng.integers(90, 120), replace=False),
                                          rng.integers(0, 2**60, rng.integers(0, 8), dtype=np.uint64)))) for _ in range(30)]
        forest = jaccard_join.Forest(len(sets))
        jaccard_join.search_block(sets, list(range(len(sets))), forest, 90)
        want = jaccard_join.Forest(len(sets))
        for i in range(len(sets)):
            for j in range(i):
                if jaccard_join.links(sets[i], sets[j]):
                    want.join(i, j)
        assert [forest.root(i) for i in range(30)] == [want.root(i) for i in range(30)]


def test_components_of_long_chains(llm):
    rng = random.Random(6)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, 103), (103, 101), (200, 200)]
    rng.shuffle(pairs)
    got = jaccard_join.components(llm.createDataFrame(pairs, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == {i: 0 for i in range(61)} | {100: 100, 101: 100, 103: 100}


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(7)
    for size, letters in ((10, 2), (10, 40), (50, 3), (50, 1000)):
        docs = [rng.integers(0, letters, rng.integers(0, 300)).astype(np.uint64) for _ in range(40)]
        docs = [np.concatenate((d, docs[0][20:160], d[:5])) for d in docs] + [np.zeros(130, np.uint64)]
        docs = [shingles.mix(d + np.uint64(1)) for d in docs]
        batch = recompression.Batch(docs)
        starts, doc = batch.windows(size)
        names, seen = recompression.anchors(batch, starts, size), {}
        for p, name in zip(starts.tolist(), names.tolist()):
            assert seen.setdefault(batch.words[p: p + size].tobytes(), name) == name
        one = recompression.anchors(recompression.Batch(docs[3:4]), recompression.Batch(docs[3:4]).windows(size)[0], size)
        assert (one == names[doc == 3]).all()


def test_odd_dedup(odd, empty):
    assert Counter(tuple(r) for r in substring_dedup.substring_dedup(odd).collect()) == brute_dedup(odd_texts())
    assert substring_dedup.substring_dedup(empty).collect() == []


def test_rows_of_windows_are_short_and_never_broadcast(llm, monkeypatch):
    """What is exchanged for every anchor and window holds no digest, and
    what it is joined with grows with the texts."""
    plans = {}

    def planned(df, name, keep=substring_dedup.saved):
        llm.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            plans[name] = df.select("*")._jdf.queryExecution().executedPlan().toString()
        finally:
            llm.conf.set("spark.sql.adaptive.enabled", "true")
        return keep(df, name)

    monkeypatch.setattr(substring_dedup, "saved", planned)
    docs = near_copies(8, groups=5, copies=12)
    substring_dedup.find_repeats(llm.createDataFrame(docs, "doc_id long, text string"))
    for name, key in (("op2-windows", "anchor"), ("op2-rebuilt", "one")):
        lines = plans[name].splitlines()
        # the projection of every exploded row
        exploded = [re.sub(r"xxhash64\([^)]*\)", "", up) for up, line in zip(lines, lines[1:]) if "Generate" in line]
        assert exploded and not any("digest" in line for line in exploded), (name, exploded)
        assert not [line for line in lines if "BroadcastHashJoin" in line and f"[{key}#" in line], name


@pytest.mark.parametrize("size", [8, 50])
def test_shared_passages(llm, size):
    docs = near_copies(8, groups=5, copies=12)
    got = substring_dedup.substring_dedup(llm.createDataFrame(docs, "doc_id long, text string").repartition(3), size)
    assert Counter(tuple(r) for r in got.collect()) == brute_dedup(docs, size)


@pytest.mark.parametrize("copies", [3, 300])
def test_repeated_rows_that_lose_a_part(llm, copies):
    """As many rows come out as go in, and each is judged."""
    rng = random.Random(21)
    passage = prose(rng, 60)
    docs = [(1, passage + " first tail"), (5, "head words " + passage + " other tail"), (7, "x " + passage)]
    rows = [docs[0]] + [docs[1]] * copies + [docs[2], docs[2], (5, "another text of five"), (None, passage), (None, passage)]
    rows += [(5, docs[1][1].replace(" ", "  "))] * 2  # the same words
    frame = llm.createDataFrame([(i, t, "kept", i, b"digest", 1) for i, t in rows],
                                "doc_id long, text string, kept string, copies long, digest binary, n long").repartition(3)
    got = Counter(tuple(r) for r in substring_dedup.substring_dedup(frame).collect())
    assert got == brute_dedup(rows) and sum(got.values()) == len(rows)


@pytest.mark.parametrize("copies", [2, 300])
def test_keep_one_of_rows_that_share_ids(llm, empty, copies):
    """Of every component one row stays, also where ids repeat."""
    rng = random.Random(22)
    a, b, c, d = (prose(rng, 80) for _ in range(4))
    near = a.rsplit(" ", 1)[0] + " end"
    rows = [(5, a)] * copies + [(7, a)] * 2 + [(7, b), (9, near), (9, c), (2, d), (4, d + " "), (6, a + " more"), (8, None), (8, ""), (8, " ")]
    rows += [(None, a), (None, a), (10, "Ab"), (10, "aB"), (11, "ab")]
    frame = llm.createDataFrame([(i, t, "k", 1, "d") for i, t in rows], "doc_id long, text string, key string, n long, doc string").repartition(3)
    kept = jaccard_join.keep_one(frame)
    assert kept.dtypes == frame.dtypes
    got = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    assert got == Counter([(5, a), (7, b), (9, c), (2, d), (8, None), (8, ""), (8, " "), (None, a), (None, a), (10, "aB")])
    assert jaccard_join.keep_one(empty).collect() == []
