"""URL filter and exact top-k search against brute force and SQL."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from aevia.llm import topk, url_filters
from aevia.llm.oracle import ORACLE

PAGES = "page_id long, url string, html string, host string, n long, prior double"


def pages(llm):
    rng = random.Random(1)
    urls = [None, "", "no scheme", "://", "http://", "http://A.Example.NET/en/x?y#z", "https://example.net/fr/", "ftp://b.net",
            "http://net/", "http://xnet/en/", "http://example.com/de/1", "http://www.EXAMPLE.com/de", "http://o.org/fr/?q://x/",
            "http://É.org/fr/a#b", "http://a.org:80/fr/", "http://h?x/y", "http://h#/en/", "x://y/z\nw"]
    urls += [f"http://spam{i % 4}.example.org/{i}" for i in range(120)] + [f"http://fine.example.org/{i}" for i in range(60)]
    html = [None, "", "<p>good text</p>", "<b>***</b> junk ### $$$", "<p>" + "word " * 50 + "|</p>"]
    rows = [(i, u, "<i>***</i> bad" if u and "spam1" in u else rng.choice(html), "x", 1, 0.5) for i, u in enumerate(urls)]
    return llm.createDataFrame(rows + [(None, None, None, None, None, None), (6, *rows[6][1:])], PAGES)


def test_urls_match_sql(llm, scratch):
    table = pages(llm)
    got = url_filters.filter_urls(table).drop("bad_bound")
    # page 6 is there twice with equal outcome; SQL joins rules by page_id, so it gets distinct ids
    numbered = table.select(F.monotonically_increasing_id().alias("page_id"), "url", "html").toPandas()
    again = url_filters.filter_urls(llm.createDataFrame(numbered)).drop("bad_bound")
    con = duckdb.connect()
    con.register("pages", numbered)
    want = con.execute(ORACLE["op9_url_filters"]).fetchall()
    assert sorted(map(tuple, again.collect()), key=str) == sorted(want, key=str)
    assert got.count() == table.count()
    verdicts = {(r["host"], r["path"]): (r["rule"], r["verdict"]) for r in got.collect()}
    assert verdicts["a.example.net", "/en/x"] == ("example.net/en/", "allow")
    assert verdicts["example.net", "/fr/"] == ("net/", "block")
    assert verdicts["b.net", ""][0] is None and verdicts["xnet", "/en/"][0] is None  # no path, not a subdomain
    assert verdicts["o.org", "/fr/"] == ("org/fr/", "allow")
    assert verdicts["spam1.example.org", "/1"] == (None, "block")
    assert verdicts["spam0.example.org", "/0"][1] == "allow" or verdicts["fine.example.org", "/0"][1] == "allow"
    assert url_filters.filter_urls(llm.createDataFrame([], PAGES)).collect() == []


def brute(rows, k):
    found = []
    for i, x in rows:
        if i is None or x is None or any(e is None or not np.isfinite(e) for e in x):
            continue
        found.append((i, [int(np.floor(256 * float(np.float32(e)))) for e in x]))
    out = set()
    for q, x in found:
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y)), c) for c, y in found if c != q and len(x) == len(y))[:k]
            out.update((q, r + 1, c, -s) for r, (s, c) in enumerate(scored))
    return out


def vectors(n, dim, seed, ties):
    rng = np.random.default_rng(seed)
    values = rng.integers(-2, 3, (n, dim)) / 4 if ties else rng.normal(0, 0.12, (n, dim))
    return [(int(i), [float(v) for v in x]) for i, x in zip(rng.permutation(4 * n)[:n], values)]


@pytest.mark.parametrize("shard_rows, block_rows", [(10_000, 10_000), (60, 3)])
@pytest.mark.parametrize("ties", [False, True])
def test_topk(llm, shard_rows, block_rows, ties):
    rows = vectors(500, 6, 3, ties)
    rows += [(1000 * 50, None), (1001 * 50, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1002 * 50, [float("nan")] * 6), (1003 * 50, [float("inf")] * 6),
             (None, [1.0] * 6), (1004 * 50, [0.5, -0.5]), (7001, [0.25, 1.0]), (1005 * 50, []), (7003, []), (1006 * 50, [0.0] * 6)]
    table = llm.createDataFrame([(i, x, 3, 1.0) for i, x in rows], "vec_id long, embedding array<float>, rank int, score double")
    got = topk.top_k(topk.whole_vectors(table), F.col("vec_id") % 50 == 0, 5, shard_rows, block_rows)
    assert {tuple(r) for r in got.collect()} == brute(rows, 5)


def test_topk_edges(llm):
    schema = "vec_id long, embedding array<float>"
    few = llm.createDataFrame([(0, [1.0]), (3, [2.0]), (3, [2.0]), (50, [-1.0])], schema)
    got = sorted(tuple(r) for r in topk.top_k(topk.whole_vectors(few), F.col("vec_id") % 50 == 0, 5).collect())
    assert got == [(0, 1, 3, 131072), (0, 2, 3, 131072), (0, 3, 50, -65536),
                   (50, 1, 0, -65536), (50, 2, 3, -131072), (50, 3, 3, -131072)]
    none = topk.top_k(topk.whole_vectors(llm.createDataFrame([], schema)), F.col("vec_id") % 50 == 0)
    assert none.collect() == []


def test_repeated_rows_are_k_candidates(llm):
    rows = [(0, [1.0, 2.0]), (100, [0.5, 0.5])] + [(7, [3.0, 1.0])] * 400 + [(n, [1.0, n / 8]) for n in range(1, 7)]
    table = topk.whole_vectors(llm.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3))
    held = topk.distinct_vectors(table, F.col("vec_id") % 50 == 0, 5)
    assert {r["vec_id"]: r["copies"] for r in held.collect()} == {i: 5 if i == 7 else 1 for i, _ in rows}
    got = topk.top_k(table, F.col("vec_id") % 50 == 0, 5, 4, 1)
    assert {tuple(r) for r in got.collect()} == brute(rows, 5)


def test_threshold_algorithm_stops_early_and_is_exact():
    rng = np.random.default_rng(9)
    x = rng.integers(-50, 50, (4000, 2)).astype(float)
    ids, q = rng.permutation(4000), rng.integers(-50, 50, (20, 2)).astype(float)
    got = topk.threshold_topk(ids, x, np.full(20, -1) - np.arange(20), q, 3)
    for j in range(20):
        scores = sorted(zip((-(x @ q[j])).tolist(), ids.tolist()))[:3]
        assert [(i, s) for k, i, s in got if k == -1 - j] == [(i, -s) for s, i in scores]
    large = topk.threshold_topk(np.arange(3), np.array([[2.0**40], [2.0**41], [1.0]]), np.array([9]), np.array([[2.0**21 + 1]]), 2)
    assert large == [(9, 1, 2**41 * (2**21 + 1)), (9, 0, 2**40 * (2**21 + 1))]  # beyond exact doubles
