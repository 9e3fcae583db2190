"""Whitening against a plain eigendecomposition of the covariance."""

import math

import numpy as np
import pytest

from aevia.llm import whitening
from aevia.llm.queries import op12_whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, x string, n long, component string"


def frame(llm, rows):
    return llm.createDataFrame([(i, None if e is None else [None if c is None else float(c) for c in e], None, "x", 1, None)
                                for i, e in rows], SCHEMA).repartition(3)


def whole(rows):
    return [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in e]) for i, e in rows
            if e is not None and all(c is not None and math.isfinite(np.float32(c)) for c in e)]


def check(rows, got, k=32):
    """``got`` rows against exact sums and numpy's symmetric solver."""
    rows = whole(rows)
    n, d = len(rows), len(rows[0][1])
    x = np.array([v for _, v in rows], object)
    s = x.sum(axis=0)
    far = n * x - s
    a = far.astype(float) / n
    cov = a.T @ a / n
    e, w = np.linalg.eigh(cov)
    e, w = e[::-1], w[:, ::-1]
    keep = min(k, int((e > e[0] * 1e-13).sum()))
    table = {}
    for r in got:
        table.setdefault(r["component"], []).append(r)
    assert sorted(table) == list(range(1, keep + 1)) and len(got) == n * keep
    assert {r["n"] for r in got} == {n} and len({r["identity_error"] for r in got}) == 1
    assert got[0]["identity_error"] < 1e-4
    expect = sorted((i if i is not None else -1, int(v)) for (i, _), v in zip(rows, (far * far).sum(axis=1)))
    white = []
    for c in range(1, keep + 1):
        here = sorted(table[c], key=lambda r: (r["vec_id"] if r["vec_id"] is not None else -1, r["deviation"], r["whitened"]))
        assert [(r["vec_id"] if r["vec_id"] is not None else -1, r["deviation"]) for r in here] == expect
        assert all(abs(r["explained"] - e[c - 1] / np.trace(cov)) < 1e-6 * r["explained"] for r in here)
        white.append([r["whitened"] for r in here])
        gap = min([abs(e[c - 1] - v) for j, v in enumerate(e) if j != c - 1], default=e[0])
        if gap > 1e-6 * e[0] and len({i for i, _ in rows}) == n:  # else the axis is not unique, or rows can't be told apart
            order = np.argsort([i if i is not None else -1 for i, _ in rows], kind="stable")
            mine = (a @ w[:, c - 1] / math.sqrt(e[c - 1]))[order]
            signed = np.array(white[-1]) * np.sign(white[-1] @ mine)
            assert np.abs(signed - mine).max() < 1e-6
    white = np.array(white)
    assert np.abs(white @ white.T / n - np.eye(keep)).max() < 1e-6


def test_query_on_its_table(llm):
    table = llm.read.parquet(SF + "/embeddings.parquet").collect()
    check([(r["vec_id"], r["embedding"]) for r in table], op12_whitening(llm, SF).collect())


def test_odd_vectors(llm):
    rng = np.random.default_rng(5)
    rows = [(i, list(rng.normal(size=6) * [30, 3, 1, 1, 0.5, 0.1])) for i in range(200)]
    rows += [(500, None), (501, [1, None, 2, 3, 4, 5]), (502, [float("nan")] * 6), (503, [float("inf"), 0, 0, 0, 0, 0])]
    rows += [(None, [1, 2, 3, 4, 5, 6])] + [(7, [9, 9, 9, 9, 9, 9])] * 3 + [(900, [0] * 6)] * 90
    got = whitening.whitened(frame(llm, rows)).collect()
    check(rows, got)
    assert whitening.whitened(frame(llm, rows), components=2).where("component > 2").count() == 0


@pytest.mark.parametrize("kind", ["dependent", "few", "scales"])
def test_hard_matrices(llm, kind):
    """Dependent and constant entries, fewer rows than entries, and entries
    of very different size."""
    rng = np.random.default_rng(7)
    if kind == "dependent":
        base = np.round(rng.normal(size=(300, 3)) * 64) / 64
        e = np.hstack([base, base[:, :2], np.full((300, 1), 3.0), base[:, :1] + base[:, 1:2]])
    elif kind == "few":
        e = rng.normal(size=(5, 40))
    else:
        e = rng.normal(size=(400, 5)) * [1e5, 1e3, 10, 1, 1]
        e[:, 4] += e[:, 3]
    rows = list(enumerate(e.astype(np.float32).tolist()))
    got = whitening.whitened(frame(llm, rows)).collect()
    if kind == "scales":
        assert {r["component"] for r in got} == set(range(1, 6)) and got[0]["identity_error"] < 1e-6
    else:
        check(rows, got)


def test_passes_orthogonalise(llm):
    """The first pass is shifted; the next ones reach rounding."""
    rng = np.random.default_rng(9)
    rows = list(enumerate((rng.normal(size=(500, 8)) * 10.0 ** np.arange(0, 4, 0.5)).tolist()))
    vectors = whitening.whole_vectors(frame(llm, rows)).cache()
    found = whitening.centres(vectors)
    (r, off), = whitening.cholesky_qr(vectors, found).values()
    assert 3 <= len(off) <= 4 and off[-1] < 1e-10
    a = whitening.centred(np.array([x["x"] for x in vectors.collect()]), found[8])
    assert np.allclose(r.T @ r, a.T @ a, rtol=1e-10) and np.allclose(r, np.triu(r))
    vectors.unpersist()


def test_lengths_are_whitened_among_themselves(llm):
    rng = np.random.default_rng(11)
    two = [(i, list(rng.normal(size=2))) for i in range(50)]
    three = [(100 + i, list(rng.normal(size=3))) for i in range(60)]
    rows = two + three + [(1000, []), (1001, [5.0])]
    got = whitening.whitened(frame(llm, rows)).collect()
    check(two, [r for r in got if r["n"] == 50])
    check(three, [r for r in got if r["n"] == 60])
    assert {r["n"] for r in got} == {50, 60}


def test_no_variance_no_components(llm):
    assert whitening.whitened(frame(llm, [])).collect() == []
    assert whitening.whitened(frame(llm, [(1, [1.0, 2.0])])).collect() == []
    assert whitening.whitened(frame(llm, [(i, [1.0, 2.0]) for i in range(9)])).collect() == []


def test_exact_deviation_beyond_long():
    c = whitening.Centre(10**6, (5, 7))
    x = np.array([[1, 2], [3 * 10**9, 0]])
    want = [sum((10**6 * v - s) ** 2 for v, s in zip(map(int, row), (5, 7))) for row in x]
    assert whitening.deviations(x, c) == [v if v < 2**63 else None for v in want]
