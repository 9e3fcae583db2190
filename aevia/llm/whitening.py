"""Embedding whitening by shifted CholeskyQR.

The centred rows A of all vectors are orthogonalised without ever forming
their covariance first: a Gram pass sums Y'Y of the rows Y = A inv(R) (each
row by triangular solves), its Cholesky factor T makes R = T R the next
factor, and so on. The first factor is of the Gram matrix plus a shift, which
exists however ill-conditioned A is and leaves a matrix that the next passes
orthogonalise to rounding. Directions that hold nothing (dependent or
constant entries, fewer vectors than entries) show after the shifted pass and
are left out there. The composed R has R'R = A'A, so the singular
values and right vectors of this one small matrix are those of A: its
squared values by n are the eigenvalues of the covariance, with errors of
the size of R's, not of the squares that a covariance holds.

Entries are whole numbers; rows are centred exactly (as whole numbers, by the
whole part of the mean, then by its fraction) before anything is multiplied.

A pass sends one upper triangle a task, whatever its rows; triangles are
added up by Spark, entry by entry, so the driver receives one matrix a vector
length. Nothing else leaves the tasks: the table of vectors is written once
and only scanned after that.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aevia.llm.common import saved

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
PASSES = 6  # at most; three do unless vectors are dependent
ORTHOGONAL = 1e-10  # of Y'Y from the identity, where the passes end
BOUND = 1 << 52  # of whole entries: doubles below hold them exactly
EPS = np.finfo(np.float64).eps
NULL = 1e-12  # of a direction's share of the shifted matrix (of 64 entries): below, it is rounding


def whole_vectors(embeddings: DataFrame, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """``(vec_id, x)``: floor(``scale`` c) + ``offset`` of every component c,
    as long. Vectors that are null or hold a null or non-finite component are
    left out; rows without an id stay. Components beyond 2**52 count as 2**52."""
    sound = F.forall("embedding", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    whole = F.transform("embedding", lambda e: F.floor(
        F.greatest(F.least(e.cast("double") * scale, F.lit(float(BOUND))), F.lit(-float(BOUND)))).cast("long") + offset)
    return embeddings.where(F.col("embedding").isNotNull() & sound).select(
        F.col("vec_id").cast("long").alias("vec_id"), whole.alias("x"))


@dataclass(frozen=True)
class Centre:
    """Number of vectors and the sums of their entries, exact."""

    n: int
    sums: tuple[int, ...]

    def split(self) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """Whole part of the mean, its fraction, and S - n * whole part."""
        whole = [s // self.n for s in self.sums]
        rest = [s - self.n * w for s, w in zip(self.sums, whole)]
        return np.array(whole, np.int64), np.array([r / self.n for r in rest]), rest


@dataclass(frozen=True)
class Whitener:
    """What ``whiten`` needs: unit eigenvectors as columns by falling
    eigenvalue (the ``components`` largest of those above rounding)."""

    centre: Centre
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float | None = None
    passes: list = field(default_factory=list, compare=False)


def centres(vectors: DataFrame) -> dict[int, Centre]:
    """Per vector length its centre: sums of whole numbers, by Spark."""
    each = vectors.select(F.size("x").alias("dim"), F.posexplode("x").alias("at", "x"))
    rows = each.groupBy("dim", "at").agg(F.count("*").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("s")).collect()
    found: dict[int, list] = {}
    for r in rows:
        found.setdefault(r["dim"], [0, {}])[0] = r["n"]
        found[r["dim"]][1][r["at"]] = int(r["s"])
    return {dim: Centre(n, tuple(s[i] for i in range(dim))) for dim, (n, s) in found.items()}


def _blocks(batch: pa.RecordBatch, at: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per vector length: (length, row numbers, entries as a matrix)."""
    column = batch.column(at)
    lengths = np.diff(column.offsets.to_numpy())
    flat, starts = column.values.to_numpy(), column.offsets.to_numpy()[:-1]
    for dim in np.unique(lengths):
        rows = np.flatnonzero(lengths == dim)
        yield int(dim), rows, flat[starts[rows][:, None] + np.arange(dim)]


def centred(x: np.ndarray, centre: Centre) -> np.ndarray:
    whole, fraction, _ = centre.split()
    return (x - whole).astype(np.float64) - fraction


def solved(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Rows y with y R = a, for upper triangular R, column by column."""
    y = np.empty_like(a)
    for j in range(r.shape[0]):
        y[:, j] = (a[:, j] - y[:, :j] @ r[:j, j]) / r[j, j]
    return y


def _summed(triangles: DataFrame) -> dict[int, np.ndarray]:
    """Symmetric matrices by length from tasks' upper triangles."""
    rows = triangles.select("dim", F.posexplode("upper").alias("at", "v")).groupBy("dim", "at").agg(F.sum("v").alias("v"))
    rows = rows.groupBy("dim").agg(F.array_sort(F.collect_list(F.struct("at", "v"))).alias("m")).collect()
    out = {}
    for r in rows:
        upper = np.array([e["v"] for e in r["m"]])
        size = (math.isqrt(8 * len(upper) + 1) - 1) // 2
        m = np.zeros((size, size))
        m[np.triu_indices(size)] = upper
        out[r["dim"]] = m + np.triu(m, 1).T
    return out


def gram(vectors: DataFrame, maps: dict) -> dict[int, np.ndarray]:
    """Per length the sum of Y'Y, Y = ``maps[length](entries)``."""
    def triangles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, _, x in _blocks(batch, 0):
                if dim in maps:
                    y = maps[dim](x)
                    sums[dim] = sums.get(dim, 0.0) + y.T @ y
        if sums:
            upper = [m[np.triu_indices(len(m))] for m in sums.values()]
            yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array(upper, pa.list_(pa.float64()))], names=["dim", "upper"])

    return _summed(vectors.select("x").mapInArrow(triangles, "dim int, upper array<double>"))


def cholesky_qr(vectors: DataFrame, found: dict[int, Centre]) -> dict[int, tuple[np.ndarray, list[float]]]:
    """Per length a factor C with C'C = A'A (a row for each direction with
    variance; upper triangular unless some have none), and the distance of
    Y'Y from the identity in each pass."""
    open_ = {dim: _Rows(c) for dim, c in found.items() if dim}
    done: dict[int, tuple[np.ndarray, list[float]]] = {}
    off: dict[int, list[float]] = {dim: [] for dim in open_}
    for step in range(PASSES):
        if not open_:
            break
        for dim, g in gram(vectors, open_).items():
            y = open_[dim]
            off[dim].append(float(np.abs(g - np.eye(len(g))).max()))
            if step == 0:
                y = y.shifted(g)
            elif y.null(g):
                y = y.deflated(g)
            else:
                y = y.factored(g)
            open_[dim] = y
            if not len(y.c) or step and off[dim][-1] < ORTHOGONAL:
                done[dim] = open_.pop(dim).c, off[dim]
    return done | {dim: (y.c, off[dim]) for dim, y in open_.items()}


@dataclass(frozen=True)
class _Rows:
    """Y = A inv(R) P of centred rows A (without R: A; without P: A inv(R)),
    and the factor C with A = Y C."""

    centre: Centre
    r: np.ndarray | None = None
    p: np.ndarray | None = None
    c: np.ndarray | None = None

    def __call__(self, x: np.ndarray) -> np.ndarray:
        y = centred(x, self.centre)
        y = y if self.r is None else solved(y, self.r)
        return y if self.p is None else y @ self.p

    def shifted(self, g: np.ndarray) -> _Rows:
        """The first step: the factor of the Gram matrix and a shift of the
        size of its rounding."""
        n, d, size = self.centre.n, len(g), float(np.linalg.norm(g, 2))
        if not size:  # all vectors are equal
            return _Rows(self.centre, c=np.zeros((0, d)))
        # the bound of the theory, below 1 for very many rows too
        shift = min(11 * (n * d + d * (d + 1)) * EPS / 2, 1e-6) * size
        r = np.linalg.cholesky(g + shift * np.eye(d)).T
        return _Rows(self.centre, r, None, r)

    def null(self, g: np.ndarray) -> bool:
        """Whether some directions hold nothing but rounding."""
        return self.p is None and float(np.linalg.eigvalsh(g)[0]) < NULL * max(1, len(g) / 64)

    def deflated(self, g: np.ndarray) -> _Rows:
        """Without the directions that hold nothing but rounding."""
        values, axes = np.linalg.eigh(g)
        kept = values >= NULL * max(1, len(g) / 64)
        values, axes = values[kept], axes[:, kept]
        return _Rows(self.centre, self.r, axes / np.sqrt(values), (axes * np.sqrt(values)).T @ self.r)

    def factored(self, g: np.ndarray) -> _Rows:
        t = np.linalg.cholesky(g).T
        if self.p is None:
            r = t @ self.r
            return _Rows(self.centre, r, None, r)
        return _Rows(self.centre, self.r, solved(self.p, t), t @ self.c)


@dataclass(frozen=True)
class _Project:
    centre: Centre
    axes: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.centre) @ self.axes


def fit(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, Whitener]:
    """Whiteners by vector length, fitted on all ``vectors(vec_id, x)`` and
    measured on them again (``identity_error``). Vectors of one length are
    whitened among themselves. Directions without variance (more dimensions
    than vectors, dependent or constant entries) are no components."""
    found = centres(vectors)
    out = {}
    for dim, (c, off) in cholesky_qr(vectors, found).items():
        _, s, wt = np.linalg.svd(c, full_matrices=False)
        n, keep = found[dim].n, min(components, len(s))
        vectors_ = wt[:keep].T
        # either sign is right; the largest entry is made positive
        at = np.abs(vectors_).argmax(axis=0) if keep else np.zeros(0, int)
        vectors_ = vectors_ * np.where(vectors_[at, np.arange(keep)] < 0, -1.0, 1.0)
        out[dim] = Whitener(found[dim], vectors_, s[:keep] ** 2 / n, float(np.sum(s**2) / n) if len(s) else 0.0, passes=off)
    axes = {dim: _Project(w.centre, w.vectors / np.sqrt(w.values)) for dim, w in out.items() if len(w.values)}
    for dim, g in gram(vectors, axes).items():
        w = out[dim]
        error = float(np.abs(g / w.centre.n - np.eye(len(g))).max())
        out[dim] = Whitener(w.centre, w.vectors, w.values, w.trace, error, w.passes)
    return out


def deviations(x: np.ndarray, centre: Centre) -> list[int | None]:
    """Sum of (n x - S)**2 of each row, exact; null beyond a long."""
    whole, _, rest = centre.split()
    d = x - whole
    most = centre.n * int(np.abs(d).max(initial=0)) + max(map(abs, rest), default=0)
    kind = np.int64 if len(rest) * most**2 < 2**63 else object
    far = d.astype(kind) * centre.n - np.array(rest, kind)
    return [v if v < 2**63 else None for v in map(int, (far * far).sum(axis=1))]


WHITE = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, whiteners: dict[int, Whitener]) -> DataFrame:
    """A row for each row and component of ``vectors(vec_id, x)``: vec_id,
    component (from 1), n, deviation, whitened, explained, identity_error.

    Repeated rows are whitened each; a row whose length has no component
    (all vectors equal, or a single one, or empty vectors) gives none; an
    empty table gives an empty result. A deviation that passes a long is
    null."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, at, x in _blocks(batch, 1):
                w = whiteners.get(dim)
                k = 0 if w is None else len(w.values)
                if not k:
                    continue
                ids = batch.column(0).take(pa.array(np.repeat(at, k)))
                white = centred(x, w.centre) @ (w.vectors / np.sqrt(w.values))
                m = len(at)
                yield pa.record_batch([
                    ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, w.centre.n, np.int64)),
                    pa.array(deviations(x, w.centre), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(white.ravel()), pa.array(np.tile(w.values / w.trace, m)),
                    pa.array(np.full(m * k, w.identity_error))],
                    names=[c.split(" ")[0] for c in WHITE.split(", ")])

    return vectors.select("vec_id", "x").mapInArrow(rows, WHITE)


def whitened(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``embeddings(vec_id, embedding)`` whitened by a fit on all of them;
    further columns are not read. See ``whole_vectors`` and ``whiten``."""
    vectors = saved(whole_vectors(embeddings), "op12-vectors")
    return whiten(vectors, fit(vectors, components))
