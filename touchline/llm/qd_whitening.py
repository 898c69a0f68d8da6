"""Embedding whitening by a bidiagonal qd solver.

Vectors are put on an integer grid, x = floor(scale * c) + shift, and the fit
uses every distinct x vector once. Sums of the fit list are exact; a row is
centred before anything is multiplied, as the integer x - m for the rounded
mean m, minus the exact remainder of the mean.

* Blockwise QR: every task reduces its centred rows, block by block, to one
  triangle R (d x d); triangles meet in groups of ``FAN_IN`` in further tasks
  until at most ``FAN_IN`` are left, whose QR is the driver's (at most FAN_IN
  triangles of d x d numbers, whatever the number of rows).
* Householder reflections from both sides make R upper bidiagonal.
* dqds (differential quotient-difference with shifts) gives the singular values
  of the bidiagonal to high relative accuracy. Shifts are lower bounds that the
  unshifted transform proves: 1 / sum(1 / d) is at most the least value.
* Twisted factorisations of B'B - value I (a stationary qd from the top meets a
  progressive one from the bottom where the twist element is least) give each
  right singular vector without iteration; vectors of values so close that they
  come out dependent are replaced by an orthonormal basis of their joint space.
* A component is that vector taken back through the reflections; whitened values
  are centred rows projected on it over the root of its eigenvalue
  (value / n). Components are numbered by falling eigenvalue, signs are fixed by
  the entry of greatest magnitude being positive.

Vectors of each length are a fit of their own, as they share no covariance.

Defined results: rows whose vector is null or holds a null or non-finite entry
are dropped (the contract's rule); an empty vector has no component and gives no
row; components of eigenvalue zero (fewer distinct vectors than dimensions, or
constant dimensions) don't exist and give no row, so a single distinct vector
gives none; repeated rows, repeated and null ids come back row by row; an
empty table gives no rows; ``deviation`` is null where it exceeds 64 bits. Only
the id and vector columns are read, so other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import ship_package, stored

SCALE = 64
SHIFT = 1_000_000
#: Triangles that one reduction step stacks.
FAN_IN = 32
#: Rows centred and reduced at once inside a task.
BLOCK_ROWS = 4096
EPS = np.finfo(np.float64).eps


# --- bidiagonal form ----------------------------------------------------------


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """Householder v with (I - 2 v v') x = (alpha, 0, ..)."""
    v = x.astype(np.float64).copy()
    size = np.linalg.norm(v)
    if size == 0:
        return v, 0.0
    alpha = -size if v[0] >= 0 else size
    v[0] -= alpha
    return v / np.linalg.norm(v), alpha


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) with U' r V upper bidiagonal, r square."""
    a = r.astype(np.float64).copy()
    d = len(a)
    v_all = np.eye(d)
    for k in range(d):
        v, alpha = _reflector(a[k:, k])
        if alpha:
            a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k + 1 < d:
            w, beta = _reflector(a[k, k + 1 :])
            if beta:
                a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ w, w)
                v_all[:, k + 1 :] -= 2 * np.outer(v_all[:, k + 1 :] @ w, w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v_all


# --- singular values ----------------------------------------------------------


def _dqds(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One transform: (q, e, the d quantities) of the shifted array."""
    n = len(q)
    out_q, out_e, ds = [0.0] * n, [0.0] * (n - 1), [0.0] * n
    d = q[0] - shift
    for k in range(n - 1):
        ds[k] = d
        out_q[k] = d + e[k]
        if out_q[k] <= 0.0:
            return out_q, out_e, [-1.0]
        t = q[k + 1] / out_q[k]
        out_e[k] = e[k] * t
        d = d * t - shift
    ds[n - 1] = out_q[n - 1] = d
    return out_q, out_e, ds


def squared_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of the singular values of an upper bidiagonal, falling."""
    q, e = (diagonal**2).tolist(), (above**2).tolist()
    top = max(q + e + [0.0])
    if top == 0.0:
        return np.zeros(len(q))
    tiny = top * EPS * EPS * EPS
    done: list[float] = []
    blocks: list[tuple[list[float], list[float], float]] = [(q, e, 0.0)]
    while blocks:
        q, e, moved = blocks.pop()
        rounds = 0
        while q:
            n = len(q)
            if n == 1:
                done.append(moved + max(q[0], 0.0))
                break
            cut = next((k for k in range(n - 2, -1, -1) if e[k] <= tiny + (100 * EPS) ** 2 * (moved + min(q[k], q[k + 1]))), None)
            if cut is not None:
                blocks.append((q[: cut + 1], e[:cut], moved))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            rounds += 1
            if rounds > 200 * n:
                raise ArithmeticError("dqds doesn't converge")
            q0, e0, ds = _dqds(q, e, 0.0)
            if min(ds) <= 0.0:  # a zero value: the unshifted transform has split it off
                q, e = [max(x, 0.0) for x in q0], e0
                if ds == [-1.0]:
                    e = [0.0] * (n - 1)
                elif q[-1] == 0.0:
                    e[-1] = 0.0
                continue
            shift = 1.0 / sum(1.0 / x for x in ds) * (1 - 4 * n * EPS)
            if shift <= EPS * moved:
                q, e = q0, e0
                continue
            q1, e1, ds = _dqds(q0, e0, shift)
            if min(ds) < 0.0:  # rounding: keep the unshifted array
                q, e = q0, e0
            else:
                q, e, moved = q1, e1, moved + shift
    return np.sort(np.array(done))[::-1]


# --- vectors ------------------------------------------------------------------


def _twisted(q: np.ndarray, l2: np.ndarray, a: np.ndarray, b: np.ndarray, lam: float) -> np.ndarray:
    """Null vector of B'B - lam by its twisted factorisation."""
    n = len(a)
    guard = EPS * EPS * (q.max() + abs(lam)) + np.finfo(np.float64).tiny
    # B'B = L D L' with D = a**2, L's subdiagonal b / a
    plus, s = np.empty(n), np.empty(n)
    s[0] = -lam
    for k in range(n - 1):
        p = s[k] + q[k]
        plus[k] = p = p if abs(p) > guard else -guard
        s[k + 1] = l2[k] * (s[k] / p) - lam
    minus, p = np.empty(n), np.empty(n)
    p[n - 1] = q[n - 1] - lam
    for k in range(n - 2, -1, -1):
        m = l2[k] + p[k + 1]
        minus[k + 1] = m = m if abs(m) > guard else -guard
        p[k] = q[k] * (p[k + 1] / m) - lam
    gamma = s + p + lam
    r = int(np.argmin(np.abs(gamma)))
    z = np.zeros(n)
    z[r] = 1.0
    for k in range(r - 1, -1, -1):
        z[k] = -(a[k] * b[k] / plus[k]) * z[k + 1]
    for k in range(r, n - 1):
        z[k + 1] = -(a[k] * b[k] / minus[k + 1]) * z[k]
    return z / np.linalg.norm(z)


def _joint_space(t: np.ndarray, values: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Orthonormal vectors of the tridiagonal t for close values: the space of
    the twisted vectors, or one from inverse iteration where these have merged,
    turned to the vectors by Jacobi rotations."""
    size = abs(t).sum(1).max()
    k = len(values)
    if np.linalg.svd(z, compute_uv=False)[-1] > 0.5:
        block = np.linalg.qr(z)[0]
    else:
        block = np.random.default_rng(0).standard_normal((len(t), k))
        at = t - (values.mean() + 8 * EPS * size) * np.eye(len(t))
        for _ in range(4):
            block = np.linalg.qr(np.linalg.solve(at, block))[0]
    small = block.T @ t @ block
    for _ in range(30):
        if np.abs(small - np.diag(np.diag(small))).max() <= EPS * size:
            break
        for i in range(k):
            for j in range(i + 1, k):
                if abs(small[i, j]) > EPS * EPS * size:
                    phi = 0.5 * np.arctan2(2 * small[i, j], small[j, j] - small[i, i])
                    turn = np.array([[np.cos(phi), np.sin(phi)], [-np.sin(phi), np.cos(phi)]])
                    small[:, [i, j]] = small[:, [i, j]] @ turn
                    small[[i, j]] = turn.T @ small[[i, j]]
                    block[:, [i, j]] = block[:, [i, j]] @ turn
    return block[:, np.argsort(-np.diag(small), kind="stable")]


def right_vectors(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Columns: right singular vectors of the bidiagonal for its squared values."""
    a, b = diagonal.astype(np.float64), above.astype(np.float64)
    t = np.diag(a * a) + np.diag(a[:-1] * b, 1) + np.diag(a[:-1] * b, -1)
    t[np.arange(1, len(a)), np.arange(1, len(a))] += b * b
    z = np.zeros((len(a), len(values)))
    for at, parts in _unreduced(a, b):  # a block's vectors go to the nearest values left
        own = squared_values(a[at:parts], b[at : parts - 1])
        for lam in own:
            free = np.flatnonzero(~z.any(0))
            k = free[np.argmin(np.abs(values[free] - lam))]
            z[at:parts, k] = _twisted(a[at:parts] ** 2, b[at : parts - 1] ** 2, a[at:parts], b[at : parts - 1], float(lam))
    # vectors of close values that aren't orthogonal: replaced group by group
    gap = np.abs(values[:, None] - values[None, :]) / values[0]
    linked = (gap <= 1e-12) | (gap <= 1e-3) & (np.abs(z.T @ z) > 64 * EPS)
    np.fill_diagonal(linked, False)
    left = set(np.flatnonzero(linked.any(1)).tolist())
    while left:
        group, todo = set(), [min(left)]
        while todo:
            k = todo.pop()
            if k not in group:
                group.add(k)
                todo += np.flatnonzero(linked[k]).tolist()
        left -= group
        at = sorted(group)
        z[:, at] = _joint_space(t, values[at], z[:, at])
    return z


def _unreduced(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, int]]:
    start = 0
    size = max(np.abs(a).max(), np.abs(b).max() if len(b) else 0.0)
    for k in range(len(b)):
        if abs(b[k]) <= EPS * size:
            yield start, k + 1
            start = k + 1
    yield start, len(a)


@dataclass
class Whitening:
    """The fit of one vector length."""

    n: int
    sums: np.ndarray  # exact sums of x, Python integers
    components: np.ndarray  # d x k, falling eigenvalue
    eigenvalues: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return _centred(x, self.n, self.sums)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.eigenvalues)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """sum((n x - S)**2) of each row, exactly."""
        if not len(x):
            return []
        mean = self._mean()
        rest = np.array([s - self.n * int(m) for s, m in zip(self.sums, mean, strict=True)], np.float64)
        about = (self.n * (x - mean).astype(np.float64) - rest) ** 2
        if about.sum(1).max() < 2.0**62:  # every step fits 64 bits
            y = self.n * (x - mean) - rest.astype(np.int64)
            return (y * y).sum(1).tolist()
        exact = [sum((self.n * int(v) - s) ** 2 for v, s in zip(row, self.sums, strict=True)) for row in x.tolist()]
        return [v if v < 1 << 63 else None for v in exact]

    def _mean(self) -> np.ndarray:
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    mean = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    rest = np.array([(s - n * int(m)) / n for s, m in zip(sums, mean, strict=True)])
    return (x - mean).astype(np.float64) - rest


def solve(r: np.ndarray, n: int, sums: np.ndarray, most: int | None = None) -> Whitening:
    """Whitening of n centred rows whose QR has the triangle ``r``."""
    diagonal, above, v = bidiagonalise(r)
    values = squared_values(diagonal, above)
    rank = int((np.sqrt(values) > 16 * max(len(values), 64) * EPS * np.sqrt(values.max(initial=0.0))).sum())
    if not rank:
        return Whitening(n, sums, np.zeros((len(r), 0)), np.zeros(0), 0.0)
    z = right_vectors(diagonal, above, values)[:, :rank][:, :most]
    components = v @ z
    components /= np.linalg.norm(components, axis=0)
    top = np.abs(components).argmax(0)
    components *= np.sign(components[top, np.arange(components.shape[1])])
    return Whitening(n, sums, components, values[: components.shape[1]] / n, float(values.sum() / n))


# --- tables -------------------------------------------------------------------


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return vector.isNotNull() & ~bad


def grid(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(vec_id, x): usable vectors on the integer grid."""
    v = F.col(vector)
    x = F.transform(v, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long") + F.lit(shift).cast("long"))
    return embeddings.where(_usable(v)).select(F.col(vec_id).alias("vec_id"), x.alias("x"))


def _by_length(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(vector length, rows of that length, their values) of one batch."""
    x = batch.column(column)
    size = pc.list_value_length(x).to_numpy(zero_copy_only=False)
    flat = x.flatten().to_numpy(zero_copy_only=False)
    at = np.cumsum(size) - size
    for d in np.unique(size):
        rows = np.flatnonzero(size == d)
        yield int(d), rows, flat[at[rows][:, None] + np.arange(d)]


def _sums(fit: DataFrame) -> dict[int, tuple[int, np.ndarray]]:
    """Number of vectors and exact sums by vector length; the driver gets
    (length + 1) numbers a length and task, added up by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, rows, x in _by_length(batch, 0):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d] * (d + 1), pa.int32()), pa.array(range(-1, d), pa.int32()), pa.array([len(rows), *x.sum(0).tolist()], pa.int64())], ["d", "i", "s"]
                )

    parts = fit.mapInArrow(run, "d int, i int, s long").groupBy("d", "i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    out: dict[int, dict[int, int]] = {}
    for r in parts.collect():  # one row a dimension
        out.setdefault(r.d, {})[r.i] = int(r.s)
    return {d: (s[-1], np.array([s[i] for i in range(d)], object)) for d, s in out.items()}


def _reduce(triangles: dict[int, np.ndarray], d: int, rows: np.ndarray) -> None:
    have = triangles.get(d)
    triangles[d] = np.linalg.qr(rows if have is None else np.vstack((have, rows)), mode="r")


_TRIANGLE = "d int, part int, r array<double>"


def _emit(triangles: dict[int, np.ndarray], part: int) -> Iterator[pa.RecordBatch]:
    for d, r in triangles.items():
        full = np.zeros((d, d))
        full[: len(r)] = r
        yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([part], pa.int32()), pa.array([full.ravel()], pa.list_(pa.float64()))], ["d", "part", "r"])


def _triangles(fit: DataFrame, sums: dict[int, tuple[int, np.ndarray]]) -> dict[int, np.ndarray]:
    """The R of the centred fit rows, by vector length."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, _, x in _by_length(batch, 0):
                for a in range(0, len(x), BLOCK_ROWS):
                    _reduce(found, d, _centred(x[a : a + BLOCK_ROWS], *sums[d]))
        yield from _emit(found, TaskContext.get().partitionId())

    def further(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                d = batch.column(0)[i].as_py()
                _reduce(found, d, batch.column(2)[i].values.to_numpy().reshape(d, d))
        yield from _emit(found, TaskContext.get().partitionId())

    found = stored(fit.mapInArrow(first, _TRIANGLE), "triangles")
    while (most := found.groupBy("d").count().agg(F.max("count")).first()[0] or 0) > FAN_IN:
        found = stored(found.repartition(-(-most // FAN_IN), F.col("part")).mapInArrow(further, _TRIANGLE), "triangles")
    out: dict[int, np.ndarray] = {}
    for row in found.collect():  # at most FAN_IN triangles a length
        _reduce(out, row.d, np.array(row.r).reshape(row.d, row.d))
    return out


def fit_whitening(rows: DataFrame, most: int | None = None) -> tuple[dict[int, Whitening], DataFrame]:
    """Whitening by vector length for ``rows`` (vec_id, x), and the fit list
    (each distinct x once), written below the checkpoint folder."""
    ship_package(rows.sparkSession)
    fit = stored(rows.where(F.size("x") > 0).select("x").distinct(), "fit")
    sums = _sums(fit)
    triangles = _triangles(fit, sums)
    return {d: solve(triangles[d], *sums[d], most) for d in sums}, fit


def identity_error(fit: DataFrame, models: dict[int, Whitening]) -> float:
    """Largest absolute entry of (covariance of the whitened fit rows - I) over
    all vector lengths; each task hands over k x k numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, _, x in _by_length(batch, 0):
                for a in range(0, len(x), BLOCK_ROWS):
                    w = models[d].whiten(x[a : a + BLOCK_ROWS])
                    held[d] = held.get(d, 0) + np.vstack((w.T @ w, w.sum(0)))
        for d, g in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([d] * g.size, pa.int32()), pa.array(range(g.size), pa.int32()), pa.array(g.ravel())], ["d", "i", "s"])

    worst = 0.0
    found = fit.mapInArrow(run, "d int, i int, s double").groupBy("d", "i").agg(F.sum("s").alias("s")).toPandas()
    for d, part in found.groupby("d"):
        k = models[d].components.shape[1]
        if k:
            g = part.sort_values("i").s.to_numpy().reshape(k + 1, k) / models[d].n
            worst = max(worst, float(np.abs(g[:k] - np.outer(g[k], g[k]) - np.eye(k)).max()))
    return worst


def whiten(rows: DataFrame, models: dict[int, Whitening]) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained) of every row and
    component. The models (d x k numbers each) go with the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, at, x in _by_length(batch, 1):
                model = models.get(d)
                k = 0 if model is None else model.components.shape[1]
                if not k:
                    continue
                for a in range(0, len(x), BLOCK_ROWS):
                    part = x[a : a + BLOCK_ROWS]
                    m = len(part)
                    each = pa.array(np.repeat(np.arange(m), k))
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(at[a : a + BLOCK_ROWS])).take(each),
                            pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                            pa.array(np.full(m * k, model.n, np.int64)),
                            pa.array(model.deviation(part), pa.int64()).take(each),
                            pa.array(model.whiten(part).ravel()),
                            pa.array(np.tile(model.eigenvalues / model.trace, m)),
                        ],
                        ["vec_id", "component", "n", "deviation", "whitened", "explained"],
                    )

    ship_package(rows.sparkSession)
    key = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id {key}, component int, n long, deviation long, whitened double, explained double")
