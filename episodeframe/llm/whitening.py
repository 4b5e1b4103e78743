"""Embedding whitening by incremental eigendecomposition.

Tasks fold their vectors one by one into a spectrum (count, mean, eigenvalues,
eigenvectors of the scatter matrix): each vector is a centred rank-one update,
whose new eigenvalues are the roots of a secular equation, with deflation of
components that the vector does not touch and of equal eigenvalues.  Spectra
of different tasks are combined in a tree: the pairs (eigenvalue, eigenvector)
of one enter the other as successive rank-one updates, and so does the
difference of the means.  A last pass over all vectors projects them on the
combined basis (Rayleigh-Ritz), whose small eigenproblem removes the rounding
gathered by the updates.

Defined results: a row whose vector is null or holds null or non-finite entries
is dropped; shorter vectors count as padded with zeros to the longest; equal
vectors are fitted once; an empty table gives no row; components without
variance have a null ``whitened`` and ``explained`` 0 (null where nothing
varies).  A state is O(d^2), a task holds one state and one batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodeframe.llm.common import cut_lineage, fresh

_EPS = np.finfo(float).eps
_STATE = "k long, n long, mean array<double>, lam array<double>, vec array<double>"


# ---------------------------------------------------------------- rank-one updates

def secular_roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + sum z2 / (d - x) = 0`` for ascending distinct ``d`` and
    positive ``z2``; root i lies between d[i] and d[i + 1] (the last below
    d[-1] + sum z2).  Returns (index of the nearer pole, offset from it), which
    keeps the small differences exact."""
    m = len(d)
    right = np.append(d[1:], d[-1] + z2.sum())
    width = right - d
    mid = d + width / 2
    at_mid = 1 + (z2 / (d[None, :] - mid[:, None])).sum(1)
    near_left = (at_mid >= 0) | (np.arange(m) == m - 1)
    origin = np.where(near_left, np.arange(m), np.minimum(np.arange(m) + 1, m - 1))
    delta = d[None, :] - d[origin][:, None]             # poles as seen from the origin
    last = np.arange(m) == m - 1
    low = np.where(near_left, np.where(last & (at_mid < 0), width / 2, 0.0), -width / 2)
    high = np.where(near_left, np.where(last & (at_mid < 0), width, width / 2), 0.0)
    x = (low + high) / 2
    below = np.arange(m)[None, :] <= np.arange(m)[:, None]
    dl = np.diagonal(delta)
    dr = np.where(last, right - d[origin], np.append(np.diagonal(delta, 1), 0.0))
    todo = np.arange(m)
    for _ in range(100):
        gap = delta[todo] - x[todo, None]
        t = z2 / gap
        f = 1 + t.sum(1)
        size = 1 + np.abs(t).sum(1)
        up = f < 0                                       # f rises from -inf to +inf between poles
        low[todo] = np.where(up, x[todo], low[todo])
        high[todo] = np.where(up, high[todo], x[todo])
        done = (np.abs(f) <= 8 * _EPS * size) | (high[todo] - low[todo] <= 2 * _EPS * np.abs(x[todo]))
        if done.all():
            break
        t /= gap
        dpsi = np.where(below[todo], t, 0).sum(1)
        dphi = t.sum(1) - dpsi
        a_l, a_r = dl[todo] - x[todo], dr[todo] - x[todo]
        c = f - a_l * dpsi - a_r * dphi
        a = (a_l + a_r) * f - a_l * a_r * (dpsi + dphi)
        b = a_l * a_r * f
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            new = x[todo] + step
        inside = np.isfinite(new) & (new > low[todo]) & (new < high[todo])
        x[todo] = np.where(done, x[todo], np.where(inside, new, (low[todo] + high[todo]) / 2))
        todo = todo[~done]
    return origin, x


def rank_one(lam: np.ndarray, vec: np.ndarray, rho: float, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors of ``vec diag(lam) vec' + rho v v'``, rho >= 0."""
    z = vec.T @ v
    scale = max(abs(lam[-1]) if len(lam) else 0.0, rho * float(z @ z))
    if rho <= 0 or scale == 0:
        return lam, vec
    z = z * np.sqrt(rho)
    tol = 8 * _EPS * scale
    lam, vec = lam.copy(), vec.copy()
    z[z * z <= tol * _EPS] = 0.0
    live = np.flatnonzero(z)
    # deflation: of equal eigenvalues only one keeps a component of the update
    close = np.flatnonzero(np.diff(lam[live]) <= tol) if len(live) > 1 else ()
    for i in close:
        a, b = live[i], live[i + 1]
        r = np.hypot(z[a], z[b])
        c, s = z[b] / r, z[a] / r
        z[a], z[b] = 0.0, r
        vec[:, [a, b]] = np.column_stack((c * vec[:, a] - s * vec[:, b], s * vec[:, a] + c * vec[:, b]))
        lam[b] = max(lam[a], lam[b])
    live = np.flatnonzero(z)
    if not len(live):
        return lam, vec
    d, zl = lam[live], z[live]
    origin, off = secular_roots(d, zl * zl)
    # d[j] - root[i], from the nearer pole; then the z for which these roots are exact
    gap = (d[None, :] - d[origin][:, None]) - off[:, None]
    gap[gap == 0] = -tol * _EPS
    m = len(d)
    poles = d[None, :] - d[:, None]
    np.fill_diagonal(poles, 1.0)
    ratio = -gap / np.where(np.eye(m, dtype=bool), 1.0, -poles.T)  # (root_i - d_j) / (d_i - d_j), diagonal root_j - d_j
    zhat = np.sqrt(np.abs(np.prod(ratio, axis=0)))
    w = np.copysign(zhat, zl)[None, :] / gap
    w /= np.sqrt((w * w).sum(1))[:, None]
    lam[live] = d[origin] + off
    vec[:, live] = vec[:, live] @ w.T
    order = np.argsort(lam, kind="stable")
    return lam[order], vec[:, order]


@dataclass
class Spectrum:
    """Count, mean and eigenpairs of the scatter matrix of a set of vectors."""

    n: int
    mean: np.ndarray
    lam: np.ndarray
    vec: np.ndarray

    @classmethod
    def empty(cls, d: int) -> Spectrum:
        return cls(0, np.zeros(d), np.zeros(d), np.eye(d))

    def add(self, x: np.ndarray) -> None:
        delta = x - self.mean
        self.lam, self.vec = rank_one(self.lam, self.vec, self.n / (self.n + 1), delta)
        self.n += 1
        self.mean = self.mean + delta / self.n

    def combine(self, other: Spectrum) -> None:
        if not other.n:
            return
        if not self.n:
            self.n, self.mean, self.lam, self.vec = other.n, other.mean, other.lam, other.vec
            return
        for value, u in zip(other.lam, other.vec.T):
            self.lam, self.vec = rank_one(self.lam, self.vec, float(value), u)
        total, delta = self.n + other.n, other.mean - self.mean
        self.lam, self.vec = rank_one(self.lam, self.vec, self.n * other.n / total, delta)
        self.mean, self.n = self.mean + delta * (other.n / total), total

    def row(self, k: int) -> dict:
        return {"k": k, "n": self.n, "mean": self.mean, "lam": self.lam, "vec": self.vec.ravel()}

    @classmethod
    def of(cls, row) -> Spectrum:
        d = len(row.mean)
        return cls(int(row.n), np.array(row.mean), np.array(row.lam), np.array(row.vec).reshape(d, d))


# ---------------------------------------------------------------- distributed fit

def finite(vec: Column) -> Column:
    """Not null, without null or non-finite entries."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce(~bad, F.lit(False))


def quantised(vec: Column, d: int) -> Column:
    """``floor(256 * c)`` as longs, padded with zeros to ``d`` entries."""
    x = F.transform(vec, lambda c: F.floor(c.cast("double") * 256) + F.lit(0).cast("long"))
    return F.concat(x, F.array_repeat(F.lit(0).cast("long"), F.lit(d) - F.size(vec)))


def _matrix(column: pd.Series, d: int) -> np.ndarray:
    flat = np.concatenate(column.to_list()) if len(column) else np.zeros(0)
    return flat.astype(np.int64).reshape(len(column), d)


def _tree(rows: DataFrame, schema: str, fold: Callable, fan: int = 8) -> DataFrame:
    """One row out of many: groups of ``fan`` consecutive ``k`` are folded until one is left."""
    def level(key, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([fold(int(key[0]), part.sort_values("k"))])

    rows = cut_lineage(rows)
    while rows.agg(F.max("k")).first()[0]:
        rows = cut_lineage(rows.groupBy(F.expr(f"k div {fan}").alias("_g")).applyInPandas(level, schema))
    return rows


def _numbered(rows: DataFrame, schema: str, task: Callable) -> DataFrame:
    """One row per task of ``rows``, numbered by the task."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        out = task(batches)
        yield pd.DataFrame([{"k": TaskContext.get().partitionId(), **out}])

    return rows.mapInPandas(run, schema)


def spectrum(fit: DataFrame, d: int) -> Spectrum:
    """Spectrum of the vectors in column ``x`` of ``fit``."""
    def task(batches) -> dict:
        state = Spectrum.empty(d)
        for part in batches:
            for x in _matrix(part["x"], d).astype(float):
                state.add(x)
        return {k: v for k, v in state.row(0).items() if k != "k"}

    def fold(k: int, part: pd.DataFrame) -> dict:
        state = Spectrum.empty(d)
        for row in part.itertuples():
            state.combine(Spectrum.of(row))
        return state.row(k)

    last = _tree(_numbered(fit, _STATE, task), _STATE, fold).first()
    return Spectrum.of(last)


def _moments(fit: DataFrame, n: int, sums: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and second moments of the centred vectors projected on ``basis``, over all of ``fit``."""
    d, m = basis.shape

    def task(batches) -> dict:
        first, second = np.zeros(m), np.zeros((m, m))
        for part in batches:
            y = centred(_matrix(part["x"], d), n, sums) @ basis
            first += y.sum(0)
            second += y.T @ y
        return {"first": first, "second": second.ravel()}

    def fold(k: int, part: pd.DataFrame) -> dict:
        return {"k": k, "first": np.sum(part["first"].to_list(), axis=0), "second": np.sum(part["second"].to_list(), axis=0)}

    schema = "k long, first array<double>, second array<double>"
    row = _tree(_numbered(fit, schema, task), schema, fold).first()
    return np.array(row["first"]) / n, np.array(row["second"]).reshape(m, m) / n


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n * x - S``, exact (Python integers where 64 bits are too few)."""
    if x.size and n * max(float(np.abs(x.astype(float)).max()), 1.0) + float(np.abs(sums.astype(float)).max(initial=0)) > 2.0 ** 62:
        return x.astype(object) * n - sums.astype(object)
    return x * n - sums


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return deviations(x, n, sums).astype(float) / n


@dataclass
class Whitening:
    """Fitted model; ``components`` are rows, by falling eigenvalue."""

    d: int
    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float | None

    @property
    def explained(self) -> list[float | None]:
        return [float(e / self.trace) if self.trace > 0 else None for e in self.eigenvalues]

    @property
    def scales(self) -> np.ndarray:
        """1 / sqrt(eigenvalue), NaN for components without variance."""
        e = self.eigenvalues
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(e > 1e-13 * self.trace, 1 / np.sqrt(e), np.nan)


def fit(vectors: DataFrame, column: str = "embedding", components: int = 4) -> Whitening | None:
    """Fit on each distinct quantised vector once; None if there is no vector."""
    good = vectors.where(finite(F.col(column))).select(F.col(column).alias("v"))
    d = good.agg(F.max(F.size("v"))).first()[0]
    if d is None:
        return None
    if d == 0:
        return Whitening(0, 1, np.zeros(0, np.int64), np.zeros((0, 0)), np.zeros(0), 0.0, None)
    rows = cut_lineage(good.select(quantised(F.col("v"), d).alias("x")).distinct())
    at = rows.select(F.posexplode("x").alias("pos", "c")).groupBy("pos").agg(F.sum("c").alias("s"), F.count("c").alias("n"))
    totals = {r.pos: (r.s, r.n) for r in at.collect()}  # d rows
    n = totals[0][1]
    sums = np.array([totals[j][0] for j in range(d)], np.int64)
    k = min(components, d)
    state = spectrum(rows, d)
    basis, _ = np.linalg.qr(state.vec)
    _, h = _moments(rows, n, sums, basis)
    values, small = np.linalg.eigh((h + h.T) / 2)
    order = np.argsort(-values, kind="stable")[:k]
    parts = (basis @ small[:, order]).T
    parts = np.array([p * (1 if p[np.argmax(np.abs(p))] > 0 else -1) for p in parts]).reshape(k, d)
    model = Whitening(d, n, sums, parts, np.maximum(values[order], 0), float(np.trace(h)), None)
    live = np.flatnonzero(np.isfinite(model.scales)) if model.trace > 0 else np.array([], int)
    if len(live):
        mean, second = _moments(rows, n, sums, parts[live].T * model.scales[live])
        model.identity_error = float(np.abs(second - np.outer(mean, mean) - np.eye(len(live))).max())
    return model


def whiten(vectors: DataFrame, model: Whitening, column: str = "embedding", out: str = "whitening") -> DataFrame:
    """Remaining rows with all their columns and a struct ``deviation``,
    ``whitened`` (one value per component) under the name ``out``, or the next
    name that is free."""
    def apply(x: pd.Series) -> pd.DataFrame:
        m = _matrix(x, model.d)
        dev = deviations(m, model.n, model.sums)
        wide = (dev.astype(float) ** 2).sum(1) > 9.2e18
        if dev.dtype == object or wide.any():
            exact = [sum(int(c) ** 2 for c in row) for row in dev]
            total = [e if e < 1 << 63 else None for e in exact]  # beyond a long: null
        else:
            total = (dev * dev).sum(1)
        y = (dev.astype(float) / model.n) @ model.components.T * model.scales
        return pd.DataFrame({"deviation": pd.array(total, dtype="Int64"),
                             "whitened": [[None if np.isnan(v) else float(v) for v in row] for row in y]})

    project = F.pandas_udf(apply, "deviation long, whitened array<double>")
    return (vectors.where(finite(F.col(column)))
            .withColumn(fresh(vectors, out), project(quantised(F.col(column), model.d))))
