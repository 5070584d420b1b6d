"""Whitening of embeddings by an incremental eigendecomposition.

Every task keeps the spectrum (mean, eigenvalues and eigenvectors of the scatter matrix) of the vectors that it has
seen. A vector changes the matrix by one centred rank-one term, so the new eigenvalues are the roots of a secular
equation, one between each two old ones; terms that do not move an eigenvalue, and equal eigenvalues, are deflated.
Roots are found relative to their nearest pole, and the term is recomputed from them before the new eigenvectors are
formed, which keeps these orthogonal. Spectra of tasks are combined in a tree: the eigenpairs of one are rank-one terms
of the other, and so is the difference of the means.

The leading eigenvectors then span the first space of a Rayleigh-Ritz refinement: one pass over the vectors multiplies
the exactly centred covariance with the space, the small projected problem is solved, and as long as a residual is
above ``RESIDUAL`` the residuals join the space and another pass follows, until the space is whole at the latest.

Vectors become whole numbers (``SCALE`` times the entry, rounded down, plus ``SHIFT``), so numbers and sums are exact.
The spectrum is fitted on distinct vectors, found after partial aggregation, so a vector that holds a third of all rows
is one row. What reaches the driver are one spectrum and products of ``d * 2 * COMPONENTS`` numbers.

Defined cases: rows whose vector is null, empty, of another length than most (ties: the longer), or holds a null, a
NaN, an infinity or an entry beyond ``LARGEST`` are left out; repeated rows give repeated results; components whose
eigenvalue is below ``LEAST_SHARE`` of the largest do not exist, so equal vectors only, a single vector and an empty
table give no rows; equal eigenvalues have any orthonormal vectors; the entry of largest size of a component is
positive. Columns other than ``vec_id`` and ``embedding`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwell.session import pin

SCALE, SHIFT = 64, 1_000_000
LARGEST = float(1 << 40)
COMPONENTS = 16
ROWS_PER_TASK = 8192
FAN = 8  # spectra that a task combines
RESIDUAL = 1e-13  # of the largest eigenvalue
LEAST_SHARE = 1e-12
STEPS = 80
EPS = float(np.finfo(float).eps)
STATE = "part long, n long, total array<bigint>, mean array<double>, values array<double>, vectors array<double>"
OUT = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> np.ndarray:
    """``out[i, j]`` is root ``i`` of ``1 + rho * sum(z**2 / (d - x))`` less ``d[j]``, to full relative precision.

    ``d`` ascends strictly; ``z`` has length 1 and no zeros."""
    n = len(d)
    weight = rho * z * z
    end = np.append(d[1:], d[-1] + weight.sum())
    half = (end - d) / 2
    value = 1 + (weight / (d - (d + half)[:, None])).sum(axis=1)
    own = np.arange(n)
    right = value < 0
    right[-1] = False  # no pole lies beyond the last root
    origin = own + right
    poles = d - d[origin][:, None]
    low, high = np.where(right, -half, 0.0), np.where(right, 0.0, half)
    if value[-1] < 0:
        low[-1], high[-1] = half[-1], 2 * half[-1]
    mu = (low + high) / 2
    above = np.append(poles[own[:-1], own[1:]], end[-1] - d[-1])  # the pole to the right of each root
    below = poles[own, own]
    lower = own <= own[:, None]  # poles to the left of each root
    todo = own
    for _ in range(STEPS):
        gap = poles[todo] - mu[todo, None]
        term = weight / gap
        f = 1 + term.sum(axis=1)
        left = np.where(lower[todo], term, 0)
        size = 1 + np.abs(term).sum(axis=1)
        up, down = f >= 0, f < 0
        high[todo[up]], low[todo[down]] = mu[todo[up]], mu[todo[down]]
        open_ = (np.abs(f) > 4 * EPS * size) & (high[todo] - low[todo] > 2 * EPS * np.abs(mu[todo]))
        if not open_.any():
            break
        slope_left = (left / gap).sum(axis=1)
        slope = (term / gap).sum(axis=1)
        one, two = below[todo] - mu[todo], above[todo] - mu[todo]
        # both sides of the sum are taken as one pole each, of the right value and slope here
        c = f - one * slope_left - two * (slope - slope_left)
        a = (one + two) * f - one * two * slope
        b = one * two * f
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        now = mu[todo] + step
        bad = ~((now > low[todo]) & (now < high[todo]))
        now[bad] = (low[todo][bad] + high[todo][bad]) / 2
        todo, now = todo[open_], now[open_]
        mu[todo] = now
    return mu[:, None] - poles


class Spectrum:
    """Eigenvalues (ascending) and eigenvectors (rows) of the scatter matrix of ``n`` vectors around ``mean``."""

    def __init__(self, d: int):
        self.n, self.mean = 0, np.zeros(d)
        self.values, self.vectors = np.zeros(d), np.eye(d)

    def add(self, x: np.ndarray) -> None:
        self.n += 1
        off = x - self.mean
        self.mean += off / self.n
        if self.n > 1:
            self.update(off, (self.n - 1) / self.n)

    def merge(self, other: Spectrum) -> None:
        off = other.mean - self.mean
        n = self.n + other.n
        for value, vector in zip(other.values, other.vectors, strict=True):
            if value > 0:
                self.update(vector, value)
        self.update(off, self.n * other.n / n)
        self.mean += off * (other.n / n)
        self.n = n

    def update(self, vector: np.ndarray, rho: float) -> None:
        """The matrix gets ``rho`` times the outer square of ``vector``."""
        z = self.vectors @ vector
        length = float(np.sqrt(z @ z))
        rho *= length * length
        if not rho:
            return
        z /= length
        tolerance = 8 * EPS * max(self.values[-1], rho)
        self._rotate(z, np.flatnonzero(rho * np.abs(z) > tolerance), tolerance)
        at = np.flatnonzero(rho * np.abs(z) > tolerance)
        z, d = z[at], self.values[at]
        if len(at) == 1:
            self.values[at] += rho * z * z
        elif len(at):
            gaps = secular_roots(d, z, rho)
            values = d + gaps.diagonal()
            # the term whose roots these are exactly
            apart = d[:, None] - d
            np.fill_diagonal(apart, 1)
            z = np.copysign(np.sqrt(np.abs((gaps / apart).prod(axis=0))), z)
            turn = z / gaps
            turn /= np.sqrt((turn * turn).sum(axis=1))[:, None]
            if len(at) == len(self.values):
                self.values, self.vectors = values, turn @ self.vectors
                return
            self.values[at], self.vectors[at] = values, turn @ self.vectors[at]
        order = np.argsort(self.values, kind="stable")
        self.values, self.vectors = self.values[order], self.vectors[order]

    def _rotate(self, z: np.ndarray, at: np.ndarray, tolerance: float) -> None:
        """Of each two eigenvalues (at the places ``at``) that are as good as equal, one is freed of the term."""
        d, q = self.values, self.vectors
        left, right = z[at[:-1]], z[at[1:]]
        if (np.diff(d[at]) * np.abs(left * right) > tolerance * (left**2 + right**2)).all():
            return
        i = -1
        for j in at:
            r = float(np.hypot(z[i], z[j]))
            if i >= 0 and abs((d[j] - d[i]) * z[i] * z[j]) <= tolerance * r * r:
                c, s = z[j] / r, z[i] / r
                q[i], q[j] = c * q[i] - s * q[j], s * q[i] + c * q[j]
                d[i], d[j] = c * c * d[i] + s * s * d[j], s * s * d[i] + c * c * d[j]
                z[i], z[j] = 0.0, r
            i = j


def _matrix(column: pa.Array, d: int, kind: type = np.int64) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, d)


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``x``, the vector as whole numbers."""
    fine = F.forall("embedding", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) <= LARGEST), F.lit(False)))
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where(F.size("embedding") > 0).where(fine)
    length = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    rows = rows.where(F.size("embedding") == (length[0] if length else 0))
    return rows.select("vec_id", F.transform("embedding", lambda c: F.floor(c * SCALE) + SHIFT).alias("x"))


def _state(part: int, total: np.ndarray, s: Spectrum) -> pa.RecordBatch:
    lists = [total.tolist(), s.mean.tolist(), s.values.tolist(), s.vectors.ravel().tolist()]
    columns = [pa.array([part], pa.int64()), pa.array([s.n], pa.int64()), pa.array([lists[0]], pa.list_(pa.int64()))]
    columns += [pa.array([x], pa.list_(pa.float64())) for x in lists[1:]]
    return pa.RecordBatch.from_arrays(columns, names=["part", "n", "total", "mean", "values", "vectors"])


def _read(row: dict) -> tuple[np.ndarray, Spectrum]:
    s = Spectrum(len(row["mean"]))
    s.n, s.mean, s.values = row["n"], np.array(row["mean"]), np.array(row["values"])
    s.vectors = np.array(row["vectors"]).reshape(len(s.mean), -1)
    return np.array(row["total"], np.int64), s


def spectrum(fit: DataFrame, rows: int, d: int) -> tuple[np.ndarray, Spectrum]:
    """Exact sums and the spectrum of the ``rows`` vectors of ``fit``."""
    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, total = Spectrum(d), np.zeros(d, np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), d)
            total += x.sum(axis=0)
            for row in (x - SHIFT).astype(float):
                s.add(row)
        if s.n:
            yield _state(TaskContext.get().partitionId(), total, s)

    def combined(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        states = [_read(row) for row in sorted(table.to_pylist(), key=lambda row: row["part"])]
        total, s = states[0]
        for more, other in states[1:]:
            total = total + more
            s.merge(other)
        return pa.Table.from_batches([_state(key[0].as_py(), total, s)])

    parts = -(-rows // ROWS_PER_TASK)
    states = fit.repartition(parts).mapInArrow(own, STATE)
    while parts > 1:
        states = states.groupBy(F.floor(F.col("part") / FAN).alias("part_of")).applyInArrow(combined, STATE)
        parts = -(-parts // FAN)
    return _read(states.first().asDict())


def _summed(fit: DataFrame, d: int, product, width: int) -> np.ndarray:
    """Sum over all batches of ``product(x)``, a matrix of ``d`` columns at most and ``width`` numbers in all."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(width)
        for batch in batches:
            out += product(_matrix(batch.column(0), d)).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(out)], names=["i", "v"])

    cells = fit.mapInArrow(own, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(width)
    for i, v in cells:  # d * 2 * COMPONENTS numbers
        out[i] = v
    return out


def centred(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """``n * x - total``, exact whole numbers: ``int64`` where these hold it, else Python's."""
    if max(int(np.abs(x).max(initial=0)) * n, int(np.abs(total).max(initial=0))) < 1 << 62:
        return x * n - total
    return x.astype(object) * n - total.astype(object)


def refined(fit: DataFrame, n: int, total: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues and eigenvectors (columns) of the covariance that lead, and its trace, from the space ``first``."""
    d, want = len(total), min(COMPONENTS, len(total))
    space = np.linalg.qr(first)[0]
    while True:
        width = space.shape[1]

        def product(x: np.ndarray, space=space) -> np.ndarray:
            y = centred(x, n, total).astype(float) / n
            return np.append((y.T @ (y @ space)).ravel(), (y * y).sum())

        sums = _summed(fit, d, product, d * width + 1)
        image, trace = sums[:-1].reshape(d, width) / n, sums[-1] / n
        values, turned = np.linalg.eigh(space.T @ image)
        lead = np.argsort(values)[::-1][:want]
        values, turned = values[lead], turned[:, lead]
        ritz = space @ turned
        rest = image @ turned - ritz * values
        worst = np.sqrt((rest * rest).sum(axis=0)).max(initial=0)
        if worst <= RESIDUAL * values[0] * np.sqrt(d) or width == d:
            return values, ritz, trace
        space = np.linalg.qr(np.concatenate([space, rest], axis=1)[:, :d])[0]


def whitened(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and, for each component, ``component, n, deviation, whitened, explained, identity_error``."""
    rows = whole_vectors(vectors)
    kind = rows.schema["vec_id"].dataType.simpleString()
    fit = pin(rows.select("x").distinct(), "vectors")
    n = fit.count()
    empty = rows.sparkSession.createDataFrame([], f"vec_id {kind}, {OUT}")
    if n < 2:
        return empty
    d = len(fit.first()[0])
    total, s = spectrum(fit, n, d)
    values, axes, trace = refined(fit, n, total, s.vectors[::-1][: 2 * COMPONENTS].T)
    real = values > LEAST_SHARE * max(values[0], 0)
    values, axes = values[real], axes[:, real]
    k = len(values)
    if not k:
        return empty
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(k)])
    scaled = axes / np.sqrt(values)

    def white(y: np.ndarray) -> np.ndarray:
        return (y.astype(float) / n) @ scaled

    def square(x: np.ndarray) -> np.ndarray:
        w = white(centred(x, n, total))
        return np.append((w.T @ w).ravel(), w.sum(axis=0))

    sums = _summed(fit, d, square, k * k + k) / n
    cov = sums[: k * k].reshape(k, k) - np.outer(sums[k * k :], sums[k * k :])
    error = float(np.abs(cov - np.eye(k)).max())
    shares = values / trace

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            y = centred(_matrix(batch.column(1), d), n, total)
            if y.dtype != object and float(np.abs(y).max()) ** 2 * d >= 1 << 62:
                y = y.astype(object)
            deviation = pa.array((y * y).sum(axis=1), None if y.dtype != object else pa.decimal128(38, 0))
            each_row = pa.array(np.repeat(np.arange(m), k))
            columns = [
                batch.column(0).take(each_row),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, n, np.int64)),
                deviation.cast(pa.decimal128(38, 0)).take(each_row),
                pa.array(white(y).ravel()),
                pa.array(np.tile(shares, m)),
                pa.array(np.full(m * k, error)),
            ]
            names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(each, f"vec_id {kind}, {OUT}")
