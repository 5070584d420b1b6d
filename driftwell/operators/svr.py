"""Linear support vector regression: half the squared length of the weights (the constant counts as one) plus ``cost``
times the sum of what the errors exceed ``epsilon`` by.

The loss has corners, so it is rounded over a width that shrinks from the spread of the label to a share of it; each
width is solved by Newton steps. A pass over the rows adds up the loss at several step lengths at once, and gradient and
Hessian at the full step (numbers of columns squared), so a full step costs one pass, a shorter one two, and none fails to
go down. The rounded solution is feasible for
the dual problem, and both objectives come from the same pass: their difference bounds how far the result is from the
optimum. Missing numbers become the median; rows without a label are left out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwell.operators.prefix import exact_quantiles_of_columns
from driftwell.session import pin

LENGTHS = 0.4 ** np.arange(16)
STEPS = 40  # per width, at most
WIDTHS = 0.25 ** np.arange(6)  # of the spread of the label
LEVEL = 1e-9  # slope, against the weights, that counts as none


@dataclass(frozen=True)
class LinearSVR:
    features: tuple[str, ...]
    medians: tuple[float, ...]
    weights: np.ndarray  # the constant last
    objective: float
    gap: float  # the optimum is at most this much lower
    passes: int

    def predict(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        terms = [_filled(c, m) * float(w) for c, m, w in zip(self.features, self.medians, self.weights, strict=False)]
        return df.select(*keep, sum(terms, F.lit(float(self.weights[-1]))).alias("y_pred"))


def _filled(column: str, median: float):
    return F.coalesce(F.nanvl(F.col(column).cast("double"), F.lit(None)), F.lit(median))


def _sums(rows: DataFrame, points: np.ndarray, epsilon: float, width: float, cost: float) -> tuple[np.ndarray, np.ndarray]:
    """Rounded loss of each point (weights), and of the first: rounded loss, loss, dual part, gradient, Hessian; all
    summed over rows."""
    k, d = points.shape
    size = k + 3 + d + d * d

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(size)
        values, full = out[:k], out[k:]
        for b in batches:
            x = b.column("x").flatten().to_numpy().reshape(-1, d)
            y = b.column("y").to_numpy()
            errors = y - points @ x.T
            beyond = np.maximum(np.abs(errors) - epsilon, 0)
            parts = np.minimum(beyond / width, 1)  # slope of the rounded loss
            values += (parts * (beyond - parts * (width / 2))).sum(axis=1)
            r, over, part = errors[0], beyond[0], parts[0]
            alpha = np.sign(r) * part
            bent = (over > 0) & (over < width)
            full[0] += (part * over - part * part * width / 2).sum()
            full[1] += over.sum()
            full[2] += (alpha * y - epsilon * part).sum()
            full[3 : 3 + d] += alpha @ x
            full[3 + d :] += (x[bent].T @ x[bent]).ravel() / width
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(out)], names=["i", "v"])

    out = np.zeros(size)
    # step lengths and (columns + 1) squared numbers
    for i, v in rows.mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[i] = v
    return cost * out[:k], cost * out[k:]


def fit_svr(df: DataFrame, features: Sequence[str], label: str = "y", cost: float = 1.0, epsilon: float = 0.2) -> LinearSVR:
    features = list(features)
    numbers = [F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in [*features, label]]
    known = df.select(*numbers).where(F.col(label).isNotNull())
    spread = known.agg(F.stddev_pop(label)).first()[0] or 1.0
    middle = exact_quantiles_of_columns(known, features, [0.5])
    medians = [m if m is not None else 0.0 for m in (middle[c][0] for c in features)]
    x = F.array(*[_filled(c, m) for c, m in zip(features, medians, strict=True)], F.lit(1.0))
    rows = pin(known.select(x.alias("x"), F.col(label).alias("y")), "points")
    d = len(features) + 1
    w, passes, best_of = np.zeros(d), 0, None
    for width in spread * WIDTHS:
        _, s = _sums(rows, w[None], epsilon, width, cost)
        passes += 1
        for _ in range(STEPS):
            value = w @ w / 2 + s[0]
            slope = w - s[3 : 3 + d]
            step = -np.linalg.solve(np.eye(d) + s[3 + d :].reshape(d, d), slope)
            if np.linalg.norm(slope) <= LEVEL * (1 + np.linalg.norm(w)):
                break
            points = w + LENGTHS[:, None] * step
            found, s_full = _sums(rows, points, epsilon, width, cost)
            passes += 1
            values = (points * points).sum(axis=1) / 2 + found
            best = int(np.argmin(values))
            if values[best] >= value:
                break
            w, s = points[best], s_full
            if best:  # a shorter step: its slopes take a pass of their own
                _, s = _sums(rows, w[None], epsilon, width, cost)
                passes += 1
        # weights from the multipliers are feasible for the dual problem
        dual = s[2] - s[3 : 3 + d] @ s[3 : 3 + d] / 2
        objective = float(w @ w / 2 + s[1])
        if best_of is None or objective - dual < best_of[2]:
            best_of = w, objective, float(objective - dual)
    w, objective, gap = best_of
    return LinearSVR(tuple(features), tuple(medians), w, objective, gap, passes)
