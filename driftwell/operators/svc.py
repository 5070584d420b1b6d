"""Linear support vector classifiers of a whole grid, fitted together.

Every model, of each cost and each fold, follows the steps of Spark's ``LinearSVC``: mean hinge loss with an L2 penalty
over standardised columns, minimised by the orthant-wise quasi-Newton method with a backtracking line search. A model
asks for loss and gradient at one point at a time, so one pass over the rows answers the questions of all of them, and
the number of passes is that of the slowest model. Nothing is cached: the rows are written once in blocks of bytes, tasks
hold a few blocks at a time and give back one sum per model and column.

Folds differ in the medians, means and deviations of their training rows. These are linear in the columns of a batch, so
a fold is a small matrix over columns that are scaled once, and one pass serves all folds.
"""

from __future__ import annotations

import pickle
from collections.abc import Generator, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Imputer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwell.session import pin

BLOCK = 4096  # rows
FILE = 64  # blocks that a task reads at once
MEMORY = 10  # steps that stand for the curvature
SEARCH = 20  # tries of a line search, at most
VALUES = 20  # losses that have to agree

ROOM = 24  # points of a pass, if fewer models are left than that

Asks = Generator[list[np.ndarray], list[tuple[float, np.ndarray]], np.ndarray]


class _Stuck(ArithmeticError):
    """A step that the method cannot take; its memory is dropped once."""


def _direction(slope: np.ndarray, memory: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    out, shares = slope.copy(), []
    with np.errstate(all="ignore"):
        for step, change in memory:
            shares.append((step @ out) / (step @ change))
            if np.isnan(shares[-1]):
                raise _Stuck
            out -= shares[-1] * change
        if memory:
            step, change = memory[0]
            if not step @ change >= 0:
                raise _Stuck
            out *= (step @ change) / (change @ change)
        for (step, change), share in zip(reversed(memory), reversed(shares), strict=True):
            out += (share - (change @ out) / (step @ change)) * step
    out = -out
    return np.where(out * slope < 0, out, 0.0)


def _length(value: float, deriv: float, first: float, shrink: float, at) -> Generator:
    """Length of a step along which loss and slope went down enough; ``at`` asks for both at a length. Spark's search holds
    the first length against the loss of the start, which always shortens it where the loss goes down: not asked for then."""
    length, here, slope = first, value, deriv
    if not deriv < 0:
        slope = (yield from at(first))[1]
    for _ in range(SEARCH):
        if here > value + length * deriv * 1e-4:
            change = shrink
        elif slope < 0.9 * deriv:
            change = 2.1
        elif slope > -0.9 * deriv:
            change = shrink
        else:
            break
        last, length = length, length * change
        if not 1e-10 <= length <= 1e10:
            raise _Stuck
        here, slope = yield from at(length)
    else:
        return last
    return length


def minimise(d: int, steps: int, tolerance: float) -> Asks:
    """Asks for loss and gradient at points of ``d`` numbers, from 0 on, and is told those of the first point at least: the
    others are what a line search may ask for next. Returns the point where it stops."""
    x = np.zeros(d)
    value, slope = (yield [x])[0]
    start, memory, losses, turn, failed = value, [], [np.inf], 0, False

    def over() -> bool:
        flat = np.linalg.norm(slope) <= max(tolerance * value, 1e-8)
        return turn >= steps or flat or abs(value - max(losses)) <= tolerance * start

    while not over():
        try:
            way = _direction(slope, memory)
            side = np.where(x != 0, np.sign(x), np.sign(-slope))
            shrink, seen = 0.1 if turn < 1 else 0.5, {}

            def point(length, x=x, way=way, side=side):
                out = x + way * length
                return np.where(np.sign(out) == side, out, 0.0)

            def at(length, way=way, shrink=shrink, seen=seen, point=point):
                if length not in seen:
                    shorter = length * shrink
                    ahead = [length, shorter, length * 2.1, shorter * shrink, shorter * shrink * shrink]
                    seen.update(zip(ahead, (yield [point(v) for v in ahead]), strict=False))
                return seen[length][0], float(seen[length][1] @ way)

            first = 0.5 / np.linalg.norm(slope) if turn < 1 else 1.0
            length = yield from _length(value, float(slope @ way), first, shrink, at)
            yield from at(length)
            new, (new_value, new_slope) = point(length), seen[length]
        except _Stuck:
            if failed:
                break
            failed, memory = True, []
            continue
        memory = [(new - x, new_slope - slope), *memory][:MEMORY]
        x, value, slope, turn, failed = new, new_value, new_slope, turn + 1, False
        losses = [*losses, value][-VALUES:]
    return x


@dataclass(frozen=True)
class Part:
    """Training rows of a fold: how many, and ``maps`` from the columns of a block to standardised ones."""

    fold: int  # -1: all rows
    rows: int
    maps: np.ndarray


@dataclass(frozen=True)
class Points:
    """``blocks`` holds the rows in bytes, see :func:`_packed`. Columns of a block are the features, scaled; the flags of
    missing values of those that have some; and a constant."""

    blocks: DataFrame
    width: int
    parts: tuple[Part, ...]


def with_folds(df: DataFrame, folds: int, seed: int = 0) -> DataFrame:
    """``_fold`` as Spark's cross-validation draws it; fixed as long as the rows stay in their place."""
    drawn, fold = df.withColumn("_drawn", F.rand(seed)), F.lit(-1)
    for i in range(folds):
        fold = F.when((F.col("_drawn") >= i * (1.0 / folds)) & (F.col("_drawn") < (i + 1) * (1.0 / folds)), i).otherwise(fold)
    return drawn.withColumn("_fold", fold.cast("int")).drop("_drawn")


def _merged(groups: Sequence[tuple[float, float, float]]) -> tuple[float, float, float]:
    """Number, mean and summed squares of several groups together."""
    n, mean, squares = 0.0, 0.0, 0.0
    for m, other, more in groups:
        if m:
            gap, both = other - mean, n + m
            squares += more + gap * gap * n * m / both
            mean, n = mean + gap * m / both, both
    return n, mean, squares


def prepare(df: DataFrame, features: Sequence[str], label: str, folds: int, seed: int = 0) -> Points:
    """Statistics of each fold's training rows, in one scan, and medians where values are missing."""
    numbers = [F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in features]
    rows = with_folds(df.select(F.col(label).cast("double").alias("_y"), *numbers), folds, seed)
    stats = [F.count(c).alias(f"n_{c}") for c in features] + [F.avg(c).alias(f"m_{c}") for c in features] + [F.var_pop(c).alias(f"v_{c}") for c in features]
    wrong = F.count_if(~F.coalesce(F.col("_y").isin(0.0, 1.0), F.lit(False)))
    # one row a fold
    held = {r["_fold"]: r for r in rows.groupBy("_fold").agg(F.count(F.lit(1)).alias("_rows"), F.sum("_y").alias("_ones"), wrong.alias("_wrong"), *stats).collect()}
    if any(r["_wrong"] for r in held.values()):
        raise ValueError(f"Labels must be 0 or 1: {label}")
    gaps = tuple(j for j, c in enumerate(features) if any(r[f"n_{c}"] < r["_rows"] for r in held.values()))

    def columns(used: list) -> list[tuple[float, float, float]]:
        """Of known values."""
        return [_merged([(r[f"n_{c}"], r[f"m_{c}"] or 0.0, (r[f"v_{c}"] or 0.0) * r[f"n_{c}"]) for r in used]) for c in features]

    whole = columns(list(held.values()))
    centre = np.array([mean for _, mean, _ in whole])
    scale = np.array([np.sqrt(squares / n) if n and squares > 0 else 1.0 for n, _, squares in whole])
    parts = []
    for fold in (*range(folds), -1):
        used = [r for k, r in held.items() if k != fold or fold < 0]
        total = sum(r["_rows"] for r in used)
        if not sum(r["_ones"] for r in used):
            raise ValueError(f"Two classes are needed: {label}")
        fill = np.zeros(len(features))
        if gaps:
            names = [features[j] for j in gaps]
            known = rows.where(F.col("_fold") != fold) if fold >= 0 else rows
            median = Imputer(strategy="median", inputCols=names, outputCols=[f"{c}__f" for c in names]).fit(known).surrogateDF.first()
            fill[list(gaps)] = [median[c] for c in names]
        maps = np.zeros((len(features), len(features) + len(gaps) + 1))
        for j, (n, mean, squares) in enumerate(columns(used)):
            n, mean, squares = _merged([(n, mean, squares), (total - n, fill[j], 0.0)])
            if squares <= 0 or total < 2:
                continue  # a constant has no weight
            spread = np.sqrt(squares / (total - 1))
            maps[j, j], maps[j, -1] = scale[j] / spread, (centre[j] - mean) / spread
            if j in gaps:  # the block has the centre there
                maps[j, len(features) + gaps.index(j)] = (fill[j] - centre[j]) / spread
        parts.append(Part(fold, total, maps))
    blocks = pin(_packed(rows.select(*features, "_y", "_fold"), centre, scale, gaps), "blocks", maxRecordsPerFile=FILE, compression="uncompressed")
    return Points(blocks, len(features) + len(gaps) + 1, tuple(parts))


def _packed(rows: DataFrame, centre: np.ndarray, scale: np.ndarray, gaps: tuple[int, ...]) -> DataFrame:
    """Rows in blocks of ``BLOCK``, by fold: where each fold begins, the sign of the label, and of each column its different
    values and the number of each row's value; or the values of all rows, if there are many."""
    d = len(centre)

    def column(v: np.ndarray) -> tuple:
        values, codes = np.unique(v, return_inverse=True)
        return (values, codes.astype(np.uint8 if len(values) <= 256 else np.uint16)) if len(values) <= BLOCK // 8 else (v, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            out = []
            for at in range(0, whole.num_rows, BLOCK):
                b = whole.slice(at, BLOCK)
                fold = b.column("_fold").to_numpy()
                order = np.argsort(fold, kind="stable")
                z = [(b.column(j).to_numpy(zero_copy_only=False)[order] - centre[j]) / scale[j] for j in range(d)]
                z = [np.nan_to_num(v, nan=0.0) if j in gaps else v for j, v in enumerate(z)] + [np.isnan(z[j]).astype(float) for j in gaps]
                sign = (2 * b.column("_y").to_numpy()[order] - 1).astype(np.int8)
                starts = np.searchsorted(fold[order], np.arange(-1, int(fold.max()) + 2))
                out.append(pickle.dumps((starts, sign, [column(v) for v in z]), protocol=5))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["block"])

    return rows.mapInArrow(run, "block binary")


def _sums(points: Points, weights: np.ndarray, folds: Sequence[int], held: bool) -> np.ndarray:
    """For each model (a row of ``weights`` over the columns of a block): loss and gradient, summed over the rows outside
    its fold; with ``held`` the number of right answers and of rows inside."""
    width, shape = points.width, (len(weights), 2 if held else 1 + points.width)
    own = {f: [k for k, of in enumerate(folds) if of == f] for f in set(folds) if f >= 0}
    own = {f: slice(k[0], k[-1] + 1) for f, k in own.items()}  # models of a fold stand together

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(shape)
        for block in (v.as_buffer() for b in batches for v in b.column(0)):
            starts, sign, columns = pickle.loads(block)
            z = np.empty((width, len(sign)))
            for j, (values, codes) in enumerate(columns):
                z[j] = values if codes is None else values.take(codes)
            z[-1] = 1.0
            inside = {f: slice(*starts[f + 1 : f + 3]) if f + 2 < len(starts) else slice(0, 0) for f in own}
            if held:
                for f, models in own.items():
                    right = (weights[models] @ z[:, inside[f]] > 0) == (sign[inside[f]] > 0)
                    out[models, 0] += right.sum(axis=1)
                    out[models, 1] += right.shape[1]
                continue
            z *= -sign
            left = weights @ z
            left += 1
            np.maximum(left, 0, out=left)
            for f, models in own.items():
                left[models, inside[f]] = 0
            out[:, 0] += left.sum(axis=1)
            out[:, 1:] += np.greater(left, 0, out=left) @ z.T
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], names=["sums"])

    # models times columns numbers a task
    found = points.blocks.mapInArrow(run, "sums binary").collect()
    return np.sum([np.frombuffer(r["sums"]).reshape(shape) for r in found], axis=0)


def fit_all(points: Points, costs: Sequence[float], penalty: Sequence[float], steps: int, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights of standardised columns and the constant, parts x costs x numbers, and the share of right answers of each
    fold's models on the fold, folds x costs."""
    d = len(points.parts[0].maps)
    models = [(part, c) for part in points.parts for c in range(len(costs))]
    asking = [minimise(d + 1, steps, tolerance) for _ in models]
    at, found = [next(m) for m in asking], [None] * len(models)

    def spread(part: Part, w: np.ndarray) -> np.ndarray:
        out = w[:d] @ part.maps
        out[-1] += w[d]
        return out

    while any(x is not None for x in at):
        open_ = [k for k, x in enumerate(at) if x is not None]
        asked = [(k, w) for k in open_ for w in at[k][: max(1, ROOM // len(open_))]]
        sums = _sums(points, np.array([spread(models[k][0], w) for k, w in asked]), [models[k][0].fold for k, _ in asked], False)
        told: dict[int, list] = {k: [] for k in open_}
        for (k, w), s in zip(asked, sums, strict=True):
            part, c = models[k]
            loss = s[0] / part.rows + 0.5 * penalty[c] * float(w[:d] @ w[:d])
            told[k].append((loss, np.append(part.maps @ s[1:] / part.rows + penalty[c] * w[:d], s[-1] / part.rows)))
        for k in open_:
            try:
                at[k] = asking[k].send(told[k])
            except StopIteration as end:
                at[k], found[k] = None, end.value
    tested = [k for k, (part, _) in enumerate(models) if part.fold >= 0]
    right = _sums(points, np.array([spread(models[k][0], found[k]) for k in tested]), [models[k][0].fold for k in tested], True)
    with np.errstate(invalid="ignore"):
        accuracy = (right[:, 0] / right[:, 1]).reshape(-1, len(costs))
    return np.array(found).reshape(len(points.parts), len(costs), d + 1), accuracy
