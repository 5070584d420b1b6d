"""Linear support vector regression against a plain subgradient check and a grid around the optimum."""

import numpy as np
import pytest

from driftwell.operators.svr import _sums, fit_svr


def objective(x, y, w, cost, epsilon):
    return w @ w / 2 + cost * np.maximum(np.abs(y - x @ w) - epsilon, 0).sum()


@pytest.mark.parametrize(("cost", "epsilon"), [(1.0, 0.2), (0.01, 0.0), (10.0, 1.0)])
def test_optimum(spark, cost, epsilon):
    rng = np.random.default_rng(3)
    x = np.stack([rng.normal(size=400), 30 * rng.random(400), rng.integers(0, 2, 400)], axis=1).astype(float)
    y = 2 * x[:, 0] - 0.3 * x[:, 1] + x[:, 2] + 4 + rng.standard_t(2, 400)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y, strict=True)], "a double, b double, c double, y double").repartition(4)
    got = fit_svr(df, ["a", "b", "c"], cost=cost, epsilon=epsilon)
    full = np.c_[x, np.ones(400)]
    assert np.isclose(objective(full, y, got.weights, cost, epsilon), got.objective)
    assert 0 <= got.gap <= 1e-3 * got.objective  # the dual value proves it
    for _ in range(300):
        near = got.weights + rng.normal(size=4) * 10.0 ** -rng.integers(1, 5) * np.abs(got.weights)
        assert objective(full, y, near, cost, epsilon) >= got.objective - got.gap
    scored = got.predict(df, ["a", "y"]).toPandas()
    order = np.argsort(x[:, 0])
    assert np.allclose(scored.sort_values("a")["y_pred"].to_numpy(), (full @ got.weights)[order])


def test_missing_values(spark):
    rows = [(float(i), 2.0 * i) for i in range(20)] + [(None, 19.0), (float("nan"), 19.0), (5.0, None), (5.0, float("nan"))]
    got = fit_svr(spark.createDataFrame(rows, "a double, y double"), ["a"])
    assert got.medians == (9.5,) and abs(got.weights[0] - 2) < 0.05
    assert got.predict(spark.createDataFrame([(None,)], "a double")).first().y_pred == pytest.approx(9.5 * got.weights[0] + got.weights[1])


def test_pass_adds_one_hessian(spark):
    """Losses of all points, slopes of the first only."""
    rng = np.random.default_rng(4)
    x, y, points = rng.normal(size=(60, 3)), rng.normal(size=60), rng.normal(size=(5, 3))
    rows = spark.createDataFrame([(r.tolist(), float(v)) for r, v in zip(x, y, strict=True)], "x array<double>, y double").repartition(3)
    losses, full = _sums(rows, points, 0.2, 0.5, 2.0)
    over = np.maximum(np.abs(y[:, None] - x @ points.T) - 0.2, 0)
    part = np.minimum(over / 0.5, 1)
    assert np.allclose(losses, 2 * (part * over - part**2 * 0.25).sum(axis=0)) and len(full) == 3 + 3 + 9
    bent = x[(over[:, 0] > 0) & (over[:, 0] < 0.5)]
    assert np.allclose(full[[0, 1]], [losses[0], 2 * over[:, 0].sum()]) and np.allclose(full[6:], 2 * (bent.T @ bent).ravel() / 0.5)
