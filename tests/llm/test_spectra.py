"""Incremental spectra against NumPy's eigenvalues, and the whitening against brute force."""

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from driftwell.llm import spectra
from driftwell.llm.registered import LLM_QUERIES
from driftwell.llm.spectra import Spectrum, secular_roots, whitened


def spectrum_of(x):
    s = Spectrum(x.shape[1])
    for row in x:
        s.add(row)
    return s


RNG = np.random.default_rng(7)
MATRICES = {
    "plain": RNG.normal(size=(120, 9)),
    "whole numbers with ties": RNG.integers(-2, 3, (200, 6)).astype(float),
    "few different rows": np.repeat(RNG.integers(-3, 4, (4, 8)), 25, 0).astype(float),
    "equal eigenvalues": np.concatenate([np.eye(12)] * 3),
    "wide range": RNG.normal(size=(150, 20)) * 10.0 ** -np.arange(20),
    "constant": np.ones((9, 3)),
    "fewer rows than columns": RNG.normal(size=(5, 16)),
}


@pytest.mark.parametrize("name", MATRICES)
@pytest.mark.parametrize("cut", [None, 0.3])
def test_spectrum(name, cut):
    x = MATRICES[name]
    s = spectrum_of(x[: int(len(x) * cut)] if cut else x)
    if cut:
        s.merge(spectrum_of(x[int(len(x) * cut) :]))
    around = x - x.mean(axis=0)
    scatter = around.T @ around
    largest = max(np.linalg.eigvalsh(scatter)[-1], 1e-300)
    assert s.n == len(x) and np.allclose(s.mean, x.mean(axis=0), atol=1e-12)
    assert np.abs(s.values - np.linalg.eigvalsh(scatter)).max() <= 1e-12 * largest
    assert np.abs(s.vectors @ s.vectors.T - np.eye(x.shape[1])).max() < 1e-12
    assert np.abs(s.vectors.T @ (s.values[:, None] * s.vectors) - scatter).max() <= 1e-12 * largest


def test_roots_interlace():
    d = np.sort(RNG.normal(size=30))
    z = RNG.normal(size=30)
    z /= np.linalg.norm(z)
    gaps = secular_roots(d, z, 2.5)
    roots = d + gaps.diagonal()
    assert (gaps.diagonal() > 0).all() and (roots[:-1] < d[1:]).all()
    assert np.allclose(roots, np.linalg.eigvalsh(np.diag(d) + 2.5 * np.outer(z, z)), atol=1e-13)


def brute(rows):
    """vec_id, x of the rows that stay; n, S; eigenvalues and vectors by falling eigenvalue."""
    keep = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.floor(64 * np.array([v for _, v in keep], float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    y = (fit * n - total) / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    return [i for i, _ in keep], x, n, total, values[::-1], vectors[:, ::-1]


def check(got, rows):
    ids, x, n, total, values, vectors = brute(rows)
    k = min(16, x.shape[1])
    assert len(got) == len(ids) * k
    table = {(r.vec_id, r.component): r for r in got}
    y = x * n - total
    project = (y / n) @ vectors[:, :k] / np.sqrt(values[:k])
    for at, i in enumerate(ids):
        for c in range(k):
            r = table[i, c + 1]
            assert (r.n, r.deviation) == (n, int((y[at].astype(object) ** 2).sum()))
            assert abs(abs(r.whitened) - abs(project[at, c])) < 1e-7
            assert abs(r.explained - values[c] / values.sum()) < 1e-9 and r.identity_error < 1e-9


@pytest.mark.parametrize("per_task", [spectra.ROWS_PER_TASK, 60])
def test_query(spark, data_dir, per_task, monkeypatch):
    monkeypatch.setattr(spectra, "ROWS_PER_TASK", per_task)  # 60: nine spectra, combined in two rounds
    got = LLM_QUERIES["op13_incremental_spectra"].job(spark, data_dir)
    assert dict(got.dtypes)["deviation"] == "bigint"
    rows = [(r["vec_id"], r["embedding"]) for r in pq.read_table(f"{data_dir}/embeddings.parquet").to_pylist()]
    check(got.collect(), rows)


def test_refinement_mends_a_poor_space(spark):
    x = np.floor(RNG.normal(size=(500, 40)) * 64 * np.linspace(3, 1, 40)).astype(np.int64)
    fit = spark.createDataFrame([(row.tolist(),) for row in x], "x array<bigint>")
    values, axes, trace = spectra.refined(fit, len(x), x.sum(axis=0), RNG.normal(size=(40, 20)))
    wanted = np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1]
    assert np.allclose(values, wanted[:16], rtol=1e-10) and abs(trace - wanted.sum()) < 1e-8 * trace


def test_cases(spark):
    base = [[float(c) for c in RNG.normal(size=5)] for _ in range(40)]
    rows = [*enumerate(base), (0, base[0]), (None, base[1]), *[(100 + i, base[2]) for i in range(30)]]
    nan, inf = float("nan"), float("inf")
    odd = [(200, None), (201, []), (202, [1.0, None, 2.0, 3.0, 4.0]), (203, [nan] * 5), (204, [inf] * 5), (205, [1.0] * 4), (None, None)]
    df = spark.createDataFrame([*rows, *odd], "vec_id long, embedding array<float>")
    for name in ("x", "n", "component", "d", "label", "count"):
        df = df.withColumn(name, F.lit(1))
    got = whitened(df).collect()
    assert len(got) == len(rows) * 5
    narrow = [(i, np.float32(v).tolist()) for i, v in rows]
    _, _, n, _, _, _ = brute(narrow)
    by_id = {}
    for r in got:
        by_id.setdefault((r.vec_id, r.component), set()).add((r.whitened, r.deviation))
    assert all(len(v) == 1 for v in by_id.values()) and {r.n for r in got} == {n} == {40}
    assert {by_id[i, 1].copy().pop() for i in (2, 100, 129)} == by_id[2, 1]
    assert by_id[None, 3] == by_id[1, 3]
    for none in (df.where("false"), df.where("vec_id in (2, 100, 101)"), df.where("vec_id >= 200"), df.where("vec_id = 3")):
        assert whitened(none).count() == 0
    two = whitened(df.where("vec_id in (1, 2)")).collect()  # one component only
    assert [r.component for r in two] == [1, 1] and sorted(round(r.whitened, 9) for r in two) == [-1, 1]
