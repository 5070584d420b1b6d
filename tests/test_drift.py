"""Drift and metrics against NumPy on small data."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from driftwell.operators import drift as D
from driftwell.operators import metrics as M


def numpy_psi(ref, cur, bins=10):
    edges = np.quantile(ref, [i / bins for i in range(bins + 1)])
    for i in range(1, len(edges)):
        edges[i] = max(edges[i], edges[i - 1] + 1e-9) if edges[i] <= edges[i - 1] else edges[i]
    edges[0], edges[-1] = -np.inf, np.inf
    p, q = (np.clip(np.histogram(x, edges)[0] / len(x), 1e-6, 1) for x in (ref, cur))
    p, q = p / p.sum(), q / q.sum()
    return float(np.sum((p - q) * np.log(p / q)))


def sample(n, shift=0.0, ties=False, seed=0):
    rnd = random.Random(seed)
    return [float(rnd.randint(0, 3)) if ties else rnd.gauss(shift, 1.0) for _ in range(n)]


def frames(spark, ref, cur, kind="double"):
    make = lambda x: spark.createDataFrame([(v,) for v in x], f"a {kind}")
    return make(ref), make(cur)


@pytest.mark.parametrize("ties", [False, True])
def test_psi(spark, ties):
    ref, cur = sample(503, ties=ties), sample(401, 0.4, ties, seed=1)
    a, b = frames(spark, ref, cur)
    row = D.psi_table(a, b, ["a"]).first()
    assert row["psi"] == pytest.approx(numpy_psi(ref, cur), rel=1e-6)
    assert row["ref_mean"] == pytest.approx(np.mean(ref))


def test_psi_needs_fifty_values(spark):
    a, b = frames(spark, sample(49) + [None] * 40 + [float("nan")] * 9, sample(100))
    assert D.psi_table(a, b, ["a"]).first()["psi"] is None


def test_psi_with_infinite_values(spark):
    ref, cur = sample(100), sample(100, 1.0, seed=2)
    a, b = frames(spark, ref, cur + [float("inf")])
    assert D.psi_table(a, b, ["a"]).first()["psi"] == pytest.approx(numpy_psi(ref, cur), rel=1e-6)


def numpy_jsd(ref, cur, eps=1e-8):
    keys = sorted(set(ref) | set(cur))
    p, q = (np.clip([Counter(x)[k] / max(len(x), 1) for k in keys], eps, 1) for x in (ref, cur))
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    return float(0.5 * np.sum(p * np.log(p / m)) + 0.5 * np.sum(q * np.log(q / m)))


def test_jsd(spark):
    ref, cur = list("aaabbc"), list("abccd")
    a, b = frames(spark, [*ref, None], [*cur, None, None], "string")
    row = D.jsd_table(a, b, ["a"]).first()
    assert row["jsd"] == pytest.approx(numpy_jsd(ref, cur), rel=1e-9)
    assert (row["ref_unique"], row["cur_unique"]) == (3, 4)


def test_jsd_of_disjoint_and_empty(spark):
    a, b = frames(spark, ["a"], ["b"], "string")
    assert D.jsd_table(a, b, ["a"]).first()["jsd"] == pytest.approx(math.log(2), abs=1e-5)
    a, b = frames(spark, [None], [None], "string")
    row = D.jsd_table(a, b, ["a"]).first()
    assert row["jsd"] is None and (row["ref_unique"], row["cur_unique"]) == (0, 0)


def brute_ks(ref, cur):
    points = sorted(set(ref) | set(cur))
    return max(abs(sum(x <= t for x in ref) / len(ref) - sum(x <= t for x in cur) / len(cur)) for t in points)


@pytest.mark.parametrize("ties", [False, True])
@pytest.mark.parametrize("buckets", [2, 8, 512])
def test_ks(spark, ties, buckets):
    ref, cur = sample(200, ties=ties), sample(150, 0.3, ties, seed=3)
    a, b = frames(spark, [*ref, None], [*cur, float("nan")])
    row = D.ks_two_sample(a, b, ["a"], buckets).first()
    assert row["ks"] == pytest.approx(brute_ks(ref, cur)) and (row["n_ref"], row["n_cur"]) == (200, 150)


def test_ks_of_like_and_unlike_slices(spark):
    a, b = frames(spark, sample(300), sample(300))
    assert D.ks_two_sample(a, b, ["a"]).first()["ks"] == 0.0
    a, b = frames(spark, [1.0, 2.0], [3.0, 4.0])
    assert D.ks_two_sample(a, b, ["a"]).first()["ks"] == 1.0
    a, b = frames(spark, [1.0], [None])
    assert D.ks_two_sample(a, b, ["a"]).count() == 0


@pytest.mark.parametrize("ties", [False, True])
def test_ks_by_chunk(spark, ties):
    ref, cur = sample(120, ties=ties), sample(250, 0.3, ties, seed=4)
    a, _ = frames(spark, ref, cur)
    b = spark.createDataFrame([(i, v) for i, v in enumerate(cur)], "id long, a double").repartition(5)
    chunked = D.with_chunk(b, "id", ["id"], 100)
    got = {r["chunk"]: r["ks"] for r in D.ks_by_chunk(a, chunked, ["a"]).collect()}
    assert got == {k: pytest.approx(brute_ks(ref, cur[k * 100 : k * 100 + 100])) for k in range(3)}


def test_chi2_by_chunk(spark):
    ref, cur = list("aaaabbbcc"), list("abcd" * 3)
    a, _ = frames(spark, ref, cur, "string")
    b = spark.createDataFrame([(0, v) for v in cur], "chunk long, a string")
    row = D.chi2_by_chunk(a, b, ["a"]).first()
    table = np.array([[Counter(x)[k] for k in "abcd"] for x in (ref, cur)], float)
    expected = table.sum(1, keepdims=True) * table.sum(0) / table.sum()
    assert row["chi2"] == pytest.approx(((table - expected) ** 2 / expected).sum()) and row["df"] == 3


def test_chi2_critical_point_beyond_the_table(spark):
    got = spark.range(1, 31).select(D.chi2_critical("id").alias("c")).collect()
    assert got[0]["c"] == pytest.approx(3.841459) and got[29]["c"] == pytest.approx(43.773, abs=0.02)


def test_chunk_monitor_and_alerts(spark):
    ref = spark.createDataFrame([(i, float(i % 50), "x" if i % 2 else "y", 1.0) for i in range(400)], "id long, trip_distance double, flag string, k double")
    cur = spark.createDataFrame([(i, float(i % 50) + 30, "x" if i % 2 else "y", 1.0) for i in range(400)], "id long, trip_distance double, flag string, k double")
    columns = ["trip_distance", "flag", "k", "absent"]
    assert D.usable_columns(ref, cur, columns) == ["trip_distance", "flag"]
    found = {r["feature"]: r["drifted"] for r in D.drifted_columns(D.chunk_drift(ref, cur, "id", ["id"], columns)).collect()}
    assert found == {"trip_distance": True, "flag": False}


def test_chunk_size():
    assert [D.chunk_size(n) for n in (10, 500, 5000)] == [100, 500, 1000]


def test_fallback(spark):
    ref = spark.createDataFrame([(1.0, "a")] * 100, "n double, s string")
    cur = spark.createDataFrame([(None, "a")] * 6 + [(1.0, "b")] * 94, "n double, s string")
    assert sorted(r["warning"] for r in D.fallback_drift(ref, cur).collect()) == [
        "Column 'n': missing values increased from 0.0% to 6.0%",
        "Column 's': 94 rows with unseen categorical values",
    ]
    cur = spark.createDataFrame([(None, "a")] * 5 + [(1.0, "a")] * 95, "n double, s string")
    assert D.fallback_drift(ref, cur).count() == 0


def test_report_summary(spark):
    ref, cur = sample(100), sample(100, 3.0, seed=5)
    a, b = frames(spark, ref, cur)
    row = D.drift_summary(D.drift_report(a, b)).first()
    assert row["psi_gt_0_25"] == 1 and row["psi_max"] == row["psi_mean"]


# ---- metrics ----------------------------------------------------------------


def test_auc_with_ties(spark):
    rnd = random.Random(6)
    rows = [(rnd.randint(0, 1), float(rnd.randint(0, 9))) for _ in range(300)]
    pos, neg = ([s for y, s in rows if y == k] for k in (1, 0))
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert M.roc_auc(spark.createDataFrame(rows, "y int, s double"), "y", "s").first()["auc"] == pytest.approx(want)
    one = spark.createDataFrame([(1, 0.5)], "y int, s double")
    assert M.roc_auc(one, "y", "s").first()["auc"] is None


def test_report_of_classes(spark):
    rows = [("a", "a")] * 5 + [("a", "b")] * 2 + [("b", "b")] * 3 + [("c", "a")]
    got = {r["class"]: r for r in M.classification_report(spark.createDataFrame(rows, "y string, p string"), "y", "p").collect()}
    assert got["a"]["precision"] == pytest.approx(5 / 6) and got["a"]["recall"] == pytest.approx(5 / 7)
    assert (got["c"]["precision"], got["c"]["recall"], got["c"]["f1"], got["c"]["support"]) == (0.0, 0.0, 0.0, 1)
    assert got["accuracy"]["f1"] == pytest.approx(8 / 11) and got["macro avg"]["support"] == 11


def test_increase_over_zero_baseline(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "y double, p double")
    row = M.against_mean(df, "y", "p", 1.0).first()
    assert row["rmse_baseline"] == 0.0 and row["rmse_increase_pct"] == 0.0


def test_averaged_gradient(spark):
    rows = [(s, float(i), float(i * 2)) for s in range(3) for i in range(s + 2)]
    df = spark.createDataFrame(rows, "s int, x double, y double")
    row = M.averaged_gradient(df, ["x"], "y", [0.5], "s").first()
    local = [np.mean([(0.5 * x - y) * x for k, x, y in rows if k == s]) for s in range(3)]
    assert row["grad_x"] == pytest.approx(np.mean(local)) and row["workers"] == 3


def test_cv_summary_rounds_half_to_even(spark):
    df = spark.createDataFrame([(1, 0.5, 2), (1, 0.7, 3), (2, 0.5, 3), (2, 0.5, 4)], "trial_id int, best_auc double, best_iteration int")
    assert {r["trial_id"]: r["best_iteration"] for r in M.cv_trial_summary(df).collect()} == {1: 2, 2: 4}


@pytest.mark.parametrize("edges", [2, 1000])
def test_ks_by_chunk_looks_up_few_values(spark, edges, monkeypatch):
    """Exact for any number of edges, and no (feature, chunk, value) row but those that can decide."""
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=3000), np.r_[rng.normal(0.3, 1, 1900), np.full(100, 0.25)]
    ref = spark.createDataFrame([(i, float(x), float(i % 3), None) for i, x in enumerate(a)], "id int, x double, k double, z double")
    cur = spark.createDataFrame([(i, float(x) if i % 9 else None, float(i % 4), 1.0) for i, x in enumerate(b)], "id int, x double, k double, z double")
    written = {}
    keep = D.pin
    monkeypatch.setattr(D, "pin", lambda df, name="table": written.setdefault(name, keep(df, name)))
    found = D.ks_by_chunk(ref, D.with_chunk(cur, "id", ["id"], 500, keep=["x", "k", "z"]), ["x", "k", "z"], edges_wanted=edges).collect()
    got = {(r["feature"], r["chunk"]): (r["n_ref"], r["n_cur"], r["ks"]) for r in found}
    assert len(got) == 8
    for k in range(4):
        for name, ours, theirs in (("x", a, [x for i, x in enumerate(b) if i // 500 == k and i % 9]), ("k", np.arange(3000) % 3, [i % 4 for i in range(500 * k, 500 * k + 500)])):
            at = np.unique(np.r_[ours, theirs])
            want = np.abs(np.searchsorted(np.sort(ours), at, "right") / 3000 - np.searchsorted(np.sort(theirs), at, "right") / len(theirs)).max()
            assert got[name, k] == (3000, len(theirs), pytest.approx(want, abs=1e-12))
    asked = written["bounds"].where("cell is not null").count()
    assert asked < (2000 if edges == 2 else 60)
