"""Sources, sinks, streaming replay, model store and the monitoring run."""

import datetime as dt
import json
import random
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftwell.functions.columns import PICKUP, tip_frame
from driftwell.operators import boosting as B
from driftwell.operators import metrics as M
from driftwell.operators import models as L
from driftwell.operators import ticks as T
from driftwell.operators.profile import GateRules
from driftwell.operators.drift import MONITORED_COLUMNS
from driftwell.plans.monitoring import MonitorConfig, integrity_gate, run_monitoring
from driftwell.plans.roles import both_slices
from driftwell.plans.store import ModelStore
from driftwell.session import pin, shared_dir
from driftwell.sources import sinks, slices
from driftwell.streaming import ticks as S

T0 = dt.datetime(2020, 1, 6)


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


# ---- sources and sinks ------------------------------------------------------


def test_slices_by_suffix(spark, folder):
    rows = [("2020-01-01 10:00:00", "2020-01-01 10:10:00", 1.5), ("bad", "2020-01-02 00:00:00", float("nan"))]
    df = spark.createDataFrame(rows, "lpep_pickup_datetime string, lpep_dropoff_datetime string, trip_distance double")
    path = slices.SLICE_NAME.format(year="2021", month="04")
    df.write.parquet(f"{folder}/{path}")
    got = slices.load_month(spark, folder, "04", "2021")
    assert dict(got.dtypes)[PICKUP] == "timestamp_ntz"
    assert got.where(f"{PICKUP} is null").count() == 1 and got.where("trip_distance is null").count() == 1
    df.write.csv(f"{folder}/slice.csv", header=True)
    assert slices.load_slice(spark, f"{folder}/slice.csv").count() == 2
    months = slices.load_months(spark, [f"{folder}/{path}", f"{folder}/none.parquet"])
    assert {r["month"] for r in months.select("month").distinct().collect()} == {"04"}


def test_bad_paths(spark, folder):
    with pytest.raises(FileNotFoundError):
        slices.load_slice(spark, f"{folder}/absent.parquet")
    with pytest.raises(FileNotFoundError):
        slices.load_month(spark, folder, "01")
    with pytest.raises(FileNotFoundError):
        slices.load_months(spark, [f"{folder}/a.parquet"])
    with open(f"{folder}/x.txt", "w") as f:
        f.write("\n   \n")
    with pytest.raises(ValueError, match="Unsupported"):
        slices.load_slice(spark, f"{folder}/x.txt")
    with pytest.raises(ValueError, match="No tokenized"):
        slices.load_corpus(spark, f"{folder}/x.txt")


def test_corpus_and_zones(spark, folder):
    with open(f"{folder}/docs.txt", "w") as f:
        f.write("one two\n\n  three  \n")
    assert sorted(r["doc"] for r in slices.load_corpus(spark, f"{folder}/docs.txt").collect()) == [["one", "two"], ["three"]]
    features = [{"properties": {"locationid": i, "zone": f"z{i}", "borough": "B"}} for i in ("1", "2", "2", "x")]
    with open(f"{folder}/zones.geojson", "w") as f:
        json.dump({"type": "FeatureCollection", "features": features}, f)
    zones = slices.load_zones(spark, f"{folder}/none.csv", f"{folder}/zones.geojson")
    assert zones.columns == ["LocationID", "Zone", "Borough"] and zones.count() == 3
    assert zones.where("LocationID is null").count() == 1


def test_decision_log_skips_bad_records(spark, folder):
    good = {"step": "B", "run_id": "r1", "timestamp": "2026-01-02T03:04:05.123", "hard_failures": ["f"], "warned": ["a", "b"], "drift_columns": ["c"], "integrity_passed": True}
    late = {"step": "B", "run_id": "r0", "timestamp": "2025-01-01T00:00:00"}
    with open(f"{folder}/log.json", "w") as f:
        f.write("\n".join([json.dumps(good), '{"step": "B", "run', "", json.dumps(late)]))
    log = slices.load_decisions(spark, f"{folder}/log.json", warnings_field="warned").collect()
    assert [r["run_id"] for r in log] == ["r0", "r1"]
    assert (log[1]["num_warnings"], log[1]["num_hard_failures"], log[1]["integrity_passed"], log[1]["run_name"]) == (2, 1, True, "r1")
    assert (log[0]["num_warnings"], log[0]["integrity_passed"]) == (0, False)


def test_rank_log(spark, folder):
    lines = [
        "profiled step summary",
        "  rank 0: profiled_steps=2, profiled_images=128, avg_profiled_step_time=0.2135s, loss=7.0921",
        "  rank 1: profiled_steps=2, profiled_images=128, avg_profiled_step_time=0.2154s, loss=7.1844",
        "  rank 0: local_rank=0 device=cuda:0",
    ]
    with open(f"{folder}/run.log", "w") as f:
        f.write("\n".join(lines))
    row = M.throughput(slices.load_rank_logs(spark, f"{folder}/run.log"), "run").first()
    # the log itself says 594.3 images/s from seconds with more digits
    assert row["window_images"] == 256 and row["images_per_second"] == pytest.approx(594.3, abs=0.1)


def test_sinks(spark, folder):
    df = spark.range(1000).withColumn("l", F.array(F.lit("a"), F.lit("b")))
    sinks.write_shards(df, f"{folder}/shards", 4, "id")
    assert slices.load_shards(spark, f"{folder}/shards").count() == 1000
    sinks.write_csv(df, f"{folder}/csv")
    assert spark.read.csv(f"{folder}/csv", header=True).first()["l"] == "a; b"
    assert sinks.write_report_table(df, f"{folder}/table") and not sinks.write_report_table(df.where("id < 0"), f"{folder}/none")


def test_shared_dir_and_pin(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    df = pin(spark.range(10).withColumn("r", F.rand()))
    assert df.collect() == df.collect()


# ---- streaming --------------------------------------------------------------


def ticks_input(spark, n_ticks=6, zones="abc"):
    grid = spark.createDataFrame([(z, T0 + dt.timedelta(minutes=15 * k)) for z in zones for k in range(n_ticks)], "zone_id string, tick timestamp_ntz")
    rows = [
        ("a", 0, "NEED", 0.5, 1),
        ("a", 0, "OK", 0.6, 2),
        ("a", 0, "OK", 5.0, 3),
        ("b", 1, "NEED", 1.5, 4),
        ("b", 3, "OK", 2.5, 5),
        ("c", 2, "NEED", 0.1, 6),
        ("c", 2, "OK", 0.05, 7),
    ]
    data = [(z, T0 + dt.timedelta(minutes=15 * k), d, lat, s) for z, k, d, lat, s in rows]
    return grid, spark.createDataFrame(data, "zone_id string, tick timestamp_ntz, decision string, latency_s double, seq long")


@pytest.mark.parametrize("files", [1, 4])
def test_stream_equals_batch_on_closed_ticks(spark, folder, files):
    spark.conf.set(S.STATE_STORE, S.ROCKSDB)
    cfg = T.TickConfig(completion_fraction=2.0, tick_timeout_s=2.0)
    grid, reports = ticks_input(spark)
    feed = S.replay_input(grid, reports).orderBy("arrival", "seq")
    for i in range(files):  # several files become several micro-batches, in arrival order
        part = feed.withColumn("k", F.floor(F.minute("tick") / 15) + 4 * (F.hour("tick"))).where(F.col("k") % files == i if files == 1 else F.floor(F.col("k") * files / 6) == i)
        part.drop("k").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = S.read_stream(spark, f"{folder}/in", S.REPORT_FIELDS, files_per_batch=1)
    S.run_to_sink(S.zone_outcomes(stream, "0 seconds", cfg), f"{folder}/out", f"{folder}/check")
    out = spark.read.parquet(f"{folder}/out")
    first = T.first_reports(reports)
    batch = T.accepted_decisions(grid, first, T.tick_close(first, 3, cfg), cfg)
    last = grid.agg(F.max("tick")).first()[0]
    want = {(r["zone_id"], r["tick"]): (r["decision"], r["used_fallback"]) for r in batch.where(F.col("tick") < F.lit(last)).collect()}
    got = {(r["zone_id"], r["tick"]): (r["decision"], r["used_fallback"]) for r in out.where("kind = 'accepted'").withColumn("tick", F.col("tick").cast("timestamp_ntz")).collect()}
    assert got == want
    assert sorted((r["kind"], r["seq"]) for r in out.where("kind <> 'accepted'").collect()) == [("duplicate", 2), ("duplicate", 6), ("late", 3), ("late", 5)]


def test_files_out_of_order_lose_nothing(spark, folder):
    """Newer files first, one file per batch: equal totals with and without batches."""
    for day in (9, 3, 6, 1):
        rows = spark.range(50).selectExpr(f"timestamp_seconds(1700000000 + {day} * 86400 + id * 60) as ts", "'z' as zone", "id")
        rows.coalesce(1).write.mode("append").parquet(f"{folder}/late")
    schema = "ts timestamp, zone string, id bigint"
    totals = set()
    for files in (1, None):
        out = f"{folder}/late-out-{files}"
        stream = S.read_stream(spark, f"{folder}/late", schema, files)
        run = S.run_to_sink(S.tick_counts(stream, "zone", "ts"), out, f"{out}-check", "update")
        totals.add(S.read_keyed(spark, out, ["zone_id", "tick"]).agg(F.sum("n")).first()[0])
        assert S.dropped_rows(run) == 0
    assert totals == {200}
    stream = S.read_stream(spark, f"{folder}/late", schema, 1)
    run = S.run_to_sink(S.tick_counts(stream, "zone", "ts", late="1 hour"), f"{folder}/strict", f"{folder}/strict-check")
    assert S.dropped_rows(run) > 0


def test_keyed_sink_is_idempotent(spark, folder):
    write = S.keyed_sink(f"{folder}/out")
    a = spark.createDataFrame([("z", 1, 5)], "zone_id string, tick int, n int")
    b = spark.createDataFrame([("z", 1, 6)], "zone_id string, tick int, n int")
    for batch, number in ((a, 0), (b, 1), (b, 1), (a, 0)):
        write(batch, number)
    assert spark.read.parquet(f"{folder}/out").count() == 2
    assert S.read_keyed(spark, f"{folder}/out", ["zone_id", "tick"]).first()["n"] == 6
    assert S.read_keyed(spark, f"{folder}/out", ["zone_id", "tick"], "first").first()["n"] == 5


def test_new_slices_run_the_job_once(spark, folder):
    seen = []
    schema = "id long"
    for n in (3, 5):
        spark.range(n).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        S.on_new_slice(S.read_stream(spark, f"{folder}/in", schema), lambda df, i: seen.append((i, df.count())), f"{folder}/check")
    assert seen == [(0, 3), (1, 5)]


# ---- models -----------------------------------------------------------------


def test_components_match_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 3)) @ np.array([[1, 0.5, 0], [0, 1, 0.2], [0, 0, 0.3]])
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    variance, loadings = L.principal_components(df, ["a", "b", "c"])
    values, vectors = np.linalg.eigh(np.corrcoef(x.T))
    ratios = [r["ratio"] for r in variance.orderBy("component").collect()]
    assert np.allclose(ratios, values[::-1] / values.sum(), atol=1e-6)
    first = {r["feature"]: abs(r["loading"]) for r in loadings.where("component = 1").collect()}
    assert np.allclose([first[c] for c in "abc"], np.abs(vectors[:, -1]), atol=1e-6)


def test_ridge_and_tree(spark):
    rows = [(float(i % 17), float(i % 5), 3.0 * (i % 17) - 2.0 * (i % 5) + 1.0) for i in range(400)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    table, model = L.ridge(df, ["a", "b"], penalty=1e-6)
    assert [(r["feature"], round(r["coefficient"], 3)) for r in table.collect()] == [("a", 3.0), ("b", -2.0)]
    assert L.error_row(L.score(model, df, ["y"]))["rmse"] < 0.01
    tree = L.fit_tree(df.withColumn("a", F.when(F.col("a") != 3, F.col("a"))), ["a", "b"], leaf=5)
    assert L.error_row(L.score(tree, df, ["y"]))["rmse"] < 6


def test_boosting_keeps_no_node_ids(spark):
    """A fit without node ids gives the trees of one with them."""
    df = spark.createDataFrame([(float(i % 10), float(i % 7), float(i % 10 > 4) + i % 7) for i in range(400)], "x double, z double, y double")
    kept = L.boosted_regressor(["x", "z"], "y", L.Boost(trees=3, depth=4))
    assert not kept.getStages()[-1].getOrDefault("cacheNodeIds")
    kept.getStages()[-1].setCacheNodeIds(True)
    fitted = [L.fit_boosted(df, ["x", "z"], "y", L.Boost(trees=3, depth=4)), kept.fit(df)]
    assert len({m.stages[-1].toDebugString.split("\n", 1)[1] for m in fitted}) == 1


def test_curve_and_search(spark):
    df = spark.createDataFrame([(float(i % 10), int(i % 10 > 4), (i // 10) % 2) for i in range(200)], "x double, y int, fold int")
    size = L.Boost(trees=4, depth=2, rate=0.3)
    model = L.fit_boosted_classifier(df, ["x"], "y", size)
    curve = L.validation_curve(model, df)
    assert curve.count() == 4 and L.best_iteration(curve) == 3
    _, auc = L.refit_at_best(df, df, ["x"], 3, "y", size)
    assert auc == 1.0
    found = B.cross_validate(df, ["x"], "fold", "y", B.random_trials(2), 2)
    assert found.count() == 4 and M.cv_trial_summary(found).where("score > 0.99").count() == 2


def config(**change):
    base = dict(
        keys=["trip_id"],
        order_by="lpep_dropoff_datetime",
        rules=GateRules(critical=(), max_invalid=0.5, max_order=0.5),
        champion=L.Boost(trees=1, depth=2, rate=0.3),
        candidate=L.Boost(trees=3, depth=4, rate=0.3),
    )
    return MonitorConfig(**(base | change))


def test_monitoring_stops_at_the_gate(spark, data_dir, folder):
    ref, cur = both_slices(spark, data_dir)
    result = run_monitoring(ref, cur, ModelStore(spark, f"{folder}/store"), config(rules=GateRules()), f"{folder}/log")
    assert result.stopped_at == "integrity" and list(result.decisions) == ["integrity"]
    log = slices.load_decisions(spark, f"{folder}/log").collect()
    assert len(log) == 1 and not log[0]["integrity_passed"] and log[0]["num_hard_failures"] > 0


def test_fallback_warnings_reach_the_decision(spark, data_dir):
    """No column can be monitored by chunk: unseen categories still warn."""
    ref, cur = both_slices(spark, data_dir)
    flat = {c: F.lit(1.0) for c in MONITORED_COLUMNS}
    odd = cur.withColumns(flat).withColumn("store_and_fwd_flag", F.lit("Q"))
    decision, _ = integrity_gate(ref.withColumns(flat), odd, config())
    assert decision["integrity_warn"] and "store_and_fwd_flag" in decision["drift_columns"]
    assert len(decision["drift_warnings"]) >= 1


def test_monitoring_promotes_and_then_keeps(spark, data_dir, folder):
    ref, cur = both_slices(spark, data_dir)
    store = ModelStore(spark, f"{folder}/store-{uuid.uuid4().hex}")
    first = run_monitoring(ref, cur, store, config(degradation_pct=-100.0))
    assert first.decisions["champion"]["bootstrap"] and first.decisions["retrain"]["retrain_executed"]
    assert first.decisions["promotion"]["promotion_executed"], first.decisions["promotion"]
    assert store.alias("trip_tip_model", "champion") == "2"
    assert store.alias("trip_tip_model", "previous_champion") == "1"
    assert first.tables["predictions"].count() == cur.count()
    second = run_monitoring(ref, cur, store, config(degradation_pct=1e9))
    assert not second.decisions["champion"]["bootstrap"]
    assert second.decisions["retrain"]["action"] == "skip_retrain"
    assert second.decisions["promotion"]["reason"] == "No retraining executed; no candidate to promote."


def test_tip_frame_leaves_out_the_total(spark, data_dir):
    ref, _ = both_slices(spark, data_dir)
    df, features = tip_frame(ref)
    assert "total_amount" not in features and "tip_amount" not in features and df.where("y is null").count() == 0
    with pytest.raises(ValueError, match="tip_amount"):
        tip_frame(ref.drop("tip_amount"))


def test_svc_grid_fits_as_spark_does(spark):
    """All models of the grid, fitted in common passes without cached rows, are those of Spark's cross-validation."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LinearSVC
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.feature import StandardScaler
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    draw = random.Random(5)
    rows = []
    for i in range(400):
        a, b, c = draw.gauss(0, 1), draw.gauss(50, 10), draw.gauss(2, 0.1)
        y = float(a + 0.2 * (b - 50) - 4 * (c - 2) + draw.gauss(0, 1.5) > 0.4)
        rows.append((y, None if i % 11 == 0 else a, float("nan") if i % 13 == 0 else b, c, 7.0, i % 6))
    df = pin(spark.createDataFrame(rows, "y double, a double, b double, c double, d double, e int").repartition(3), "points")
    names = ["a", "b", "c", "d", "e"]
    table, model = L.svc_grid(df, names, costs=(1, 100), folds=2)
    assert not df.is_cached and not spark.sparkContext._jsc.getPersistentRDDs()
    svc = LinearSVC(labelCol="y", featuresCol="scaled", maxIter=30, tol=1e-3)
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    grid = ParamGridBuilder().addGrid(svc.regParam, [1.0 / (c * 400) for c in (1, 100)]).build()
    judge = MulticlassClassificationEvaluator(labelCol="y", metricName="accuracy")
    pipe = Pipeline(stages=[*L.assembled(names), scaler, svc])
    want = CrossValidator(estimator=pipe, estimatorParamMaps=grid, evaluator=judge, numFolds=2, seed=0).fit(L.ints_to_double(df))
    got = {r.cost: r.accuracy for r in table.collect()}
    assert [got[1.0], got[100.0]] == pytest.approx(want.avgMetrics, abs=1e-9)
    one, other = model.stages[-1], want.bestModel.stages[-1]
    assert one.coefficients.toArray() == pytest.approx(other.coefficients.toArray(), abs=1e-6)
    assert one.intercept == pytest.approx(other.intercept, abs=1e-6) and one.getRegParam() == other.getRegParam()
    assert model.transform(L.ints_to_double(df)).count() == 400
    with pytest.raises(ValueError, match="Labels"):
        L.svc_grid(df.withColumn("y", F.col("y") + 1), names)
