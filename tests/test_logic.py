"""Features, counting, reports, gates, registry, splits, ticks and vectors on small frames."""

import datetime as dt
import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftwell.functions import columns as C
from driftwell.functions.text import letter_bucket, tokens
from driftwell.operators import counting as K
from driftwell.operators import features as X
from driftwell.operators import registry as R
from driftwell.operators import reports as P
from driftwell.operators import sampling as S
from driftwell.operators import ticks as T
from driftwell.operators import vectors as V

T0 = dt.datetime(2020, 1, 6)  # a Monday


# ---- columns and features ---------------------------------------------------


def test_latency_bands(spark):
    edge = [-2, -1, 0, 60, 61, 120, 121, 240, 241, None]
    df = spark.createDataFrame([(T0, "crash", v) for v in edge], "event_ts timestamp_ntz, event_type string, latency_ms int")
    got = [r["latency_band"] for r in X.enrich_events(df).collect()]
    assert got == [None, None, "fast", "fast", "stable", "stable", "slow", "slow", "spiky", None]


def test_engineered_defaults(spark):
    layout = "lpep_pickup_datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz, PULocationID long, trip_distance double, passenger_count double, payment_type double, tolls_amount double"
    rows = [(None, T0, None, None, None, None, None), (T0, T0 + dt.timedelta(hours=9), 400, -3.0, 9.7, 2.0, 0.5)]
    a, b = X.engineer_features(spark.createDataFrame(rows, layout)).collect()
    assert (a["pickup_hour"], a["pu_location_norm"], a["passenger_count_binned"], a["trip_duration_minutes"]) == (-1, 0.0, 1, 0.0)
    assert a["log_trip_distance"] == b["log_trip_distance"] == pytest.approx(math.log(1.1))
    assert (b["pickup_day_of_week"], b["pu_location_norm"], b["passenger_count_binned"], b["trip_duration_minutes"]) == (0, 1.0, 6, 300.0)
    assert [b[f"payment_type_{k}"] for k in (1, 2, 3, 4)] == [0, 1, 0, 0] and b["has_tolls"] == 1


def test_leaky_total_can_be_dropped(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "fare_amount double, total_amount double")
    assert X.engineer_features(df).columns == ["log_fare_amount", "log_total_amount"]
    assert X.engineer_features(df, drop_leaky=True).columns == ["log_fare_amount"]


def test_feature_schema_mismatch(spark):
    df = spark.createDataFrame([(1.0,)], "a double")
    with pytest.raises(ValueError, match="mismatch"):
        X.feature_schema(df, df.withColumn("b", F.lit(1)))
    with pytest.raises(ValueError, match="Missing required feature columns"):
        C.align_columns(df, ["a", "z"])


def test_clip_needs_more_than_twenty_values(spark):
    make = lambda n: spark.createDataFrame([(float(i),) for i in range(n)] + [(None,)], "v double")
    top = lambda n: X.clip_upper_tail(make(n), ["v"], 0.5).agg(F.max("value"), F.count(F.lit(1))).first()
    assert tuple(top(21)) == (20.0, 20)  # 20 positive values: not clipped
    assert tuple(top(22)) == (11.0, 21)


def test_message_columns_and_lists(spark):
    df = spark.createDataFrame([("Column 'a b' has 2",), ("Critical column 'x' has 1",), ("none",)], "m string")
    assert [r[0] for r in df.select(C.column_in_message("m")).collect()] == ["a b", None, None]
    lists = spark.createDataFrame([(["a", "b"],), ([],)], "l array<string>")
    back = lists.select(C.split_list(C.join_list("l", "; "), "; ").alias("l"))
    assert [r[0] for r in back.collect()] == [["a", "b"], []]


def test_text_rounding_matches_python(spark):
    values = [6.25, 6.35, 6.75, 0.05, 2.675, 1.005, 0.125, 0.375, -0.125, -0.004, 63.5, 0.15, 1e6 + 0.05, 12.5, 99.95]
    values += [k / 20 for k in range(400)] + [k / 37 for k in range(200)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (1, 2, 4):
        got = df.select(F.format_string(f"%.{digits}f", C.to_digits(F.col("v"), digits)).alias("t")).collect()
        assert [r["t"] for r in got] == [f"{v:.{digits}f}" for v in values]


def test_status_labels(spark):
    df = spark.createDataFrame([(80.0, 10), (79.9, 9), (50.0, 5), (49.9, 4)], "s double, n int")
    got = [tuple(r) for r in df.select(C.quality_status("s"), C.severity("n")).collect()]
    assert got == [("GOOD", "CRITICAL"), ("MODERATE", "HIGH"), ("MODERATE", "HIGH"), ("POOR", "MEDIUM")]


# ---- words ------------------------------------------------------------------

LINES = ["The quick tide ran", "  the tide\tran out ", "", "Zebra émigré 9 i j r s", "   "]


def test_tokens_match_python_split(spark):
    df = spark.createDataFrame([(t,) for t in LINES], "text string")
    assert [r[0] for r in df.select(tokens("text")).collect()] == [t.split() for t in LINES]
    got = {r["word"]: r["n"] for r in K.word_count(df).collect()}
    want = {}
    for t in LINES:
        for w in t.split():
            want[w] = want.get(w, 0) + 1
    assert got == want and K.count_mismatches(K.word_count(df), K.word_count_two_step(df)).count() == 0


def test_mismatches_are_found(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "word string, n long")
    b = spark.createDataFrame([("x", 1), ("y", 3), ("z", 1)], "word string, n long")
    assert sorted(tuple(r) for r in K.count_mismatches(a, b).collect()) == [("y", 2, 3), ("z", None, 1)]


def test_letter_buckets(spark):
    df = spark.createDataFrame([(w,) for w in ["apple", "I", "j", "Rust", "s", "9", "(x)", "émigré"]], "w string")
    assert [r[0] for r in df.select(letter_bucket("w")).collect()] == [0, 0, 1, 1, 2, 0, 0, 2]


def test_repeat_multiplies_counts(spark):
    df = spark.createDataFrame([(t,) for t in LINES], "text string")
    once = {r["word"]: r["n"] for r in K.word_count(df).collect()}
    assert {r["word"]: r["n"] for r in K.word_count(K.repeat_rows(df, 7)).collect()} == {w: 7 * n for w, n in once.items()}


def test_chunk_stats(spark):
    df = spark.createDataFrame(list(enumerate(LINES)), "id int, text string")
    got = {r["chunk_id"]: tuple(r)[1:] for r in K.chunk_stats(K.with_chunk_id(df, "id", 2), "chunk_id", k=2).collect()}
    assert got[0] == (2, 8, "ran:2, tide:2") and got[1] == (2, 7, "9:1, Zebra:1") and got[2] == (1, 0, None)


def test_paid_rate(spark):
    df = spark.createDataFrame([(1.0,), (None,), (0.0,), (2.0,)], "v double")
    row = df.agg(K.paid_rate("v").alias("a"), K.paid_rate("v", True).alias("b")).first()
    assert (row["a"], row["b"]) == (0.5, pytest.approx(2 / 3))
    assert df.where("1 = 0").agg(K.paid_rate("v")).first()[0] is None


def test_dominant_year_and_busy_months(spark):
    rows = [(dt.datetime(2020, 1, 1),)] * 3 + [(dt.datetime(2020, 2, 1),)] * 2 + [(dt.datetime(2019, 5, 1),)] * 4 + [(None,)] * 9
    df = spark.createDataFrame(rows, "p timestamp_ntz")
    assert [tuple(r) for r in K.busy_months(df, "p", 3).collect()] == [(2020, 1, 3)]
    assert K.in_busy_months(df, "p", 3).count() == 3


def test_layout_does_not_matter(spark):
    df = spark.createDataFrame([(i, f"w{i % 7} w{i % 3}") for i in range(200)], "id int, text string")
    results = []
    for parts in (1, 5, 13):
        d = df.repartition(parts, F.rand(parts))
        ids = {r["id"]: r["chunk_id"] for r in K.with_chunk_id(d, "id", 9).collect()}
        folds = {r["id"]: r["fold"] for r in S.stratified_folds(d.withColumn("y", F.col("id") % 2), ["id"], "y", 3).collect()}
        drawn = sorted(tuple(r) for r in S.sample_to_workers(d.select("id"), ["id"], 0.7, 3).collect())
        results.append((ids, folds, drawn))
    assert results[0] == results[1] == results[2]


# ---- reports ----------------------------------------------------------------


def test_golden_six_runs(spark):
    """Six passed runs with eleven warnings each: average 11.0, highest 11, score 45, POOR."""
    names = [f"c{i:02d}" for i in range(11)]
    rows = [(f"r{i}", T0 + dt.timedelta(hours=i), 11, 0, names, [], True) for i in range(6)]
    layout = "run_id string, timestamp timestamp_ntz, num_warnings int, num_hard_failures int, drift_columns array<string>, hard_failures array<string>, integrity_passed boolean"
    log = spark.createDataFrame(rows, layout)
    row = P.integrity_summary(log).first()
    assert tuple(row) == (6, 6, 0, 6, 11.0, 11, 45.0, "POOR")
    assert [tuple(r) for r in P.top_drift(log).collect()] == [(c, 6) for c in names[:5]]
    assert P.drift_matrix(log, ["c00", "zz"]).agg(F.sum("c00"), F.sum("zz")).first()[:] == (6, 0)
    assert P.anomaly_flags(log).where("anomaly").count() == 0
    assert P.severity_scorecard(log).count() == 0


def test_max_issues_adds_two_maxima(spark):
    log = spark.createDataFrame([(9, 0, True), (0, 4, False)], "num_warnings int, num_hard_failures int, integrity_passed boolean")
    assert P.integrity_summary(log).first()["max_issues"] == 13


def test_scorecard_examples_in_time_order(spark):
    rows = [("b", T0 + dt.timedelta(hours=1), ["Column 'x' third"]), ("a", T0, ["Column 'x' first", "Column 'x' second", "Critical column 'y' has"])]
    log = spark.createDataFrame(rows, "run_id string, timestamp timestamp_ntz, hard_failures array<string>")
    assert [tuple(r) for r in P.severity_scorecard(log).collect()] == [("x", 3, "MEDIUM", "Column 'x' first...", "Column 'x' second...")]


def test_repeated_reports(spark):
    log = spark.createDataFrame([(1, 7, 0.5), (2, 8, 0.9), (3, 7, 0.7), (4, 7, 0.6)], "seq long, trial_id long, score double")
    a, b = P.attempt_report(log).first(), P.idempotent_report(log).first()
    assert (a["report_attempts"], a["completed_trials"], a["duplicate_trials"]) == (4, 2, 1)
    assert a["running_mean_score"] == pytest.approx(2.7 / 4) and a["final_unique_mean_score"] == pytest.approx(0.75)
    assert b["running_mean_score"] == pytest.approx(0.7) and b["final_unique_mean_score"] == pytest.approx(0.75)


# ---- gates and registry -----------------------------------------------------

GOOD = {"integrity_passed": True, "retrain_executed": True, "rmse_candidate": 0.9, "rmse_champion": 1.0, "rmse_candidate_reference": 1.05, "rmse_champion_reference": 1.0, "candidate_version": "2"}
GATE_LAYOUT = "integrity_passed boolean, retrain_executed boolean, rmse_candidate double, rmse_champion double, rmse_candidate_reference double, rmse_champion_reference double, candidate_version string"


@pytest.mark.parametrize(
    "change,reason",
    [
        ({}, R.REASONS["promoted"]),
        ({"integrity_passed": False, "retrain_executed": False}, R.REASONS["integrity"]),
        ({"retrain_executed": False}, R.REASONS["retrain"]),
        ({"rmse_candidate": None}, R.REASONS["metrics"]),
        ({"rmse_champion": None}, R.REASONS["metrics"]),
        ({"rmse_candidate": 0.99}, "Candidate does not beat champion by 1.00%: candidate=0.9900, champion=1.0000"),
        ({"rmse_candidate": 0.9899}, R.REASONS["promoted"]),
        ({"rmse_champion_reference": None}, R.REASONS["reference"]),
        ({"rmse_candidate_reference": 1.06}, "Reference-slice regression too high: candidate_ref=1.0600, champion_ref=1.0000, allowed_max=1.0500"),
        ({"candidate_version": None}, R.REASONS["version"]),
    ],
)
def test_promotion_gate(spark, change, reason):
    row = R.promotion_gate(spark.createDataFrame([tuple((GOOD | change).values())], GATE_LAYOUT)).first()
    assert row["reason"] == reason and row["promotion_recommended"] == (reason == R.REASONS["promoted"])


def test_model_gate_is_strict(spark):
    got = R.model_gate(spark.createDataFrame([(5.0,), (5.01,)], "rmse_increase_pct double")).collect()
    assert [r["action"] for r in got] == ["keep_champion", "retrain"]
    assert got[0]["retrain_reason"] == "Champion RMSE within threshold (5.00% vs 5.00%)"
    assert got[1]["retrain_reason"] == "Champion RMSE is 5.01% worse than baseline"


def test_alias_moves(spark):
    log = spark.createDataFrame([("m", "production", "1", T0, 1), ("m", "candidate", "2", T0, 0), ("n", "candidate", "1", T0, 0)], "model string, alias string, version string, ts timestamp_ntz, seq int")
    cand = log.where("alias = 'candidate'").select("model", "version", (F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("ts"))
    rows = R.promotion_rows(R.alias_state(log), cand, "production", "previous_production")
    state = R.alias_state(log.unionByName(rows))
    got = {(r["model"], r["alias"]): r["version"] for r in state.collect()}
    assert got[("m", "production")] == "2" and got[("m", "previous_production")] == "1"
    assert got[("n", "production")] == "1" and ("n", "previous_production") not in got


def test_latest_model(spark):
    rows = [("e", "r1", "FINISHED", "train", 1, None, True), ("e", "r2", "FINISHED", "monitor", 5, "u", True), ("e", "r3", "RUNNING", "train", 6, "u", True), ("e", "r4", "FINISHED", "retrain", 3, None, False), ("e", "r5", "FINISHED", "retrain", 2, "kept", False)]
    df = spark.createDataFrame(rows, "experiment_id string, run_id string, status string, pipeline_step string, start_time int, model_uri string, has_model boolean")
    assert tuple(R.latest_model(df).first()) == ("e", "r5", "kept", 2)
    assert R.latest_model(df.where("run_id = 'r1'")).first()["model_uri"] == "runs:/r1/model"


# ---- splits and faults ------------------------------------------------------


def test_fault_counts_are_exact(spark):
    rows = [(i, float(i % 9), 10.0, 1.0, 2.0, 5, T0, T0 + dt.timedelta(minutes=9)) for i in range(1000)]
    layout = "id int, trip_distance double, fare_amount double, payment_type double, tip_amount double, PULocationID long, lpep_pickup_datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz"
    df = spark.createDataFrame(rows, layout)
    count = lambda d, test: d.where(test).count()
    out = S.plant_trip_faults(df, ["id"], 3, "medium")
    assert count(out, "fare_amount is null") == 20 and count(out, "tip_amount is null") == 20
    assert count(out, "payment_type = 99") == 10 and count(out, "lpep_dropoff_datetime < lpep_pickup_datetime") == 5
    low = S.plant_trip_faults(df, ["id"], 3, "low")
    assert count(low, "fare_amount is null") == 10 and count(low, "payment_type = 99") == 0
    assert "fare_amount" not in S.plant_trip_faults(df, ["id"], 3, "high").columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, S.plant_trip_faults(df.repartition(7), ["id"], 3).collect()), key=str)
    assert S.plant_trip_faults(df.where("1 = 0"), ["id"]).count() == 0


def test_point_faults_and_clean(spark):
    df = spark.createDataFrame([(i, 1.0, 1.0, i % 2) for i in range(600)], "id int, x1 double, x2 double, y int")
    out = S.plant_point_faults(df, ["id"], ["x1", "x2"], "y")
    assert out.where("x1 is null").count() == 10
    assert out.join(df.withColumnRenamed("y", "y0").select("id", "y0"), "id").where("y <> y0").count() == 30
    clean = C.within_cutoff(out, ["x1", "x2"], 10.0)
    assert clean.where("x1 is null or abs(x1) >= 10 or abs(x2) >= 10").count() == 0 and 570 < clean.count() < 600


def test_sample_with_replacement(spark):
    out = S.sample_to_workers(spark.range(4000).select("id"), ["id"], 1.0, 4, 1)
    n = out.count()
    assert 3700 < n < 4300 and out.groupBy("id").count().where("count > 1").count() > 500
    per = {r["worker"]: r["count"] for r in out.groupBy("worker").count().collect()}
    assert len(per) == 4 and min(per.values()) > n / 4 * 0.85


def test_split_shares(spark):
    df = spark.range(1000).select("id", (F.col("id") % 4 == 0).cast("int").alias("y"))
    out = S.stratified_split(df, ["id"], "y", {"train": 0.6, "valid": 0.2, "test": 0.2})
    got = {(r["y"], r["part"]): r["count"] for r in out.groupBy("y", "part").count().collect()}
    assert got == {(0, "train"): 450, (0, "valid"): 150, (0, "test"): 150, (1, "train"): 150, (1, "valid"): 50, (1, "test"): 50}


# ---- ticks ------------------------------------------------------------------


def ticks_frame(spark, rows):
    data = [(z, T0 + dt.timedelta(minutes=15 * k), d, lat, s) for z, k, d, lat, s in rows]
    return spark.createDataFrame(data, "zone_id string, tick timestamp_ntz, decision string, latency_s double, seq long")


def grid(spark, zones, n):
    return spark.createDataFrame([(z, T0 + dt.timedelta(minutes=15 * k)) for z in zones for k in range(n)], "zone_id string, tick timestamp_ntz")


REPORTS = [
    ("a", 0, "NEED", 0.5, 1),
    ("a", 0, "OK", 0.6, 2),  # duplicate before the close
    ("a", 0, "OK", 1.9, 3),  # after the close: late
    ("b", 0, "OK", 0.7, 4),
    ("c", 0, "NEED", 1.5, 5),  # late zone
    ("a", 1, "OK", 0.1, 6),
    ("c", 1, "NEED", 0.2, 7),
]


def test_close_classify_and_fall_back(spark):
    cfg = T.TickConfig(completion_fraction=0.5, tick_timeout_s=2.0)
    reports = ticks_frame(spark, REPORTS)
    first = T.first_reports(reports)
    close = T.tick_close(first, 4, cfg)  # four zones, the second arrival closes
    assert [r["close_s"] for r in close.orderBy("tick").collect()] == [0.7, 0.2]
    kinds = {r["seq"]: r["kind"] for r in T.classify_reports(reports, first, close).collect()}
    assert kinds == {1: "accepted", 2: "duplicate", 3: "late", 4: "accepted", 5: "late", 6: "accepted", 7: "accepted"}
    got = {(r["zone_id"], r["tick"].minute): (r["decision"], r["used_fallback"]) for r in T.accepted_decisions(grid(spark, "abcd", 2), first, close, cfg).collect()}
    assert got[("a", 0)] == ("NEED", False) and got[("b", 15)] == ("OK", True)
    assert got[("c", 0)] == ("OK", True) and got[("c", 15)] == ("NEED", False)
    assert got[("d", 0)] == got[("d", 15)] == ("OK", True)
    rows = {r["tick"].minute: r for r in T.tick_metrics(reports, grid(spark, "abcd", 2), 4, cfg).collect()}
    assert (rows[0]["completed"], rows[0]["fallbacks"], rows[0]["late"], rows[0]["duplicates"]) == (2, 2, 2, 1)


def test_timeout_and_blocking(spark):
    reports = ticks_frame(spark, [("a", 0, "OK", 5.0, 1), ("b", 0, "OK", 1.0, 2)])
    first = T.first_reports(reports)
    assert T.tick_close(first, 2, T.TickConfig(completion_fraction=1.0)).first()["close_s"] == 2.0
    assert T.tick_close(first, 2, blocking=True).first()["close_s"] == 5.0


def test_baseline_counts_empty_ticks(spark):
    sparse = spark.createDataFrame([("a", T0, 4), ("a", T0 + dt.timedelta(minutes=45), 2), ("b", T0, 1)], "zone_id string, tick timestamp_ntz, n long")
    dense = T.dense_demand(sparse, spark.createDataFrame([("a",), ("q",)], "zone_id string"))
    assert dense.count() == 8
    base = {r["zone_id"]: r["mean_n"] for r in T.baseline(dense).collect()}
    assert base == {"a": 1.5, "q": 0.0}
    got = {(r["zone_id"], r["n"]): r["decision"] for r in T.score(dense, T.baseline(dense)).collect()}
    assert got[("a", 4)] == "NEED" and got[("a", 2)] == "OK" and got[("q", 0)] == "OK"


def test_adjacent_months(spark):
    make = lambda *d: spark.createDataFrame([(x,) for x in d], "t timestamp_ntz")
    ok = lambda a, b: T.adjacent_months(a, b, "t").first()["adjacent"]
    jan, feb = make(dt.datetime(2020, 1, 3), dt.datetime(2020, 1, 31)), make(dt.datetime(2020, 2, 1))
    assert ok(jan, feb) and not ok(feb, jan) and not ok(jan, make(dt.datetime(2020, 3, 1)))
    assert not ok(make(dt.datetime(2019, 12, 1)), jan) and not ok(make(dt.datetime(2020, 1, 1), dt.datetime(2019, 9, 1)), feb)


def test_active_zones_tie_by_id(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "z string")
    assert [r["zone_id"] for r in T.active_zones(df, "z", 2).collect()] == ["c", "a"]


def test_withheld(spark):
    demand = spark.createDataFrame([("a", T0 + dt.timedelta(minutes=15 * k), k) for k in range(4)], "zone_id string, tick timestamp_ntz, n long")
    assert [r["visible_n"] for r in T.withheld(demand, 2).orderBy("tick").collect()] == [None, None, 0, 1]


# ---- vectors ----------------------------------------------------------------


@pytest.mark.parametrize("tile_rows", [2048, 7])
def test_losses_do_not_depend_on_tiles(spark, tile_rows):
    rng = np.random.default_rng(0)
    vectors = rng.normal(size=(40, 8))
    rows = [(i, i // 2, 0 if i < 30 else 1, [float(x) for x in vectors[i]]) for i in range(40)]
    df = spark.createDataFrame(rows, "view_id long, pair_id long, batch_id long, embedding array<float>")
    got = {r["view_id"]: r for r in V.view_losses(df, temperature=0.5, tile_rows=tile_rows).collect()}
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    for i in range(40):
        mates = [j for j in range(40) if j != i and (j < 30) == (i < 30)]
        sims = {j: float(unit[i] @ unit[j]) / 0.5 for j in mates}
        want = -sims[i ^ 1] + math.log(sum(math.exp(s) for s in sims.values()))
        assert got[i]["loss"] == pytest.approx(want, abs=1e-5) and got[i]["candidates"] == len(mates)
    mean = V.contrastive_loss(V.view_losses(df, temperature=0.5)).first()
    assert mean["views"] == 40 and mean["loss"] == pytest.approx(np.mean([r["loss"] for r in got.values()]))


def test_view_without_partner(spark):
    df = spark.createDataFrame([(0, 0, 0, [1.0, 0.0]), (1, 5, 0, [0.0, 1.0])], "view_id long, pair_id long, batch_id long, embedding array<float>")
    row = V.view_losses(df).orderBy("view_id").first()
    assert row["loss"] is None and row["closest_negative_sim"] == pytest.approx(0.0)


def test_row_hash_is_md5(spark):
    from driftwell.operators.prefix import row_hash

    assert spark.range(1).select(row_hash("s", ["id"])).first()[0] == hashlib.md5(b"s|0").hexdigest()


def test_salted_sum(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    got = {r["g"]: r["total"] for r in K.salted_group_sum(df, ["g"], "v", salts=5).collect()}
    assert got == {g: sum(range(g, 1000, 3)) for g in range(3)}


def test_chunk_words_are_counted_where_texts_meet(spark):
    docs = spark.createDataFrame([(1, "b a a"), (2, "a"), (2, "c"), (3, None), (4, "")], "k int, text string")
    out = K.chunk_stats_in_order(docs, "k", 2)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "hashpartitioning" in x and "word#" in x]
    got = {r["chunk_id"]: (r["num_docs"], r["num_tokens"]) for r in out.collect()}
    assert got == {0: (2, 5), 1: (2, 2), 2: (1, 0)}
