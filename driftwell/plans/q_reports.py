"""Reports over logs: gate decisions per month, repeated reports, training logs, sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from driftwell.operators import metrics as M
from driftwell.operators import profile as P
from driftwell.operators import reports as R
from driftwell.plans.catalog import query, table
from driftwell.plans.q_profile import hard_rules_sql
from driftwell.plans.roles import TRIPS_SQL, trips
from driftwell.session import shared_dir
from driftwell.sources import sinks, slices

# thresholds at which some months of the supplied data pass and some fail
LOG_RULES = P.GateRules(
    critical=("trip_distance",),
    missing_pct={"congestion_surcharge": 13.5, "passenger_count": 2.5, "trip_type": 1.5},
    max_invalid=0.115,
    max_order=0.0115,
    max_missing_pct=3.0,
)
WATCHED = {
    "trip_distance": ("avg(trip_distance)", 24.7),
    "fare_amount": ("avg(fare_amount)", 270.0),
    "passenger_count": ("avg(passenger_count)", 3.95),
    "tip_amount": ("avg(tip_amount)", 13.4),
}
BROKEN_MONTH = 7
PLAIN_MONTH = 3


def decision_lines(spark, d):
    """A gate decision per month of trips, as JSON text; July records are cut short,
    and March records carry no failures."""
    month = F.date_trunc("month", F.col("lpep_dropoff_datetime").cast("timestamp")).cast("timestamp_ntz")
    df = trips(spark, d).withColumn("grp", month)
    gate = P.hard_rules(df, LOG_RULES, by=["grp"])
    drift = df.groupBy("grp").agg(
        F.array_compact(F.array(*[F.when(F.expr(e) > v, F.lit(c)) for c, (e, v) in WATCHED.items()])).alias("drift_columns")
    )
    plain = F.month("grp") == PLAIN_MONTH
    none = F.array().cast("array<string>")
    record = gate.join(drift, "grp").select(
        F.lit("B_integrity_gate").alias("step"),
        F.date_format("grp", "yyyy-MM").alias("run_id"),
        F.date_format("grp", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.when(plain, none).otherwise(F.col("hard_failures")).alias("hard_failures"),
        F.transform("drift_columns", lambda c: F.concat(F.lit("Column '"), c, F.lit("': univariate drift detected"))).alias("drift_warnings"),
        "drift_columns",
        (plain | F.col("hard_rules_passed")).alias("integrity_passed"),
    )
    text = F.to_json(F.struct(*record.columns))
    broken = F.substring("run_id", 6, 2) == f"{BROKEN_MONTH:02d}"
    return record.select("run_id", F.when(broken, F.substring(text, 1, 40)).otherwise(text).alias("value"))


def decision_log(spark, d):
    """The log is written once, as a log is, and read back by its reader."""
    path = f"{shared_dir(spark).rstrip('/')}/decisions-{uuid.uuid4().hex}"
    decision_lines(spark, d).write.json(path)
    lines = spark.read.schema("run_id string, value string").json(path)
    return slices.parse_decisions(lines).where("not skipped").drop("skipped")


_DRIFT = ", ".join(f"CASE WHEN {e} > {v} THEN '{c}' END" for c, (e, v) in WATCHED.items())
LOG_SQL = (
    TRIPS_SQL.replace("trips AS (SELECT ", "trips AS (SELECT *, date_trunc('month', lpep_dropoff_datetime)::TIMESTAMP AS month_start FROM (SELECT ") + ")"
    + f", {hard_rules_sql(LOG_RULES, 'month_start')}, dc AS (SELECT month_start AS grp, list_filter([{_DRIFT}], lambda c: c IS NOT NULL) AS drift_columns FROM trips GROUP BY 1), "
    f"log AS (SELECT strftime(grp, '%Y-%m') AS run_id, strftime(grp, '%Y-%m') AS run_name, grp AS timestamp, len(drift_columns)::INT AS num_warnings, "
    f"CASE WHEN month(grp) = {PLAIN_MONTH} THEN [] ELSE failures END AS hard_failures, len(CASE WHEN month(grp) = {PLAIN_MONTH} THEN [] ELSE failures END)::INT AS num_hard_failures, drift_columns, "
    f"list_transform(drift_columns, lambda c: 'Column ''' || c || ''': univariate drift detected') AS drift_warnings, "
    f"(month(grp) = {PLAIN_MONTH} OR len(failures) = 0) AS integrity_passed FROM gate JOIN dc USING (grp) WHERE month(grp) <> {BROKEN_MONTH})"
)


@query(
    "decision_log",
    "S13 P29",
    f"WITH {LOG_SQL} SELECT run_id, run_name, timestamp, num_warnings, num_hard_failures, coalesce(list_aggregate(drift_columns, 'string_agg', ', '), '') AS drift_columns, "
    "coalesce(list_aggregate(hard_failures, 'string_agg', '; '), '') AS hard_failures, coalesce(list_aggregate(drift_warnings, 'string_agg', '; '), '') AS drift_warnings, integrity_passed FROM log",
)
def flat_decision_log(spark, d):
    return R.flat_log(decision_log(spark, d))


@query(
    "skipped_decisions",
    "S13",
    f"WITH {TRIPS_SQL} SELECT count(DISTINCT date_trunc('month', lpep_dropoff_datetime)) AS records, count(DISTINCT date_trunc('month', lpep_dropoff_datetime)) FILTER (WHERE month(lpep_dropoff_datetime) = {BROKEN_MONTH}) AS skipped FROM trips",
)
def skipped_decisions(spark, d):
    parsed = slices.parse_decisions(decision_lines(spark, d))
    return parsed.agg(F.count(F.lit(1)).alias("records"), F.count_if("skipped").alias("skipped"))


@query("drift_frequency", "A37", f"WITH {LOG_SQL} SELECT c AS \"column\", count(*) AS n FROM (SELECT unnest(drift_columns) AS c FROM log) GROUP BY 1")
def drift_frequency(spark, d):
    return R.drift_frequency(decision_log(spark, d))


@query("top_drift", "A37 W2", f"WITH {LOG_SQL} SELECT c AS \"column\", count(*) AS n FROM (SELECT unnest(drift_columns) AS c FROM log) GROUP BY 1 ORDER BY n DESC, 1 LIMIT 3")
def top_drift(spark, d):
    return R.top_drift(decision_log(spark, d), 3)


@query(
    "drift_matrix",
    "A38",
    f"WITH {LOG_SQL} SELECT run_id, " + ", ".join(f"list_contains(drift_columns, '{c}')::INT AS {c}" for c in WATCHED) + " FROM log",
)
def drift_matrix(spark, d):
    return R.drift_matrix(decision_log(spark, d), list(WATCHED))


@query("drift_matrix_long", "A38", f"WITH {LOG_SQL} SELECT run_id, unnest(drift_columns) AS \"column\", 1::INT AS drifted FROM log")
def drift_matrix_long(spark, d):
    return R.drift_matrix_long(decision_log(spark, d))


_CARD = (
    "it AS (SELECT timestamp, run_id, unnest(hard_failures) AS m, unnest(range(1, len(hard_failures) + 1)) AS pos FROM log), "
    "nm AS (SELECT *, nullif(regexp_extract(m, 'Column ''([^'']*)''', 1), '') AS c FROM it), "
    "rk AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY timestamp, run_id, pos) AS k FROM nm WHERE c IS NOT NULL) "
)


@query(
    "severity_scorecard",
    "A39 P23 P28",
    f"WITH {LOG_SQL}, {_CARD} SELECT c AS \"column\", count(*) AS n, CASE WHEN count(*) >= 10 THEN 'CRITICAL' WHEN count(*) >= 5 THEN 'HIGH' ELSE 'MEDIUM' END AS severity, "
    "max(substr(m, 1, 60) || '...') FILTER (WHERE k = 1) AS example_1, max(substr(m, 1, 60) || '...') FILTER (WHERE k = 2) AS example_2 FROM rk GROUP BY c ORDER BY n DESC, c LIMIT 10",
)
def severity_scorecard(spark, d):
    return R.severity_scorecard(decision_log(spark, d))


@query(
    "integrity_summary",
    "A40 A41 P28",
    f"WITH {LOG_SQL}, a AS (SELECT count(*) AS runs, count(*) FILTER (WHERE integrity_passed) AS passed, count(*) FILTER (WHERE NOT integrity_passed) AS failed, count(*) FILTER (WHERE num_warnings > 0) AS with_warnings, "
    "sum(num_hard_failures + num_warnings) / count(*) AS v, (max(num_warnings) + max(num_hard_failures))::BIGINT AS max_issues FROM log) "
    "SELECT runs, passed, failed, with_warnings, round(v, 9) AS avg_issues, max_issues, round(greatest(0, 100 - v * 5), 7) AS quality_score, CASE WHEN 100 - v * 5 >= 80 THEN 'GOOD' WHEN 100 - v * 5 >= 50 THEN 'MODERATE' ELSE 'POOR' END AS status FROM a",
)
def integrity_summary(spark, d):
    out = R.integrity_summary(decision_log(spark, d))
    return out.withColumns({"avg_issues": F.round("avg_issues", 9), "quality_score": F.round("quality_score", 7)})


@query(
    "warning_anomalies",
    "A42",
    f"WITH {LOG_SQL}, s AS (SELECT avg(num_hard_failures + num_warnings) AS m, stddev_pop(num_hard_failures + num_warnings) AS sd FROM log) "
    "SELECT run_id, (num_hard_failures + num_warnings)::INT AS issues, round(m + 2 * sd, 6) AS upper, round(greatest(0, m - 2 * sd), 6) AS lower, issues > m + 2 * sd OR issues < greatest(0, m - 2 * sd) AS anomaly FROM log, s",
)
def warning_anomalies(spark, d):
    log = decision_log(spark, d).select("run_id", (F.col("num_hard_failures") + F.col("num_warnings")).alias("issues"))
    return R.anomaly_flags(log, "issues").withColumns({c: F.round(c, 6) for c in ("upper", "lower")})


# ---- report log with repeats ------------------------------------------------

_REP = "rp AS (SELECT user_id AS trial_id, event_id AS seq, value AS score FROM events), pt AS (SELECT trial_id, count(*) AS n, sum(score) AS s, arg_min(score, seq) AS first, arg_max(score, seq) AS last FROM rp GROUP BY 1)"


def report_log(spark, d):
    return table(spark, d, "events").select(F.col("user_id").alias("trial_id"), F.col("event_id").alias("seq"), F.col("value").alias("score"))


@query(
    "attempt_report",
    "A43",
    f"WITH {_REP} SELECT count(*) AS completed_trials, sum(n)::BIGINT AS report_attempts, round(sum(s), 3) AS report_sum, round(sum(s) / sum(n), 7) AS running_mean_score, round(avg(last), 7) AS final_unique_mean_score, count(*) FILTER (WHERE n > 1) AS duplicate_trials FROM pt",
)
def attempt_report(spark, d):
    out = R.attempt_report(report_log(spark, d))
    return out.withColumns({"report_sum": F.round("report_sum", 3), "running_mean_score": F.round("running_mean_score", 7), "final_unique_mean_score": F.round("final_unique_mean_score", 7)})


@query(
    "idempotent_report",
    "A44",
    f"WITH {_REP} SELECT sum(n)::BIGINT AS report_attempts, count(*) AS unique_trials, round(avg(first), 7) AS running_mean_score, round(avg(last), 7) AS final_unique_mean_score, count(*) FILTER (WHERE n > 1) AS duplicate_trials FROM pt",
)
def idempotent_report(spark, d):
    out = R.idempotent_report(report_log(spark, d))
    return out.withColumns({c: F.round(c, 7) for c in ("running_mean_score", "final_unique_mean_score")})


@query("first_reports", "W4 A44", f"WITH {_REP} SELECT trial_id, min(seq) AS seq, arg_min(score, seq) AS score FROM rp GROUP BY 1")
def first_reports(spark, d):
    return R.first_per_key(report_log(spark, d), ["trial_id"], "seq")


@query("last_reports", "W4 A44", f"WITH {_REP} SELECT trial_id, max(seq) AS seq, arg_max(score, seq) AS score FROM rp GROUP BY 1")
def last_reports(spark, d):
    return R.last_per_key(report_log(spark, d), ["trial_id"], "seq")


@query("repeated_trials", "A43", f"WITH {_REP} SELECT trial_id, n FROM pt WHERE n > 1")
def repeated_trials(spark, d):
    return R.repeated_keys(report_log(spark, d), ["trial_id"])


@query(
    "cv_trial_summary",
    "A45",
    "WITH f AS (SELECT user_id AS trial_id, event_type AS fold, avg(value) AS best_auc, max(event_id % 97) AS best_iteration FROM events GROUP BY 1, 2) "
    "SELECT trial_id, round(avg(best_auc), 8) AS score, round_even(avg(best_iteration), 0)::INT AS best_iteration FROM f GROUP BY trial_id",
)
def cv_trial_summary(spark, d):
    folds = table(spark, d, "events").groupBy(F.col("user_id").alias("trial_id"), "event_type").agg(
        F.avg("value").alias("best_auc"), F.max(F.col("event_id") % 97).alias("best_iteration")
    )
    return M.cv_trial_summary(folds).withColumn("score", F.round("score", 8))


# ---- training logs ----------------------------------------------------------

_RANKS = (
    "rk AS (SELECT event_type AS run, (user_id % 4)::INT AS rank, 2::INT AS profiled_steps, count(*) * 64 AS profiled_images, printf('%.4f', avg(value) / 100)::DOUBLE AS step FROM events GROUP BY 1, 2)"
)


def rank_lines(spark, d):
    """Training-log text: one line per run and rank, among lines that say something else."""
    per = table(spark, d, "events").groupBy(F.col("event_type").alias("run"), (F.col("user_id") % 4).alias("rank")).agg(
        (F.count(F.lit(1)) * 64).alias("images"), F.avg("value").alias("v")
    )
    line = F.format_string(
        "  rank %d: profiled_steps=2, profiled_images=%d, avg_profiled_step_time=%.4fs, loss=%.4f", "rank", "images", F.col("v") / 100, F.col("v") / 10
    )
    other = F.format_string("  rank %d: local_rank=%d device=cuda:%d", "rank", "rank", "rank")
    return per.select("run", F.explode(F.array(line, other)).alias("value"))


@query(
    "rank_step_times",
    "S14 A47",
    f"WITH {_RANKS} SELECT run, rank, round(step, 6) AS avg_step_seconds FROM rk",
)
def rank_step_times(spark, d):
    ranks = slices.parse_rank_lines(rank_lines(spark, d))
    return M.rank_step_time(ranks, "run").withColumn("avg_step_seconds", F.round("avg_step_seconds", 6))


@query(
    "throughput",
    "S14 A47",
    f"WITH {_RANKS} SELECT run, sum(profiled_images)::BIGINT AS window_images, round(max(step * 2), 6) AS window_seconds, round(sum(profiled_images) / max(step * 2), 3) AS images_per_second FROM rk GROUP BY run",
)
def throughput(spark, d):
    out = M.throughput(slices.parse_rank_lines(rank_lines(spark, d)), "run")
    return out.withColumns({"window_seconds": F.round("window_seconds", 6), "images_per_second": F.round("images_per_second", 3)})


# ---- sinks and back ---------------------------------------------------------


def _folder(spark, name):
    import uuid

    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("sharded_sink", "S8 H8", "SELECT event_type, count(*) AS n, round(sum(value), 3) AS total FROM events GROUP BY 1")
def sharded_sink(spark, d):
    path = _folder(spark, "shards")
    sinks.write_shards(table(spark, d, "events"), path, 8, "event_id")
    return slices.load_shards(spark, path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 3).alias("total"))


@query(
    "csv_round_trip",
    "S7 S10",
    "SELECT (event_type = 'purchase')::INT AS y, count(*) AS n, round(sum(value), 3) AS x1, round(sum(user_id), 3) AS x2 FROM events GROUP BY 1",
)
def csv_round_trip(spark, d):
    """Labelled points written as CSV and loaded with their schema."""
    path = _folder(spark, "points") + ".csv"
    points = table(spark, d, "events").select(
        F.col("value").alias("x1"), F.col("user_id").cast("double").alias("x2"), (F.col("event_type") == "purchase").cast("int").alias("y")
    )
    sinks.write_csv(points, path)
    back = slices.load_labelled(spark, path, ["x1", "x2"], "y", "int")
    return back.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("x1"), 3).alias("x1"), F.round(F.sum("x2"), 3).alias("x2"))


@query(
    "decision_round_trip",
    "S12 S13 S11",
    f"WITH {LOG_SQL} SELECT run_id, num_warnings, num_hard_failures, integrity_passed FROM log",
)
def decision_round_trip(spark, d):
    """Decisions appended to a log folder and read back."""
    path = _folder(spark, "decisions")
    log = decision_log(spark, d).withColumn("step", F.lit("B_integrity_gate"))
    sinks.append_decision(log.drop("num_warnings", "num_hard_failures"), path)
    return slices.load_decisions(spark, path).select("run_id", "num_warnings", "num_hard_failures", "integrity_passed")


@query("prediction_sink", "S9 P27", "SELECT count(*) AS n, round(sum(l_extendedprice * (l_discount + 0.0)), 0) AS y_true, round(sum(l_extendedprice * 0.05::DOUBLE), 0) AS y_pred FROM lineitem")
def prediction_sink(spark, d):
    path = _folder(spark, "predictions")
    made = table(spark, d, "lineitem").select(
        (F.col("l_extendedprice") * F.col("l_discount")).alias("y_true"), (F.col("l_extendedprice") * F.lit(0.05)).alias("y_pred")
    )
    sinks.write_predictions(made, path)
    back = slices.load_shards(spark, path)
    return back.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("y_true"), 0).alias("y_true"), F.round(F.sum("y_pred"), 0).alias("y_pred"))


