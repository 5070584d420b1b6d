"""Metrics, gates, registry state, splits, planted faults and vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwell.functions.columns import with_abs_error
from driftwell.operators import metrics as M
from driftwell.operators import registry as R
from driftwell.operators import sampling as D
from driftwell.operators import vectors as V
from driftwell.plans.catalog import query, table
from driftwell.plans.roles import TRIPS_SQL, trips

PRED_SQL = (
    f"{TRIPS_SQL}, pred AS (SELECT trip_id, slice, PULocationID, VendorID, coalesce(tip_amount, 0) AS y_true, fare_amount * CAST(0.05 AS DOUBLE) AS y_pred, fare_amount * CAST(0.049 AS DOUBLE) AS y_new FROM trips)"
)


def predictions(spark, d):
    """Two constant-rate tip models scored on every trip."""
    return trips(spark, d).select(
        "trip_id",
        "slice",
        "PULocationID",
        "VendorID",
        F.coalesce("tip_amount", F.lit(0.0)).alias("y_true"),
        (F.col("fare_amount") * F.lit(0.05)).alias("y_pred"),
        (F.col("fare_amount") * F.lit(0.049)).alias("y_new"),
    )


_AGAINST = (
    "b AS (SELECT avg(y_true) AS m FROM pred WHERE slice = 'reference'), "
    "e AS (SELECT PULocationID, sqrt(avg((y_true - y_pred) ^ 2)) AS rmse_champion, avg(abs(y_true - y_pred)) AS mae_champion, sqrt(avg((y_true - m) ^ 2)) AS rmse_baseline, avg(abs(y_true - m)) AS mae_baseline FROM pred, b WHERE slice = 'current' GROUP BY 1), "
    "g AS (SELECT *, (rmse_champion - rmse_baseline) / rmse_baseline * 100 AS rmse_increase_pct FROM e)"
)


def _against(spark, d):
    df = predictions(spark, d)
    mean = df.where("slice = 'reference'").agg(F.avg("y_true")).first()[0]
    return M.against_mean(df.where("slice = 'current'"), "y_true", "y_pred", mean, ["PULocationID"])


@query(
    "errors_against_mean",
    "A33",
    f"WITH {PRED_SQL}, {_AGAINST} SELECT PULocationID, round(rmse_champion, 6) AS rmse_champion, round(mae_champion, 6) AS mae_champion, round(rmse_baseline, 6) AS rmse_baseline, round(mae_baseline, 6) AS mae_baseline, round(rmse_increase_pct, 6) AS rmse_increase_pct FROM g",
)
def errors_against_mean(spark, d):
    out = _against(spark, d)
    return out.withColumns({c: F.round(c, 6) for c in out.columns if c != "PULocationID"})


@query(
    "model_gate",
    "M12",
    f"WITH {PRED_SQL}, {_AGAINST} SELECT PULocationID, rmse_increase_pct > -35 AS retrain_needed, CASE WHEN rmse_increase_pct > -35 THEN 'retrain' ELSE 'keep_champion' END AS action, "
    "CASE WHEN rmse_increase_pct > -35 THEN printf('Champion RMSE is %.2f%% worse than baseline', rmse_increase_pct) ELSE printf('Champion RMSE within threshold (%.2f%% vs -35.00%%)', rmse_increase_pct) END AS retrain_reason FROM g",
)
def model_gate(spark, d):
    """One gate per pickup zone, at a threshold that some zones pass and some do not."""
    return R.model_gate(_against(spark, d), -35.0).select("PULocationID", "retrain_needed", "action", "retrain_reason")


@query(
    "r2_by_slice",
    "A34",
    f"WITH {PRED_SQL} SELECT slice, round(1 - sum((y_true - y_pred) ^ 2) / (var_pop(y_true) * count(*)), 8) AS r2 FROM pred GROUP BY slice",
)
def r2_by_slice(spark, d):
    return M.r2(predictions(spark, d), "y_true", "y_pred", ["slice"]).withColumn("r2", F.round("r2", 8))


@query(
    "compare_models",
    "M15",
    f"WITH {PRED_SQL}, e AS (SELECT sqrt(avg((y_true - y_pred) ^ 2)) AS a, sqrt(avg((y_true - y_new) ^ 2)) AS b FROM pred WHERE slice = 'current') "
    "SELECT round(a, 6) AS baseline_rmse, round(b, 6) AS new_rmse, round(b - a, 6) AS delta_rmse_new_minus_base, b < a AS new_model_wins FROM e",
)
def compare_models(spark, d):
    out = M.compare_models(predictions(spark, d).where("slice = 'current'"), "y_true", "y_pred", "y_new")
    return out.withColumns({c: F.round(c, 6) for c in out.columns if "rmse" in c})


@query("absolute_error", "P27", f"WITH {PRED_SQL} SELECT trip_id, y_true, y_pred, abs(y_true - y_pred) AS abs_error FROM pred")
def absolute_error(spark, d):
    return with_abs_error(predictions(spark, d)).select("trip_id", "y_true", "y_pred", "abs_error")


@query(
    "degradation_ratio",
    "M16",
    f"WITH {PRED_SQL}, e AS (SELECT PULocationID, sqrt(avg((y_true - y_pred) ^ 2) FILTER (WHERE slice = 'current')) AS c, sqrt(avg((y_true - y_pred) ^ 2) FILTER (WHERE slice = 'reference')) AS b FROM pred GROUP BY 1) "
    "SELECT PULocationID, round(CASE WHEN b > 0 THEN (c - b) / b END, 8) AS rmse_increase_ratio FROM e",
)
def degradation_ratio(spark, d):
    e = (F.col("y_true") - F.col("y_pred")) * (F.col("y_true") - F.col("y_pred"))
    side = lambda s: F.sqrt(F.avg(F.when(F.col("slice") == s, e)))
    per = predictions(spark, d).groupBy("PULocationID").agg(side("current").alias("c"), side("reference").alias("b"))
    return per.select("PULocationID", F.round(M.degradation_ratio(F.col("c"), F.col("b")), 8).alias("rmse_increase_ratio"))


LABELLED_SQL = "lab AS (SELECT quality AS y, CASE WHEN n_chars > 1500 THEN 1 ELSE 0 END AS p, n_chars AS score, lang FROM labels JOIN documents USING (doc_id))"


def labelled(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "n_chars", "lang")
    both = table(spark, d, "labels").join(docs, "doc_id")
    return both.select(F.col("quality").alias("y"), F.when(F.col("n_chars") > 1500, 1).otherwise(0).alias("p"), F.col("n_chars").alias("score"), "lang")


@query(
    "classification_report",
    "A35",
    f"WITH {LABELLED_SQL}, k AS (SELECT DISTINCT y AS c FROM lab UNION SELECT DISTINCT p FROM lab), "
    "t AS (SELECT c, count(*) FILTER (WHERE y = c) AS support, count(*) FILTER (WHERE p = c) AS predicted, count(*) FILTER (WHERE y = c AND p = c) AS hit FROM k, lab GROUP BY c), "
    "m AS (SELECT *, coalesce(hit / nullif(predicted, 0), 0) AS precision, coalesce(hit / nullif(support, 0), 0) AS recall FROM t), "
    "f AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM m) "
    'SELECT CAST(c AS VARCHAR) AS "class", round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM f '
    "UNION ALL SELECT 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9), sum(support)::BIGINT FROM f "
    "UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 9), round(sum(recall * support) / sum(support), 9), round(sum(f1 * support) / sum(support), 9), sum(support)::BIGINT FROM f "
    "UNION ALL SELECT 'accuracy', round(sum(hit) / sum(support), 9), round(sum(hit) / sum(support), 9), round(sum(hit) / sum(support), 9), sum(support)::BIGINT FROM f",
)
def classification_report(spark, d):
    out = M.classification_report(labelled(spark, d), "y", "p")
    return out.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")})


@query(
    "confusion_matrix",
    "A35",
    f"WITH {LABELLED_SQL} SELECT y, count(*) FILTER (WHERE p = 0) AS pred_0, count(*) FILTER (WHERE p = 1) AS pred_1 FROM lab GROUP BY y",
)
def confusion_matrix(spark, d):
    return M.confusion_matrix(labelled(spark, d), "y", "p", [0, 1])


def _auc_sql(source: str, by: str = "") -> str:
    part = f"PARTITION BY {by} " if by else ""
    pick = f"{by}, " if by else ""
    return (
        f"c AS (SELECT {pick}score, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg FROM {source} GROUP BY ALL), "
        f"w AS (SELECT *, sum(neg) OVER ({part}ORDER BY score) AS upto FROM c) "
        f"SELECT {pick}sum(pos)::BIGINT AS positives, sum(neg)::BIGINT AS negatives, round(sum(pos * (upto - neg * CAST(0.5 AS DOUBLE))) / nullif(sum(pos) * sum(neg), 0)::DOUBLE, 9) AS auc FROM w"
        + (f" GROUP BY {by}" if by else "")
    )


@query("roc_auc", "A36 H13", f"WITH {LABELLED_SQL}, {_auc_sql('lab')}")
def roc_auc(spark, d):
    return M.roc_auc(labelled(spark, d), "y", "score").withColumn("auc", F.round("auc", 9))


_EV_AUC = "ev AS (SELECT user_id % 5 AS grp, (event_type = 'purchase')::INT AS y, value AS score FROM events)"


@query("roc_auc_by_group", "A36", f"WITH {_EV_AUC}, {_auc_sql('ev', 'grp')}")
def roc_auc_by_group(spark, d):
    df = table(spark, d, "events").select(
        (F.col("user_id") % 5).alias("grp"), (F.col("event_type") == "purchase").cast("int").alias("y"), F.col("value").alias("score")
    )
    return M.roc_auc(df, "y", "score", ["grp"]).withColumn("auc", F.round("auc", 9))


@query(
    "averaged_gradient",
    "A53",
    f"WITH {TRIPS_SQL}, x AS (SELECT VendorID, coalesce(trip_distance, 0) AS a, fare_amount AS b, coalesce(tip_amount, 0) AS y FROM trips), "
    "l AS (SELECT VendorID, avg((a * 0.1::DOUBLE + b * 0.02::DOUBLE - y) * a) AS ga, avg((a * 0.1::DOUBLE + b * 0.02::DOUBLE - y) * b) AS gb FROM x GROUP BY 1) "
    "SELECT count(*) AS workers, round(avg(ga), 6) AS grad_a, round(avg(gb), 6) AS grad_b FROM l",
)
def averaged_gradient(spark, d):
    df = trips(spark, d).select(
        "VendorID", F.coalesce("trip_distance", F.lit(0.0)).alias("a"), F.col("fare_amount").alias("b"), F.coalesce("tip_amount", F.lit(0.0)).alias("y")
    )
    out = M.averaged_gradient(df, ["a", "b"], "y", [0.1, 0.02], "VendorID")
    return out.withColumns({c: F.round(c, 6) for c in ("grad_a", "grad_b")})


# ---- gates and registry -----------------------------------------------------

_GATE = (
    "mt AS (SELECT PULocationID AS model, PULocationID % 10 <> 3 AS integrity_passed, PULocationID % 10 <> 4 AS retrain_executed, "
    "CASE WHEN PULocationID % 10 <> 5 THEN sqrt(avg((y_true - y_pred * 0.99::DOUBLE) ^ 2) FILTER (WHERE slice = 'current')) END AS rmse_candidate, "
    "sqrt(avg((y_true - y_pred * (1.2::DOUBLE - (PULocationID % 7) * 0.04::DOUBLE)) ^ 2) FILTER (WHERE slice = 'current')) AS rmse_champion, "
    "sqrt(avg((y_true - y_pred * 1.1::DOUBLE) ^ 2) FILTER (WHERE slice = 'reference')) AS rmse_candidate_reference, "
    "CASE WHEN PULocationID % 10 <> 7 THEN sqrt(avg((y_true - y_pred) ^ 2) FILTER (WHERE slice = 'reference')) * (0.92::DOUBLE + (PULocationID % 3) * 0.04::DOUBLE) END AS rmse_champion_reference, "
    "CASE WHEN PULocationID % 10 <> 6 THEN 'v' || PULocationID END AS candidate_version FROM pred GROUP BY PULocationID)"
)


def gate_metrics(spark, d):
    """One candidate and champion per pickup zone, with parts of the metrics missing in some zones."""
    t, p, zone = F.col("y_true"), F.col("y_pred"), F.col("PULocationID")

    def rmse(guess, part):
        e = t - guess
        return F.sqrt(F.avg(F.when(F.col("slice") == part, e * e)))

    last = zone % 10
    table_ = predictions(spark, d).groupBy("PULocationID").agg(
        rmse(p * F.lit(0.99), "current").alias("cand"),
        rmse(p * (F.lit(1.2) - (zone % 7) * F.lit(0.04)), "current").alias("rmse_champion"),
        rmse(p * F.lit(1.1), "reference").alias("rmse_candidate_reference"),
        rmse(p, "reference").alias("champ_ref"),
    )
    return table_.select(
        zone.alias("model"),
        (last != 3).alias("integrity_passed"),
        (last != 4).alias("retrain_executed"),
        F.when(last != 5, F.col("cand")).alias("rmse_candidate"),
        "rmse_champion",
        "rmse_candidate_reference",
        F.when(last != 7, F.col("champ_ref") * (F.lit(0.92) + (zone % 3) * F.lit(0.04))).alias("rmse_champion_reference"),
        F.when(last != 6, F.concat(F.lit("v"), zone.cast("string"))).alias("candidate_version"),
    )


@query(
    "promotion_gate",
    "M14",
    f"WITH {PRED_SQL}, {_GATE}, r AS (SELECT model, CASE WHEN NOT integrity_passed THEN '{R.REASONS['integrity']}' WHEN NOT retrain_executed THEN '{R.REASONS['retrain']}' "
    f"WHEN rmse_candidate IS NULL OR rmse_champion IS NULL THEN '{R.REASONS['metrics']}' "
    "WHEN NOT rmse_candidate < rmse_champion * (1.0::DOUBLE - 0.01::DOUBLE) THEN printf('Candidate does not beat champion by 1.00%%: candidate=%.4f, champion=%.4f', rmse_candidate, rmse_champion) "
    f"WHEN rmse_candidate_reference IS NULL OR rmse_champion_reference IS NULL THEN '{R.REASONS['reference']}' "
    "WHEN rmse_candidate_reference > rmse_champion_reference * 1.05::DOUBLE THEN printf('Reference-slice regression too high: candidate_ref=%.4f, champion_ref=%.4f, allowed_max=%.4f', rmse_candidate_reference, rmse_champion_reference, rmse_champion_reference * 1.05::DOUBLE) "
    f"WHEN candidate_version IS NULL THEN '{R.REASONS['version']}' ELSE '{R.REASONS['promoted']}' END AS reason FROM mt) "
    f"SELECT model, reason, reason = '{R.REASONS['promoted']}' AS promotion_recommended FROM r",
)
def promotion_gate(spark, d):
    return R.promotion_gate(gate_metrics(spark, d)).select("model", "reason", "promotion_recommended")


@query(
    "latest_model",
    "W10",
    "WITH u AS (SELECT o_custkey AS experiment_id, o_orderkey AS run_id, o_orderdate AS start_time, CASE WHEN o_orderpriority = '5-LOW' THEN 'store/' || o_orderkey ELSE 'runs:/' || o_orderkey || '/model' END AS model_uri FROM orders "
    "WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW') AND (o_orderpriority = '5-LOW' OR o_totalprice > 100000)), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY experiment_id ORDER BY start_time DESC, run_id DESC) AS k FROM u) SELECT experiment_id, run_id, model_uri, start_time FROM r WHERE k = 1",
)
def latest_model(spark, d):
    """Orders as runs of one experiment per customer."""
    p = F.col("o_orderpriority")
    runs = table(spark, d, "orders").select(
        F.col("o_custkey").alias("experiment_id"),
        F.col("o_orderkey").alias("run_id"),
        F.when(F.col("o_orderstatus") == "F", "FINISHED").otherwise("RUNNING").alias("status"),
        F.when(p == "1-URGENT", "train").when(p.isin("2-HIGH", "5-LOW"), "retrain").otherwise("monitor").alias("pipeline_step"),
        F.col("o_orderdate").alias("start_time"),
        F.when(p == "5-LOW", F.concat(F.lit("store/"), F.col("o_orderkey").cast("string"))).alias("model_uri"),
        (F.col("o_totalprice") > 100000).alias("has_model"),
    )
    return R.latest_model(runs)


_ALIAS = "al AS (SELECT o_custkey AS model, CASE WHEN o_orderpriority < '3' THEN 'production' ELSE 'candidate' END AS alias, 'v' || o_orderkey AS version, o_orderdate AS ts, o_orderkey AS seq FROM orders)"


def alias_log(spark, d):
    return table(spark, d, "orders").select(
        F.col("o_custkey").alias("model"),
        F.when(F.col("o_orderpriority") < "3", "production").otherwise("candidate").alias("alias"),
        F.concat(F.lit("v"), F.col("o_orderkey").cast("string")).alias("version"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_orderkey").alias("seq"),
    )


_STATE = "st AS (SELECT model, alias, version, ts AS since, count(*) OVER (PARTITION BY model, alias) AS moves, row_number() OVER (PARTITION BY model, alias ORDER BY ts DESC, seq DESC) AS k FROM al)"


@query("alias_state", "W11", f"WITH {_ALIAS}, {_STATE} SELECT model, alias, version, since, moves FROM st WHERE k = 1")
def alias_state(spark, d):
    return R.alias_state(alias_log(spark, d))


@query(
    "promotion_log",
    "W11",
    f"WITH {_ALIAS}, {_STATE}, s AS (SELECT * FROM st WHERE k = 1), c AS (SELECT model, version, since FROM s WHERE alias = 'candidate'), p AS (SELECT model, version FROM s WHERE alias = 'production') "
    "SELECT model, 'previous_production' AS alias, p.version AS version, 0::INT AS seq FROM c JOIN p USING (model) UNION ALL SELECT model, 'production', version, 1 FROM c",
)
def promotion_log(spark, d):
    """Every model promotes its candidate; the rollback anchor is written before the move."""
    state = R.alias_state(alias_log(spark, d))
    cand = state.where("alias = 'candidate'").select("model", "version", F.col("since").alias("ts"))
    return R.promotion_rows(state, cand, "production", "previous_production").select("model", "alias", "version", "seq")


# ---- splits and faults ------------------------------------------------------

_U = "('0x' || substr(md5('{seed}|' || event_id), 1, 8))::UBIGINT / 4294967296.0::DOUBLE"


@query("random_split", "D1", f"SELECT event_id, CASE WHEN {_U.format(seed=7)} < 0.25 THEN 'test' ELSE 'train' END AS part FROM events")
def random_split(spark, d):
    return D.random_split(table(spark, d, "events"), ["event_id"], 0.25, 7).select("event_id", "part")


_RANK = "SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY md5('{seed}|' || event_id)) AS r, count(*) OVER (PARTITION BY event_type) AS n FROM events"


@query(
    "stratified_split",
    "D2",
    f"WITH x AS ({_RANK.format(seed=3)}) SELECT event_id, CASE WHEN r <= round(0.6::DOUBLE * n) THEN 'train' WHEN r <= round(0.8::DOUBLE * n) THEN 'valid' WHEN r <= round(1.0::DOUBLE * n) THEN 'test' END AS part FROM x",
)
def stratified_split(spark, d):
    df = table(spark, d, "events").select("event_id", "event_type")
    return D.stratified_split(df, ["event_id"], "event_type", {"train": 0.6, "valid": 0.2, "test": 0.2}, 3).select("event_id", "part")


@query("stratified_folds", "D3", f"WITH x AS ({_RANK.format(seed=5)}) SELECT event_id, ((r - 1) % 5)::INT AS fold FROM x")
def stratified_folds(spark, d):
    df = table(spark, d, "events").select("event_id", "event_type")
    return D.stratified_folds(df, ["event_id"], "event_type", 5, 5).select("event_id", "fold")


@query(
    "fold_sizes",
    "A46 D3",
    f"WITH x AS ({_RANK.format(seed=5)}) SELECT ((r - 1) % 5)::INT AS fold, count(*) AS valid_rows, (SELECT count(*) FROM events) - count(*) AS train_rows FROM x GROUP BY 1",
)
def fold_sizes(spark, d):
    df = table(spark, d, "events").select("event_id", "event_type")
    return M.fold_sizes(D.stratified_folds(df, ["event_id"], "event_type", 5, 5), "fold")


@query(
    "time_split",
    "D4",
    f"WITH {TRIPS_SQL} SELECT CASE WHEN month(lpep_pickup_datetime) = 3 THEN 'train' ELSE 'test' END AS part, count(*) AS n, round(avg(fare_amount), 6) AS fare FROM trips WHERE year(lpep_pickup_datetime) = 1998 AND month(lpep_pickup_datetime) IN (3, 7) GROUP BY 1",
)
def time_split(spark, d):
    out = D.time_split(trips(spark, d), "lpep_pickup_datetime", (1998, 3), (1998, 7))
    return out.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("fare_amount"), 6).alias("fare"))


def _turned(key: str, seed: int, turn: int) -> str:
    h = f"md5('{seed}|' || {key})"
    return f"(substr({h}, {3 * turn + 1}) || substr({h}, 1, {3 * turn}))"


def _pick(turn: int, share: float, seed: int = 11) -> str:
    return f"(row_number() OVER (ORDER BY {_turned('trip_id', seed, turn)}) <= greatest(1, floor({share}::DOUBLE * count(*) OVER ())::BIGINT))"


@query(
    "planted_faults",
    "D5",
    f"WITH {TRIPS_SQL}, f AS (SELECT *, {_pick(0, 0.02)} AS m1, {_pick(1, 0.02)} AS m2, {_pick(2, 0.02)} AS m3, {_pick(3, 0.02)} AS m4, "
    f"{_pick(4, 0.01)} AS neg, {_pick(5, 0.01)} AS pay, {_pick(6, 0.005)} AS ord FROM trips) "
    "SELECT trip_id, CASE WHEN neg THEN -abs(coalesce(CASE WHEN NOT m1 THEN trip_distance END, 1)) WHEN NOT m1 THEN trip_distance END AS trip_distance, CASE WHEN NOT m2 THEN fare_amount END AS fare_amount, "
    "CASE WHEN pay THEN 99 WHEN NOT m3 THEN payment_type END::DOUBLE AS payment_type, CASE WHEN NOT m4 THEN tip_amount END AS tip_amount, "
    "CASE WHEN ord THEN lpep_pickup_datetime - INTERVAL 5 MINUTE ELSE lpep_dropoff_datetime END AS lpep_dropoff_datetime FROM f",
)
def planted_faults(spark, d):
    out = D.plant_trip_faults(trips(spark, d), ["trip_id"], 11, "medium")
    return out.select("trip_id", "trip_distance", "fare_amount", "payment_type", "tip_amount", "lpep_dropoff_datetime")


def _ev_pick(turn: int, k: str) -> str:
    return f"(row_number() OVER (ORDER BY {_turned('event_id', 2, turn)}) <= {k})"


def _ev_unit(rule: str) -> str:
    return f"(('0x' || substr(md5('2-{rule}|' || event_id), 1, 8))::UBIGINT / 4294967296.0::DOUBLE)"


def _ev_noise(c: str) -> str:
    return f"30 * sqrt(-2 * ln(greatest({_ev_unit(c + '-1')}, 1e-9))) * cos(6.283185307179586 * {_ev_unit(c + '-2')})"


@query(
    "planted_point_faults",
    "D6",
    "WITH x AS (SELECT event_id, value AS x1, user_id::DOUBLE AS x2, (event_type = 'purchase')::INT AS y FROM events), "
    f"f AS (SELECT *, {_ev_pick(0, 18)} AS o, {_ev_pick(1, 10)} AS m, {_ev_pick(2, 'floor(0.05::DOUBLE * count(*) OVER ())')} AS fl FROM x) "
    f"SELECT event_id, round(CASE WHEN NOT m THEN CASE WHEN o THEN x1 + {_ev_noise('x1')} ELSE x1 END END, 6) AS x1, round(CASE WHEN o THEN x2 + {_ev_noise('x2')} ELSE x2 END, 6) AS x2, CASE WHEN fl THEN 1 - y ELSE y END AS y FROM f",
)
def planted_point_faults(spark, d):
    df = table(spark, d, "events").select(
        "event_id", F.col("value").alias("x1"), F.col("user_id").cast("double").alias("x2"), (F.col("event_type") == "purchase").cast("int").alias("y")
    )
    out = D.plant_point_faults(df, ["event_id"], ["x1", "x2"], "y", seed=2)
    return out.withColumns({c: F.round(c, 6) for c in ("x1", "x2")})


@query(
    "sample_to_workers",
    "D10",
    "WITH RECURSIVE pk AS (SELECT 0 AS k, exp(-0.8::DOUBLE) AS p, exp(-0.8::DOUBLE) AS c UNION ALL SELECT k + 1, p * 0.8::DOUBLE / (k + 1), c + p * 0.8::DOUBLE / (k + 1) FROM pk WHERE k < 15), "
    f"x AS (SELECT event_id, (SELECT count(*) FROM pk WHERE {_U.format(seed='4-copies')} >= c) AS copies FROM events), "
    "dr AS (SELECT event_id, unnest(range(1, copies + 1)) AS draw FROM x) "
    "SELECT event_id, draw::INT AS draw, (('0x' || substr(md5('4-worker|' || event_id || '|' || draw), 1, 8))::UBIGINT % 4)::INT AS worker FROM dr",
)
def sample_to_workers(spark, d):
    return D.sample_to_workers(table(spark, d, "events").select("event_id"), ["event_id"], 0.8, 4, 4).select("event_id", "draw", "worker")


# ---- vectors ----------------------------------------------------------------

_VIEWS = (
    "vw AS (SELECT vec_id AS view_id, vec_id // 2 AS pair_id, vec_id // 100 AS batch_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings), "
    "pr AS (SELECT a.batch_id, a.view_id, a.pair_id = b.pair_id AS pos, list_cosine_similarity(a.e, b.e) AS s FROM vw a JOIN vw b ON a.batch_id = b.batch_id AND a.view_id <> b.view_id), "
    "ls AS (SELECT batch_id, view_id, count(*) AS candidates, max(s) FILTER (WHERE pos) AS positive_sim, max(s) FILTER (WHERE NOT pos) AS closest_negative_sim, ln(sum(exp(s / 0.5))) - max(s) FILTER (WHERE pos) / 0.5 AS loss FROM pr GROUP BY 1, 2)"
)


def _views(spark, d):
    return table(spark, d, "embeddings").select(
        F.col("vec_id").alias("view_id"),
        F.floor(F.col("vec_id") / 2).alias("pair_id"),
        F.floor(F.col("vec_id") / 100).alias("batch_id"),
        "embedding",
    )


@query(
    "view_similarities",
    "J10 A52",
    f"WITH {_VIEWS} SELECT batch_id, view_id, candidates, round(positive_sim, 6) AS positive_sim, round(closest_negative_sim, 6) AS closest_negative_sim, round(loss, 6) AS loss FROM ls",
)
def view_similarities(spark, d):
    out = V.view_losses(_views(spark, d), temperature=0.5)
    return out.withColumns({c: F.round(c, 6) for c in ("positive_sim", "closest_negative_sim", "loss")})


@query("contrastive_loss", "A52", f"WITH {_VIEWS} SELECT count(loss) AS views, round(avg(loss), 7) AS loss FROM ls")
def contrastive_loss(spark, d):
    return V.contrastive_loss(V.view_losses(_views(spark, d), temperature=0.5)).withColumn("loss", F.round("loss", 7))
