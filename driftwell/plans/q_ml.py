"""Spark ML jobs over the trip role. Fits have no SQL form; conditions that a right fit meets do, and the others are
checked by rows here and by tests on small frames.

Every job is registered at the sizes of the reference procedure, which are the
defaults of the library, over all features.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwell.functions.columns import DROPOFF, PICKUP, ints_to_double, tip_frame, with_abs_error
from driftwell.operators import boosting as B
from driftwell.operators import metrics as M
from driftwell.operators import models as L
from driftwell.operators.features import engineer_features
from driftwell.operators.profile import GateRules
from driftwell.operators.sampling import random_split, stratified_folds, stratified_split
from driftwell.plans.catalog import query
from driftwell.plans.monitoring import MonitorConfig, run_monitoring
from driftwell.plans.roles import SLICES_SQL, TRIPS_SQL, both_slices, trips
from driftwell.plans.store import ModelStore
from driftwell.session import pin, shared_dir


def _tips(spark, d):
    """Card tips with their features."""
    df, features = tip_frame(trips(spark, d))
    return df, features


def _paid(spark, d):
    """Engineered features with the label "has tolls", stratified into three parts."""
    df = trips(spark, d)
    made = engineer_features(df, keep=["trip_id"])
    names = [c for c in made.columns if c not in ("trip_id", "has_tolls", "log_total_amount")]
    ready = made.select("trip_id", F.col("has_tolls").cast("int").alias("y"), *names)
    return ready, names


@query("tip_tree", "M1 M10 P7 P27")
def tip_tree(spark, d):
    """Median-filled tree fitted on the reference half of card trips, scored on the other half."""
    ref, cur = both_slices(spark, d)
    train, features = tip_frame(ref)
    test, _ = tip_frame(cur)
    model = L.fit_tree(train, features)
    scored = L.score(model, test.withColumnRenamed("y", "y_true"), ["PULocationID", "DOLocationID", "trip_distance", "y_true"])
    return with_abs_error(scored)


@query("boosted_tips", "M2 A33 A34")
def boosted_tips(spark, d):
    """Boosted trees on engineered features; errors of both halves."""
    ref, cur = both_slices(spark, d)
    made = [engineer_features(s.withColumn("y", F.coalesce("tip_amount", F.lit(0.0))), keep=["y"], drop_leaky=True) for s in (ref, cur)]
    names = [c for c in made[0].columns if c != "y"]
    model = L.fit_boosted(pin(made[0], "train"), names, "y", L.CHAMPION)
    parts = [
        L.score(model, m, ["y"]).agg(F.lit(n).alias("slice"), M.rmse("y", "y_pred").alias("rmse"), M.mae("y", "y_pred").alias("mae"))
        for n, m in zip(("reference", "current"), made)
    ]
    return parts[0].unionByName(parts[1])


@query("ridge_coefficients", "M3")
def ridge_coefficients(spark, d):
    df, features = _tips(spark, d)
    return L.ridge(df, features)[0]


@query("validation_curve", "M4")
def validation_curve(spark, d):
    """Loss after each boosting round on held-out rows, best round marked."""
    df, names = _paid(spark, d)
    parts = random_split(df, ["trip_id"], 0.25, 1)
    model = L.fit_boosted_classifier(parts.where("part = 'train'"), names, "y", L.CHAMPION)
    return L.validation_curve(model, parts.where("part = 'test'"))


_CARD_SQL = "SELECT *, coalesce(tip_amount, 0) AS y FROM trips WHERE payment_type = 1"


@query(
    "ridge_optimality",
    "M3",
    f"WITH {TRIPS_SQL}, t AS ({_CARD_SQL}) SELECT count(*) AS rows, 0::DOUBLE AS worst_slope, round(avg(y), 6) AS mean_prediction FROM t",
)
def ridge_optimality(spark, d):
    """At the optimum of the penalised squares no coefficient has a slope left (against the sizes of column and label),
    and the mean prediction is the mean label."""
    df, features = _tips(spark, d)
    table, model = L.ridge(df, features)
    weights = {r["feature"]: r["coefficient"] for r in table.collect()}  # one row a column
    scored = model.transform(ints_to_double(df.select(*features, "y")))
    left = F.col("y") - F.col("y_pred")
    x = {c: F.col(f"{c}__f") for c in features}
    slopes = [
        F.abs(F.sum(left * x[c]) - weights[c]) / F.sqrt(F.greatest(F.sum(x[c] * x[c]) * F.sum(F.col("y") * F.col("y")), F.lit(1.0)))
        for c in features
    ]
    worst = F.round(F.greatest(*slopes), 3)  # the solver stops at a tolerance if columns depend on each other
    return scored.agg(F.count(F.lit(1)).alias("rows"), worst.alias("worst_slope"), F.round(F.avg("y_pred"), 6).alias("mean_prediction"))


@query(
    "tree_leaf_means",
    "M1",
    f"WITH {SLICES_SQL}, t AS ({_CARD_SQL.replace('FROM trips', 'FROM ref')}) "
    "SELECT count(*) AS rows, round(avg(y), 6) AS mean_prediction, 0::BIGINT AS small_leaves, 0::BIGINT AS wrong_leaves FROM t",
)
def tree_leaf_means(spark, d):
    """Every leaf of the fitted tree has two hundred training rows or more and predicts their mean."""
    train, features = tip_frame(both_slices(spark, d)[0])
    scored = L.score(L.fit_tree(train, features), train, ["y"])
    leaves = scored.groupBy("y_pred").agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("mean"))
    return leaves.agg(
        F.sum("n").alias("rows"),
        F.round(F.sum(F.col("n") * F.col("y_pred")) / F.sum("n"), 6).alias("mean_prediction"),
        F.count_if(F.col("n") < 200).alias("small_leaves"),
        F.count_if(F.abs(F.col("mean") - F.col("y_pred")) > 1e-9).alias("wrong_leaves"),
    )


_WHOLE_COLUMNS = ("fare_amount", "total_amount", "tolls_amount", "PULocationID", "DOLocationID", "RatecodeID")
_CORRELATIONS = " + ".join(f"2 * pow(corr({a}, {b}), 2)" for i, a in enumerate(_WHOLE_COLUMNS) for b in _WHOLE_COLUMNS[i + 1 :])


@query(
    "component_spectrum",
    "M7 P25",
    f"WITH {TRIPS_SQL} SELECT {len(_WHOLE_COLUMNS)}::BIGINT AS components, 1::DOUBLE AS ratios, round(({len(_WHOLE_COLUMNS)} + {_CORRELATIONS}) / {len(_WHOLE_COLUMNS) ** 2}, 8) AS squares, 0::DOUBLE AS worst_product FROM trips",
)
def component_spectrum(spark, d):
    """Explained shares add up to one, their squares to the squared correlations, and loadings are orthonormal."""
    variance, loadings = L.principal_components(trips(spark, d), _WHOLE_COLUMNS)
    pairs = loadings.alias("a").join(loadings.alias("b"), "feature").groupBy("a.component", "b.component")  # columns squared
    product = F.sum(F.col("a.loading") * F.col("b.loading")) - (F.first("a.component") == F.first("b.component")).cast("int")
    worst = pairs.agg(F.abs(product).alias("p")).agg(F.round(F.max("p"), 8))
    return variance.agg(
        F.count(F.lit(1)).alias("components"),
        F.round(F.sum("ratio"), 8).alias("ratios"),
        F.round(F.sum(F.col("ratio") * F.col("ratio")), 8).alias("squares"),
    ).withColumn("worst_product", worst.scalar())


@query("svc_grid", "M5")
def svc_grid(spark, d):
    df, names = _paid(spark, d)
    return L.svc_grid(pin(df.select("y", *names), "points"), names, "y")[0]


@query("compare_regressors", "M6 M15")
def compare_regressors(spark, d):
    df, features = _tips(spark, d)
    df = df.withColumn("row_key", F.xxhash64(*df.columns))
    parts = random_split(df, ["row_key"], 0.25, 0)
    return L.compare_regressors(parts.where("part = 'train'"), parts.where("part = 'test'"), features, "y")


@query("principal_components", "M7 P25")
def principal_components(spark, d):
    columns = ["trip_distance", "fare_amount", "total_amount", "tip_amount", "passenger_count"]
    variance, loadings = L.principal_components(trips(spark, d), columns)
    sizes = loadings.groupBy("component").agg(F.max_by("feature", F.abs("loading")).alias("strongest"))
    return variance.join(sizes, "component")


_SPLIT_COLUMNS = ("VendorID", "RatecodeID", "passenger_count", "payment_type", "trip_type", "congestion_surcharge")
_LONG_SQL = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v, y FROM t" for c in _SPLIT_COLUMNS)


@query(
    "first_split_gains",
    "M2 M4",
    f"WITH {TRIPS_SQL}, t AS (SELECT *, CASE WHEN tolls_amount > 0 THEN 1 ELSE 0 END AS y FROM trips), l AS ({_LONG_SQL}), "
    "a AS (SELECT feature, sum(0.5::DOUBLE - y) AS g, count(*) * 0.25::DOUBLE AS h, count(*) AS n, coalesce(sum(0.5::DOUBLE - y) FILTER (WHERE v IS NULL), 0) AS gm, count(*) FILTER (WHERE v IS NULL) AS nm FROM l GROUP BY 1), "
    "c AS (SELECT feature, v, sum(0.5::DOUBLE - y) AS g, count(*) AS n FROM l WHERE v IS NOT NULL GROUP BY 1, 2), "
    "r AS (SELECT feature, v, sum(g) OVER w AS g, sum(n) OVER w AS n FROM c WINDOW w AS (PARTITION BY feature ORDER BY v)), "
    "s AS (SELECT r.feature, v AS threshold, k AS missing_left, r.g + CASE WHEN k THEN gm ELSE 0 END AS gl, r.n + CASE WHEN k THEN nm ELSE 0 END AS nl, a.g, a.h, a.n FROM r JOIN a ON a.feature = r.feature CROSS JOIN (VALUES (false), (true)) AS o(k)) "
    "SELECT feature, threshold, missing_left, nl::BIGINT AS left_rows, round(gl * gl / (nl * 0.25 + 1) + (g - gl) * (g - gl) / (h - nl * 0.25 + 1) - g * g / (h + 1), 6) AS gain FROM s WHERE nl * 0.25 >= 1 AND h - nl * 0.25 >= 1",
)
def first_split_gains(spark, d):
    """Every split that the first node of a boosted classifier may take, with its gain, from one histogram."""
    df = trips(spark, d).withColumn("y", (F.col("tolls_amount") > 0).cast("int"))
    return B.root_splits(B.binned(df, _SPLIT_COLUMNS, "y")).withColumn("gain", F.round("gain", 6))


@query("cv_search", "M8 A45 U5 D3")
def cv_search(spark, d):
    """Random search: six trials on the same three stratified folds, sixty rounds, all grown together; the score of a
    trial is the mean over folds of its largest AUC, its iteration the mean of the rounds where that is reached."""
    df, names = _paid(spark, d)
    folded = stratified_folds(df, ["trip_id"], "y", 3, 0)
    return M.cv_trial_summary(B.cross_validate(folded, names, "fold", "y", B.random_trials(6), 60))


@query("refit_at_best", "M9 D2 A36")
def refit_at_best(spark, d):
    """60/20/20: best round on the validation rows, refit on train and validation, AUC on test."""
    df, names = _paid(spark, d)
    parts = pin(stratified_split(df, ["trip_id"], "y", {"train": 0.6, "valid": 0.2, "test": 0.2}), "parts")
    part = lambda p: parts.where(F.col("part") == p)
    first = L.fit_boosted_classifier(part("train"), names, "y", L.CHAMPION)
    best = L.best_iteration(L.validation_curve(first, part("valid")))
    model, auc = L.refit_at_best(part("train").unionByName(part("valid")), part("test"), names, best, "y", L.CHAMPION)
    scored = L.class_share(model, part("test")).select("y", "score")
    return M.roc_auc(scored, "y", "score").withColumns({"best_iteration": F.lit(best), "evaluator_auc": F.lit(auc)})


def valid_rows(batch, rules: GateRules = GateRules()):
    """Rows of a batch that break none of the gate's rules for single rows."""
    bad = [F.col(c).isNull() for c in rules.critical]
    for c, lo, hi in rules.ranges:
        bad += [F.col(c) < lo, F.col(c) > hi]
    bad += [F.col(PICKUP) >= F.col(DROPOFF), F.col("tip_amount") > F.col("total_amount")]
    return batch.where(~F.coalesce(F.greatest(*bad), F.lit(False)))


@query("monitoring_run", "M11 M12 M13 M14 M10 J8 W11 S12")
def monitoring_run(spark, d):
    """Whole run: gate, features, champion bootstrap, performance gate, retrain, promotion.

    Once for the whole batch, as the gate finds it, and once for its valid rows, as they are sent again
    after a rejection. A rejected batch has no scored rows.
    """
    root = shared_dir(spark).rstrip("/")
    ref, cur = both_slices(spark, d)
    import uuid

    store = ModelStore(spark, f"{root}/registry-{uuid.uuid4().hex}")
    cfg = MonitorConfig(keys=["trip_id"], order_by="lpep_dropoff_datetime")
    rows = []
    for name, batch in (("whole", cur), ("valid", valid_rows(cur, cfg.rules))):
        result = run_monitoring(ref, batch, store, cfg, f"{root}/decisions-{uuid.uuid4().hex}")
        n, mae = 0, None
        if "predictions" in result.tables:
            n, mae = result.tables["predictions"].agg(F.count(F.lit(1)), F.avg("abs_error")).first()
        rows += [
            (name, step, decision.get("action") or decision.get("reason") or "", str(decision.get("promotion_executed", "")), n, mae)
            for step, decision in result.decisions.items()
        ]
    return spark.createDataFrame(rows, "batch string, step string, outcome string, promoted string, scored_rows long, mae double")
