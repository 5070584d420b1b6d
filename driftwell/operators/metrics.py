"""Model metrics as plain aggregates, optionally per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwell.operators.prefix import column_points, running_total


def rmse(truth: str | Column, guess: str | Column) -> Column:
    t, g = _col(truth), _col(guess)
    return F.sqrt(F.avg((t - g) * (t - g)))


def mae(truth: str | Column, guess: str | Column) -> Column:
    return F.avg(F.abs(_col(truth) - _col(guess)))


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def increase_pct(value: Column, baseline: Column) -> Column:
    """Percent above the baseline; 0 when the baseline is 0."""
    return F.when(baseline == 0, F.lit(0.0)).otherwise((value - baseline) / F.nullif(baseline, F.lit(0.0)) * 100.0)


def against_mean(df: DataFrame, truth: str, guess: str, mean: float, by: Sequence[str] = ()) -> DataFrame:
    """Errors of a model and of the constant mean predictor on the same rows."""
    base = F.lit(float(mean))
    table = df.groupBy(*by).agg(
        rmse(truth, guess).alias("rmse_champion"),
        mae(truth, guess).alias("mae_champion"),
        rmse(truth, base).alias("rmse_baseline"),
        mae(truth, base).alias("mae_baseline"),
    )
    return table.withColumn("rmse_increase_pct", increase_pct(F.col("rmse_champion"), F.col("rmse_baseline")))


def r2(df: DataFrame, truth: str, guess: str, by: Sequence[str] = ()) -> DataFrame:
    """1 - residual over total sum of squares; NULL for a constant truth."""
    t, g = F.col(truth).cast("double"), F.col(guess).cast("double")
    total = F.var_pop(t) * F.count(t)
    return df.where(t.isNotNull() & g.isNotNull()).groupBy(*by).agg(
        (F.lit(1.0) - F.try_divide(F.sum((t - g) * (t - g)), total)).alias("r2")
    )


def confusion(df: DataFrame, label: str, guess: str) -> DataFrame:
    return df.groupBy(label, guess).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, label: str, guess: str, classes: Sequence) -> DataFrame:
    """Wide form: one row per true class, one column per predicted class."""
    cells = [F.count_if(F.col(guess) == k).alias(f"pred_{k}") for k in classes]
    return df.groupBy(label).agg(*cells)


def classification_report(df: DataFrame, label: str, guess: str) -> DataFrame:
    """Precision, recall, F1 and support per class, then macro, weighted and accuracy rows.

    Works from the confusion counts (classes x classes rows).
    """
    cells = confusion(df, label, guess).select(
        F.col(label).cast("string").alias("y"), F.col(guess).cast("string").alias("p"), "n"
    )
    sides = cells.select(
        F.inline(
            F.array(
                F.struct(F.col("y").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted"), F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("hit")),
                F.struct(F.col("p").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("hit")),
            )
        )
    )
    per = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hit")])
    zero = F.lit(0.0)
    per = per.withColumns(
        {
            "precision": F.coalesce(F.try_divide(F.col("hit"), F.col("predicted")), zero),
            "recall": F.coalesce(F.try_divide(F.col("hit"), F.col("support")), zero),
        }
    ).withColumn(
        "f1",
        F.coalesce(
            F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), zero
        ),
    )
    names = ["precision", "recall", "f1"]
    n = F.sum("support")
    macro = per.agg(*[F.avg(c).alias(c) for c in names], n.alias("support")).withColumn("class", F.lit("macro avg"))
    weighted = per.agg(
        *[(F.sum(F.col(c) * F.col("support")) / n).alias(c) for c in names], n.alias("support")
    ).withColumn("class", F.lit("weighted avg"))
    hits = F.sum("hit") / n
    accuracy = per.agg(*[hits.alias(c) for c in names], n.alias("support")).withColumn("class", F.lit("accuracy"))
    out = per.select("class", *names, "support")
    for extra in (macro, weighted, accuracy):
        out = out.unionByName(extra)
    return out


def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve by rank sums, ties averaged; NULL with one class only.

    Counts per distinct score first, then a bucketed running total.
    """
    by = list(by)
    counts = df.where(F.col(label).isNotNull() & F.col(score).isNotNull()).groupBy(*by, score).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    ranked = running_total(counts, score, {"neg_to": "neg"}, by, points=column_points(df, [score]))
    wins = F.sum(F.col("pos") * (F.col("neg_to") - F.col("neg") * 0.5))
    return ranked.groupBy(*by).agg(
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
        F.try_divide(wins, (F.sum("pos") * F.sum("neg")).cast("double")).alias("auc"),
    )


def compare_models(df: DataFrame, truth: str, old: str, new: str) -> DataFrame:
    """Baseline against new on an evaluation slice, with a winner flag (strictly lower wins)."""
    table = df.agg(rmse(truth, old).alias("baseline_rmse"), rmse(truth, new).alias("new_rmse"))
    return table.withColumns(
        {
            "delta_rmse_new_minus_base": F.col("new_rmse") - F.col("baseline_rmse"),
            "new_model_wins": F.col("new_rmse") < F.col("baseline_rmse"),
        }
    )


def degradation_ratio(current: Column, baseline: Column) -> Column:
    """(current - baseline) / baseline: a ratio, not a percentage; NULL for a baseline of 0 or less."""
    return F.when(baseline > 0, (current - baseline) / baseline)


def averaged_gradient(df: DataFrame, features: Sequence[str], label: str, weights: Sequence[float], shard: str) -> DataFrame:
    """Gradient of the squared error of a linear model, summed over shards and divided by their number.

    Each shard contributes its mean gradient, as one worker would.
    """
    guess = sum((F.col(f) * F.lit(float(w)) for f, w in zip(features, weights)), F.lit(0.0))
    residual = guess - F.col(label)
    local = df.groupBy(shard).agg(*[F.avg(residual * F.col(f)).alias(f) for f in features])
    return local.agg(F.count(F.lit(1)).alias("workers"), *[F.avg(f).alias(f"grad_{f}") for f in features])


def throughput(ranks: DataFrame, run: str) -> DataFrame:
    """Images of all ranks over the slowest rank's seconds, per run."""
    return ranks.groupBy(run).agg(
        F.sum("profiled_images").alias("window_images"),
        F.max("profiled_seconds").alias("window_seconds"),
        F.when(
            F.max("profiled_seconds") > 0, F.sum("profiled_images") / F.max("profiled_seconds")
        ).alias("images_per_second"),
    )


def rank_step_time(ranks: DataFrame, run: str) -> DataFrame:
    steps = F.greatest(F.col("profiled_steps"), F.lit(1))
    return ranks.select(run, "rank", (F.col("profiled_seconds") / steps).alias("avg_step_seconds"))


def fold_sizes(df: DataFrame, fold: str) -> DataFrame:
    """Validation and training rows per fold."""
    counts = df.groupBy(fold).agg(F.count(F.lit(1)).alias("valid_rows"))
    total = counts.agg(F.sum("valid_rows")).scalar()
    return counts.withColumn("train_rows", total - F.col("valid_rows"))


def cv_trial_summary(folds: DataFrame, trial: str = "trial_id") -> DataFrame:
    """Mean best score and the mean best iteration rounded half to even, per trial."""
    return folds.groupBy(trial).agg(
        F.avg("best_auc").alias("score"), F.bround(F.avg("best_iteration")).cast("int").alias("best_iteration")
    )
