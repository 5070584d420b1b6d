"""Model registry kept in tables: runs, versions, aliases, gates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwell.functions.columns import to_digits


def latest_model(runs: DataFrame, by: Sequence[str] = ("experiment_id",)) -> DataFrame:
    """Newest finished train or retrain run that has a model, per experiment.

    Expects ``run_id, status, pipeline_step, start_time, model_uri, has_model``;
    a run without a stored address but with a model gets the default one.
    """
    usable = runs.where(
        (F.col("status") == "FINISHED")
        & F.col("pipeline_step").isin("train", "retrain")
        & (F.col("model_uri").isNotNull() | F.col("has_model"))
    )
    uri = F.coalesce("model_uri", F.concat(F.lit("runs:/"), F.col("run_id").cast("string"), F.lit("/model")))
    row = F.struct("run_id", uri.alias("model_uri"), "start_time")
    newest = usable.groupBy(*by).agg(F.max_by(row, F.struct("start_time", "run_id")).alias("r"))
    return newest.select(*by, "r.run_id", "r.model_uri", "r.start_time")


def alias_state(log: DataFrame, by: Sequence[str] = ("model", "alias")) -> DataFrame:
    """Where every alias points now, from an append-only log ``model, alias, version, ts, seq``."""
    return log.groupBy(*by).agg(
        F.max_by("version", F.struct("ts", "seq")).alias("version"),
        F.max(F.struct("ts", "seq"))["ts"].alias("since"),
        F.count(F.lit(1)).alias("moves"),
    )


def promotion_rows(state: DataFrame, candidates: DataFrame, alias: str, previous: str) -> DataFrame:
    """Log rows that promote a candidate: the rollback anchor first (seq 0), then the move (seq 1).

    ``candidates`` has ``model, version, ts``. A model that had no such alias
    gets the move only.
    """
    now = state.where(F.col("alias") == alias).select("model", F.col("version").alias("_old"))
    both = candidates.join(now, "model", "left")
    rows = F.array(
        F.struct(F.lit(previous).alias("alias"), F.col("_old").alias("version"), F.lit(0).alias("seq")),
        F.struct(F.lit(alias).alias("alias"), F.col("version"), F.lit(1).alias("seq")),
    )
    made = both.select("model", "ts", F.inline(rows))
    return made.where(F.col("version").isNotNull()).select("model", "alias", "version", "ts", "seq")


def model_gate(table: DataFrame, threshold_pct: float = 5.0) -> DataFrame:
    """Retrain when the champion's RMSE is more than ``threshold_pct`` above the mean predictor's."""
    x = F.col("rmse_increase_pct")
    needed = x > threshold_pct
    return table.withColumns(
        {
            "retrain_needed": needed,
            "action": F.when(needed, "retrain").otherwise("keep_champion"),
            "retrain_reason": F.when(
                needed, F.format_string("Champion RMSE is %.2f%% worse than baseline", to_digits(x, 2))
            ).otherwise(
                F.format_string(f"Champion RMSE within threshold (%.2f%% vs {threshold_pct:.2f}%%)", to_digits(x, 2))
            ),
        }
    )


# Reasons of the promotion gate.
REASONS = {
    "integrity": "Integrity gate failed. Promotion blocked.",
    "retrain": "No retraining executed; no candidate to promote.",
    "metrics": "Missing evaluation metrics; promotion blocked.",
    "reference": "Missing reference-slice stability metrics; promotion blocked.",
    "version": "Candidate version missing; promotion blocked.",
    "promoted": "Candidate beat champion by required margin and was promoted",
}


def promotion_gate(
    metrics: DataFrame, min_improvement: float = 0.01, max_regression_pct: float = 5.0
) -> DataFrame:
    """Adds ``promotion_recommended`` and ``reason``; checks are taken in a fixed order.

    Beating the champion is strict, the allowance on the reference slice is not.
    """
    c = F.col
    allowed = c("rmse_champion_reference") * (1.0 + max_regression_pct / 100.0)
    beats = c("rmse_candidate") < c("rmse_champion") * (1.0 - min_improvement)
    text: Column = (
        F.when(~F.coalesce(c("integrity_passed"), F.lit(False)), REASONS["integrity"])
        .when(~F.coalesce(c("retrain_executed"), F.lit(False)), REASONS["retrain"])
        .when(c("rmse_candidate").isNull() | c("rmse_champion").isNull(), REASONS["metrics"])
        .when(
            ~beats,
            F.format_string(
                f"Candidate does not beat champion by {min_improvement * 100:.2f}%%: candidate=%.4f, champion=%.4f",
                to_digits(c("rmse_candidate"), 4),
                to_digits(c("rmse_champion"), 4),
            ),
        )
        .when(c("rmse_candidate_reference").isNull() | c("rmse_champion_reference").isNull(), REASONS["reference"])
        .when(
            c("rmse_candidate_reference") > allowed,
            F.format_string(
                "Reference-slice regression too high: candidate_ref=%.4f, champion_ref=%.4f, allowed_max=%.4f",
                to_digits(c("rmse_candidate_reference"), 4),
                to_digits(c("rmse_champion_reference"), 4),
                to_digits(allowed, 4),
            ),
        )
        .when(c("candidate_version").isNull(), REASONS["version"])
        .otherwise(REASONS["promoted"])
    )
    return metrics.withColumn("reason", text).withColumn(
        "promotion_recommended", F.col("reason") == REASONS["promoted"]
    )
