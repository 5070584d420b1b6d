"""Load, gate, features, champion, performance gate, retrain, promotion: one run over two slices.

Everything up to a gate is a lazy frame; a gate brings one row to the driver and
the run branches there.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwell.functions.columns import PICKUP, to_number, with_abs_error
from driftwell.operators import drift, features, models, profile
from driftwell.operators.metrics import against_mean
from driftwell.operators.registry import model_gate, promotion_gate
from driftwell.plans.store import ModelStore
from driftwell.session import pin
from driftwell.sources.sinks import append_decision


@dataclass(frozen=True)
class MonitorConfig:
    """``keys`` identify a row of a slice; the rest are fixed values of the run, each can be overridden."""

    keys: Sequence[str]
    model_name: str = "trip_tip_model"
    label: str = "tip_amount"
    order_by: str = PICKUP
    rules: profile.GateRules = field(default_factory=profile.GateRules)
    degradation_pct: float = 5.0
    min_improvement: float = 0.01
    max_regression_pct: float = 5.0
    champion: models.Boost = models.CHAMPION
    candidate: models.Boost = models.CANDIDATE
    drop_leaky: bool = False
    holdout_fraction: float = 0.0
    batch_id: str = "unknown"


@dataclass
class MonitorResult:
    tables: dict[str, DataFrame] = field(default_factory=dict)
    decisions: dict[str, dict] = field(default_factory=dict)
    stopped_at: str | None = None


def integrity_gate(ref: DataFrame, batch: DataFrame, cfg: MonitorConfig) -> tuple[dict, dict[str, DataFrame]]:
    """Hard rules decide; drift alerts only warn and are taken even when the rules fail."""
    gate = profile.hard_rules(batch, cfg.rules).first()
    columns = [c for c in drift.MONITORED_COLUMNS if c in ref.columns and c in batch.columns]
    if drift.usable_columns(ref, batch, columns) and gate["rows"]:
        alerts = drift.drifted_columns(drift.chunk_drift(ref, batch, cfg.order_by, cfg.keys, columns))
        drifted = [(r["feature"], r["warning"]) for r in alerts.where("drifted").orderBy("feature").collect()]
    else:
        alerts = drift.fallback_drift(ref, batch)
        drifted = [(r["column"], r["warning"]) for r in alerts.orderBy("column", "kind").collect()]
    tables = {
        "missingness": profile.missingness(batch),
        "duplicates": profile.duplicate_rows(batch),
        "range_checks": profile.range_checks(batch, tuple(profile.GATE_RANGES), all_invalid="skip"),
        "domain_checks": profile.domain_checks(batch),
        "datetime_checks": profile.datetime_checks(batch),
        "schema_dtypes": profile.schema_dtypes(batch),
        "schema_presence": profile.schema_presence(batch),
        "drift_alerts": alerts,
    }
    passed = bool(gate["hard_rules_passed"])
    decision = {
        "step": "B_integrity_gate",
        "hard_rules_passed": passed,
        "hard_failures": list(gate["hard_failures"]),
        "drift_warnings": [w for _, w in drifted],
        "drift_columns": list(dict.fromkeys(c for c, _ in drifted)),
        "additional_checks_summary": check_summary(batch, tables),
        "integrity_passed": passed,
        "integrity_warn": bool(drifted),
        "action": "proceed" if passed else "reject_batch",
    }
    return decision, tables


def check_summary(batch: DataFrame, tables: dict[str, DataFrame]) -> dict[str, float]:
    """The seven dashboard numbers of a gate decision, one small row each."""
    one = lambda df, e: float(df.agg(e).first()[0] or 0.0)
    return {
        "schema_missing_cols": one(tables["schema_presence"], F.count_if(F.col("status") == "missing")),
        "schema_bad_family_dtypes": one(tables["schema_dtypes"], F.count_if(~F.col("family_ok"))),
        "duplicate_rows_frac": one(tables["duplicates"], F.max("duplicate_rows_frac")),
        "missing_frac_max": one(profile.missingness(batch, unique=False), F.max("missing_frac")),
        "range_worst_bad_frac": one(tables["range_checks"], F.max("bad_frac")),
        "domain_worst_bad_frac": one(tables["domain_checks"], F.max("bad_frac")),
        "duration_over_6h_frac": one(
            tables["datetime_checks"], F.max(F.when(F.col("check") == "duration_over_6h", F.col("bad_frac")))
        ),
    }


def label_frame(df: DataFrame, cfg: MonitorConfig) -> DataFrame:
    """Features and the label ``y`` (missing counts as 0) beside the row keys; written once."""
    if cfg.label not in df.columns:
        raise ValueError(f"Labels missing: {cfg.label}")
    made = features.feature_columns(df, cfg.drop_leaky)
    y = F.coalesce(to_number(cfg.label), F.lit(0.0)).alias("y")
    return pin(df.select(*cfg.keys, y, *[c.alias(n) for n, c in made.items() if n not in cfg.keys]), "features")


def run_monitoring(ref: DataFrame, batch: DataFrame, store: ModelStore, cfg: MonitorConfig, log: str | None = None) -> MonitorResult:
    """One monitoring run; decisions are returned and, with ``log``, appended to the decision log."""
    out = MonitorResult()

    def decide(name: str, decision: dict) -> dict:
        out.decisions[name] = decision
        if log:
            row = ref.sparkSession.createDataFrame([decision], _layout(decision))
            append_decision(row.withColumn("timestamp", F.date_format(F.localtimestamp(), "yyyy-MM-dd'T'HH:mm:ss")), log)
        return decision

    out.tables["dataset_summary"] = profile.dataset_profile(ref, "reference").unionByName(profile.dataset_profile(batch, "batch"))
    out.tables["schema_compare"] = profile.schema_compare(ref, batch)
    out.tables["top_missing"] = profile.top_missing(batch)

    gate, tables = integrity_gate(ref, batch, cfg)
    out.tables |= tables
    decide("integrity", gate)
    if not gate["integrity_passed"]:
        out.stopped_at = "integrity"
        return out

    ref_x, batch_x = label_frame(ref, cfg), label_frame(batch, cfg)
    names = [c for c in ref_x.columns if c not in (*cfg.keys, "y")]
    out.tables["feature_schema"] = features.feature_schema(ref_x.select(*names), batch_x.select(*names))

    version = store.alias(cfg.model_name, "champion")
    bootstrap = version is None
    if bootstrap:
        fitted = models.fit_boosted(ref_x, names, "y", cfg.champion)
        version = store.add_version(cfg.model_name, fitted, "champion", "approved", "bootstrap")
        store.move_alias(cfg.model_name, "champion", version)
    champion = store.load(cfg.model_name, version)
    decide("champion", {"step": "D_load_champion", "model_name": cfg.model_name, "champion_version": version, "bootstrap": bootstrap, "action": "load_champion"})

    scored = models.score(champion, batch_x, [*cfg.keys, "y"])
    mean = ref_x.agg(F.avg("y")).first()[0]
    performance = model_gate(against_mean(scored, "y", "y_pred", mean), cfg.degradation_pct).first().asDict()
    decide("model", {"step": "E_model_gate", **performance})

    metrics = {"integrity_passed": True, "retrain_executed": False, "rmse_candidate": None, "rmse_champion": performance["rmse_champion"]}
    metrics |= {"rmse_candidate_reference": None, "rmse_champion_reference": None, "candidate_version": None}
    if performance["retrain_needed"]:
        metrics |= retrain(ref_x, batch_x, names, champion, store, cfg)
        decide("retrain", {"step": "F_retrain_candidate", "retrain_executed": True, "action": "candidate_trained"} | {k: v for k, v in metrics.items() if v is not None and k not in ("integrity_passed", "retrain_executed")})
    else:
        decide("retrain", {"step": "F_retrain_candidate", "retrain_executed": False, "action": "skip_retrain", "reason": performance["retrain_reason"]})

    layout = "integrity_passed boolean, retrain_executed boolean, rmse_candidate double, rmse_champion double, rmse_candidate_reference double, rmse_champion_reference double, candidate_version string"
    table = ref.sparkSession.createDataFrame([tuple(metrics[c.split()[0]] for c in layout.split(", "))], layout)
    verdict = promotion_gate(table, cfg.min_improvement, cfg.max_regression_pct)
    out.tables["gate_checks"] = verdict
    row = verdict.first()
    if row["promotion_recommended"]:
        store.move_alias(cfg.model_name, "champion", metrics["candidate_version"])
    decide("promotion", {"step": "G_promotion_gate", "promotion_recommended": row["promotion_recommended"], "promotion_executed": row["promotion_recommended"], "reason": row["reason"]})

    final = store.load(cfg.model_name, store.alias(cfg.model_name, "champion"))
    out.tables["predictions"] = with_abs_error(
        models.score(final, batch_x, [*cfg.keys, "y"]).withColumnRenamed("y", "y_true")
    )
    return out


def retrain(ref_x: DataFrame, batch_x: DataFrame, names: Sequence[str], champion, store: ModelStore, cfg: MonitorConfig) -> dict:
    """Candidate on reference and batch rows, by column name.

    By default it is scored on rows it was trained on, as the usual run does;
    ``holdout_fraction`` keeps that share of the batch out of training.
    """
    from driftwell.operators.sampling import unit_hash

    train_batch = test_batch = batch_x
    if cfg.holdout_fraction > 0:
        u = unit_hash(list(cfg.keys), "holdout")
        train_batch, test_batch = batch_x.where(u >= cfg.holdout_fraction), batch_x.where(u < cfg.holdout_fraction)
    pick = ["y", *names]
    fitted = models.fit_boosted(ref_x.select(*pick).unionByName(train_batch.select(*pick)), names, "y", cfg.candidate)
    version = store.add_version(cfg.model_name, fitted, "candidate", "pending", f"batch {cfg.batch_id}")
    on_batch = models.error_row(models.score(fitted, test_batch, ["y"]))
    candidate_ref = models.error_row(models.score(fitted, ref_x, ["y"]))["rmse"]
    champion_ref = models.error_row(models.score(champion, ref_x, ["y"]))["rmse"]
    return {
        "retrain_executed": True,
        "candidate_version": version,
        "rmse_candidate": on_batch["rmse"],
        "rmse_candidate_reference": candidate_ref,
        "rmse_champion_reference": champion_ref,
    }


def _layout(decision: dict) -> str:
    kinds = {bool: "boolean", int: "int", float: "double", str: "string", list: "array<string>"}
    parts = []
    for name, value in decision.items():
        if isinstance(value, dict):
            kind = "struct<" + ", ".join(f"{k}: double" for k in value) + ">"
        else:
            kind = kinds.get(type(value), "string")
        parts.append(f"{name} {kind}")
    return ", ".join(parts)
