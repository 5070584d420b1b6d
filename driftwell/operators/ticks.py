"""Per-zone demand replay in fixed ticks, batch form.

A report is ``zone_id, tick, decision, latency_s, seq``: its arrival is counted
in seconds from the start of its tick. Raw reports may repeat without bound, so
every step first reduces them to one row per (zone, tick) by an aggregate; the
windows below then see at most one row per zone (in a tick) or per tick (in a zone).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TickConfig:
    """Defaults of the replay."""

    tick_minutes: int = 15
    completion_fraction: float = 0.75
    tick_timeout_s: float = 2.0
    need_factor: float = 1.5
    first_use: str = "OK"


def tick_of(ts: str | Column, minutes: int = 15) -> Column:
    """Start of the tick a time falls in."""
    t = (F.col(ts) if isinstance(ts, str) else ts).cast("timestamp")
    width = minutes * 60
    return F.timestamp_seconds(F.floor(F.unix_seconds(t) / width) * width).cast("timestamp_ntz")


def adjacent_months(ref: DataFrame, replay: DataFrame, ts: str) -> DataFrame:
    """One row that says whether two slices are whole neighbours: single months of one year, in order."""

    def span(df: DataFrame, name: str) -> DataFrame:
        month = F.date_trunc("month", F.col(ts).cast("timestamp"))
        return df.agg(F.min(month).cast("date").alias(f"{name}_month"), (F.min(month) == F.max(month)).alias(f"{name}_single"))

    a, b = span(ref, "ref"), span(replay, "replay")
    both = a.select(
        "ref_month",
        b.select("replay_month").scalar().alias("replay_month"),
        "ref_single",
        b.select("replay_single").scalar().alias("replay_single"),
    )
    next_month = F.months_between("replay_month", "ref_month") == 1
    same_year = F.year("replay_month") == F.year("ref_month")
    return both.withColumn("adjacent", F.col("ref_single") & F.col("replay_single") & next_month & same_year)


def active_zones(ref: DataFrame, zone: str, n: int) -> DataFrame:
    """Busiest ``n`` zones of the reference; equal counts by zone id."""
    counts = ref.where(F.col(zone).isNotNull()).groupBy(F.col(zone).alias("zone_id")).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), "zone_id").limit(n)


def tick_demand(df: DataFrame, zone: str, ts: str, minutes: int = 15) -> DataFrame:
    """Rows per (zone, tick), only where there are any."""
    return df.groupBy(F.col(zone).alias("zone_id"), tick_of(ts, minutes).alias("tick")).agg(
        F.count(F.lit(1)).alias("n")
    )


def dense_demand(sparse: DataFrame, zones: DataFrame, minutes: int = 15) -> DataFrame:
    """One row per (active zone, tick) over the whole span of the data, 0 where nothing happened."""
    span = sparse.agg(F.min("tick").alias("a"), F.max("tick").alias("b"))
    ticks = F.sequence(
        span.select("a").scalar(), span.select("b").scalar(), F.expr(f"INTERVAL {int(minutes)} MINUTES")
    )
    grid = zones.select("zone_id", F.explode(ticks).alias("tick"))
    return grid.join(sparse, ["zone_id", "tick"], "left").na.fill(0, ["n"])


def baseline(dense: DataFrame) -> DataFrame:
    """Mean demand by zone, hour of day and weekday over all ticks, empty ones included."""
    return dense.groupBy(
        "zone_id", F.hour("tick").alias("hour_of_day"), F.weekday("tick").alias("day_of_week")
    ).agg(F.avg("n").alias("mean_n"))


def with_baseline(demand: DataFrame, base: DataFrame) -> DataFrame:
    """Replay rows beside their norm; no norm counts as 0. One norm per key, so rows never multiply."""
    keyed = demand.withColumns({"hour_of_day": F.hour("tick"), "day_of_week": F.weekday("tick")})
    return keyed.join(base, ["zone_id", "hour_of_day", "day_of_week"], "left").na.fill(0.0, ["mean_n"])


def need_or_ok(n: str | Column = "n", mean: str | Column = "mean_n", factor: float = 1.5) -> Column:
    n = F.col(n) if isinstance(n, str) else n
    mean = F.col(mean) if isinstance(mean, str) else mean
    return F.when(n > F.lit(float(factor)) * mean, "NEED").otherwise("OK")


def score(demand: DataFrame, base: DataFrame, factor: float = 1.5) -> DataFrame:
    return with_baseline(demand, base).withColumn("decision", need_or_ok(factor=factor))


def withheld(demand: DataFrame, ticks: int, minutes: int = 15) -> DataFrame:
    """What a snapshot knows when input becomes visible ``ticks`` ticks late.

    ``visible_n`` of a tick is the demand of the tick that became available then;
    NULL while nothing has been released yet.
    """
    shift = F.expr(f"INTERVAL {int(ticks) * int(minutes)} MINUTES")
    released = demand.select("zone_id", (F.col("tick") + shift).alias("tick"), F.col("n").alias("visible_n"))
    return demand.join(released, ["zone_id", "tick"], "left")


# ---- closing a tick ---------------------------------------------------------


def first_reports(reports: DataFrame) -> DataFrame:
    """Earliest report per (zone, tick), with the number of reports."""
    row = F.struct("latency_s", "decision", "seq")
    return (
        reports.groupBy("zone_id", "tick")
        .agg(F.min_by(row, F.struct("latency_s", "seq")).alias("r"), F.count(F.lit(1)).alias("reports"))
        .select("zone_id", "tick", "r.decision", "r.latency_s", "r.seq", "reports")
    )


def tick_close(first: DataFrame, zones: int, cfg: TickConfig = TickConfig(), blocking: bool = False) -> DataFrame:
    """``(tick, close_s)``: the arrival that completes the wanted share of zones, or the timeout.

    The blocking policy waits for the last zone and has no timeout.
    """
    if blocking:
        return first.groupBy("tick").agg(F.max("latency_s").alias("close_s"))
    need = math.ceil(cfg.completion_fraction * zones)
    order = Window.partitionBy("tick").orderBy("latency_s", "zone_id")
    ranked = first.withColumn("k", F.row_number().over(order))
    nth = F.min(F.when(F.col("k") >= need, F.col("latency_s")))
    return ranked.groupBy("tick").agg(
        F.least(F.coalesce(nth, F.lit(cfg.tick_timeout_s)), F.lit(cfg.tick_timeout_s)).alias("close_s")
    )


def classify_reports(reports: DataFrame, first: DataFrame, close: DataFrame) -> DataFrame:
    """Every report as accepted, duplicate (before the close, not the first) or late (after it)."""
    winners = first.select("zone_id", "tick", F.col("seq").alias("first_seq"))
    kind = (
        F.when(F.col("latency_s") > F.col("close_s"), "late")
        .when(F.col("seq") != F.col("first_seq"), "duplicate")
        .otherwise("accepted")
    )
    return reports.join(winners, ["zone_id", "tick"]).join(close, "tick").withColumn("kind", kind).drop("first_seq")


def report_counts(reports: DataFrame, first: DataFrame, close: DataFrame) -> DataFrame:
    """Late and duplicate reports per (zone, tick), without marking single reports.

    Reports are counted per distinct latency first; the join then sees one row
    per (zone, tick, latency).
    """
    counts = reports.groupBy("zone_id", "tick", "latency_s").agg(F.count(F.lit(1)).alias("c"))
    per = (
        counts.join(close, "tick")
        .groupBy("zone_id", "tick")
        .agg(
            F.coalesce(F.sum(F.when(F.col("latency_s") > F.col("close_s"), F.col("c"))), F.lit(0)).alias("late"),
            F.sum("c").alias("reports"),
        )
    )
    in_time = F.col("reports") - F.col("late")
    return per.withColumn("duplicates", F.greatest(in_time - 1, F.lit(0)))


def carry_forward(decision: str = "decision", first_use: str = "OK") -> Column:
    """Own decision, else the last one before it in the zone, else ``first_use``."""
    past = Window.partitionBy("zone_id").orderBy("tick").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.col(decision), F.last(decision, ignorenulls=True).over(past), F.lit(first_use))


def accepted_decisions(
    grid: DataFrame, first: DataFrame, close: DataFrame, cfg: TickConfig = TickConfig()
) -> DataFrame:
    """Outcome per (zone, tick) of ``grid``: the report in time, else the previous outcome."""
    in_time = first.join(close, "tick").where(F.col("latency_s") <= F.col("close_s"))
    rows = grid.select("zone_id", "tick").join(in_time.select("zone_id", "tick", "decision"), ["zone_id", "tick"], "left")
    return rows.select(
        "zone_id",
        "tick",
        carry_forward(first_use=cfg.first_use).alias("decision"),
        F.col("decision").isNull().alias("used_fallback"),
    )


def tick_metrics(
    reports: DataFrame, grid: DataFrame, zones: int, cfg: TickConfig = TickConfig(), blocking: bool = False
) -> DataFrame:
    """Latency, completion, fallback, late and duplicate counts per tick."""
    first = first_reports(reports)
    close = tick_close(first, zones, cfg, blocking)
    counts = report_counts(reports, first, close)
    both = first.drop("reports").join(counts, ["zone_id", "tick"]).join(close, "tick")
    per_tick = both.groupBy("tick").agg(
        F.avg("latency_s").alias("mean_latency_s"),
        F.max("latency_s").alias("max_latency_s"),
        F.count_if(F.col("latency_s") <= F.col("close_s")).alias("completed"),
        F.sum("late").alias("late"),
        F.sum("duplicates").alias("duplicates"),
        F.max("close_s").alias("tick_latency_s"),
    )
    expected = grid.groupBy("tick").agg(F.count(F.lit(1)).alias("zones"))
    return expected.join(per_tick, "tick").select(
        "tick",
        "mean_latency_s",
        "max_latency_s",
        F.try_divide("max_latency_s", "mean_latency_s").alias("max_mean_ratio"),
        "completed",
        (F.col("zones") - F.col("completed")).alias("fallbacks"),
        "late",
        "duplicates",
        "tick_latency_s",
    )


def compare_policies(reports: DataFrame, grid: DataFrame, zones: int, cfg: TickConfig = TickConfig()) -> DataFrame:
    """Blocking against early closing on the same replay, one row per policy."""
    parts = [
        tick_metrics(reports, grid, zones, cfg, blocking).withColumn("policy", F.lit(name))
        for name, blocking in (("blocking", True), ("async", False))
    ]
    return parts[0].unionByName(parts[1]).groupBy("policy").agg(
        F.count(F.lit(1)).alias("ticks"),
        F.avg("tick_latency_s").alias("mean_tick_latency_s"),
        F.max("tick_latency_s").alias("max_tick_latency_s"),
        F.sum("completed").alias("completed"),
        F.sum("fallbacks").alias("fallbacks"),
        F.sum("late").alias("late"),
        F.sum("duplicates").alias("duplicates"),
    )
