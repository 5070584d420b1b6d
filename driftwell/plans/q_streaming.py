"""Streaming forms of the replay, run over the whole event table and read back."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import functions as F

from driftwell.operators import ticks as T
from driftwell.plans import q_ticks as Q
from driftwell.plans.catalog import query, table
from driftwell.session import shared_dir
from driftwell.streaming import ticks as S
from driftwell.streaming.completion import completed_outcomes
from driftwell.streaming.snapshots import KeyedSnapshot


def _folder(spark, name):
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _events(spark, d):
    schema = table(spark, d, "events").schema
    return S.read_stream(spark, f"{d.rstrip('/')}/events*.parquet", schema)


@query("streamed_tick_demand", "T2 T12", f"SELECT event_type AS zone_id, {Q.TICK} AS tick, count(*) AS n FROM events GROUP BY 1, 2")
def streamed_tick_demand(spark, d):
    """Counts kept up to date in a keyed sink; update mode also shows windows still open at the end."""
    out, check = _folder(spark, "counts"), _folder(spark, "counts-checkpoint")
    S.run_to_sink(S.tick_counts(_events(spark, d), "event_type", "ts"), out, check, "update")
    return S.read_keyed(spark, out, ["zone_id", "tick"])


@query("streamed_demand_snapshot", "T2 T12 S12", f"SELECT event_type AS zone_id, {Q.TICK} AS tick, count(*) AS n FROM events GROUP BY 1, 2")
def streamed_demand_snapshot(spark, d):
    """The same counts in a sink that is merged by key with every batch, each batch taken up once."""
    out, check = _folder(spark, "snapshot"), _folder(spark, "snapshot-checkpoint")
    counts = S.tick_counts(_events(spark, d), "event_type", "ts")
    sink = KeyedSnapshot(spark, out, ("zone_id", "tick"), counts.schema)
    S.run_merged(counts, sink, check, "update")
    return sink.read()


@query(
    "streamed_tick_scores",
    "T2 T3",
    f"WITH {Q.PREP_SQL}, al AS (SELECT event_type AS zone_id, {Q.TICK} AS tick, count(*) AS n FROM events GROUP BY 1, 2) "
    "SELECT al.zone_id, al.tick, al.n, round(coalesce(b.mean_n, 0), 7) AS mean_n, CASE WHEN al.n > 1.5::DOUBLE * coalesce(b.mean_n, 0) THEN 'NEED' ELSE 'OK' END AS decision "
    "FROM al LEFT JOIN bs b ON b.zone_id = al.zone_id AND b.hour_of_day = hour(al.tick) AND b.day_of_week = isodow(al.tick) - 1",
)
def streamed_tick_scores(spark, d):
    """Windows joined with the static norm; update mode puts out the last one too, and no row is too late."""
    base = T.baseline(Q.demand(spark, d, "reference"))
    out, check = _folder(spark, "scores"), _folder(spark, "scores-checkpoint")
    counts = S.tick_counts(_events(spark, d), "event_type", "ts")
    S.run_to_sink(S.score_stream(counts, base), out, check, "update")
    return S.read_keyed(spark, out, ["zone_id", "tick"]).withColumn("mean_n", F.round("mean_n", 7))


_TIMEOUT = T.TickConfig(completion_fraction=2.0, tick_timeout_s=2.0)


@query(
    "streamed_outcomes",
    "T4 T5 T6 T7 T12",
    f"WITH {Q.PREP_SQL}, {Q.REPORT_SQL}, ar AS (SELECT max(m) AS w FROM (SELECT max(tick + to_microseconds(round(latency_s * 1000000)::BIGINT)) AS m FROM rep UNION ALL SELECT max(tick) FROM rp)), "
    "x AS (SELECT g.zone_id, g.tick, f.decision FROM rp g LEFT JOIN fr f ON f.zone_id = g.zone_id AND f.tick = g.tick AND f.latency_s <= 2), "
    "a AS (SELECT zone_id, tick, coalesce(decision, last_value(decision IGNORE NULLS) OVER (PARTITION BY zone_id ORDER BY tick ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 'OK') AS decision, decision IS NULL AS used_fallback FROM x) "
    "SELECT 'accepted' AS kind, decision, used_fallback, count(*) AS n FROM a, ar WHERE tick + INTERVAL 2 SECOND <= date_trunc('milliseconds', w) GROUP BY ALL "
    "UNION ALL SELECT CASE WHEN r.latency_s > 2 THEN 'late' ELSE 'duplicate' END, r.decision, false, count(*) FROM rep r JOIN fr f ON f.zone_id = r.zone_id AND f.tick = r.tick WHERE r.latency_s > 2 OR r.seq <> f.seq GROUP BY ALL",
)
def streamed_outcomes(spark, d):
    """Reports and tick markers through per-zone state: accepted outcomes, duplicates and late reports."""
    spark.conf.set(S.STATE_STORE, S.ROCKSDB)
    source, out, check = (_folder(spark, n) for n in ("replay", "outcomes", "outcomes-checkpoint"))
    S.replay_input(Q.demand(spark, d, "replay"), Q.reports(spark, d)).write.parquet(source)
    stream = S.read_stream(spark, source, S.REPORT_FIELDS)
    # one run over all that is there: rows of one batch are never late
    run = S.run_to_sink(S.zone_outcomes(stream, "0 seconds", _TIMEOUT), out, check)
    if lost := S.dropped_rows(run):
        raise RuntimeError(f"{lost} rows came too late")
    found = spark.read.parquet(out)
    return found.groupBy("kind", "decision", "used_fallback").agg(F.count(F.lit(1)).alias("n"))


USER_ZONES = 20
_COMPLETION = T.TickConfig(completion_fraction=0.75, tick_timeout_s=2.0)
_ZONE_SQL = (
    f"z AS (SELECT DISTINCT concat('U', CAST(user_id % {USER_ZONES} AS VARCHAR)) AS zone_id FROM events), "
    f"g AS (SELECT zone_id, tick FROM z CROSS JOIN (SELECT unnest(generate_series((SELECT min({Q.TICK}) FROM events), (SELECT max({Q.TICK}) FROM events), INTERVAL 15 MINUTE)) AS tick)), "
    f"rep AS (SELECT concat('U', CAST(user_id % {USER_ZONES} AS VARCHAR)) AS zone_id, {Q.TICK} AS tick, CASE WHEN value > 50 THEN 'NEED' ELSE 'OK' END AS decision, round(value / 25.0::DOUBLE * 1000000)::BIGINT AS us, event_id AS seq FROM events), "
    "fr AS (SELECT * EXCLUDE k FROM (SELECT *, row_number() OVER (PARTITION BY zone_id, tick ORDER BY us, seq) AS k FROM rep) WHERE k = 1), "
    "od AS (SELECT *, row_number() OVER (PARTITION BY tick ORDER BY us, zone_id) AS k FROM fr), "
    f"cl AS (SELECT tick, least(coalesce(min(us) FILTER (WHERE k >= {math.ceil(0.75 * USER_ZONES)}), 2000000), 2000000) AS close_us FROM od GROUP BY 1), "
    "x AS (SELECT g.zone_id, g.tick, o.decision FROM g LEFT JOIN (SELECT f.* FROM fr f JOIN cl USING (tick) WHERE f.us <= cl.close_us) o ON o.zone_id = g.zone_id AND o.tick = g.tick), "
    "a AS (SELECT zone_id, tick, coalesce(decision, last_value(decision IGNORE NULLS) OVER (PARTITION BY zone_id ORDER BY tick ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 'OK') AS decision, decision IS NULL AS used_fallback FROM x)"
)


@query(
    "streamed_completion",
    "T7 T4 T5 T6 W7 W8 W9",
    f"WITH {_ZONE_SQL} SELECT zone_id, tick::TIMESTAMP AS tick, 'accepted' AS kind, decision, used_fallback, 1::BIGINT AS n FROM a "
    "UNION ALL SELECT r.zone_id, r.tick, CASE WHEN r.us > c.close_us THEN 'late' ELSE 'duplicate' END, r.decision, false, count(*) FROM rep r JOIN fr f ON f.zone_id = r.zone_id AND f.tick = r.tick JOIN cl c ON c.tick = r.tick WHERE r.us > c.close_us OR r.seq <> f.seq GROUP BY ALL",
)
def streamed_completion(spark, d):
    """Ticks of twenty zones, closed by three quarters of them or by time, from several files out of order."""
    spark.conf.set(S.STATE_STORE, S.ROCKSDB)
    events = table(spark, d, "events")
    zone = F.concat(F.lit("U"), (F.col("user_id") % USER_ZONES).cast("string"))
    counts = T.tick_demand(events.withColumn("zone", zone), "zone", "ts")
    grid = T.dense_demand(counts, counts.select("zone_id").distinct())
    decision = F.when(F.col("value") > 50, "NEED").otherwise("OK").alias("decision")
    sent = events.select(zone.alias("zone_id"), T.tick_of("ts").alias("tick"), decision, (F.col("value") / 25.0).alias("latency_s"), F.col("event_id").alias("seq"))
    source, out, check = (_folder(spark, n) for n in ("completion", "completed", "completed-checkpoint"))
    late = S.write_deliveries(S.replay_input(grid, sent), source, 4)
    stream = S.read_deliveries(spark, source, S.REPORT_FIELDS)
    run = S.run_to_sink(completed_outcomes(stream, late, USER_ZONES, _COMPLETION), out, check)
    if lost := S.dropped_rows(run):
        raise RuntimeError(f"{lost} rows came too late")
    found = spark.read.parquet(out)
    keys = ["zone_id", F.col("tick").cast("timestamp_ntz").alias("tick"), "kind", "decision", "used_fallback"]
    return found.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


@query(
    "streamed_first_reports",
    "T5",
    f"WITH {Q.PREP_SQL}, {Q.REPORT_SQL} SELECT zone_id, tick, 1::BIGINT AS n FROM fr",
)
def streamed_first_reports(spark, d):
    """Repeats dropped: one report per (zone, tick) remains."""
    source, out, check = (_folder(spark, n) for n in ("reports", "first", "first-checkpoint"))
    S.replay_input(Q.demand(spark, d, "replay"), Q.reports(spark, d)).where("kind = 'report'").write.parquet(source)
    S.run_to_sink(S.drop_repeats(S.read_stream(spark, source, S.REPORT_FIELDS)), out, check)
    found = spark.read.parquet(out)
    return found.groupBy("zone_id", F.col("tick").cast("timestamp_ntz").alias("tick")).agg(F.count(F.lit(1)).alias("n"))


@query("slice_trigger", "T11", "SELECT year(l_shipdate)::INT AS slice_year, count(*) AS rows, count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY 1")
def slice_trigger(spark, d):
    """Every yearly slice starts the profile job once it is whole, on all its files; distinct counts of parts would
    not add up."""
    landing, markers, out, check = (_folder(spark, n) for n in ("landing", "markers", "profiles", "profiles-checkpoint"))
    made = table(spark, d, "lineitem").select("l_orderkey", "l_quantity", "l_shipdate", F.year("l_shipdate").alias("slice_year"))
    # ranges of (year, key): a large year is spread over several tasks and files
    made.repartitionByRange("slice_year", "l_orderkey").write.partitionBy("slice_year").parquet(landing)
    for (year,) in spark.read.parquet(landing).select("slice_year").distinct().orderBy("slice_year").collect():
        S.finish_slice(spark, markers, str(year), f"{landing}/slice_year={year}")

    def job(name, rows):
        counts = rows.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("l_orderkey").alias("orders"))
        counts.write.mode("overwrite").parquet(f"{out}/slice_year={name}")

    S.on_whole_slice(spark, markers, job, check)
    return spark.read.parquet(out).select(F.col("slice_year").cast("int").alias("slice_year"), "rows", "orders")


@query(
    "streamed_withheld_demand",
    "T10",
    f"WITH {Q.PREP_SQL} SELECT a.zone_id, a.tick, a.n, b.n::DOUBLE AS visible_n FROM rp a LEFT JOIN rp b ON b.zone_id = a.zone_id AND b.tick = a.tick - INTERVAL 45 MINUTE",
)
def streamed_withheld_demand(spark, d):
    """Demand beside what was visible then, three ticks late, as a join of a stream with itself; the last delivery is a
    marker far ahead, so the open end comes out as well."""
    source, out, check = (_folder(spark, n) for n in ("withheld", "seen", "seen-checkpoint"))
    made = Q.demand(spark, d, "replay").select("zone_id", F.col("tick").cast("timestamp").alias("tick"), "n", F.col("tick").cast("timestamp").alias("arrival"), F.lit("tick").alias("kind"), F.lit(None).cast("string").alias("decision"), F.col("n").alias("seq"))
    late = S.write_deliveries(made.drop("n"), source, 3)
    rows = S.read_deliveries(spark, source, S.REPORT_FIELDS).select("zone_id", "tick", F.col("seq").alias("n"))
    run = S.run_to_sink(S.withheld_stream(rows, 3, late), out, check)
    if lost := S.dropped_rows(run):
        raise RuntimeError(f"{lost} rows came too late")
    found = spark.read.parquet(out).where("zone_id <> ''")  # not the marker
    return found.select("zone_id", F.col("tick").cast("timestamp_ntz").alias("tick"), "n", F.col("visible_n").cast("double").alias("visible_n"))
