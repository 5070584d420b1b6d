"""Demand replay over the event table: five zones (event types), 15-minute ticks."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwell.operators import ticks as T
from driftwell.plans.catalog import query, table

CUT = "2024-01-16"
ZONES = 4  # active zones, of five
CFG = T.TickConfig(completion_fraction=0.5, tick_timeout_s=2.0)


def reference(spark, d):
    return table(spark, d, "events").where(F.col("ts") < F.lit(CUT).cast("timestamp_ntz"))


def replay(spark, d):
    return table(spark, d, "events").where(F.col("ts") >= F.lit(CUT).cast("timestamp_ntz"))


def zones(spark, d):
    return T.active_zones(reference(spark, d), "event_type", ZONES)


def demand(spark, d, part):
    source = reference if part == "reference" else replay
    return T.dense_demand(T.tick_demand(source(spark, d), "event_type", "ts"), zones(spark, d))


def reports(spark, d):
    """One report per event of an active zone; its value sets the delay, so zones report
    several times in a tick and some reports come late."""
    rows = replay(spark, d).select(
        F.col("event_type").alias("zone_id"),
        T.tick_of("ts").alias("tick"),
        F.when(F.col("value") > 50, "NEED").otherwise("OK").alias("decision"),
        (F.col("value") / 25.0).alias("latency_s"),
        F.col("event_id").alias("seq"),
    )
    return rows.join(zones(spark, d).select("zone_id"), "zone_id", "left_semi")


TICK = "time_bucket(INTERVAL 15 MINUTE, ts)"
ZONES_SQL = f"az AS (SELECT event_type AS zone_id, count(*) AS n FROM events WHERE ts < TIMESTAMP '{CUT}' GROUP BY 1 ORDER BY n DESC, 1 LIMIT {ZONES})"


def _demand_sql(name: str, test: str) -> str:
    return (
        f"{name}_s AS (SELECT event_type AS zone_id, {TICK} AS tick, count(*) AS n FROM events WHERE ts {test} TIMESTAMP '{CUT}' GROUP BY 1, 2), "
        f"{name} AS (SELECT z.zone_id, g.tick, coalesce(s.n, 0) AS n FROM az z CROSS JOIN (SELECT unnest(generate_series((SELECT min(tick) FROM {name}_s), (SELECT max(tick) FROM {name}_s), INTERVAL 15 MINUTE)) AS tick) g LEFT JOIN {name}_s s ON s.zone_id = z.zone_id AND s.tick = g.tick)"
    )


BASE_SQL = "bs AS (SELECT zone_id, hour(tick)::INT AS hour_of_day, (isodow(tick) - 1)::INT AS day_of_week, avg(n) AS mean_n FROM rf GROUP BY 1, 2, 3)"
PREP_SQL = f"{ZONES_SQL}, {_demand_sql('rf', '<')}, {_demand_sql('rp', '>=')}, {BASE_SQL}"
REPORT_SQL = (
    f"rep AS (SELECT event_type AS zone_id, {TICK} AS tick, CASE WHEN value > 50 THEN 'NEED' ELSE 'OK' END AS decision, value / 25.0::DOUBLE AS latency_s, event_id AS seq FROM events WHERE ts >= TIMESTAMP '{CUT}' AND event_type IN (SELECT zone_id FROM az)), "
    "fr AS (SELECT * EXCLUDE k FROM (SELECT *, row_number() OVER (PARTITION BY zone_id, tick ORDER BY latency_s, seq) AS k FROM rep) WHERE k = 1), "
    "od AS (SELECT *, row_number() OVER (PARTITION BY tick ORDER BY latency_s, zone_id) AS k FROM fr), "
    "cl AS (SELECT tick, least(coalesce(min(latency_s) FILTER (WHERE k >= 2), 2.0::DOUBLE), 2.0::DOUBLE) AS close_s FROM od GROUP BY 1), "
    "bl AS (SELECT tick, max(latency_s) AS close_s FROM fr GROUP BY 1)"
)


def _metrics_sql(close: str, name: str) -> str:
    return (
        f"cn_{name} AS (SELECT zone_id, tick, count(*) FILTER (WHERE latency_s > close_s) AS late, greatest(count(*) FILTER (WHERE latency_s <= close_s) - 1, 0) AS dup FROM rep JOIN {close} USING (tick) GROUP BY 1, 2), "
        f"tm_{name} AS (SELECT tick, avg(latency_s) AS mean_l, max(latency_s) AS max_l, count(*) FILTER (WHERE latency_s <= close_s) AS completed, sum(late)::BIGINT AS late, sum(dup)::BIGINT AS duplicates, max(close_s) AS tick_latency_s "
        f"FROM fr JOIN cn_{name} USING (zone_id, tick) JOIN {close} USING (tick) GROUP BY 1)"
    )


@query("active_zones", "A49", f"WITH {ZONES_SQL} SELECT zone_id, n FROM az")
def active_zones(spark, d):
    return zones(spark, d)


@query(
    "adjacent_months",
    "T1",
    "WITH a AS (SELECT strftime(min(o_orderdate), '%Y-%m') AS m, date_trunc('month', min(o_orderdate)) = date_trunc('month', max(o_orderdate)) AS s, max(o_orderdate) AS e FROM orders WHERE year(o_orderdate) <= 1997), "
    "b AS (SELECT strftime(min(o_orderdate), '%Y-%m') AS m, date_trunc('month', min(o_orderdate)) = date_trunc('month', max(o_orderdate)) AS s, min(o_orderdate) AS e FROM orders WHERE year(o_orderdate) > 1997) "
    "SELECT a.m AS ref_month, b.m AS replay_month, a.s AS ref_single, b.s AS replay_single, a.s AND b.s AND year(a.e) = year(b.e) AS adjacent FROM a, b",
)
def adjacent_months(spark, d):
    """The two halves of the order table are no pair of neighbouring months; the check says so."""
    orders = table(spark, d, "orders")
    year = F.year("o_orderdate")
    out = T.adjacent_months(orders.where(year <= 1997), orders.where(year > 1997), "o_orderdate")
    return out.withColumns({c: F.date_format(c, "yyyy-MM") for c in ("ref_month", "replay_month")})


@query("tick_demand", "A51", f"SELECT event_type AS zone_id, {TICK} AS tick, count(*) AS n FROM events GROUP BY 1, 2")
def tick_demand(spark, d):
    return T.tick_demand(table(spark, d, "events"), "event_type", "ts")


@query("dense_demand", "A51 T1", f"WITH {PREP_SQL} SELECT zone_id, tick, n FROM rp")
def dense_demand(spark, d):
    return demand(spark, d, "replay")


@query("tick_baseline", "A50", f"WITH {PREP_SQL} SELECT zone_id, hour_of_day, day_of_week, round(mean_n, 7) AS mean_n FROM bs")
def tick_baseline(spark, d):
    return T.baseline(demand(spark, d, "reference")).withColumn("mean_n", F.round("mean_n", 7))


@query(
    "tick_scores",
    "J9 T3",
    f"WITH {PREP_SQL} SELECT zone_id, tick, n, round(coalesce(mean_n, 0), 7) AS mean_n, CASE WHEN n > 1.5::DOUBLE * coalesce(mean_n, 0) THEN 'NEED' ELSE 'OK' END AS decision FROM rp LEFT JOIN bs USING (zone_id) WHERE hour_of_day = hour(tick) AND day_of_week = isodow(tick) - 1",
)
def tick_scores(spark, d):
    out = T.score(demand(spark, d, "replay"), T.baseline(demand(spark, d, "reference")))
    return out.select("zone_id", "tick", "n", F.round("mean_n", 7).alias("mean_n"), "decision")


@query(
    "withheld_demand",
    "T10",
    f"WITH {PREP_SQL} SELECT a.zone_id, a.tick, a.n, b.n::DOUBLE AS visible_n FROM rp a LEFT JOIN rp b ON b.zone_id = a.zone_id AND b.tick = a.tick - INTERVAL 45 MINUTE",
)
def withheld_demand(spark, d):
    return T.withheld(demand(spark, d, "replay"), 3).withColumn("visible_n", F.col("visible_n").cast("double"))


@query("tick_close", "W8 T7", f"WITH {PREP_SQL}, {REPORT_SQL} SELECT tick, close_s FROM cl")
def tick_close(spark, d):
    return T.tick_close(T.first_reports(reports(spark, d)), ZONES, CFG)


@query(
    "report_kinds",
    "W9 T5 T6 W4",
    f"WITH {PREP_SQL}, {REPORT_SQL} SELECT r.zone_id, r.tick, r.decision, r.latency_s, r.seq, c.close_s, CASE WHEN r.latency_s > c.close_s THEN 'late' WHEN r.seq <> f.seq THEN 'duplicate' ELSE 'accepted' END AS kind FROM rep r JOIN fr f ON f.zone_id = r.zone_id AND f.tick = r.tick JOIN cl c ON c.tick = r.tick",
)
def report_kinds(spark, d):
    rep = reports(spark, d)
    first = T.first_reports(rep)
    return T.classify_reports(rep, first, T.tick_close(first, ZONES, CFG))


@query(
    "accepted_decisions",
    "W7 T7",
    f"WITH {PREP_SQL}, {REPORT_SQL}, x AS (SELECT g.zone_id, g.tick, o.decision FROM rp g LEFT JOIN (SELECT f.zone_id, f.tick, f.decision FROM fr f JOIN cl ON cl.tick = f.tick WHERE f.latency_s <= cl.close_s) o ON o.zone_id = g.zone_id AND o.tick = g.tick) "
    "SELECT zone_id, tick, coalesce(decision, last_value(decision IGNORE NULLS) OVER (PARTITION BY zone_id ORDER BY tick ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 'OK') AS decision, decision IS NULL AS used_fallback FROM x",
)
def accepted_decisions(spark, d):
    first = T.first_reports(reports(spark, d))
    return T.accepted_decisions(demand(spark, d, "replay"), first, T.tick_close(first, ZONES, CFG), CFG)


@query(
    "tick_metrics",
    "A48 W8 W9",
    f"WITH {PREP_SQL}, {REPORT_SQL}, {_metrics_sql('cl', 'a')} SELECT tick, round(mean_l, 9) AS mean_latency_s, round(max_l, 9) AS max_latency_s, round(max_l / nullif(mean_l, 0), 7) AS max_mean_ratio, completed, 4 - completed AS fallbacks, late, duplicates, tick_latency_s FROM tm_a",
)
def tick_metrics(spark, d):
    out = T.tick_metrics(reports(spark, d), demand(spark, d, "replay"), ZONES, CFG)
    return out.withColumns({"mean_latency_s": F.round("mean_latency_s", 9), "max_latency_s": F.round("max_latency_s", 9), "max_mean_ratio": F.round("max_mean_ratio", 7)})


def _policy(name: str, suffix: str) -> str:
    return (
        f"SELECT '{name}' AS policy, count(*) AS ticks, round(avg(tick_latency_s), 8) AS mean_tick_latency_s, round(max(tick_latency_s), 8) AS max_tick_latency_s, sum(completed)::BIGINT AS completed, sum(4 - completed)::BIGINT AS fallbacks, sum(late)::BIGINT AS late, sum(duplicates)::BIGINT AS duplicates FROM tm_{suffix}"
    )


@query(
    "compare_policies",
    "T8 A48",
    f"WITH {PREP_SQL}, {REPORT_SQL}, {_metrics_sql('cl', 'a')}, {_metrics_sql('bl', 'b')} {_policy('blocking', 'b')} UNION ALL {_policy('async', 'a')}",
)
def compare_policies(spark, d):
    out = T.compare_policies(reports(spark, d), demand(spark, d, "replay"), ZONES, CFG)
    return out.withColumns({c: F.round(c, 8) for c in ("mean_tick_latency_s", "max_tick_latency_s")})
