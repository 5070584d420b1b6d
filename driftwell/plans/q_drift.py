"""Drift between the two halves of the trip role."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwell.operators import drift as D
from driftwell.plans.catalog import query, table
from driftwell.plans.roles import SLICES_SQL, both_slices

NUMERIC = D.REPORT_COLUMNS
TEXT = ["store_and_fwd_flag", "vendor_text", "trip_code"]
TEXT_SQL = {
    "store_and_fwd_flag": "store_and_fwd_flag",
    "vendor_text": "CAST(VendorID AS VARCHAR)",
    "trip_code": "CASE WHEN slice = 'current' AND payment_type = 7 THEN 'new' ELSE concat('t', CAST(CAST(trip_type AS INT) AS VARCHAR)) END",
}


def _slices(spark, d):
    """Both slices with three text columns; one has a category only the current slice knows."""
    new = F.when((F.col("slice") == "current") & (F.col("payment_type") == 7), "new").otherwise(
        F.concat(F.lit("t"), F.coalesce(F.col("trip_type").cast("int").cast("string"), F.lit("")))
    )
    extra = {"vendor_text": F.col("VendorID").cast("string"), "trip_code": new}
    return tuple(s.withColumns(extra) for s in both_slices(spark, d))


def psi_sql(columns: list[str]) -> str:
    """Edges from the reference quantiles (ties pushed up in order), counts per bin, smoothed shares."""
    steps = []
    for c in columns:
        pick = ", ".join(f"quantile_cont({c}, {i / 10}) AS e{i}" for i in range(11))
        fixed, prev = ["e0 AS f0"], "e0"
        chain = f"SELECT {pick} FROM ref WHERE {c} IS NOT NULL"
        for i in range(1, 11):
            chain = f"SELECT *, CASE WHEN e{i} <= f{i-1} THEN f{i-1} + 1e-9 ELSE e{i} END AS f{i} FROM ({chain})" if i > 1 else f"SELECT *, CASE WHEN e1 <= e0 THEN e0 + 1e-9 ELSE e1 END AS f1 FROM ({chain})"
        steps.append(f"edges_{c} AS ({chain})")
        inside = " + ".join(f"({c} >= f{i})::INT" for i in range(1, 10))
        side = lambda t: f"SELECT '{t}' AS s, {inside} AS b FROM {t}, edges_{c} WHERE {c} IS NOT NULL"
        steps.append(
            f"bins_{c} AS (SELECT b.b AS bin, count(*) FILTER (WHERE x.s = 'ref') AS r, count(*) FILTER (WHERE x.s = 'cur') AS c "
            f"FROM (SELECT unnest(range(10)) AS b) b LEFT JOIN ({side('ref')} UNION ALL {side('cur')}) x ON x.b = b.b GROUP BY 1)"
        )
        steps.append(
            f"p0_{c} AS (SELECT least(greatest(r / greatest(sum(r) OVER (), 1), 1e-6), 1) AS p, least(greatest(c / greatest(sum(c) OVER (), 1), 1e-6), 1) AS q FROM bins_{c})"
        )
        steps.append(f"p1_{c} AS (SELECT p / sum(p) OVER () AS p, q / sum(q) OVER () AS q FROM p0_{c})")
    return ", ".join(steps)


def psi_rows(columns: list[str], digits: int = 6) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, (SELECT round(sum((p - q) * ln(p / q)), 8) FROM p1_{c}) AS psi, "
        f"(SELECT round(avg({c}), {digits}) FROM ref) AS ref_mean, (SELECT round(avg({c}), {digits}) FROM cur) AS cur_mean"
        for c in columns
    )


PSI_SQL = psi_sql(NUMERIC)

TEXT_CTE = ", " + ", ".join(
    f"{n} AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, {e} AS v FROM {s}" for c, e in TEXT_SQL.items()) + ")"
    for n, s in (("rt", "ref"), ("ct", "cur"))
)
JSD_SQL = (
    "g AS (SELECT feature, v, sum(r) AS r, sum(c) AS c FROM (SELECT feature, v, 1 AS r, 0 AS c FROM rt WHERE v IS NOT NULL UNION ALL SELECT feature, v, 0, 1 FROM ct WHERE v IS NOT NULL) GROUP BY 1, 2), "
    "s1 AS (SELECT feature, r, c, least(greatest(r / sum(r) OVER (PARTITION BY feature), 1e-8), 1) AS p, least(greatest(c / sum(c) OVER (PARTITION BY feature), 1e-8), 1) AS q FROM g), "
    "s2 AS (SELECT feature, r, c, p / sum(p) OVER (PARTITION BY feature) AS p, q / sum(q) OVER (PARTITION BY feature) AS q FROM s1), "
    "jsd AS (SELECT feature, sum(0.5 * p * ln(p / (0.5 * (p + q))) + 0.5 * q * ln(q / (0.5 * (p + q)))) AS jsd, count(*) FILTER (WHERE r > 0) AS ref_unique, count(*) FILTER (WHERE c > 0) AS cur_unique FROM s2 GROUP BY 1)"
)


@query("psi", "A18 A20", f"WITH {SLICES_SQL}, {PSI_SQL} {psi_rows(NUMERIC)}")
def psi(spark, d):
    ref, cur = both_slices(spark, d)
    out = D.psi_table(ref, cur, NUMERIC)
    return out.withColumns({"psi": F.round("psi", 8), "ref_mean": F.round("ref_mean", 6), "cur_mean": F.round("cur_mean", 6)})


@query("jensen_shannon", "A19 J5", f"WITH {SLICES_SQL}{TEXT_CTE}, {JSD_SQL} SELECT feature, round(jsd, 9) AS jsd, ref_unique, cur_unique FROM jsd")
def jensen_shannon(spark, d):
    ref, cur = _slices(spark, d)
    return D.jsd_table(ref, cur, TEXT).withColumn("jsd", F.round("jsd", 9))


@query(
    "drift_report",
    "A20",
    f"WITH {SLICES_SQL}{TEXT_CTE}, {PSI_SQL}, {JSD_SQL}, n AS ({psi_rows(NUMERIC)}) "
    "SELECT feature, 'numeric' AS type, psi, ref_mean, cur_mean, NULL::DOUBLE AS jsd, NULL::DOUBLE AS ref_unique, NULL::DOUBLE AS cur_unique FROM n "
    "UNION ALL SELECT feature, 'categorical', NULL, NULL, NULL, round(jsd, 9), ref_unique, cur_unique FROM jsd",
)
def drift_report(spark, d):
    ref, cur = _slices(spark, d)
    out = D.drift_report(ref, cur, NUMERIC, TEXT)
    digits = {"psi": 8, "ref_mean": 6, "cur_mean": 6, "jsd": 9}
    out = out.withColumns({c: F.round(c, n) for c, n in digits.items()})
    return out.withColumns({c: F.col(c).cast("double") for c in ("ref_unique", "cur_unique")})


@query(
    "drift_summary",
    "A20",
    f"WITH {SLICES_SQL}{TEXT_CTE}, {PSI_SQL}, {JSD_SQL}, n AS ({psi_rows(NUMERIC)}) "
    "SELECT round(avg(psi), 7) AS psi_mean, round(max(psi), 7) AS psi_max, count(*) FILTER (WHERE psi > 0.25) AS psi_gt_0_25, (SELECT round(avg(jsd), 7) FROM jsd) AS jsd_mean, (SELECT round(max(jsd), 7) FROM jsd) AS jsd_max FROM n",
)
def drift_summary(spark, d):
    ref, cur = _slices(spark, d)
    report = D.drift_report(ref, cur, NUMERIC, TEXT).withColumn("psi", F.round("psi", 8))
    out = D.drift_summary(report)
    return out.withColumns({c: F.round(c, 7) for c in ("psi_mean", "psi_max", "jsd_mean", "jsd_max")})


@query(
    "unseen_categories",
    "J4 A22",
    f"WITH {SLICES_SQL}{TEXT_CTE} SELECT feature AS \"column\", v AS value, count(*) AS rows FROM ct WHERE v IS NOT NULL AND NOT EXISTS (SELECT 1 FROM rt WHERE rt.feature = ct.feature AND rt.v = ct.v) GROUP BY 1, 2",
)
def unseen_categories(spark, d):
    ref, cur = _slices(spark, d)
    return D.unseen_categories(ref, cur, TEXT)


_FALL = ["trip_distance", "passenger_count", "congestion_surcharge", "tip_amount"]
_FALL_CUR = {c: c for c in _FALL} | {"passenger_count": "CASE WHEN payment_type = 3 THEN NULL ELSE passenger_count END"}


@query(
    "fallback_drift",
    "A22 J4",
    f"WITH {SLICES_SQL}{TEXT_CTE}, m AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS c, (SELECT 100.0::DOUBLE * (count(*) - count({c})) / count(*) FROM ref) AS a, (SELECT 100.0::DOUBLE * (count(*) - count({e})) / count(*) FROM cur) AS b"
        for c, e in _FALL_CUR.items()
    )
    + "), u AS (SELECT feature, count(*) AS n FROM ct WHERE v IS NOT NULL AND NOT EXISTS (SELECT 1 FROM rt WHERE rt.feature = ct.feature AND rt.v = ct.v) GROUP BY 1) "
    "SELECT c AS \"column\", 'missing' AS kind, printf('Column ''%s'': missing values increased from %.1f%% to %.1f%%', c, a, b) AS warning FROM m WHERE b - a > 5 "
    "UNION ALL SELECT feature, 'unseen', printf('Column ''%s'': %d rows with unseen categorical values', feature, n) FROM u",
)
def fallback_drift(spark, d):
    """The current slice loses the passenger count of one payment type on top."""
    ref, cur = _slices(spark, d)
    cur = cur.withColumn("passenger_count", F.when(F.col("payment_type") != 3, F.col("passenger_count")))
    return D.fallback_drift(ref.select(*_FALL, *TEXT), cur.select(*_FALL, *TEXT))


_KS = ["trip_distance", "fare_amount", "tip_amount", "total_amount", "passenger_count", "PULocationID"]


def _long_sql(source: str, extra: str = "", columns=_KS, present: bool = True) -> str:
    kept = " WHERE {0} IS NOT NULL" if present else ""
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, {extra}{c}::DOUBLE AS v FROM {source}{kept.format(c)}" for c in columns)


@query(
    "ks_whole_slices",
    "A21 H13",
    f"WITH {SLICES_SQL}, k AS (SELECT feature, v, sum(r) AS r, sum(c) AS c FROM (SELECT feature, v, 1 AS r, 0 AS c FROM ({_long_sql('ref')}) UNION ALL SELECT feature, v, 0, 1 FROM ({_long_sql('cur')})) GROUP BY 1, 2), "
    "w AS (SELECT feature, sum(r) OVER o AS rc, sum(c) OVER o AS cc, sum(r) OVER f AS n, sum(c) OVER f AS m FROM k WINDOW o AS (PARTITION BY feature ORDER BY v), f AS (PARTITION BY feature)) "
    "SELECT feature, max(n)::BIGINT AS n_ref, max(m)::BIGINT AS n_cur, round(max(abs(rc / n - cc / m)), 9) AS ks, max(abs(rc / n - cc / m)) > 1.358::DOUBLE * sqrt((max(n) + max(m)) / (max(n) * max(m))::DOUBLE) AS alert FROM w GROUP BY feature",
)
def ks_whole_slices(spark, d):
    ref, cur = both_slices(spark, d)
    return D.with_ks_alert(D.ks_two_sample(ref, cur, _KS)).withColumn("ks", F.round("ks", 9))


_CHUNKED = (
    "ch AS (SELECT *, ((row_number() OVER (ORDER BY lpep_dropoff_datetime, md5('|' || trip_id), trip_id) - 1) // 1000)::BIGINT AS chunk FROM cur)"
)


@query(
    "ks_by_chunk",
    "A21 W6",
    f"WITH {SLICES_SQL}, {_CHUNKED}, rv AS (SELECT feature, v, count(*) AS r FROM ({_long_sql('ref')}) GROUP BY 1, 2), "
    f"cv AS (SELECT feature, chunk, v, count(*) AS c FROM ({_long_sql('ch', 'chunk, ')}) GROUP BY 1, 2, 3), "
    "pts AS (SELECT feature, v, sum(r) AS r FROM (SELECT * FROM rv UNION ALL SELECT DISTINCT feature, v, 0 FROM cv) GROUP BY 1, 2), "
    "lv AS (SELECT feature, v, sum(r) OVER (PARTITION BY feature ORDER BY v) AS cum, r, sum(r) OVER (PARTITION BY feature) AS n FROM pts), "
    "st AS (SELECT feature, chunk, c, cum, r, n, sum(c) OVER (PARTITION BY feature, chunk ORDER BY v) AS upto, sum(c) OVER (PARTITION BY feature, chunk) AS m FROM cv JOIN lv USING (feature, v)) "
    "SELECT feature, chunk, max(n)::BIGINT AS n_ref, max(m)::BIGINT AS n_cur, round(max(greatest(abs(upto / m - cum / n), abs((upto - c) / m - (cum - r) / n))), 9) AS ks FROM st GROUP BY feature, chunk",
)
def ks_by_chunk(spark, d):
    ref, cur = both_slices(spark, d)
    chunked = D.with_chunk(cur.select("trip_id", "lpep_dropoff_datetime", *_KS), "lpep_dropoff_datetime", ["trip_id"], 1000, keep=_KS)
    return D.ks_by_chunk(ref, chunked, _KS).withColumn("ks", F.round("ks", 9))


@query(
    "chi2_by_chunk",
    "A21 J5",
    f"WITH {SLICES_SQL}, {_CHUNKED}, rv AS (SELECT store_and_fwd_flag AS v, count(*) AS r FROM ref WHERE store_and_fwd_flag IS NOT NULL GROUP BY 1), "
    "cv AS (SELECT chunk, store_and_fwd_flag AS v, count(*) AS c FROM ch WHERE store_and_fwd_flag IS NOT NULL GROUP BY 1, 2), "
    "ks AS (SELECT DISTINCT chunk FROM cv), vs AS (SELECT v FROM rv UNION SELECT v FROM cv), "
    "grid AS (SELECT chunk, v, coalesce(r, 0)::DOUBLE AS r, coalesce(c, 0)::DOUBLE AS c FROM ks CROSS JOIN vs LEFT JOIN rv USING (v) LEFT JOIN cv USING (chunk, v)), "
    "tot AS (SELECT *, sum(r) OVER (PARTITION BY chunk) AS rt, sum(c) OVER (PARTITION BY chunk) AS ct FROM grid WHERE r + c > 0), "
    "e AS (SELECT chunk, r, c, (r + c) * rt / (rt + ct) AS er, (r + c) * ct / (rt + ct) AS ec FROM tot) "
    "SELECT 'store_and_fwd_flag' AS feature, chunk, round(sum((r - er) ^ 2 / er + (c - ec) ^ 2 / ec), 6) AS chi2, (count(*) - 1)::INT AS df, sum((r - er) ^ 2 / er + (c - ec) ^ 2 / ec) > 5.991465 AS alert FROM e GROUP BY chunk",
)
def chi2_by_chunk(spark, d):
    ref, cur = both_slices(spark, d)
    chunked = D.with_chunk(
        cur.select("trip_id", "lpep_dropoff_datetime", "store_and_fwd_flag"), "lpep_dropoff_datetime", ["trip_id"], 1000
    )
    return D.chi2_by_chunk(ref, chunked, ["store_and_fwd_flag"]).withColumn("chi2", F.round("chi2", 6))


def _usable_sql(source: str) -> str:
    cells = _long_sql(source, columns=D.MONITORED_COLUMNS, present=False)
    return f"SELECT feature FROM ({cells}) GROUP BY feature HAVING count(v) / count(*) >= 0.05 AND min(v) < max(v)"


@query(
    "drifted_columns",
    "A21",
    f"WITH {SLICES_SQL}, ch AS (SELECT *, ((row_number() OVER (ORDER BY lpep_dropoff_datetime, md5('|' || trip_id), trip_id) - 1) // greatest(100, least(count(*) OVER (), 1000)))::BIGINT AS chunk FROM cur), "
    f"us AS ({_usable_sql('ref')} INTERSECT {_usable_sql('cur')}), "
    f"rv AS (SELECT feature, v, count(*) AS r FROM ({_long_sql('ref', columns=D.MONITORED_COLUMNS)}) GROUP BY 1, 2), "
    f"cv AS (SELECT feature, chunk, v, count(*) AS c FROM ({_long_sql('ch', 'chunk, ', D.MONITORED_COLUMNS)}) GROUP BY 1, 2, 3), "
    "pts AS (SELECT feature, v, sum(r) AS r FROM (SELECT * FROM rv UNION ALL SELECT DISTINCT feature, v, 0 FROM cv) WHERE feature IN (SELECT feature FROM us) GROUP BY 1, 2), "
    "lv AS (SELECT feature, v, sum(r) OVER (PARTITION BY feature ORDER BY v) AS cum, r, sum(r) OVER (PARTITION BY feature) AS n FROM pts), "
    "st AS (SELECT feature, chunk, c, cum, r, n, sum(c) OVER (PARTITION BY feature, chunk ORDER BY v) AS upto, sum(c) OVER (PARTITION BY feature, chunk) AS m FROM cv JOIN lv USING (feature, v)), "
    "ks AS (SELECT feature, chunk, max(greatest(abs(upto / m - cum / n), abs((upto - c) / m - (cum - r) / n))) > 1.358::DOUBLE * sqrt((max(n) + max(m)) / (max(n) * max(m))::DOUBLE) AS alert FROM st GROUP BY feature, chunk), "
    "al AS (SELECT feature, count(*) AS chunks, count(*) FILTER (WHERE alert) AS alerts FROM ks GROUP BY feature) "
    "SELECT feature, chunks, alerts, alerts > 0 AS drifted, CASE WHEN alerts > 0 THEN printf('Column ''%s'': univariate drift detected', feature) END AS warning FROM al",
)
def drifted_columns(spark, d):
    """Whole monitor: usable columns, chunk alerts, and one row per feature."""
    ref, cur = both_slices(spark, d)
    return D.drifted_columns(D.chunk_drift(ref, cur, "lpep_dropoff_datetime", ["trip_id"]))


@query(
    "event_value_drift",
    "A18 A20",
    "WITH ref AS (SELECT value FROM events WHERE ts < TIMESTAMP '2024-01-16'), cur AS (SELECT value FROM events WHERE ts >= TIMESTAMP '2024-01-16'), "
    + psi_sql(["value"])
    + " "
    + psi_rows(["value"], 9),
)
def event_value_drift(spark, d):
    df = table(spark, d, "events")
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    out = D.psi_table(df.where(F.col("ts") < cut), df.where(F.col("ts") >= cut), ["value"])
    return out.withColumns({"psi": F.round("psi", 8), "ref_mean": F.round("ref_mean", 9), "cur_mean": F.round("cur_mean", 9)})
