"""Profiling, gates, zones and exploratory statistics over the trip role."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwell.operators import counting as K
from driftwell.operators import features as X
from driftwell.operators import profile as P
from driftwell.plans.catalog import query
from driftwell.plans.roles import SLICES_SQL, TRIP_COLUMNS, TRIPS_SQL, ZONES_SQL, both_slices, trips, zones
from driftwell.sources import slices as S

PICKUP, DROPOFF = "lpep_pickup_datetime", "lpep_dropoff_datetime"
MINUTES_SQL = f"(epoch_us({DROPOFF}) - epoch_us({PICKUP})) / 6e7"
FEATURES_SQL = (
    f"coalesce(hour({PICKUP}), -1)::BIGINT AS pickup_hour, coalesce(isodow({PICKUP}) - 1, -1)::BIGINT AS pickup_day_of_week, "
    f"coalesce(month({PICKUP}), -1)::BIGINT AS pickup_month, coalesce(dayofyear({PICKUP}), -1)::BIGINT AS pickup_day_of_year, "
    "least(greatest(coalesce(PULocationID, 0)::DOUBLE / 263, 0), 1)::DOUBLE AS pu_location_norm, "
    "least(greatest(coalesce(DOLocationID, 0)::DOUBLE / 263, 0), 1)::DOUBLE AS do_location_norm, "
    "round(ln(1 + greatest(coalesce(trip_distance, 0), 0.1::DOUBLE)), 6) AS log_trip_distance, "
    "round(ln(1 + greatest(coalesce(fare_amount, 0), 0.1::DOUBLE)), 6) AS log_fare_amount, "
    "round(ln(1 + greatest(coalesce(total_amount, 0), 0.1::DOUBLE)), 6) AS log_total_amount, "
    "least(greatest(trunc(coalesce(passenger_count, 1))::BIGINT, 1), 6)::BIGINT AS passenger_count_binned, "
    "coalesce(trip_type, 0)::BIGINT AS trip_type, "
    + "".join(f"(coalesce(payment_type, 0)::BIGINT = {k})::BIGINT AS payment_type_{k}, " for k in (1, 2, 3, 4))
    + "(coalesce(congestion_surcharge, 0) > 0)::BIGINT AS has_congestion_surcharge, (coalesce(tolls_amount, 0) > 0)::BIGINT AS has_tolls, "
    f"least(greatest(coalesce({MINUTES_SQL}, 0), 0), 300)::DOUBLE AS trip_duration_minutes"
)
DTYPES = {
    **{c: "double" for c in TRIP_COLUMNS},
    **{c: "bigint" for c in ("VendorID", "PULocationID", "DOLocationID")},
    PICKUP: "timestamp_ntz",
    DROPOFF: "timestamp_ntz",
    "store_and_fwd_flag": "string",
}


def _union(part, columns):
    return " UNION ALL ".join(part(c) for c in columns)


def _trip_frame(spark, d):
    return trips(spark, d).select(*TRIP_COLUMNS)


@query(
    "missingness",
    "A9 W3",
    f"WITH {TRIPS_SQL} "
    + _union(
        lambda c: f"SELECT '{c}' AS \"column\", '{DTYPES[c]}' AS dtype, round((count(*) - count({c})) / count(*), 9) AS missing_frac, "
        f"count(*) - count({c}) AS missing_count, count(DISTINCT {c}) + max(({c} IS NULL)::INT)::BIGINT AS n_unique FROM trips",
        TRIP_COLUMNS,
    ),
)
def missingness(spark, d):
    return P.missingness(_trip_frame(spark, d)).withColumn("missing_frac", F.round("missing_frac", 9))


@query(
    "missing_summary",
    "A9",
    f"WITH {TRIPS_SQL}, m AS ("
    + _union(lambda c: f"SELECT (count(*) - count({c})) / count(*) AS f FROM trips", TRIP_COLUMNS)
    + ") SELECT round(avg(f), 9) AS missing_frac_mean, round(max(f), 9) AS missing_frac_max FROM m",
)
def missing_summary(spark, d):
    out = P.missing_summary(P.missingness(_trip_frame(spark, d), unique=False))
    return out.select(*[F.round(c, 9).alias(c) for c in out.columns])


@query(
    "top_missing",
    "W3 A9",
    f"WITH {TRIPS_SQL}, m AS ("
    + _union(lambda c: f"SELECT '{c}' AS \"column\", (count(*) - count({c})) / count(*) AS missing_frac FROM trips", TRIP_COLUMNS)
    + ') SELECT "column", round(missing_frac, 9) AS missing_frac, round(missing_frac * 100, 3) AS missing_pct FROM m ORDER BY m.missing_frac DESC, "column" LIMIT 15',
)
def top_missing(spark, d):
    return P.top_missing(_trip_frame(spark, d)).withColumn("missing_frac", F.round("missing_frac", 9))


_DUP_COLUMNS = "VendorID, PULocationID, passenger_count, trip_distance, payment_type, store_and_fwd_flag"


@query(
    "duplicate_rows",
    "A10 A32",
    f"WITH {TRIPS_SQL}, u AS (SELECT {_DUP_COLUMNS} FROM trips), g AS (SELECT count(*) AS n FROM u GROUP BY {_DUP_COLUMNS}) "
    "SELECT sum(n)::BIGINT AS rows, (sum(n) - count(*))::BIGINT AS duplicate_rows, round((sum(n) - count(*)) / greatest(sum(n), 1), 9) AS duplicate_rows_frac FROM g",
)
def duplicate_rows(spark, d):
    df = trips(spark, d).select(*_DUP_COLUMNS.split(", "))
    return P.duplicate_rows(df).withColumn("duplicate_rows_frac", F.round("duplicate_rows_frac", 9))


@query(
    "planted_duplicates",
    "A10 A32",
    f"WITH {TRIPS_SQL}, u AS (SELECT {', '.join(TRIP_COLUMNS)}, trip_id FROM trips), r AS (SELECT * FROM u UNION ALL SELECT * FROM u WHERE payment_type = 7), "
    f"g AS (SELECT count(*) AS n FROM r GROUP BY {', '.join(TRIP_COLUMNS)}, trip_id) SELECT sum(n - 1)::BIGINT AS duplicate_rows, "
    f"(SELECT {' + '.join(f'count(*) - count({c})' for c in TRIP_COLUMNS)} FROM r)::BIGINT AS missing_cells, "
    f"'{', '.join(['trip_id'] + [c for c in TRIP_COLUMNS if DTYPES[c] in ('string', 'timestamp_ntz')])}' AS non_numeric_columns FROM g",
)
def planted_duplicates(spark, d):
    """Every trip with payment code 7 appears twice, nulls included; whole-row duplicates."""
    df = trips(spark, d).select("trip_id", *TRIP_COLUMNS)
    copies = F.when(F.col("payment_type") == 7, 2).otherwise(1)
    twice = df.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).drop("copy")
    return P.table_sanity(twice).select("duplicate_rows", "missing_cells", "non_numeric_columns")


@query(
    "dataset_profile",
    "A16 J8",
    f"WITH {SLICES_SQL} "
    + _union(
        lambda s: f"SELECT '{s}' AS dataset, 'lineitem' AS source_file, count(*) AS rows, {len(TRIP_COLUMNS)}::INT AS columns, "
        f"({' + '.join(f'count(*) - count({c})' for c in TRIP_COLUMNS)})::BIGINT AS missing_cells, "
        f"round(100.0::DOUBLE * ({' + '.join(f'count(*) - count({c})' for c in TRIP_COLUMNS)}) / (count(*) * {len(TRIP_COLUMNS)}), 9) AS missing_pct, "
        f"min({PICKUP}) AS pickup_min, max({PICKUP}) AS pickup_max FROM {'ref' if s == 'reference' else 'cur'}",
        ["reference", "batch"],
    ),
)
def dataset_profile(spark, d):
    ref, cur = (s.select(*TRIP_COLUMNS) for s in both_slices(spark, d))
    both = P.dataset_profile(ref, "reference", "lineitem").unionByName(P.dataset_profile(cur, "batch", "lineitem"))
    return both.withColumn("missing_pct", F.round("missing_pct", 9))


@query(
    "schema_compare",
    "J6 J7 A15",
    f"WITH {SLICES_SQL}, x AS ("
    + _union(
        lambda c: f"SELECT '{c}' AS \"column\", {'NULL' if c == 'extra' else repr(DTYPES[c])} AS ref_dtype, "
        f"{'NULL' if c == 'tolls_amount' else repr('double' if c == 'VendorID' else DTYPES[c])} AS batch_dtype, "
        f"{'NULL' if c == 'extra' else f'(SELECT count({c}) FROM ref)'}::DOUBLE AS ref_non_null, {'NULL' if c == 'tolls_amount' else f'(SELECT count({c}) FROM cur)'}::DOUBLE AS batch_non_null",
        TRIP_COLUMNS,
    )
    + ') SELECT "column", ref_dtype IS NOT NULL AS in_reference, batch_dtype IS NOT NULL AS in_batch, ref_dtype, batch_dtype, coalesce(ref_dtype = batch_dtype, false) AS dtype_match, ref_non_null, batch_non_null FROM x',
)
def schema_compare(spark, d):
    """The batch has lost one column, gained one, and changed a type."""
    ref, cur = (s.select(*TRIP_COLUMNS) for s in both_slices(spark, d))
    cur = cur.drop("tolls_amount").withColumn("VendorID", F.col("VendorID").cast("double"))
    out = P.schema_compare(ref.drop("extra"), cur)
    return out.withColumns({c: F.col(c).cast("double") for c in ("ref_non_null", "batch_non_null")})


def _range_sql(c, lo, hi):
    x = MINUTES_SQL if c == "duration_min" else c
    return (
        f"SELECT '{c}' AS \"column\", {lo}::DOUBLE AS lo, {hi}::DOUBLE AS hi, round(count(*) FILTER (WHERE {x} < {lo} OR {x} > {hi}) / count({x}), 9) AS bad_frac, "
        f"min({x}) + 0.0::DOUBLE AS \"min\", max({x}) + 0.0::DOUBLE AS \"max\" FROM trips"
    )


@query("range_checks", "A11 P11", f"WITH {TRIPS_SQL} " + " UNION ALL ".join(_range_sql(*r) for r in P.RANGES))
def range_checks(spark, d):
    df = trips(spark, d).withColumn("duration_min", P.minutes_between(PICKUP, DROPOFF))
    return P.range_checks(df).withColumn("bad_frac", F.round("bad_frac", 9))


@query(
    "range_summary",
    "A11",
    f"WITH {TRIPS_SQL}, r AS (" + " UNION ALL ".join(_range_sql(*r) for r in P.GATE_RANGES) + ") SELECT round(max(bad_frac), 9) AS range_worst_bad_frac, count(*) FILTER (WHERE bad_frac > 0) AS range_any_bad_cols FROM r",
)
def range_summary(spark, d):
    out = P.range_summary(P.range_checks(trips(spark, d), tuple(P.GATE_RANGES), all_invalid="skip"))
    return out.withColumn("range_worst_bad_frac", F.round("range_worst_bad_frac", 9))


def _domain_sql(c, allowed):
    inside = f"{c} IN ({', '.join(repr(v) for v in allowed)})"
    return (
        f"SELECT '{c}' AS \"column\", round(count(*) FILTER (WHERE NOT {inside}) / count(*), 9) AS bad_frac, "
        f"count(*) FILTER (WHERE NOT {inside}) AS bad_count, count(DISTINCT {c}) AS n_unique FROM trips"
    )


@query("domain_checks", "A12 J3", f"WITH {TRIPS_SQL} " + " UNION ALL ".join(_domain_sql(*r) for r in P.DOMAINS))
def domain_checks(spark, d):
    return P.domain_checks(trips(spark, d)).withColumn("bad_frac", F.round("bad_frac", 9))


@query(
    "datetime_checks",
    "A13",
    f"WITH {TRIPS_SQL}, m AS (SELECT {MINUTES_SQL} AS m FROM trips) "
    + " UNION ALL ".join(
        f"SELECT 'duration_min' AS \"column\", '{n}' AS \"check\", round(count(*) FILTER (WHERE {t}) / count(*), 9) AS bad_frac FROM m"
        for n, t in (("duration_negative", "m < 0"), ("duration_over_6h", "m > 360"), ("duration_nan", "m IS NULL"))
    ),
)
def datetime_checks(spark, d):
    return P.datetime_checks(trips(spark, d)).withColumn("bad_frac", F.round("bad_frac", 9))


_NEG = ["trip_distance", "fare_amount", "tip_amount", "tolls_amount", "total_amount"]


@query(
    "negative_values",
    "A14",
    f"WITH {TRIPS_SQL} "
    + _union(lambda c: f"SELECT '{c}' AS feature, round(count(*) FILTER (WHERE {c} < 0) / count(*), 9) AS neg_frac, count(*) FILTER (WHERE {c} < 0) AS neg_count FROM trips", _NEG),
)
def negative_values(spark, d):
    return P.negative_values(trips(spark, d), _NEG).withColumn("neg_frac", F.round("neg_frac", 9))


@query(
    "nonpositive_share",
    "A23 P3",
    f"WITH {TRIPS_SQL} "
    + _union(
        lambda c: f"SELECT slice AS split, '{c}' AS feature, round(count(*) FILTER (WHERE {c} <= 0) / count({c}), 9) AS nonpos_frac FROM trips WHERE payment_type = 1 GROUP BY slice",
        ["tip_amount", "fare_amount", "trip_distance"],
    ),
)
def nonpositive_share(spark, d):
    cards = trips(spark, d).where("payment_type = 1").withColumnRenamed("slice", "split")
    return P.nonpositive_share(cards, ["tip_amount", "fare_amount", "trip_distance"], "split").withColumn(
        "nonpos_frac", F.round("nonpos_frac", 9)
    )


@query(
    "unknown_zones",
    "J2",
    f"WITH {TRIPS_SQL}, {ZONES_SQL} "
    + _union(
        lambda c: f"SELECT '{c}' AS \"column\", count({c}) AS n, round(count(*) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT LocationID FROM zones)) / count({c}), 9) AS unknown_frac FROM trips",
        ["PULocationID", "DOLocationID"],
    ),
)
def unknown_zones(spark, d):
    dim = S.zone_dimension(zones(spark, d))
    return P.unknown_keys(trips(spark, d), ["PULocationID", "DOLocationID"], dim).withColumn(
        "unknown_frac", F.round("unknown_frac", 9)
    )


@query(
    "zone_counts",
    "J1 A30",
    f"WITH {TRIPS_SQL}, {ZONES_SQL}, pu AS (SELECT PULocationID AS id, count(*) AS n FROM trips GROUP BY 1), dof AS (SELECT DOLocationID AS id, count(*) AS n FROM trips GROUP BY 1) "
    "SELECT LocationID, Zone, Borough, coalesce(pu.n, 0) AS pu_count, coalesce(dof.n, 0) AS do_count FROM zones LEFT JOIN pu ON pu.id = LocationID LEFT JOIN dof ON dof.id = LocationID",
)
def zone_counts(spark, d):
    return K.zone_counts(S.zone_dimension(zones(spark, d)), trips(spark, d))


# ---- hard rules -------------------------------------------------------------


def hard_rules_sql(rules: P.GateRules, by: str | None = None) -> str:
    """The gate as SQL: counts per slice, then the list of messages in rule order."""
    counts, messages = ["count(*) AS n"], []
    for c in sorted(set(rules.required) | set(rules.missing_pct)):
        limit = rules.missing_pct.get(c, rules.max_missing_pct)
        counts.append(f"count(*) - count({c}) AS na_{c}")
        messages.append(
            f"CASE WHEN 100.0::DOUBLE * na_{c} / n > {limit} THEN printf('Column ''{c}'' has %.1f%% missing values (threshold: {limit}%%)', 100.0::DOUBLE * na_{c} / n) END"
        )
    for c, lo, hi in rules.ranges:
        for bound, word, op, tag in ((lo, "below minimum", "<", "lt"), (hi, "above maximum", ">", "gt")):
            counts.append(f"count(*) FILTER (WHERE {c} {op} {bound}) AS {tag}_{c}")
            messages.append(
                f"CASE WHEN {tag}_{c} / n > {rules.max_invalid} THEN printf('Column ''{c}'' has %d values {word} {bound} (%.2f%% > {rules.max_invalid * 100:.2f}%%)', {tag}_{c}, {tag}_{c} / n * 100) END"
            )
    counts.append(f"count(*) FILTER (WHERE {PICKUP} >= {DROPOFF}) AS bad_order")
    messages.append(
        f"CASE WHEN bad_order / n > {rules.max_order} THEN printf('Found %d rows where pickup_datetime >= dropoff_datetime (%.2f%% > {rules.max_order * 100:.2f}%%)', bad_order, bad_order / n * 100) END"
    )
    counts.append("count(*) FILTER (WHERE tip_amount > total_amount) AS bad_tip")
    messages.append(
        f"CASE WHEN bad_tip / n > {rules.max_tip_over_total} THEN printf('Found %d rows where tip_amount > total_amount (%.2f%% > {rules.max_tip_over_total * 100:.2f}%%)', bad_tip, bad_tip / n * 100) END"
    )
    for c in rules.critical:
        messages.append(f"CASE WHEN na_{c} > 0 THEN printf('Critical column ''{c}'' has %d missing values', na_{c}) END")
    group = f"{by} AS grp, " if by else ""
    tail = " GROUP BY grp" if by else ""
    return (
        f"counted AS (SELECT {group}{', '.join(counts)} FROM trips{tail}), "
        f"gate AS (SELECT {'grp, ' if by else ''}n, list_filter([{', '.join(messages)}], lambda m: m IS NOT NULL) AS failures FROM counted)"
    )


@query(
    "hard_rules",
    "A17",
    f"WITH {TRIPS_SQL}, {hard_rules_sql(P.GateRules(), 'slice')} SELECT grp AS slice, n AS rows, list_aggregate(failures, 'string_agg', ' / ') AS hard_failures, len(failures) = 0 AS hard_rules_passed FROM gate",
)
def hard_rules(spark, d):
    out = P.hard_rules(trips(spark, d), by=["slice"])
    return out.withColumn("hard_failures", F.array_join("hard_failures", " / "))


# ---- features ---------------------------------------------------------------


@query(
    "features",
    "P11 P12 P13 P14 P15 P16 P17 P18 P19",
    f"WITH {TRIPS_SQL} SELECT trip_id, {FEATURES_SQL} FROM trips",
)
def features(spark, d):
    out = X.engineer_features(trips(spark, d), keep=["trip_id"])
    return out.withColumns({c: F.round(c, 6) for c in out.columns if c.startswith("log_")})


_FEATURE_KINDS = {
    **{
        c: "bigint"
        for c in ("pickup_hour", "pickup_day_of_week", "pickup_month", "pickup_day_of_year", "passenger_count_binned", "trip_type", "has_congestion_surcharge", "has_tolls")
    },
    **{f"payment_type_{k}": "bigint" for k in (1, 2, 3, 4)},
    **{c: "double" for c in ("pu_location_norm", "do_location_norm", "log_trip_distance", "log_fare_amount", "log_total_amount", "trip_duration_minutes")},
}


@query(
    "feature_schema",
    "M17",
    f"WITH {SLICES_SQL}, rf AS (SELECT {FEATURES_SQL} FROM ref), cf AS (SELECT {FEATURES_SQL} FROM cur) "
    + _union(
        lambda c: f"SELECT '{c}' AS feature, '{_FEATURE_KINDS[c]}' AS dtype, (SELECT 1 - count({c}) / count(*) FROM rf)::DOUBLE AS ref_missing_frac, (SELECT 1 - count({c}) / count(*) FROM cf)::DOUBLE AS batch_missing_frac",
        sorted(_FEATURE_KINDS),
    ),
)
def feature_schema(spark, d):
    ref, cur = both_slices(spark, d)
    return X.feature_schema(X.engineer_features(ref), X.engineer_features(cur))


_CLIP = ["tip_amount", "fare_amount", "trip_distance"]


@query(
    "clipped_tail",
    "P24",
    f"WITH {TRIPS_SQL}, x AS ({_union(lambda c: f'SELECT {chr(39)}{c}{chr(39)} AS feature, {c} AS v FROM trips WHERE {c} > 0', _CLIP)}), "
    "q AS (SELECT feature, quantile_cont(v, 0.995) AS hi FROM x GROUP BY 1) "
    "SELECT feature, count(*) AS n, round(max(least(v, hi)), 6) AS top, count(*) FILTER (WHERE v > hi) AS cut, round(sum(least(v, hi)), 2) AS total FROM x JOIN q USING (feature) GROUP BY feature",
)
def clipped_tail(spark, d):
    df = trips(spark, d)
    clipped = X.clip_upper_tail(df, _CLIP)
    top = F.max("value")
    out = clipped.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), F.round(top, 6).alias("top"), F.round(F.sum("value"), 2).alias("total"), top.alias("t")
    )
    raw = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("raw")) for c in _CLIP])))
    cut = raw.join(F.broadcast(out.select("feature", "t")), "feature").groupBy("feature").agg(F.count_if(F.col("raw") > F.col("t")).alias("cut"))
    return out.drop("t").join(cut, "feature")


_Z = ["trip_distance", "fare_amount", "total_amount"]


@query(
    "zscores",
    "P25",
    f"WITH {TRIPS_SQL} "
    + _union(
        lambda c: f"SELECT trip_id, '{c}' AS feature, round(({c} - (SELECT avg({c}) FROM trips)) / (SELECT stddev_pop({c}) FROM trips), 6) AS z FROM trips",
        _Z,
    ),
)
def zscores(spark, d):
    return X.zscore_long(trips(spark, d), _Z, ["trip_id"]).withColumn("z", F.round("z", 6))


# ---- exploration ------------------------------------------------------------

_DESC = ["trip_distance", "fare_amount", "tip_amount", "total_amount", "passenger_count", "tolls_amount"]


@query(
    "describe_columns",
    "A24",
    f"WITH {TRIPS_SQL} "
    + _union(
        lambda c: f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c}) + 0.0::DOUBLE AS \"min\", max({c}) + 0.0::DOUBLE AS \"max\", "
        f"round(max({c}) / nullif(min({c}), 0), 6) AS max_min_ratio FROM trips",
        _DESC,
    ),
)
def describe_columns(spark, d):
    out = P.describe_columns(trips(spark, d), _DESC)
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "std", "max_min_ratio")})


@query(
    "tip_percentiles",
    "A24",
    f"WITH {TRIPS_SQL} "
    + "SELECT prob, round(value, 6) AS value FROM ("
    + " UNION ALL ".join(f"SELECT {q}::DOUBLE AS prob, quantile_cont(tip_amount, {q}) AS value FROM trips" for q in (0.5, 0.9, 0.95, 0.99))
    + ")",
)
def tip_percentiles(spark, d):
    from driftwell.operators.prefix import exact_quantiles

    return exact_quantiles(trips(spark, d), "tip_amount", [0.5, 0.9, 0.95, 0.99]).withColumn("value", F.round("value", 6))


@query(
    "tips_by_payment",
    "A25 U4",
    f"WITH {TRIPS_SQL} SELECT payment_type, count(*) AS n, round(avg(tip_amount), 6) AS mean_tip, round(median(tip_amount), 6) AS median_tip, "
    "round(count(*) FILTER (WHERE coalesce(tip_amount, 0) = 0) / count(*), 9) AS pct_zero_tip, round(count(*) FILTER (WHERE tip_amount > 0) / count(*), 9) AS pct_positive_tip, "
    "round(count(*) FILTER (WHERE tip_amount IS NULL) / count(*), 9) AS pct_missing_tip FROM trips WHERE payment_type IS NOT NULL GROUP BY 1",
)
def tips_by_payment(spark, d):
    out = K.tips_by_payment(trips(spark, d))
    digits = {"mean_tip": 6, "median_tip": 6, "pct_zero_tip": 9, "pct_positive_tip": 9, "pct_missing_tip": 9}
    return out.withColumns({c: F.round(c, n) for c, n in digits.items()})


_CORR = ["trip_distance", "fare_amount", "total_amount", "passenger_count", "tolls_amount", "PULocationID"]


@query(
    "corr_with_tip",
    "A26 P3",
    f"WITH {TRIPS_SQL} "
    + _union(
        lambda c: f"SELECT '{c}' AS feature, round(corr({c}, tip_amount), 6) AS corr, round(abs(corr({c}, tip_amount)), 6) AS abs_corr FROM trips WHERE payment_type = 1",
        _CORR,
    ),
)
def corr_with_tip(spark, d):
    cards = trips(spark, d).where("payment_type = 1")
    return X.corr_with_target(cards, "tip_amount", _CORR).withColumns({c: F.round(c, 6) for c in ("corr", "abs_corr")})


@query(
    "corr_matrix",
    "A26",
    f"WITH {TRIPS_SQL} " + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM trips" for a in _CORR for b in _CORR),
)
def corr_matrix(spark, d):
    return X.corr_matrix(trips(spark, d), _CORR).withColumn("corr", F.round("corr", 6))


@query(
    "month_totals",
    "A27",
    f"WITH {TRIPS_SQL} SELECT strftime({DROPOFF}, '%m') AS month, count({PICKUP}) AS trips, round(sum(total_amount), 2) AS total_pay, round(avg(fare_amount), 6) AS mean_fare FROM trips GROUP BY 1",
)
def month_totals(spark, d):
    df = trips(spark, d).withColumn("month", F.date_format(DROPOFF, "MM"))
    out = K.month_totals(df, "month", PICKUP, "total_amount", "fare_amount")
    return out.withColumns({"total_pay": F.round("total_pay", 2), "mean_fare": F.round("mean_fare", 6)})


_YEAR_SQL = f"yr AS (SELECT year({PICKUP}) AS y FROM trips WHERE {PICKUP} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"


@query(
    "busy_months",
    "A28",
    f"WITH {TRIPS_SQL}, {_YEAR_SQL} SELECT year({PICKUP})::INT AS year, month({PICKUP})::INT AS month, count(*) AS n FROM trips WHERE year({PICKUP}) = (SELECT y FROM yr) GROUP BY 1, 2 HAVING count(*) >= 700",
)
def busy_months(spark, d):
    return K.busy_months(trips(spark, d), PICKUP, 700)


@query(
    "daily_overlay",
    "A29 A28",
    f"WITH {TRIPS_SQL}, {_YEAR_SQL}, keep AS (SELECT month({PICKUP}) AS m FROM trips WHERE year({PICKUP}) = (SELECT y FROM yr) GROUP BY 1 HAVING count(*) >= 700) "
    f"SELECT strftime({PICKUP}, '%m') AS month, day({PICKUP})::INT AS day, count({PICKUP}) AS trips, round(avg(fare_amount), 6) AS mean_fare, round(avg(passenger_count), 6) AS mean_pax, "
    f"round(count(*) FILTER (WHERE payment_type = 1) / count(*), 9) AS frac_cc, round(count(*) FILTER (WHERE payment_type = 2) / count(*), 9) AS frac_cash "
    f"FROM trips WHERE year({PICKUP}) = (SELECT y FROM yr) AND month({PICKUP}) IN (SELECT m FROM keep) GROUP BY 1, 2",
)
def daily_overlay(spark, d):
    df = K.in_busy_months(trips(spark, d), PICKUP, 700)
    out = K.daily_overlay(df, PICKUP, "fare_amount", "passenger_count", "payment_type")
    return out.withColumns({"mean_fare": F.round("mean_fare", 6), "mean_pax": F.round("mean_pax", 6), "frac_cc": F.round("frac_cc", 9), "frac_cash": F.round("frac_cash", 9)})


@query(
    "pickup_counts",
    "A30",
    f"WITH {TRIPS_SQL} SELECT PULocationID, count(*) AS n FROM trips WHERE PULocationID IS NOT NULL GROUP BY 1",
)
def pickup_counts(spark, d):
    return K.value_counts(trips(spark, d), "PULocationID")


_TOP = ["VendorID", "passenger_count", "extra", "tolls_amount", "trip_type"]


@query(
    "top_value_share",
    "A31",
    f"WITH {TRIPS_SQL}, x AS ({_union(lambda c: f'SELECT {chr(39)}{c}{chr(39)} AS c, CAST({c} AS VARCHAR) AS v, count(*) AS n FROM trips WHERE {c} IS NOT NULL GROUP BY 2', _TOP)}) "
    'SELECT c AS "column", count(*) AS n_unique, round(max(n) / sum(n), 9) AS top_frac, count(*) <= 1 AS constant, max(n) / sum(n) >= 0.995 AS near_constant FROM x GROUP BY c',
)
def top_value_share(spark, d):
    return P.top_value_share(trips(spark, d), _TOP).withColumn("top_frac", F.round("top_frac", 9))
