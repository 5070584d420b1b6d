"""Role maps: the supplied tables seen as trips, zones, telemetry, reports and labels.

Each role is one set of column expressions, used for Spark and printed as a SQL
view for the comparison. Missing values and repeated rows are planted by a rule
on the row itself, since no supplied table has any.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from driftwell.plans.catalog import table


def _plus_minutes(ts: str, minutes: str, spark: bool) -> str:
    return f"timestampadd(MINUTE, CAST({minutes} AS INT), {ts})" if spark else f"({ts} + to_minutes({minutes}))"


def trip_columns(spark: bool) -> dict[str, str]:
    """One trip per line item; every column is row-local, so a scan reads only what a query needs."""
    start = "(l_orderkey * 37 + l_linenumber * 101) % 1440"
    ride = "(l_partkey * 13 + l_linenumber) % 401 - 8"
    pickup = _plus_minutes("l_shipdate", start, spark)
    dropoff = _plus_minutes("l_shipdate", f"({start}) + ({ride})", spark)
    fare = "l_extendedprice / 197"
    tip = f"({fare}) * (l_discount + 0.0)"
    text = "STRING" if spark else "VARCHAR"
    return {
        "trip_id": f"concat_ws('|', CAST(l_orderkey AS {text}), CAST(l_linenumber AS {text}), CAST(l_partkey AS {text}), "
        f"CAST(l_suppkey AS {text}), CAST(CAST(l_quantity AS INT) AS {text}), "
        f"CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS {text}))",
        "slice": "CASE WHEN year(l_shipdate) <= 1997 THEN 'reference' ELSE 'current' END",
        "VendorID": "CAST(l_linenumber % 2 + 1 AS BIGINT)",
        "lpep_pickup_datetime": f"CASE WHEN l_partkey % 211 = 0 THEN NULL ELSE {pickup} END",
        "lpep_dropoff_datetime": dropoff,
        "store_and_fwd_flag": "CASE WHEN l_returnflag = 'R' THEN 'Y' WHEN l_returnflag = 'N' THEN 'N' "
        "WHEN l_linestatus = 'O' THEN 'X' ELSE NULL END",
        "RatecodeID": "CAST(l_linenumber AS DOUBLE)",
        "PULocationID": "CAST(l_suppkey AS BIGINT)",
        "DOLocationID": "CAST(l_partkey AS BIGINT)",
        "passenger_count": "CASE WHEN l_orderkey % 50 = 0 THEN NULL ELSE CAST(CAST(l_quantity AS INT) % 9 AS DOUBLE) END",
        "trip_distance": "CASE WHEN l_orderkey % 40 = 0 THEN NULL WHEN l_partkey % 301 = 0 THEN -l_quantity ELSE l_quantity END",
        "fare_amount": fare,
        "extra": "CAST(0.5 AS DOUBLE)",
        "tip_amount": f"CASE WHEN l_suppkey % 37 = 5 THEN NULL ELSE {tip} END",
        "tolls_amount": "CAST(CASE WHEN l_tax > 0.065 THEN 5.76 ELSE 0 END AS DOUBLE)",
        "total_amount": f"({fare}) * (1 + l_tax) + {tip}",
        "congestion_surcharge": "CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linestatus = 'O' THEN CAST(2.75 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END",
        "payment_type": "CAST(l_linenumber AS DOUBLE)",
        "trip_type": "CASE WHEN l_orderkey % 61 = 0 THEN NULL ELSE CAST(1 + l_suppkey % 2 AS DOUBLE) END",
    }


TRIP_COLUMNS = [c for c in trip_columns(True) if c not in ("trip_id", "slice")]


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*[f"{e} AS {c}" for c, e in trip_columns(True).items()])


def both_slices(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Reference and current slice; together they are the whole table."""
    df = trips(spark, sf_dir)
    return df.where("slice = 'reference'"), df.where("slice = 'current'")


TRIPS_SQL = "trips AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in trip_columns(False).items()) + " FROM lineitem)"
SLICES_SQL = TRIPS_SQL + ", ref AS (SELECT * FROM trips WHERE slice = 'reference'), cur AS (SELECT * FROM trips WHERE slice = 'current')"


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as zones, nation and region as zone name and borough."""
    supplier, nation, region = (table(spark, sf_dir, n) for n in ("supplier", "nation", "region"))
    return (
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .selectExpr("s_suppkey AS locationid", "concat(n_name, '/', s_name) AS zone", "r_name AS borough")
    )


ZONES_SQL = (
    "zones AS (SELECT DISTINCT CAST(s_suppkey AS BIGINT) AS LocationID, concat(n_name, '/', s_name) AS Zone, r_name AS Borough "
    "FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"
)


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as game telemetry: value is the latency, and the spend of a purchase."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "ts AS event_ts",
        "CAST(user_id AS INT) AS player_id",
        "concat('R', CAST(user_id % 5 AS STRING)) AS region",
        "CASE WHEN event_type = 'error' THEN 'crash' ELSE event_type END AS event_type",
        "CASE WHEN event_id % 83 = 0 THEN -1 ELSE CAST(floor(value) AS INT) END AS latency_ms",
        "CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_type = 'purchase' THEN value ELSE 0.0D END AS spend_usd",
        "props AS payload_blob",
    )


TELEMETRY_SQL = (
    "telemetry AS (SELECT event_id, ts AS event_ts, CAST(user_id AS INT) AS player_id, concat('R', CAST(user_id % 5 AS VARCHAR)) AS region, "
    "CASE WHEN event_type = 'error' THEN 'crash' ELSE event_type END AS event_type, "
    "CASE WHEN event_id % 83 = 0 THEN -1 ELSE CAST(floor(value) AS INT) END AS latency_ms, "
    "CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_type = 'purchase' THEN value ELSE CAST(0 AS DOUBLE) END AS spend_usd, "
    "props AS payload_blob FROM events)"
)
