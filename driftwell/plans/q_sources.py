"""Loaders and sinks over files written from the supplied tables, and global positions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from driftwell.operators import counting as K
from driftwell.operators import profile as P
from driftwell.operators.prefix import global_row_number
from driftwell.plans.catalog import query, table
from driftwell.plans.roles import TRIPS_SQL, both_slices, trips
from driftwell.session import shared_dir
from driftwell.sources import sinks, slices
from driftwell.sources.months import read_months, write_months


def _folder(spark, name):
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query(
    "customer_name_positions",
    "W5 W6",
    "SELECT c_custkey, row_number() OVER (ORDER BY c_name, md5('|' || c_custkey), c_custkey) AS position FROM customer",
)
def customer_name_positions(spark, d):
    """Every name begins alike."""
    df = table(spark, d, "customer").select("c_custkey", "c_name")
    return global_row_number(df, "c_name", ["c_custkey"], out="position").select("c_custkey", "position")


_LARGE = "9000000000000000000 + (o_orderkey * 7919) % 1000003"


@query(
    "large_number_positions",
    "W6",
    f"SELECT o_orderkey, row_number() OVER (ORDER BY {_LARGE}, md5('|' || o_orderkey), o_orderkey) AS position FROM orders",
)
def large_number_positions(spark, d):
    """Neighbouring integers far beyond the exact range of a double."""
    df = table(spark, d, "orders").selectExpr("o_orderkey", f"{_LARGE} AS large")
    return global_row_number(df, "large", ["o_orderkey"], out="position").select("o_orderkey", "position")


@query(
    "month_slices",
    "S2 S3",
    "SELECT lpad(month(o_orderdate)::VARCHAR, 2, '0') AS month, count(*) AS n, round(sum(o_totalprice), 2) AS total "
    "FROM orders WHERE year(o_orderdate) = 1995 AND month(o_orderdate) IN (1, 4) GROUP BY 1",
)
def month_slices(spark, d):
    """Two monthly slices written under their names, resolved by month and read in one scan."""
    folder = _folder(spark, "slices")
    orders = table(spark, d, "orders").where(F.year("o_orderdate") == 1995)
    for month in ("01", "04"):
        path = f"{folder}/{slices.SLICE_NAME.format(year='1995', month=month)}"
        orders.where(F.month("o_orderdate") == int(month)).write.parquet(path)
    found = [slices.slice_path(spark, folder, month, "1995") for month in ("01", "04")]
    df = slices.load_months(spark, found)
    return df.groupBy("month").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


_LINES = "unnest(string_split(text, chr(10))) AS line FROM documents"
_TRIM = "regexp_extract_all(line, '[^ \\t\\n\\r\\f\\v]+')"


@query(
    "corpus_lines",
    "S5 A4",
    f"SELECT len({_TRIM})::INT AS words, count(*) AS documents FROM (SELECT {_LINES}) WHERE len({_TRIM}) > 0 GROUP BY 1",
)
def corpus_lines(spark, d):
    """Texts written as lines, read back as a tokenised corpus: documents by number of words."""
    path = _folder(spark, "corpus")
    table(spark, d, "documents").select("text").write.text(path)
    docs = slices.load_corpus(spark, path).select(F.size("doc").alias("words"))
    return K.salted_group_sum(docs.withColumn("one", F.lit(1)), ["words"], "one", out="documents")


_ZONES = "SELECT n_nationkey::BIGINT AS \"LocationID\", n_name AS \"Zone\", n_regionkey::VARCHAR AS \"Borough\" FROM nation"


@query("zones_from_csv", "S6", _ZONES)
def zones_from_csv(spark, d):
    path = _folder(spark, "zones")
    rows = table(spark, d, "nation").selectExpr("n_nationkey AS LocationID", "n_name AS zone", "n_regionkey AS borough")
    sinks.write_csv(rows.union(rows), path)
    return slices.load_zones(spark, csv=path)


@query("zones_from_geojson", "S6", _ZONES)
def zones_from_geojson(spark, d):
    path = _folder(spark, "geojson")
    rows = table(spark, d, "nation").selectExpr(
        "named_struct('properties', named_struct('locationid', cast(n_nationkey AS string), 'zone', n_name, "
        "'borough', cast(n_regionkey AS string))) AS f"
    )
    rows.agg(F.collect_list("f").alias("features")).write.json(path)  # one row per nation
    return slices.load_zones(spark, csv=f"{path}-none", geojson=path)


@query(
    "rank_log_folder",
    "S14",
    "SELECT (c_custkey % 8)::INT AS rank, count(*) AS lines, sum(c_custkey)::BIGINT AS images FROM customer GROUP BY 1",
)
def rank_log_folder(spark, d):
    """Training-log lines written to a folder and read back by the log reader; other lines are passed over."""
    path = _folder(spark, "logs")
    rows = table(spark, d, "customer").select(
        F.explode(
            F.array(
                F.lit("starting"),
                F.format_string(
                    "rank %d: profiled_steps=%d, profiled_images=%d, avg_profiled_step_time=%.4fs, loss=%.4f",
                    F.col("c_custkey") % 8, F.lit(2), F.col("c_custkey"), F.lit(0.25), F.lit(1.5),
                ),
            )
        ).alias("value")
    )
    rows.write.text(path)
    return slices.load_rank_logs(spark, path).groupBy("rank").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("profiled_images").alias("images")
    )


@query(
    "report_table_json",
    "S11",
    "SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem GROUP BY 1",
)
def report_table_json(spark, d):
    path = _folder(spark, "report")
    rows = table(spark, d, "lineitem").groupBy("l_returnflag")
    sinks.write_report_table(rows.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty")), path)
    return spark.read.schema("l_returnflag string, n bigint, qty double").json(path)


@query(
    "exact_shards",
    "S8",
    "WITH p AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS i, count(*) OVER () AS n FROM events) "
    "SELECT (i // ceil(n / 7)::BIGINT)::INT AS shard, count(*) AS rows, min(event_id) AS first_id FROM p GROUP BY 1",
)
def exact_shards(spark, d):
    path = _folder(spark, "shards")
    sinks.write_shards(table(spark, d, "events"), path, 7, "event_id")
    return spark.read.parquet(path).groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.min("event_id").alias("first_id"))


_EXPECTED = {"lpep_pickup_datetime": "int64", "PULocationID": "int64", "trip_distance": "float64", "absent": "object"}


@query(
    "schema_tables",
    "A15 J7",
    "WITH e AS (SELECT * FROM (VALUES ('lpep_pickup_datetime', 'int64', 'timestamp_ntz', false, false, true), "
    "('PULocationID', 'int64', 'bigint', true, true, true), ('trip_distance', 'float64', 'double', true, true, true)) t(c, want, got, fam, ex, p)), "
    "n AS (SELECT count(*) AS n FROM lineitem) "
    "SELECT c AS \"column\", want AS expected_dtype, got AS actual_dtype, fam AS family_ok, ex AS exact_match, 'present' AS status, n AS rows FROM e, n "
    "UNION ALL SELECT 'absent', NULL, NULL, false, false, 'missing', n FROM n UNION ALL SELECT 'VendorID', NULL, NULL, false, false, 'extra', n FROM n",
)
def schema_tables(spark, d):
    """Type conformity and presence of the columns of the trips, beside their number of rows."""
    ref, cur = both_slices(spark, d)
    df = ref.unionByName(cur).select("VendorID", "lpep_pickup_datetime", "PULocationID", "trip_distance")
    kinds = P.schema_dtypes(df, _EXPECTED).withColumn("status", F.lit("present"))
    both = kinds.unionByName(P.schema_presence(df, tuple(_EXPECTED)), allowMissingColumns=True).na.fill(False)
    return both.crossJoin(F.broadcast(df.agg(F.count(F.lit(1)).alias("rows"))))  # one row


@query(
    "pruned_months",
    "S1 S2 S3",
    f"WITH {TRIPS_SQL} SELECT year(lpep_pickup_datetime)::INT AS slice_year, month(lpep_pickup_datetime)::INT AS slice_month, count(*) AS rows, round(sum(fare_amount), 2) AS fares "
    "FROM trips WHERE year(lpep_pickup_datetime) IN (1995, 1996) AND month(lpep_pickup_datetime) <= 6 GROUP BY 1, 2",
)
def pruned_months(spark, d):
    """Trips stored by month; the first halves of two years are read without opening another month."""
    path = _folder(spark, "months")
    write_months(trips(spark, d).select("trip_id", "lpep_pickup_datetime", "fare_amount"), path, "lpep_pickup_datetime")
    df = read_months(spark, path, [(y, m) for y in (1995, 1996) for m in range(1, 7)])
    return df.groupBy("slice_year", "slice_month").agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("fare_amount"), 2).alias("fares"))
