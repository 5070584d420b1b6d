"""Scans, projections, word counts, group-bys, sorts and top-k."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from driftwell.functions import columns as C
from driftwell.functions.text import letter_bucket, tokens
from driftwell.operators import counting as K
from driftwell.operators import features as X
from driftwell.operators.reports import completion_rank
from driftwell.operators.states import Fold, fold
from driftwell.operators.vectors import aggregate_blocks, map_batches
from driftwell.plans.catalog import query, table
from driftwell.plans.roles import TELEMETRY_SQL, TRIPS_SQL, ZONES_SQL, telemetry, trips, zones
from driftwell.sources import slices as S

WORDS_SQL = "words AS (SELECT doc_id, unnest(string_split_regex(trim(text, ' \t\n\r\f\v'), '\\s+')) AS word FROM documents WHERE length(trim(text, ' \t\n\r\f\v')) > 0)"
WORDS_SQL = WORDS_SQL.replace("\t", "' || chr(9) || '").replace("\n", "' || chr(10) || '").replace("\r", "' || chr(13) || '").replace("\f", "' || chr(12) || '").replace("\v", "' || chr(11) || '")
BUCKET_SQL = "CASE WHEN lower(substr(word, 1, 1)) <= 'i' THEN 0 WHEN lower(substr(word, 1, 1)) <= 'r' THEN 1 ELSE 2 END"


@query(
    "region_summary",
    "P1 A6 A7 A8 U3",
    f"WITH {TELEMETRY_SQL} SELECT region, count(*) AS events, round(avg(latency_ms), 6) AS mean_latency_ms, "
    "round(sum(spend_usd), 4) AS total_spend_usd, round(count(*) FILTER (WHERE spend_usd > 0) / count(*), 9) AS paid_event_rate, "
    "round(count(*) FILTER (WHERE spend_usd > 0) / count(spend_usd), 9) AS paid_event_rate_present "
    "FROM telemetry GROUP BY region",
)
def region_summary(spark, d):
    """Grouped summary and both forms of the paid share, in one aggregate over three columns."""
    return telemetry(spark, d).groupBy("region").agg(
        F.count(F.lit(1)).alias("events"),
        F.round(F.avg("latency_ms"), 6).alias("mean_latency_ms"),
        F.round(F.sum("spend_usd"), 4).alias("total_spend_usd"),
        F.round(K.paid_rate("spend_usd"), 9).alias("paid_event_rate"),
        F.round(K.paid_rate("spend_usd", ignore_nulls=True), 9).alias("paid_event_rate_present"),
    )


@query(
    "group_by_region",
    "A6",
    f"WITH {TELEMETRY_SQL} SELECT region, count(*) AS events, round(avg(latency_ms), 6) AS mean_latency_ms, round(sum(spend_usd), 4) AS total_spend_usd FROM telemetry GROUP BY region",
)
def group_by_region(spark, d):
    out = K.group_summary(telemetry(spark, d), "region", "latency_ms", "spend_usd")
    return out.withColumns({"mean_latency_ms": F.round("mean_latency_ms", 6), "total_spend_usd": F.round("total_spend_usd", 4)})


@query("dataset_totals", "A8", f"WITH {TELEMETRY_SQL} SELECT round(sum(spend_usd), 4) AS total, count(*) AS rows FROM telemetry")
def dataset_totals(spark, d):
    return K.totals(telemetry(spark, d), "spend_usd").withColumn("total", F.round("total", 4))


@query(
    "slice_scan",
    "S1",
    "SELECT year(l_shipdate)::INT AS y, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem GROUP BY 1",
)
def slice_scan(spark, d):
    df = S.load_slice(spark, f"{d.rstrip('/')}/lineitem.parquet", times=["l_shipdate"])
    return df.groupBy(F.year("l_shipdate").alias("y")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty")
    )


@query(
    "multi_slice_scan",
    "S3 J8",
    "SELECT 'ts' AS month, count(*) AS n, round(sum(value), 3) AS value FROM events",
)
def multi_slice_scan(spark, d):
    """Slice id from the file name: the table of events is the slice with the id 'ts'."""
    df = S.load_months(spark, [f"{d.rstrip('/')}/events.parquet", f"{d.rstrip('/')}/absent.parquet"])
    return df.groupBy("month").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 3).alias("value"))


@query("sharded_scan", "S4", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def sharded_scan(spark, d):
    return S.load_shards(spark, f"{d.rstrip('/')}/events.parquet").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "corpus_tokens",
    "S5 P21",
    f"WITH {WORDS_SQL} SELECT doc_id, count(*) AS n_tokens, count(DISTINCT word) AS n_words FROM words GROUP BY doc_id",
)
def corpus_tokens(spark, d):
    t = tokens("text")
    return (
        table(spark, d, "documents")
        .select("doc_id", F.size(t).cast("bigint").alias("n_tokens"), F.size(F.array_distinct(t)).cast("bigint").alias("n_words"))
        .where("n_tokens > 0")
    )


@query("zone_dimension", "S6", f"WITH {ZONES_SQL} SELECT LocationID, Zone, Borough FROM zones")
def zone_dimension(spark, d):
    return S.zone_dimension(zones(spark, d))


@query(
    "trip_preview",
    "P2 W3",
    f"WITH {TRIPS_SQL} SELECT {', '.join(c for c in C.PREVIEW_COLUMNS if c != 'x')} FROM trips ORDER BY lpep_dropoff_datetime, trip_id LIMIT 8",
)
def trip_preview(spark, d):
    return C.preview(trips(spark, d), ["lpep_dropoff_datetime", "trip_id"])


@query(
    "card_only",
    "P3 P1",
    f"WITH {TRIPS_SQL} SELECT VendorID, count(*) AS n, round(sum(fare_amount), 2) AS fares FROM trips WHERE payment_type = 1 GROUP BY VendorID",
)
def card_only(spark, d):
    return C.card_only(trips(spark, d)).groupBy("VendorID").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("fare_amount"), 2).alias("fares")
    )


@query(
    "within_cutoff",
    "P4",
    f"WITH {TRIPS_SQL} SELECT trip_id, trip_distance, passenger_count FROM trips WHERE abs(trip_distance) < 6 AND abs(passenger_count) < 6",
)
def within_cutoff(spark, d):
    return C.within_cutoff(trips(spark, d), ["trip_distance", "passenger_count"], 6.0).select("trip_id", "trip_distance", "passenger_count")


@query(
    "number_coercion",
    "P5 P6",
    "SELECT substr(o_orderpriority, 1, 1) AS code, count(*) AS n, "
    "round(sum(TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE CAST(o_totalprice AS VARCHAR) END AS DOUBLE)), 2) AS total, "
    "count(*) - count(TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE CAST(o_totalprice AS VARCHAR) END AS DOUBLE)) AS bad "
    "FROM orders GROUP BY 1",
)
def number_coercion(spark, d):
    """Text that is a number in some rows and a label in others: labels become missing."""
    mixed = F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise(F.col("o_totalprice").cast("string"))
    x = C.to_number(mixed)
    return table(spark, d, "orders").groupBy(F.substring("o_orderpriority", 1, 1).alias("code")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(x), 2).alias("total"), F.count_if(x.isNull()).alias("bad")
    )


@query(
    "tip_frame",
    "P7 P8 P6 P9 P11",
    f"WITH {TRIPS_SQL} SELECT CAST(VendorID AS DOUBLE) AS VendorID, CAST(PULocationID AS DOUBLE) AS PULocationID, trip_distance, fare_amount, "
    "CAST(hour(lpep_pickup_datetime) AS DOUBLE) AS lpep_pickup_hour, CAST(isodow(lpep_dropoff_datetime) - 1 AS DOUBLE) AS lpep_dropoff_weekday, "
    "(epoch_us(lpep_dropoff_datetime) - epoch_us(lpep_pickup_datetime)) / 6e7 AS duration_min, coalesce(tip_amount, 0) AS y "
    "FROM trips WHERE payment_type = 1",
)
def tip_frame(spark, d):
    made, _ = C.tip_frame(trips(spark, d))
    order = ["VendorID", "PULocationID", "trip_distance", "fare_amount", "lpep_pickup_hour", "lpep_dropoff_weekday", "duration_min", "y"]
    return C.ints_to_double(C.align_columns(made, order))


@query(
    "calendar_parts",
    "P9 P11",
    f"WITH {TRIPS_SQL} SELECT trip_id, year(lpep_pickup_datetime)::DOUBLE AS lpep_pickup_year, month(lpep_pickup_datetime)::DOUBLE AS lpep_pickup_month, "
    "(isodow(lpep_pickup_datetime) - 1)::DOUBLE AS lpep_pickup_weekday, hour(lpep_pickup_datetime)::DOUBLE AS lpep_pickup_hour, "
    "(epoch_us(lpep_dropoff_datetime) - epoch_us(lpep_pickup_datetime)) / 6e7 AS duration_min FROM trips",
)
def calendar_parts(spark, d):
    made = C.ints_to_double(C.add_datetime_features(trips(spark, d)))
    return made.select("trip_id", *[f"lpep_pickup_{p}" for p in ("year", "month", "weekday", "hour")], "duration_min")


_DT = "CAST(CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'n/a' ELSE CAST(o_orderdate AS VARCHAR) END AS VARCHAR)"


@query(
    "datetime_detection",
    "P10",
    f"WITH t AS (SELECT o_orderstatus, o_orderpriority, {_DT} AS placed_text FROM orders) "
    "SELECT 'o_orderstatus' AS \"column\", round(avg((TRY_CAST(o_orderstatus AS TIMESTAMP) IS NOT NULL)::INT), 9) AS parse_frac, avg((TRY_CAST(o_orderstatus AS TIMESTAMP) IS NOT NULL)::INT) > 0.8 AS is_datetime FROM t "
    "UNION ALL SELECT 'o_orderpriority', round(avg((TRY_CAST(o_orderpriority AS TIMESTAMP) IS NOT NULL)::INT), 9), avg((TRY_CAST(o_orderpriority AS TIMESTAMP) IS NOT NULL)::INT) > 0.8 FROM t "
    "UNION ALL SELECT 'placed_text', round(avg((TRY_CAST(placed_text AS TIMESTAMP) IS NOT NULL)::INT), 9), avg((TRY_CAST(placed_text AS TIMESTAMP) IS NOT NULL)::INT) > 0.8 FROM t",
)
def datetime_detection(spark, d):
    odd = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
    text = F.when(odd, "n/a").otherwise(F.col("o_orderdate").cast("string"))
    df = table(spark, d, "orders").select("o_orderstatus", "o_orderpriority", text.alias("placed_text"))
    return C.detect_datetime_columns(df).withColumn("parse_frac", F.round("parse_frac", 9))


@query(
    "event_enrichment",
    "P20 U1",
    f"WITH {TELEMETRY_SQL} SELECT event_id, hour(event_ts)::INT AS hour_of_day, event_type = 'purchase' AS is_purchase, event_type = 'crash' AS is_crash, "
    "CASE WHEN latency_ms <= -1 THEN NULL WHEN latency_ms <= 60 THEN 'fast' WHEN latency_ms <= 120 THEN 'stable' WHEN latency_ms <= 240 THEN 'slow' ELSE 'spiky' END AS latency_band FROM telemetry",
)
def event_enrichment(spark, d):
    made = X.enrich_events(telemetry(spark, d))
    return made.select("event_id", F.col("hour_of_day").cast("int").alias("hour_of_day"), "is_purchase", "is_crash", "latency_band")


@query(
    "event_batches",
    "U1 U2",
    f"WITH {TELEMETRY_SQL} SELECT event_id, CAST(latency_ms AS BIGINT) * 2 AS doubled FROM telemetry",
)
def event_batches(spark, d):
    """The open hook for a function on pandas blocks; built-ins are the first choice elsewhere."""

    def double(block):
        return block.assign(doubled=block["latency_ms"].astype("int64") * 2)[["event_id", "doubled"]]

    return map_batches(telemetry(spark, d).select("event_id", "latency_ms"), double, "event_id bigint, doubled bigint")


@query(
    "paid_rate_by_block",
    "U3 A7",
    f"WITH {TELEMETRY_SQL} SELECT region, round(count(*) FILTER (WHERE spend_usd > 0) / count(*), 9) AS paid_event_rate FROM telemetry GROUP BY region",
)
def paid_rate_by_block(spark, d):
    """The same share through partial states per Arrow block, merged by Spark."""

    def partial(block):
        grouped = block.assign(paid=block["spend_usd"].gt(0)).groupby("region", dropna=False)["paid"]
        return grouped.agg(paid="sum", rows="size").reset_index()

    df = telemetry(spark, d).select("region", "spend_usd")
    return aggregate_blocks(
        df,
        ["region"],
        partial,
        "region string, paid bigint, rows bigint",
        {"paid": "sum", "rows": "sum"},
        lambda m: m.select("region", F.round(F.try_divide("paid", "rows"), 9).alias("paid_event_rate")),
    )


COVER_US = 600_000_000  # an event covers ten minutes


def _stretches(intervals: np.ndarray) -> np.ndarray:
    """Overlapping and touching intervals (begin, end) put together."""
    if not len(intervals):
        return intervals
    intervals = intervals[np.argsort(intervals[:, 0], kind="stable")]
    reach = np.maximum.accumulate(intervals[:, 1])
    begins = np.append(True, intervals[1:, 0] > reach[:-1])
    at = np.flatnonzero(begins)
    return np.stack([intervals[at, 0], reach[np.append(at[1:], len(reach)) - 1]], axis=1)


COVERED = Fold(
    zero=lambda: np.empty((0, 2), np.int64),
    block=lambda state, rows: _stretches(np.concatenate([state, rows[["a", "b"]].to_numpy(np.int64)])),
    combine=lambda x, y: _stretches(np.concatenate([x, y])),
    final=lambda state: (len(state), int((state[:, 1] - state[:, 0]).sum())),
)


@query(
    "covered_time",
    "U3 A7",
    f"WITH {TELEMETRY_SQL}, i AS (SELECT region, epoch_us(event_ts) AS a, epoch_us(event_ts) + {COVER_US} AS b FROM telemetry), "
    "m AS (SELECT *, max(b) OVER (PARTITION BY region ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM i) "
    "SELECT region, count(*) FILTER (WHERE p IS NULL OR a > p) AS stretches, sum(greatest(b - greatest(a, coalesce(p, a)), 0))::BIGINT AS covered_us FROM m GROUP BY region",
)
def covered_time(spark, d):
    """Time with an event in the last ten minutes, by region: sets of stretches, united by a combine step of its own."""
    begin = F.unix_micros(F.col("event_ts").cast("timestamp"))
    rows = telemetry(spark, d).select("region", begin.alias("a"), (begin + COVER_US).alias("b"))
    return fold(rows, ["region"], COVERED, "stretches bigint, covered_us bigint")


@query("word_count", "A1 P21 S5", f"WITH {WORDS_SQL} SELECT word, count(*) AS n FROM words GROUP BY word")
def word_count(spark, d):
    return K.word_count(table(spark, d, "documents"))


@query("word_count_two_step", "A4", f"WITH {WORDS_SQL} SELECT word, count(*) AS n FROM words GROUP BY word")
def word_count_two_step(spark, d):
    return K.word_count_two_step(table(spark, d, "documents"))


@query(
    "word_count_self_check",
    "A5",
    f"WITH {WORDS_SQL} SELECT count(*) - count(*) AS mismatches, count(*) AS tokens FROM words",
)
def word_count_self_check(spark, d):
    docs = table(spark, d, "documents")
    wrong = K.count_mismatches(K.word_count(docs), K.word_count_two_step(docs)).agg(F.count(F.lit(1))).scalar()
    return docs.agg(F.sum(F.size(tokens("text"))).cast("bigint").alias("tokens")).select(wrong.alias("mismatches"), "tokens")


@query(
    "words_by_bucket",
    "P22 A3 W2",
    f"WITH {WORDS_SQL}, c AS (SELECT {BUCKET_SQL} AS bucket, word, count(*) AS n FROM words GROUP BY 1, 2), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY n DESC, word) AS k FROM c) "
    "SELECT bucket::INT AS bucket, count(*) AS unique_words, sum(n)::BIGINT AS tokens, string_agg(word || ':' || n, ', ' ORDER BY k) FILTER (WHERE k <= 3) AS top_words FROM r GROUP BY bucket",
)
def words_by_bucket(spark, d):
    return K.reducer_summary(K.word_count(table(spark, d, "documents")))


@query(
    "words_per_chunk",
    "A2 W6 U2",
    f"WITH {WORDS_SQL}, ch AS (SELECT doc_id, ((row_number() OVER (ORDER BY doc_id) - 1) // 3)::BIGINT AS chunk_id FROM documents), "
    "c AS (SELECT chunk_id, word, count(*) AS n FROM words JOIN ch USING (doc_id) GROUP BY 1, 2), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY n DESC, word) AS k FROM c), "
    "t AS (SELECT chunk_id, sum(n)::BIGINT AS num_tokens, string_agg(word || ':' || n, ', ' ORDER BY k) FILTER (WHERE k <= 3) AS top_words FROM r GROUP BY chunk_id) "
    "SELECT s.chunk_id, s.num_docs, coalesce(t.num_tokens, 0) AS num_tokens, t.top_words FROM (SELECT chunk_id, count(*) AS num_docs FROM ch GROUP BY 1) s LEFT JOIN t USING (chunk_id)",
)
def words_per_chunk(spark, d):
    return K.chunk_stats_in_order(table(spark, d, "documents"), "doc_id", 3)


@query("top_words", "W2", f"WITH {WORDS_SQL} SELECT word, count(*) AS n FROM words GROUP BY word ORDER BY n DESC, word LIMIT 20")
def top_words(spark, d):
    return K.top_k(K.word_count(table(spark, d, "documents")), 20)


@query(
    "repeated_corpus",
    "D11",
    f"WITH {WORDS_SQL} SELECT {BUCKET_SQL} AS bucket, 3 * count(*) AS tokens FROM words GROUP BY 1",
)
def repeated_corpus(spark, d):
    docs = K.repeat_rows(table(spark, d, "documents").select("text"), 3)
    return K.word_count(docs).groupBy(letter_bucket("word").alias("bucket")).agg(F.sum("n").alias("tokens"))


@query(
    "narrow_time_sort",
    "W1 P1",
    f"WITH {TELEMETRY_SQL} SELECT event_ts, event_id, region, latency_ms FROM telemetry ORDER BY event_ts, event_id",
)
def narrow_time_sort(spark, d):
    narrow = C.drop_wide(telemetry(spark, d), "payload_blob")
    return K.sorted_by_time(narrow, "event_ts", ["event_ts", "event_id", "region", "latency_ms"], ["event_id"])


@query(
    "event_chunks",
    "W6",
    "SELECT event_id, ((row_number() OVER (ORDER BY ts, md5('|' || CAST(event_id AS VARCHAR))) - 1) // 1000)::BIGINT AS chunk_id FROM events",
)
def event_chunks(spark, d):
    df = table(spark, d, "events").select("event_id", "ts")
    return K.with_chunk_id(df, "ts", 1000, ["event_id"]).select("event_id", "chunk_id")


@query(
    "completion_rank",
    "W5",
    "SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, md5('|' || CAST(event_id AS VARCHAR))) AS completion_rank FROM events",
)
def completion_ranks(spark, d):
    df = table(spark, d, "events").select("user_id", "event_id", "ts")
    return completion_rank(df, ["user_id"], "ts", ["event_id"]).select("user_id", "event_id", "completion_rank")


@query(
    "study_results",
    "P26",
    "SELECT (row_number() OVER (PARTITION BY 1 ORDER BY user_id))::INT AS completion_rank, user_id AS trial_id, round(avg(value), 6) AS score, round_even(avg(event_id % 97), 0)::INT AS best_iteration FROM events GROUP BY user_id",
)
def study_results(spark, d):
    raw = table(spark, d, "events").groupBy(F.col("user_id").alias("number")).agg(
        F.round(F.avg("value"), 6).alias("value"),
        F.bround(F.avg(F.col("event_id") % 97)).cast("int").alias("user_attrs_best_iteration"),
    )
    ranked = K.with_chunk_id(raw, "number", 1).withColumn("user_attrs_completion_rank", (F.col("chunk_id") + 1).cast("int"))
    return C.study_results(ranked.drop("chunk_id"))
