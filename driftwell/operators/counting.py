"""Counting, grouping, sorting and ranking of large event and text tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwell.functions.text import letter_bucket, tokens, words
from driftwell.operators.prefix import exact_quantiles, global_row_number, join_null_safe


def word_count(df: DataFrame, text: str = "text") -> DataFrame:
    """Partial counts before the shuffle, then the final sum; case-sensitive."""
    return words(df.select(text), text).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def word_count_two_step(df: DataFrame, text: str = "text", fan_in: int = 16) -> DataFrame:
    """The same counts with an explicit partial merge of at most ``fan_in`` parts per word."""
    part = F.pmod(F.spark_partition_id(), F.lit(fan_in))
    partial = words(df.select(text), text).groupBy("word", part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


def count_mismatches(a: DataFrame, b: DataFrame, key: str = "word", n: str = "n") -> DataFrame:
    """Keys whose counts differ between two results; a matching pair gives no row."""
    right = b.select(F.col(key).alias("_k"), F.col(n).alias("_n"))
    both = a.join(right, F.col(key).eqNullSafe(F.col("_k")), "full")
    return both.where(~F.col(n).eqNullSafe(F.col("_n"))).select(
        F.coalesce(F.col(key), F.col("_k")).alias(key), F.col(n).alias("left_n"), F.col("_n").alias("right_n")
    )


def top_k(df: DataFrame, k: int, n: str = "n", tie: Sequence[str] = ("word",)) -> DataFrame:
    """Largest ``k`` rows; ties by name. Each task keeps its own ``k`` only."""
    return df.orderBy(F.col(n).desc(), *tie).limit(k)


def top_k_per_group(
    df: DataFrame, by: Sequence[str], k: int, n: str = "n", tie: Sequence[str] = ("word",), out: str = "rank"
) -> DataFrame:
    """Rank 1..k per group. The filter on the rank lets Spark keep ``k`` rows per
    group and task before the shuffle, so a huge group never meets in one task."""
    order = Window.partitionBy(*by).orderBy(F.col(n).desc(), *tie)
    return df.withColumn(out, F.row_number().over(order)).where(F.col(out) <= k)


def top_words_text(ranked: DataFrame, by: Sequence[str], out: str = "top_words") -> DataFrame:
    """``word:count`` list of ranked rows (at most k per group)."""
    items = F.array_sort(F.collect_list(F.struct("rank", F.concat_ws(":", "word", "n").alias("t"))))
    return ranked.groupBy(*by).agg(F.concat_ws(", ", items["t"]).alias(out))


def chunk_stats(df: DataFrame, chunk: str, text: str = "text", k: int = 3) -> DataFrame:
    """Documents, tokens and top words of every chunk."""
    size = df.groupBy(chunk).agg(
        F.count(F.lit(1)).alias("num_docs"), F.sum(F.size(tokens(text))).cast("bigint").alias("num_tokens")
    )
    counts = words(df.select(chunk, text), text).groupBy(chunk, "word").agg(F.count(F.lit(1)).alias("n"))
    top = top_words_text(top_k_per_group(counts, [chunk], k), [chunk])
    return join_null_safe(size, top, [chunk], "left")


def chunk_stats_in_order(df: DataFrame, key: str, size: int, text: str = "text", k: int = 3, chunk: str = "chunk_id") -> DataFrame:
    """:func:`chunk_stats` of chunks of ``size`` documents along a unique key. Only keys are put in order; texts
    move to their key's chunk as they are."""
    ids = with_chunk_id(df.select(key), key, size, out=chunk)
    # the few texts of a chunk meet in one task, which splits and counts them: no word is shuffled
    texts = df.select(key, text).join(ids, key).select(chunk, text).repartition(chunk)
    counts = words(texts, text).groupBy(chunk, "word").agg(F.count(F.lit(1)).alias("n"))
    docs = ids.groupBy(chunk).agg(F.count(F.lit(1)).alias("num_docs"))
    tokens_in = counts.groupBy(chunk).agg(F.sum("n").alias("num_tokens"))
    size_of = docs.join(tokens_in, chunk, "left").na.fill(0, ["num_tokens"])
    return size_of.join(top_words_text(top_k_per_group(counts, [chunk], k), [chunk]), chunk, "left")


def reducer_summary(counts: DataFrame, k: int = 3) -> DataFrame:
    """Distinct words, tokens and top words per letter bucket."""
    keyed = counts.withColumn("bucket", letter_bucket("word"))
    size = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("unique_words"), F.sum("n").alias("tokens"))
    return size.join(top_words_text(top_k_per_group(keyed, ["bucket"], k), ["bucket"]), "bucket")


def repeat_rows(df: DataFrame, times: int, out: str = "copy") -> DataFrame:
    """Every row ``times`` times; an explode, not a join."""
    return df.withColumn(out, F.explode(F.sequence(F.lit(0), F.lit(times - 1))))


def group_summary(df: DataFrame, key: str, latency: str, spend: str) -> DataFrame:
    """Events, mean latency and total spend per key, from three columns of the scan."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("events"),
        F.avg(latency).alias("mean_latency_ms"),
        F.sum(spend).alias("total_spend_usd"),
    )


def paid_rate(spend: str | Column, ignore_nulls: bool = False) -> Column:
    """Share of rows with spend above 0; NULL rows stay in the denominator unless ignored.

    An expression with a partial phase, not a grouped Python function. No rows gives NULL.
    """
    x = F.col(spend) if isinstance(spend, str) else spend
    rows = F.count(x) if ignore_nulls else F.count(F.lit(1))
    return F.try_divide(F.count_if(x > 0), rows)


def totals(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.sum(column).alias("total"), F.count(F.lit(1)).alias("rows"))


def sorted_by_time(df: DataFrame, ts: str, columns: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """Global sort of a narrow projection; wide columns never enter the shuffle."""
    return df.select(*columns).orderBy(ts, *tie)


def with_chunk_id(df: DataFrame, order_by: str, size: int, tie: Sequence[str] = (), out: str = "chunk_id") -> DataFrame:
    """Position based chunk id along ``order_by``."""
    numbered = global_row_number(df, order_by, tie or [order_by], out="_rn")
    return numbered.withColumn(out, F.floor((F.col("_rn") - 1) / size)).drop("_rn")


# ---- exploratory group-bys --------------------------------------------------


def tips_by_payment(df: DataFrame, key: str = "payment_type", tip: str = "tip_amount") -> DataFrame:
    """Rows, mean, median and shares of zero, positive and missing tips per payment type."""
    known = df.where(F.col(key).isNotNull())
    x = F.col(tip)
    n = F.count(F.lit(1))
    base = known.groupBy(key).agg(
        n.alias("n"),
        F.avg(x).alias("mean_tip"),
        (F.count_if(F.coalesce(x, F.lit(0.0)) == 0) / n).alias("pct_zero_tip"),
        (F.count_if(x > 0) / n).alias("pct_positive_tip"),
        (F.count_if(x.isNull()) / n).alias("pct_missing_tip"),
    )
    medians = exact_quantiles(known, tip, [0.5], [key]).select(key, F.col("value").alias("median_tip"))
    return base.join(medians, key, "left")


def month_totals(df: DataFrame, month: str, pickup: str, pay: str, fare: str) -> DataFrame:
    return df.groupBy(month).agg(
        F.count(pickup).alias("trips"), F.sum(pay).alias("total_pay"), F.avg(fare).alias("mean_fare")
    )


def dominant_year(df: DataFrame, pickup: str) -> DataFrame:
    """One row: the year with most rows (the earlier year on a tie)."""
    years = df.where(F.col(pickup).isNotNull()).groupBy(F.year(pickup).alias("year")).agg(F.count(F.lit(1)).alias("n"))
    return years.orderBy(F.col("n").desc(), "year").limit(1)


def busy_months(df: DataFrame, pickup: str, min_rides: int = 1000) -> DataFrame:
    """Months of the dominant year with enough rides: ``(year, month, n)``."""
    year = dominant_year(df, pickup).select("year").scalar()
    months = (
        df.where(F.year(pickup) == year)
        .groupBy(F.year(pickup).alias("year"), F.month(pickup).alias("month"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return months.where(F.col("n") >= min_rides)


def in_busy_months(df: DataFrame, pickup: str, min_rides: int = 1000) -> DataFrame:
    keep = busy_months(df, pickup, min_rides).select(F.col("year").alias("_y"), F.col("month").alias("_m"))
    on = (F.year(pickup) == F.col("_y")) & (F.month(pickup) == F.col("_m"))
    return df.join(F.broadcast(keep), on, "left_semi")  # at most 12 rows: months of one year


def daily_overlay(df: DataFrame, pickup: str, fare: str, passengers: str, payment: str) -> DataFrame:
    """Per month and day of month: trips, means, card and cash shares over all rows."""
    n = F.count(F.lit(1))
    return df.groupBy(F.date_format(pickup, "MM").alias("month"), F.dayofmonth(pickup).alias("day")).agg(
        F.count(pickup).alias("trips"),
        F.avg(fare).alias("mean_fare"),
        F.avg(passengers).alias("mean_pax"),
        (F.count_if(F.col(payment) == 1) / n).alias("frac_cc"),
        (F.count_if(F.col(payment) == 2) / n).alias("frac_cash"),
    )


def value_counts(df: DataFrame, column: str, out: str = "n") -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(out))


def zone_counts(zones: DataFrame, trips: DataFrame, key: str = "LocationID") -> DataFrame:
    """Every zone with its pickup and drop-off counts, 0 where there are none.

    Both sides are counts per zone before the join, so hot zones cost nothing there.
    """
    out = zones
    for column, name in (("PULocationID", "pu_count"), ("DOLocationID", "do_count")):
        counts = value_counts(trips, column, name).withColumnRenamed(column, key)
        out = out.join(counts, key, "left")
    return out.na.fill(0, ["pu_count", "do_count"])


def salted_group_sum(df: DataFrame, by: Sequence[str], value: str, salts: int = 16, out: str = "total") -> DataFrame:
    """Two-level sum for keys with no useful partial phase upstream; the salt is a row hash."""
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salts))
    part = df.groupBy(*by, salt.alias("_salt")).agg(F.sum(value).alias("_p"))
    return part.groupBy(*by).agg(F.sum("_p").alias(out))
