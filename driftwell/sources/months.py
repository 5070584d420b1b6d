"""Slices in one table, partitioned by month: a scan opens only the months that are asked for.

A month is replaced as a whole, and no other month is touched, so a slice can be delivered again. Rows without a time
are in a partition of their own, which no month reads.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

YEAR, MONTH = "slice_year", "slice_month"
ROWS_PER_FILE = 5_000_000


def write_months(df: DataFrame, path: str, ts: str) -> None:
    """Replaces the months that ``df`` has rows of. Months are spread over as many tasks as their rows need."""
    made = df.withColumns({YEAR: F.year(ts), MONTH: F.month(ts)})
    sizes = made.groupBy(YEAR, MONTH).agg(F.ceil(F.count(F.lit(1)) / ROWS_PER_FILE).cast("int").alias("_files"))
    sizes = sizes.withColumnsRenamed({YEAR: "_y", MONTH: "_m"})
    same = F.col(YEAR).eqNullSafe(F.col("_y")) & F.col(MONTH).eqNullSafe(F.col("_m"))
    dealt = made.join(sizes, same).withColumn("_file", F.pmod(F.xxhash64(*df.columns), F.col("_files")))
    dealt = dealt.repartition(YEAR, MONTH, "_file").drop("_y", "_m", "_files", "_file")
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(YEAR, MONTH).parquet(path)


def in_months(months: Iterable[tuple[int, int]]) -> Column:
    """A condition on the partition columns only."""
    by_year: dict[int, list[int]] = {}
    for year, month in sorted(set(months)):
        by_year.setdefault(year, []).append(month)
    wanted = F.lit(False)
    for year, own in by_year.items():
        wanted |= (F.col(YEAR) == year) & F.col(MONTH).isin(own)
    return wanted


def read_months(spark: SparkSession, path: str, months: Iterable[tuple[int, int]] | None = None) -> DataFrame:
    """The rows of some months (all, if none are named); other months are not listed in the scan."""
    df = spark.read.parquet(path)
    return df if months is None else df.where(in_months(months))


def months_of(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """Months that have rows, from the partitions alone."""
    found = spark.read.parquet(path).select(YEAR, MONTH).distinct().where(f"{YEAR} is not null").collect()  # one row a month
    return sorted((r[0], r[1]) for r in found)
