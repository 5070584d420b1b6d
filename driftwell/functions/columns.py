"""Column expressions and small projections. All of them stay inside codegen."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLOATS = (T.FloatType, T.DoubleType)
INTS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)

# Column names of a trip slice.
PICKUP = "lpep_pickup_datetime"
DROPOFF = "lpep_dropoff_datetime"
PREVIEW_COLUMNS = [
    "lpep_pickup_datetime",
    "lpep_dropoff_datetime",
    "PULocationID",
    "DOLocationID",
    "trip_distance",
    "fare_amount",
    "total_amount",
    "passenger_count",
    "payment_type",
    "congestion_surcharge",
    "tolls_amount",
    "trip_type",
    "tip_amount",
]


def normalise_missing(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every float column, so one null rule holds everywhere."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, FLOATS)]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in floats}) if floats else df


def to_number(column: str | Column) -> Column:
    """Double, or NULL where the value is not a number."""
    value = F.col(column) if isinstance(column, str) else column
    return F.nanvl(value.try_cast("double"), F.lit(None))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def non_numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if not isinstance(f.dataType, T.NumericType)]


def ints_to_double(df: DataFrame) -> DataFrame:
    ints = [f.name for f in df.schema if isinstance(f.dataType, INTS)]
    return df.withColumns({c: F.col(c).cast("double") for c in ints}) if ints else df


def drop_wide(df: DataFrame, *columns: str) -> DataFrame:
    """Drop wide columns before a global step; the scan then never reads them."""
    return df.drop(*columns)


def preview(
    df: DataFrame,
    order_by: Sequence[str],
    preferred: Sequence[str] = PREVIEW_COLUMNS,
    rows: int = 8,
    width: int = 12,
) -> DataFrame:
    """First rows of the preferred columns, or of the first ``width`` columns if none is there."""
    have = [c for c in preferred if c in df.columns] or df.columns[:width]
    return df.orderBy(*order_by).limit(rows).select(*have)


def card_only(df: DataFrame, payment: str = "payment_type") -> DataFrame:
    return df.where(F.col(payment) == 1) if payment in df.columns else df


def within_cutoff(df: DataFrame, columns: Sequence[str], cutoff: float) -> DataFrame:
    """Rows whose coordinates are all present and strictly inside ``(-cutoff, cutoff)``."""
    tests = [F.nanvl(F.abs(F.col(c)), F.lit(None)) < cutoff for c in columns]
    return df.where(reduce(and_, tests))


def minutes_between(start: str, end: str) -> Column:
    micros = F.unix_micros(F.col(end).cast("timestamp")) - F.unix_micros(F.col(start).cast("timestamp"))
    return micros / F.lit(6e7)


def add_datetime_features(df: DataFrame, pickup: str = PICKUP, dropoff: str = DROPOFF) -> DataFrame:
    """Nullable calendar parts of both times (Monday is 0) and ``duration_min``."""
    new: dict[str, Column] = {}
    for c in (pickup, dropoff):
        if c in df.columns:
            prefix = c.replace("_datetime", "")
            for part, fn in (("year", F.year), ("month", F.month), ("weekday", F.weekday), ("hour", F.hour)):
                new[f"{prefix}_{part}"] = fn(c).cast("long")
    if pickup in df.columns and dropoff in df.columns:
        new["duration_min"] = minutes_between(pickup, dropoff)
    return df.withColumns(new) if new else df


def tip_frame(df: DataFrame, label: str = "tip_amount", card: bool = True) -> tuple[DataFrame, list[str]]:
    """Numeric features plus label ``y``; the label and the total that contains it are left out."""
    if label not in df.columns:
        raise ValueError(f"Expected column '{label}'.")
    made = add_datetime_features(df)
    if card:
        made = card_only(made)
    features = [c for c in numeric_columns(made) if c not in (label, "total_amount")]
    return made.select(*features, F.coalesce(to_number(label), F.lit(0.0)).alias("y")), features


def align_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Stored training order; a missing column is an error."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required feature columns: {missing}")
    return df.select(*columns)


def detect_datetime_columns(df: DataFrame, share: float = 0.8) -> DataFrame:
    """``(column, parse_frac, is_datetime)``: time columns, and text where more than ``share`` parses."""
    rows = []
    for f in df.schema:
        if isinstance(f.dataType, TIMES):
            frac = F.lit(1.0)
        elif isinstance(f.dataType, T.StringType):
            frac = F.avg(F.col(f.name).try_cast("timestamp").isNotNull().cast("double"))
        else:
            continue
        rows.append(F.struct(F.lit(f.name).alias("column"), frac.alias("parse_frac")))
    table = df.agg(F.count(F.lit(1)).alias("_n"), F.array(*rows).alias("_r")).select(F.inline("_r"))
    return table.withColumn("is_datetime", F.col("parse_frac") > share)


def melted(
    df: DataFrame,
    columns: Sequence[str],
    value: Callable[[str], Column],
    keep: Sequence[str] = (),
    name: str = "feature",
) -> DataFrame:
    """``(keep..., name, v)``: one row per row and column, from one scan of all of them.

    For work that shuffles by value: partial counts per task come before the shuffle.
    """
    cells = F.array(*[F.struct(F.lit(c).alias(name), value(c).alias("v")) for c in columns])
    return df.select(*keep, F.inline(cells))


def as_text(column: str, kind: str) -> Column:
    """A value as text, equal texts for equal values (0.0 and -0.0 are equal)."""
    c = F.col(column)
    return (c + F.lit(0.0) if kind in ("double", "float") else c).cast("string")


def to_digits(x: Column, digits: int) -> Column:
    """Rounding of fixed-point text: by the exact binary value, ties to even.

    The JVM formatter rounds the shortest decimal form half up, so 6.25 would
    print as 6.3. The error of ``x * 10**digits`` is kept to decide near ties.
    Meant for the few rows of a report: the value is bound once, outside of codegen.
    """
    return F.transform(F.array(x), lambda v: _exact_round(v, digits))[0]


def _exact_round(x: Column, digits: int) -> Column:
    p = F.lit(float(10**digits))
    y = x * p
    big = x * F.lit(134217729.0)
    high = big - (big - x)
    error = (high * p - y) + (x - high) * p
    down = F.floor(y).cast("double")
    rest = y - down
    up = (rest > 0.5) | ((rest == 0.5) & ((error > 0) | ((error == 0) & (F.abs(down) % 2 == 1))))
    rounded = F.when(up, down + 1.0).otherwise(down)
    return F.when((rounded == 0) & (x < 0), F.lit(-0.0)).otherwise(rounded / p)


def column_in_message(message: str | Column) -> Column:
    """Text between ``Column '`` and the next quote; NULL when there is none."""
    found = F.regexp_extract(message, "Column '([^']*)'", 1)
    return F.nullif(found, F.lit(""))


def with_abs_error(df: DataFrame, truth: str = "y_true", guess: str = "y_pred") -> DataFrame:
    """Error beside the key columns of the same row (never joined by position)."""
    return df.withColumn("abs_error", F.abs(F.col(truth) - F.col(guess)))


def quality_status(score: str | Column) -> Column:
    score = F.col(score) if isinstance(score, str) else score
    return F.when(score >= 80, "GOOD").when(score >= 50, "MODERATE").otherwise("POOR")


def severity(count: str | Column) -> Column:
    count = F.col(count) if isinstance(count, str) else count
    return F.when(count >= 10, "CRITICAL").when(count >= 5, "HIGH").otherwise("MEDIUM")


def join_list(column: str | Column, separator: str = ", ") -> Column:
    return F.concat_ws(separator, column)


def split_list(column: str | Column, separator: str = ", ") -> Column:
    """Inverse of :func:`join_list`; empty text is an empty list."""
    value = F.col(column) if isinstance(column, str) else column
    parts = F.split(value, F.lit("\\Q" + separator + "\\E"))
    return F.when(value == "", F.array().cast("array<string>")).otherwise(parts)


def rename_and_order(
    df: DataFrame, names: Mapping[str, str], preferred: Sequence[str], sort: Sequence[Column]
) -> DataFrame:
    """Renamed results table in a preferred column order; absent columns are skipped."""
    renamed = df.withColumnsRenamed(dict(names))
    return renamed.select(*[c for c in preferred if c in renamed.columns]).orderBy(*sort)


# Names of a study table and their report names, in report order.
STUDY_NAMES = {
    "number": "trial_id",
    "value": "score",
    "user_attrs_completion_rank": "completion_rank",
    "user_attrs_best_iteration": "best_iteration",
    "params_max_depth": "max_depth",
    "params_eta": "eta",
    "params_subsample": "subsample",
    "params_colsample_bytree": "colsample_bytree",
    "params_lambda": "lambda",
}
STUDY_COLUMNS = [
    "completion_rank",
    "trial_id",
    "score",
    "best_iteration",
    "max_depth",
    "eta",
    "subsample",
    "colsample_bytree",
    "lambda",
]


def study_results(df: DataFrame, sort_by: str = "score", ascending: bool = False) -> DataFrame:
    key = F.col(sort_by).asc() if ascending else F.col(sort_by).desc()
    return rename_and_order(df, STUDY_NAMES, STUDY_COLUMNS, [key, F.col("trial_id")])
