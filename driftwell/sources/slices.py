"""Slices of trips, sharded tables, zones, logs: reading."""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwell.functions.columns import DROPOFF, PICKUP, normalise_missing
from driftwell.functions.text import tokens

SLICE_NAME = "green_tripdata_{year}-{month}.parquet"  # fixed value: file name of a month


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def load_slice(spark: SparkSession, path: str, times: Sequence[str] = (PICKUP, DROPOFF), schema: str | T.StructType | None = None) -> DataFrame:
    """A parquet or CSV slice by suffix, times coerced, NaN as NULL. With ``schema`` a CSV is read once; without it
    a first pass finds the types."""
    if not _exists(spark, path):
        raise FileNotFoundError(f"Missing data file: {path}")
    suffix = PurePosixPath(path).suffix.lower()
    if suffix == ".parquet":
        df = spark.read.parquet(path)
    elif suffix == ".csv":
        df = spark.read.csv(path, header=True, schema=schema) if schema else spark.read.csv(path, header=True, inferSchema=True)
    else:
        raise ValueError(f"Unsupported file type: {suffix} (expected .parquet or .csv)")
    text = [c for c in times if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)]
    df = df.withColumns({c: F.col(c).try_cast("timestamp_ntz") for c in text}) if text else df
    return normalise_missing(df)


def slice_path(spark: SparkSession, folder: str, month: str, year: str = "2020") -> str:
    path = f"{folder.rstrip('/')}/{SLICE_NAME.format(year=year, month=month)}"
    if not _exists(spark, path):
        raise FileNotFoundError(f"No slice at {path}")
    return path


def load_month(spark: SparkSession, folder: str, month: str, year: str = "2020") -> DataFrame:
    return load_slice(spark, slice_path(spark, folder, month, year))


def load_months(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Several slices in one scan; ``month`` is the last two characters of the file stem."""
    present = [p for p in paths if _exists(spark, p)]
    if not present:
        raise FileNotFoundError("No slice files were found.")
    df = spark.read.option("mergeSchema", "true").parquet(*present)
    # the folder is the parent when a slice was written as a directory of part files
    name = F.regexp_extract(F.input_file_name(), r"([^/]+)\.parquet(?:/[^/]*)?$", 1)
    return normalise_missing(df).withColumn("month", F.right(name, F.lit(2)))


def load_shards(spark: SparkSession, folder: str, partitions: int | None = None) -> DataFrame:
    """A sharded parquet table. Scan splits are Spark's; ``partitions`` forces a shuffle, so ask only if needed."""
    df = spark.read.parquet(folder)
    return df.repartition(partitions) if partitions else df


def load_corpus(spark: SparkSession, path: str) -> DataFrame:
    """One document per non-empty line, as ``doc array<string>``; no document at all is an error."""
    docs = spark.read.text(path).where(F.trim("value") != "").select(tokens("value").alias("doc"))
    if docs.isEmpty():
        raise ValueError(f"No tokenized documents found in {path}")
    return docs


def zone_dimension(raw: DataFrame) -> DataFrame:
    """Distinct zones with usable names and a numeric id."""
    names = {"locationid": "LocationID", "zone": "Zone", "borough": "Borough"}
    df = raw.withColumnsRenamed({c: names[c.lower()] for c in raw.columns if c.lower() in names})
    keep = [c for c in ("LocationID", "Zone", "Borough") if c in df.columns]
    return df.select(*[F.col(c).try_cast("bigint").alias(c) if c == "LocationID" else F.col(c) for c in keep]).dropDuplicates()


def load_zones(spark: SparkSession, csv: str | None = None, geojson: str | None = None) -> DataFrame:
    """Zone table from CSV, or from the ``properties`` of a GeoJSON when there is no CSV."""
    if csv and _exists(spark, csv):
        return zone_dimension(spark.read.csv(csv, header=True))
    if geojson and _exists(spark, geojson):
        features = spark.read.json(geojson, multiLine=True).select(F.explode("features").alias("f"))
        return zone_dimension(features.select("f.properties.*"))
    raise FileNotFoundError("No zone lookup found.")


def load_labelled(spark: SparkSession, path: str, features: Sequence[str], label: str = "y", kind: str = "double") -> DataFrame:
    fields = ", ".join(f"{c} double" for c in features) + f", {label} {kind}"
    return normalise_missing(spark.read.csv(path, header=True, schema=fields))


# ---- logs -------------------------------------------------------------------

CHECK_FIELDS = (
    "schema_missing_cols double, schema_bad_family_dtypes double, duplicate_rows_frac double, missing_frac_max double, "
    "range_worst_bad_frac double, domain_worst_bad_frac double, duration_over_6h_frac double"
)
DECISION_SCHEMA = (
    "step string, run_id string, run_name string, timestamp string, hard_rules_passed boolean, "
    "hard_failures array<string>, drift_warnings array<string>, drift_columns array<string>, "
    f"additional_checks_summary struct<{CHECK_FIELDS.replace(' double', ': double')}>, "
    "integrity_passed boolean, integrity_warn boolean, action string"
)


def parse_decisions(lines: DataFrame, value: str = "value", warnings_field: str = "drift_warnings") -> DataFrame:
    """Decision records from JSON text, one row per readable record.

    Unreadable or empty records are kept out by ``skipped`` = true, so that they
    can be counted; the rest carry list sizes and a real timestamp.
    """
    layout = DECISION_SCHEMA.replace("drift_warnings", warnings_field)
    parsed = lines.withColumn("_d", F.from_json(value, layout + ", _bad string", {"columnNameOfCorruptRecord": "_bad"}))
    d = lambda c: F.col(f"_d.{c}")
    empty = F.array().cast("array<string>")
    lists = {c: F.coalesce(d(s), empty) for c, s in (("drift_columns", "drift_columns"), ("hard_failures", "hard_failures"), ("drift_warnings", warnings_field))}
    skipped = F.col("_d").isNull() | d("_bad").isNotNull() | d("step").isNull()
    rest = [c for c in lines.columns if c != value]
    run_id = F.col("run_id") if "run_id" in rest else d("run_id")
    return parsed.select(
        *[c for c in rest if c not in ("run_id", "run_name")],
        run_id.alias("run_id"),
        F.coalesce(F.col("run_name") if "run_name" in rest else d("run_name"), F.substring(run_id, 1, 8)).alias("run_name"),
        d("timestamp").try_cast("timestamp_ntz").alias("timestamp"),
        F.size(lists["drift_warnings"]).alias("num_warnings"),
        F.size(lists["hard_failures"]).alias("num_hard_failures"),
        *[v.alias(k) for k, v in lists.items()],
        F.coalesce(d("integrity_passed"), F.lit(False)).alias("integrity_passed"),
        F.coalesce(skipped, F.lit(True)).alias("skipped"),
    )


def load_decisions(spark: SparkSession, path: str, warnings_field: str = "drift_warnings") -> DataFrame:
    """Readable decision records of a folder of JSON lines, in time order."""
    return parse_decisions(spark.read.text(path), warnings_field=warnings_field).where("not skipped").orderBy("timestamp", "run_id")


RANK_LINE = (
    r"rank (\d+): profiled_steps=(\d+), profiled_images=(\d+), "
    r"avg_profiled_step_time=([0-9.]+)s, loss=([0-9.]+)"
)


def parse_rank_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Rank summaries from training-log lines; other lines are passed over."""
    part = lambda i: F.regexp_extract(value, RANK_LINE, i)
    hits = lines.where(F.col(value).rlike(RANK_LINE))
    rest = [c for c in lines.columns if c != value]
    steps, step_time = part(2).cast("int"), part(4).cast("double")
    return hits.select(
        *rest,
        part(1).cast("int").alias("rank"),
        steps.alias("profiled_steps"),
        part(3).cast("bigint").alias("profiled_images"),
        step_time.alias("avg_step_seconds"),
        (step_time * steps).alias("profiled_seconds"),
        part(5).cast("double").alias("loss"),
    )


def load_rank_logs(spark: SparkSession, path: str) -> DataFrame:
    name = F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1)
    return parse_rank_lines(spark.read.text(path).withColumn("run", name))
