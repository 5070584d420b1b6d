"""Session settings and durable intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "driftwell", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings every job here expects (UTC, AQE, Arrow)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for written intermediates.

    Taken from ``spark.checkpoint.dir``. Only a local master may fall back to a
    temporary folder; on a cluster an unset value is an error, because a folder
    of one machine is lost with that machine.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if path:
        return path
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    path = tempfile.mkdtemp(prefix="driftwell-")
    spark.conf.set(CHECKPOINT_CONF, path)
    return path


def pin(df: DataFrame, name: str = "table", **options: object) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage durably: a lost executor re-reads files instead of
    recomputing, and values that are not repeatable become fixed.
    ``options`` are those of Spark's writer.
    """
    return pin_at(df, name, **options)[0]


def pin_at(df: DataFrame, name: str = "table", **options: object) -> tuple[DataFrame, str]:
    """What :func:`pin` gives, and the folder, for :func:`unpin`."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _PINNED.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def unpin(spark: SparkSession, path: str) -> None:
    """Removes one folder of :func:`pin_at`; nothing may read it any more."""
    _PINNED[spark.sparkContext.applicationId].remove(path)
    _remove(spark, [path])


_PINNED: dict[str, list[str]] = {}  # application -> folders that pin wrote


def release_pins(spark: SparkSession) -> int:
    """Removes all that :func:`pin` wrote in this application, and gives the number of folders. To be called after the
    results that read them are written; frames made before that cannot be read any more."""
    paths = _PINNED.pop(spark.sparkContext.applicationId, [])
    _remove(spark, paths)
    return len(paths)


def _remove(spark: SparkSession, paths: list[str]) -> None:
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for text in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(text)
        path.getFileSystem(conf).delete(path, True)
