"""Session settings and small frame helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"

Batches = Iterator[pa.RecordBatch]


def bounded_batches(spark: SparkSession, rows: int = 1000, size: str = "4m") -> None:
    """Bound what a Python worker holds at a time, and drop shuffle files once a write has ended."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` (null: empty) and ``th``, a hash of the text.

    ``(doc_id, th)`` names a document in every later step, so equal rows get equal results and
    two texts under one id stay apart. Other columns are left out, whatever their names are.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id"), text.alias("text"), F.xxhash64(text).alias("th"))


def word_count(text: str | Column) -> Column:
    return F.regexp_count(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), F.lit(WORD)).cast("long")


def per_batch(make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]]) -> Callable[[Batches], Batches]:
    """A function for ``mapInArrow``: ``make`` runs once per task, its result once per batch."""

    def run(batches: Batches) -> Batches:
        each = make()
        for batch in batches:
            if batch.num_rows and (out := each(batch)) is not None and out.num_rows:
                yield out

    return run
