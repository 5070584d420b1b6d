"""Query of the periodic runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwell.llm.catalog import query
from driftwell.llm.recompression import word_runs
from driftwell.plans.catalog import table


def planted(words: list[bytes], g: int) -> list[bytes]:
    """From word a = g % n on, the p words that begin there are repeated to the end."""
    n = len(words)
    if not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * -(-(n - a) // p))[: n - a]


def digests(found):
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), -r.start, -r.period)))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start.cast("string"), r.length.cast("string"), r.period.cast("string")))
    best = found.withColumn("best", longest)
    start, length, period = -F.col("best.col2"), F.col("best.length"), -F.col("best.col3")
    text = F.concat(F.concat_ws("\n", lines), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(F.lit(1000) * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.encode(text, "UTF-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"),
    )


@query("op12_recompression_runs")
def recompression_runs(spark, sf_dir):
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.when(h % 10 == 0, F.floor(h / 10))
    return digests(word_runs(table(spark, sf_dir, "documents"), planted, g))
