"""Query of the sharder."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwell.llm.catalog import query
from driftwell.llm.sharding import shard_rows
from driftwell.plans.catalog import table

SHARDS = 40


@query("op10_vector_bin_packing")
def vector_bin_packing(spark, sf_dir):
    """Balances bytes first: law ``bytes``."""
    return shard_rows(table(spark, sf_dir, "documents"), SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "tokens",
    )
