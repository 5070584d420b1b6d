"""Query of the embedding whitening."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwell.llm.catalog import query
from driftwell.llm.spectra import whitened
from driftwell.plans.catalog import table


@query("op13_incremental_spectra")
def incremental_spectra(spark, sf_dir):
    rows = whitened(table(spark, sf_dir, "embeddings"))
    # a sum beyond 63 bits (some 50 million different vectors) does not fit the column and is null there
    return rows.withColumn("deviation", F.col("deviation").try_cast("long"))
