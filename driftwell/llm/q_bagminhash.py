"""Query of the near-duplicate finder."""

from __future__ import annotations

from driftwell.llm.bagminhash import near_duplicates
from driftwell.llm.catalog import query
from driftwell.plans.catalog import table


@query("op4_bagminhash")
def bagminhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents")).drop("th")
