"""Query of the document fingerprints."""

from __future__ import annotations

from driftwell.llm.catalog import query
from driftwell.llm.fingerprints import with_neighbours
from driftwell.plans.catalog import table


@query("op2_prefix_hash_fingerprints")
def prefix_hash_fingerprints(spark, sf_dir):
    return with_neighbours(table(spark, sf_dir, "documents"))
