"""Query of the quality classifier."""

from __future__ import annotations

from driftwell.llm.catalog import query
from driftwell.llm.neighbours import verdicts
from driftwell.plans.catalog import table


@query("op9_neighbour_votes")
def neighbour_votes(spark, sf_dir):
    return verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
