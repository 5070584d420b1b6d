"""Query of the source mixer."""

from __future__ import annotations

from driftwell.llm.catalog import query
from driftwell.llm.mixing import taken_words
from driftwell.plans.catalog import table


@query("op7_multinomial_block_mix")
def multinomial_block_mix(spark, sf_dir):
    return taken_words(table(spark, sf_dir, "documents"))
