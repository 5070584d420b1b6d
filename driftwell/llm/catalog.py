"""Registered queries of this subpackage: one job per operator over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from driftwell.llm.table import bounded_batches
from driftwell.plans.catalog import Job, Query

LLM_QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def register(job: Job) -> Job:
        def run(spark, sf_dir):
            bounded_batches(spark)
            return job(spark, sf_dir)

        if name in LLM_QUERIES:
            raise ValueError(f"query {name} is registered twice")
        LLM_QUERIES[name] = Query(name, "llm", run, sql)
        return job

    return register
