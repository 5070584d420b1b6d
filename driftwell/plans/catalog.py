"""Registered queries: a Spark job over the supplied tables, with SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Job = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    items: str
    job: Job
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, items: str, sql: str | None = None) -> Callable[[Job], Job]:
    """Register a job under ``name``; ``items`` are the inventory ids it covers."""

    def register(job: Job) -> Job:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return job(spark, sf_dir)

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, items, run, sql)
        return job

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
