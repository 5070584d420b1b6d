"""A keyed sink that stays merged: one row per key, however many batches have come.

Keys are dealt to a fixed number of buckets. A batch rewrites the buckets that it touches, each to a new folder, and
then commits a manifest (bucket -> folder, and the number of the batch). Readers follow the newest manifest, so they
never see half a batch, and their cost follows the number of keys. A batch that comes again after its commit changes
nothing; one that failed before its commit left folders that no manifest names.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwell.sources.commits import CommitLog

BUCKETS = 64


@dataclass(frozen=True)
class KeyedSnapshot:
    """``keep`` says which row of a key stays: the "last" one, or the "first"."""

    spark: SparkSession
    root: str
    keys: tuple[str, ...]
    schema: T.StructType
    keep: str = "last"
    buckets: int = BUCKETS

    @property
    def log(self) -> CommitLog:
        return CommitLog(self.spark, f"{self.root.rstrip('/')}/manifests")

    def _files(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def read(self) -> DataFrame:
        """One row per key, as of the newest manifest."""
        manifest = self.log.last()[1]
        return self._files(sorted(manifest["folders"].values()) if manifest else [])

    def folders(self) -> dict[str, str]:
        manifest = self.log.last()[1]
        return manifest["folders"] if manifest else {}

    def merge(self, batch: DataFrame, batch_id: int) -> bool:
        """Take up a batch (one row per key at most); False if it was taken up before."""
        _, before = self.log.last()
        if before and before["batch_id"] >= batch_id:
            return False
        held = before["folders"] if before else {}
        columns = self.schema.fieldNames()
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        new = batch.select(*columns).withColumns({"_bucket": bucket, "_age": F.lit(1)})
        touched = [str(r[0]) for r in new.select("_bucket").distinct().collect()]  # one row a bucket
        old = self._files([held[b] for b in touched if b in held]).withColumns({"_bucket": bucket, "_age": F.lit(0)})
        pick = F.max_by if self.keep == "last" else F.min_by
        rest = [c for c in columns if c not in self.keys]
        row = F.struct(*rest) if rest else F.lit(None)
        merged = old.unionByName(new).groupBy("_bucket", *self.keys).agg(pick(row, "_age").alias("_row"))
        folder = f"{self.root.rstrip('/')}/data/{batch_id}-{uuid.uuid4().hex}"
        out = merged.select("_bucket", *[F.col(c) if c in self.keys else F.col(f"_row.{c}").alias(c) for c in columns])
        out.repartition(F.col("_bucket")).write.partitionBy("_bucket").parquet(folder)
        folders = held | {b: f"{folder}/_bucket={b}" for b in touched}

        def commit(_, last):
            if (last or {}).get("batch_id") != (before or {}).get("batch_id"):
                raise RuntimeError("another run writes to this snapshot")
            return {"batch_id": batch_id, "folders": folders}

        self.log.append(commit)
        return True
