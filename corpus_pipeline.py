"""From documents to training tokens: five stages, each over all that the one before kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a frame that is written as Parquet and read again as
the ``docs`` of the next one. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwell.llm.bagminhash import deduplicated
from driftwell.llm.bpe import encode_texts
from driftwell.llm.bwt import cleaned_documents
from driftwell.llm.mixing import mixed_documents
from driftwell.llm.neighbours import kept_documents
from driftwell.llm.q_bpe import VOCABULARY
from driftwell.llm.table import bounded_batches
from driftwell.plans.catalog import Query, table
from driftwell.session import pin


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest-neighbour classifier rejects go."""
    bounded_batches(spark)
    return kept_documents(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays, the one of the smallest id."""
    bounded_batches(spark)
    return deduplicated(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every byte inside a string of 200 bytes that occurs again goes; texts of which nothing stays go too."""
    bounded_batches(spark)
    return _measured(cleaned_documents(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes: a row for each pass over a document that takes some of it."""
    bounded_batches(spark)
    return _measured(mixed_documents(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` (packed) and the digest of the text that they decode to."""
    bounded_batches(spark)
    return encode_texts(docs, VOCABULARY).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_dedup),
    ("suffix-array dedup", substring_dedup),
    ("mixing sources to target weights", mix),
    ("BPE encoding and decoding", tokens),
]
ORACLE_SQL = None  # votes, signatures, draws and merges have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERY = Query("pipeline", "llm", run, ORACLE_SQL)
