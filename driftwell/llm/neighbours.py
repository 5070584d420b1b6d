"""Quality classifier: a similarity-weighted vote of the nearest labelled documents.

Every text becomes a vector of byte-trigram counts (hashed) and a few repetition counts, weighted by rarity
and projected on the leading singular directions of the labelled sample (latent semantic vectors of unit
length). The labelled vectors are broadcast; each batch of texts is multiplied with all of them, so the
cosines are exact, and the ``NEIGHBOURS`` nearest vote with weights that grow with the cosine.

The sample holds at most ``MAX_LABELLED`` labelled rows that have a text, the first by a hash of the id, so the model is of
bounded size whatever the corpus holds. The score uses the text only.

Defined cases: a null or empty text, and any text when there are no labels, gets the share of label 1 in
the sample (1 without labels); labels of rows without text or with a null label are not used; of several
labels of one id the smallest counts; repeated rows give repeated results; an empty table gives an empty result;
a very long text is counted like any other; of labelled texts that are equally near at the last place any may vote,
so the scores of equal texts may differ by some 1e-6 from batch to batch; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwell.llm.blocks import Words, flat
from driftwell.llm.table import per_batch

HASHED = 2048
EXTRA = 3
TERMS = HASHED + EXTRA
ROWS_AT_ONCE = 256
DIMENSIONS = 64
NEIGHBOURS = 15
MAX_LABELLED = 4096
FOLDS = 5
THRESHOLD = 0.3
SHARPNESS = 4
SEED = 11


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``FOLDS``; 0 is held out."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS


def term_counts(column: pa.Array) -> np.ndarray:
    """Counts of hashed byte trigrams, of words equal to the one before or the one before that, and of words."""
    data, offsets = flat(column)
    n = len(offsets) - 1
    out = np.zeros((n, TERMS), np.float32)
    if len(data) >= 3:
        code = data[:-2].astype(np.uint32) << 16 | data[1:-1].astype(np.uint32) << 8 | data[2:]
        term = (code * np.uint32(2654435761)) >> np.uint32(21)  # the top 11 bits
        doc = np.repeat(np.arange(n), np.diff(offsets))
        whole = doc[:-2] == doc[2:]
        counts = np.bincount(doc[:-2][whole] * HASHED + term[whole], minlength=n * HASHED)
        out[:, :HASHED] = counts.reshape(n, HASHED)
    words = Words(data, offsets)
    hashes, doc = words.hashes(), np.repeat(np.arange(n), words.counts())
    for step in (1, 2):
        if len(hashes) > step:
            again = (hashes[step:] == hashes[:-step]) & (doc[step:] == doc[:-step])
            out[:, HASHED + step - 1] = np.bincount(doc[step:][again], minlength=n)
    out[:, HASHED + 2] = words.counts()
    return out


def weighted(counts: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Damped shares of the terms, times rarity, at unit length."""
    x = counts.copy()  # the only copy: all that follows is done in place, some rows at a time
    x[:, :HASHED] /= np.maximum(counts[:, :HASHED].sum(axis=1, keepdims=True), 1)
    x[:, HASHED:-1] /= np.maximum(counts[:, -1:], 1)
    x[:, -1] = 0
    np.sqrt(x, out=x)
    x *= rarity
    for at in range(0, len(x), ROWS_AT_ONCE):
        some = x[at : at + ROWS_AT_ONCE]
        some /= np.maximum(np.linalg.norm(some, axis=1, keepdims=True), 1e-12)
    return x


class Model:
    """Rarity weights, singular directions, and the labelled vectors with their labels."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray):
        n = len(labels)
        self.prior = float(labels.mean()) if n else 1.0
        self.labels = labels.astype(np.float32)
        self.rarity = (np.log((1 + n) / (1 + (counts > 0).sum(axis=0))) + 1).astype(np.float32)
        x = weighted(counts, self.rarity)
        self.directions = self.leading(x) if n else np.zeros((TERMS, 0), np.float32)
        self.vectors = self.project(x)

    @staticmethod
    def leading(x: np.ndarray) -> np.ndarray:
        """Leading right singular directions by subspace iteration."""
        k = min(DIMENSIONS, *x.shape)
        q = np.random.Generator(np.random.Philox(SEED)).standard_normal((x.shape[1], k)).astype(np.float32)
        for _ in range(8):
            q, _ = np.linalg.qr(x.T @ (x @ q))
        return q.astype(np.float32)

    def project(self, x: np.ndarray) -> np.ndarray:
        z = x @ self.directions
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        out = np.full(len(counts), self.prior)
        seen = np.flatnonzero(counts.any(axis=1))
        if not len(seen) or not len(self.labels):
            return out
        near = self.project(weighted(counts[seen], self.rarity)) @ self.vectors.T
        k = min(NEIGHBOURS, near.shape[1])
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(near, best, axis=1), 1e-6) ** SHARPNESS
        out[seen] = (weight * self.labels[best]).sum(axis=1) / weight.sum(axis=1)
        return np.clip(out, 0, 1).round(6)


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """At most ``MAX_LABELLED`` rows ``text, label`` outside the held-out fold."""
    rows = labels.where(F.col("quality").isNotNull() & (fold() != 0))
    rows = rows.groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    rows = rows.join(texts.select("doc_id"), "doc_id", "left_semi")
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    return texts.join(F.broadcast(rows), "doc_id").select("doc_id", "text", "label")


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of a bounded sample; sparse term counts of the sample come to the driver."""

    def counted(batch: pa.RecordBatch) -> pa.RecordBatch:
        packed = [row.tobytes() for row in term_counts(batch.column(1)).astype("<u4")]
        arrays = [batch.column(0), batch.column(2), pa.array(packed, pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "label", "counts"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, label int, counts binary"
    got = labelled_sample(docs, labels).mapInArrow(per_batch(lambda: counted), schema)
    # repeated rows could exceed the bound: one row for each id
    got = got.groupBy("doc_id").agg(F.min(F.struct("label", "counts")).alias("r")).orderBy("doc_id").toArrow()
    counts, labels, at = np.empty((got.num_rows, TERMS), np.float32), np.empty(got.num_rows), 0
    for batch in got.to_batches(ROWS_AT_ONCE):  # few rows at a time: the driver holds the counts once
        r = batch.column("r")
        counts[at : at + len(r)] = np.frombuffer(b"".join(r.field("counts").to_pylist()), "<u4").reshape(-1, TERMS)
        labels[at : at + len(r)] = r.field("label").to_numpy(zero_copy_only=False)
        at += len(r)
    del got
    return Model(counts, labels)


def scored(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct(*keep).alias("row"), F.col("text").alias("text"))

    def make():
        judge = shared.value

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            score = judge.scores(term_counts(batch.column(1)))
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["row", "score"])

        return each

    schema = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(per_batch(make), schema).select("row.*", "score")


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""
    return scored(docs, fit(docs, labels)).select(
        "doc_id",
        F.coalesce(fold() == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with the columns they came with."""
    columns = docs.columns
    rows = docs.select(F.struct(*columns).alias("own"), F.col("doc_id"), F.col("text"))
    kept = scored(rows, fit(docs, labels), ("own",)).where(F.col("score") >= THRESHOLD)
    return kept.select(*[F.col("own")[c].alias(c) for c in columns])
