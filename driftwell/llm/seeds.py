"""Substring dedup by seed and extend.

Seeds are winnowed: of the hashes of ``GRAM`` consecutive words inside a window of ``LENGTH`` words, the
smallest (the first of equals) is the window's anchor, so two equal windows have the same anchor at the same
place and about one gram in seven is kept. Documents are joined on anchors. A match is extended both ways
as far as windows with this anchor can reach: the extent of an occurrence is the union of the windows whose
anchor it is, hashed on both sides of it. Occurrences with equal extents repeat each other wholly, so all
but the first of them are repeats; where one anchor has different extents, the matches end inside them, and
the windows of one occurrence of each extent are compared singly. Overlapping and adjoining repeats are put
together to maximal ones.

Rows leave a document as one per anchor, groups are reduced by aggregation (a text copied a million times
is one row per task), and joins are equi-joins with one row per key on one side, which adaptive execution
can split. Words and windows are compared by 64-bit hashes of anchor and window together.

Defined cases: a null text has no words; documents are ordered by id (null first), then text hash; repeated
rows are one document and get equal results; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwell.llm.blocks import Words, constants, flat, mix64, sliding_argmin, spans_to_mask, window_hashes
from driftwell.llm.table import per_batch, texts
from driftwell.session import pin

LENGTH = 20
GRAM = 8
U = np.uint64
_LOW, _HIGH, _SHAPE = constants("extent", 3)


class Anchored:
    """Words of a batch with the hash of every window and the anchor of every window."""

    def __init__(self, column: pa.Array):
        words = Words(*flat(column))
        self.first = words.first
        hashes = words.hashes()
        self.windows = window_hashes(hashes, LENGTH, "window")
        self.grams = window_hashes(hashes, GRAM, "gram")
        self.doc = np.repeat(np.arange(len(column)), words.counts())

    def extents(self) -> tuple[np.ndarray, ...]:
        """Document index, anchor place, first and last window start, anchor hash and extent hash."""
        place = sliding_argmin(self.grams, LENGTH - GRAM + 1)
        n = len(self.windows)
        start = np.flatnonzero(self.doc[:n] == self.doc[LENGTH - 1 :]) if n else np.empty(0, np.int64)
        anchor, doc = place[start], self.doc[start]
        begin = np.ones(len(start), bool)
        begin[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(begin)
        low, high = start[at], start[np.append(at[1:], len(start)) - 1] if len(at) else start[at]
        anchor, doc = anchor[at], doc[at]
        shape = ((high - low) << 8 | (anchor - low)).astype(U)
        extent = mix64(self.windows[low] * _LOW + self.windows[high] * _HIGH + shape * _SHAPE)
        return doc, anchor, low, high, self.grams[anchor], extent


def _seed_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    found = Anchored(batch.column(1))
    doc, anchor, low, high, gram, extent = found.extents()
    at = (anchor - found.first[doc]) << 16 | (anchor - low) << 8 | (anchor - high)
    key = batch.column(0).take(pa.array(doc))
    arrays = [key, pa.array(at), pa.array(gram.view(np.int64)), pa.array(extent.view(np.int64))]
    return pa.RecordBatch.from_arrays(arrays, names=["k", "at", "anchor", "extent"])


def _window_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Single windows of the extents asked for."""
    found = Anchored(batch.column(1))
    doc = pc.list_parent_indices(batch.column(2)).to_numpy()
    asked = pc.list_flatten(batch.column(2))
    at, gram = asked.field("at").to_numpy(), asked.field("anchor").to_numpy()
    low = (at >> 16) - (at >> 8 & 255)
    count = (at >> 8 & 255) - (at & 255) + 1
    which = np.repeat(np.arange(len(at)), count)
    start = low[which] + np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    window = found.windows[found.first[doc[which]] + start]
    key = batch.column(0).take(pa.array(doc[which]))
    arrays = [key, pa.array(start), pa.array(gram[which]), pa.array(window.view(np.int64))]
    return pa.RecordBatch.from_arrays(arrays, names=["k", "start", "anchor", "window"])


def _schema(key: T.DataType, *columns: str) -> T.StructType:
    return T.StructType([T.StructField("k", key), *[T.StructField(c, T.LongType()) for c in columns]])


def keyed(docs: DataFrame) -> DataFrame:
    return texts(docs).select(F.struct("doc_id", "th").alias("k"), "text")


def repeats(rows: DataFrame) -> DataFrame:
    """``k, start, end``: word spans of ``rows`` (k, text) that repeat an earlier one, at least ``LENGTH`` long."""
    key = rows.schema["k"].dataType
    seeds = rows.mapInArrow(per_batch(lambda: _seed_rows), _schema(key, "at", "anchor", "extent"))
    # seed: join on anchors that occur again
    counted = seeds.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    hits = pin(seeds.join(pin(counted, "anchors"), "anchor", "left_semi"), "hits")
    # extend: equal extents repeat each other wholly
    first = F.min(F.struct("k", "at")).alias("first")
    extents = pin(hits.groupBy("anchor", "extent").agg(first, F.count(F.lit(1)).alias("n")), "extents")
    copies = hits.join(extents.where("n > 1"), ["anchor", "extent"]).where(F.struct("k", "at") != F.col("first"))
    low = F.shiftright("at", 16) - F.shiftright("at", 8).bitwiseAND(255)
    high = F.shiftright("at", 16) - F.col("at").bitwiseAND(255)
    whole = copies.select("k", low.alias("start"), (high + LENGTH).alias("end"))
    # extents that differ around one anchor: compare their windows
    differ = extents.groupBy("anchor").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("anchor")
    ends = extents.join(differ, "anchor", "left_semi").select("first.k", F.struct("anchor", "first.at").alias("seed"))
    ends = ends.groupBy("k").agg(F.collect_list("seed").alias("seeds"))  # of one document
    windows = rows.join(ends, "k").mapInArrow(
        per_batch(lambda: _window_rows), _schema(key, "start", "anchor", "window")
    )
    windows = pin(windows.distinct(), "windows")
    earliest = windows.groupBy("anchor", "window").agg(
        F.min(F.struct("k", "start")).alias("first"), F.count(F.lit(1)).alias("n")
    )
    later = windows.join(earliest.where("n > 1"), ["anchor", "window"]).where(F.struct("k", "start") != F.col("first"))
    return whole.union(later.select("k", "start", (F.col("start") + LENGTH).alias("end")))


def _keep_words(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Per text: numbers of words and of removed ones, maximal spans, and the kept words joined by a blank."""
    data, offsets = flat(batch.column(1))
    words = Words(data, offsets)
    counts = words.counts()
    spans = batch.column(2)
    doc = pc.list_parent_indices(spans).to_numpy()
    flat_spans = pc.list_flatten(spans)
    base = words.first[doc]
    gone = spans_to_mask(
        len(words.start), base + flat_spans.field("start").to_numpy(), base + flat_spans.field("end").to_numpy()
    )
    raw, start, end, keep = data.tobytes(), words.start, words.end, ~gone
    removed, kept, runs = np.zeros(len(counts), np.int64), [], []
    for i, n in enumerate(counts.tolist()):
        a = words.first[i]
        mine = np.flatnonzero(keep[a : a + n]) + a
        removed[i] = n - len(mine)
        kept.append(b" ".join([raw[x:y] for x, y in zip(start[mine].tolist(), end[mine].tolist(), strict=True)]).decode())
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone[a : a + n].view(np.int8), [0]])))
        runs.append([{"start": int(x), "end": int(y)} for x, y in zip(edge[::2], edge[1::2], strict=True)])
    arrays = [batch.column(0), pa.array(counts), pa.array(removed), pa.array(kept, pa.string())]
    arrays.append(pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))))
    return pa.RecordBatch.from_arrays(arrays, names=["k", "n_words", "n_removed", "kept", "spans"])


def without_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept, spans``: every document without the words that repeat earlier ones,
    and the maximal spans of word places that went."""
    rows = keyed(docs)
    spans = repeats(rows).groupBy("k").agg(F.collect_list(F.struct("start", "end")).alias("spans"))  # of one document
    spans = pin(spans, "spans")
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    joined = rows.join(spans, "k", "left").select("k", "text", F.coalesce("spans", none).alias("spans"))
    schema = T.StructType([
        T.StructField("k", rows.schema["k"].dataType),
        T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("kept", T.StringType()),
        T.StructField("spans", spans.schema["spans"].dataType),
    ])
    return joined.mapInArrow(per_batch(lambda: _keep_words), schema).select(
        F.col("k.doc_id").alias("doc_id"), "n_words", "n_removed", "kept", "spans"
    )
