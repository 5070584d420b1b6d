"""Substring dedup by merging shard Burrows-Wheeler transforms.

A transform over every byte of a corpus would move each byte many times. Here it is sparse: suffixes are
sampled at content-defined anchors (the smallest hash of ``GRAM`` bytes inside a window of ``LENGTH``
bytes, the first of equals), so each string of ``LENGTH`` bytes holds the anchor it belongs to, at the same
place wherever it occurs, and its suffix is reached from the anchor's by stepping left. Intervals of the
merged order of all shards are refined from coarse to fine, and only those still open go on:

1. the anchor: intervals of one suffix hold no repeat and end here (counted per shard, then added up);
2. the extent, all strings that belong to an occurrence of the anchor: intervals of two or more repeat
   wholly; an anchor with one extent only ends here;
3. bytes: of each different extent of an anchor one suffix is taken, with the bytes that follow and
   precede it. Each batch of documents lists its own in order (its transform); tasks gather the lists of all
   shards by anchor and refine the intervals of the merged order eight bytes at a time, which gives common
   prefixes and repeated intervals (see ``interleave``). The order inside a list is not kept by the shuffle, so
   an interval that is still open is sorted by its next eight bytes; settled suffixes are not touched again.

An anchor with more than ``GROUP_ROWS`` different extents is too much for one task: its strings are
counted by hash in Spark instead, with the same result. Anchors, extents and strings are compared by
64-bit hashes of anchor and extent (or string) together; step 3 compares bytes.

Defined cases: a null text is empty; matches never cross documents; repeated rows are one document, so
a row that only repeats another row, id included, is not removed for that; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwell.llm.blocks import constants, flat, mix64, sliding_argmin, spans_to_mask
from driftwell.llm.interleave import repeated_offsets
from driftwell.llm.table import per_batch, texts
from driftwell.session import pin

LENGTH = 200
GRAM = 56
REACH = LENGTH - GRAM
GROUP_ROWS = 50_000
CHUNK_ROWS = 50_000

U = np.uint64
_WORD = constants("bytes", LENGTH // 8)
_LOW, _HIGH, _SHAPE = constants("byte extent", 3)


class Anchored:
    """Bytes of a batch with the hashes of all grams."""

    def __init__(self, column: pa.Array):
        self.data, self.offsets = flat(column)
        if len(self.data) < LENGTH:
            self.words = self.grams = np.empty(0, U)
            return
        x = self.data.astype(U)
        for width in (1, 2, 4):
            x = x[:-width] | (x[width:] << U(8 * width))
        self.words = x  # the eight bytes from each place on
        n = len(x) - GRAM + 8
        total = np.zeros(n, U)
        for j in range(GRAM // 8):
            total += x[8 * j : 8 * j + n] * _WORD[j]
        self.grams = mix64(total)

    def strings(self, at: np.ndarray) -> np.ndarray:
        """Hashes of the strings of ``LENGTH`` bytes from ``at`` on."""
        total = np.zeros(len(at), U)
        for j in range(LENGTH // 8):
            total += self.words[at + 8 * j] * _WORD[j]
        return mix64(total)

    def extents(self) -> tuple[np.ndarray, ...]:
        """Text index, anchor place, first and last string start, anchor hash and extent hash."""
        inside = np.ones(len(self.data), bool)
        for a, b in zip(self.offsets[:-1].tolist(), self.offsets[1:].tolist(), strict=True):
            inside[max(a, b - LENGTH + 1) : b] = False
        start = np.flatnonzero(inside)
        anchor = sliding_argmin(self.grams, REACH + 1)[start] if len(start) else start
        begin = np.ones(len(start), bool)
        begin[1:] = anchor[1:] != anchor[:-1]
        at = np.flatnonzero(begin)
        low, high = start[at], start[np.append(at[1:], len(start)) - 1] if len(at) else start[at]
        anchor = anchor[at]
        doc = np.searchsorted(self.offsets, anchor, side="right") - 1
        shape = ((high - low) << 8 | (anchor - low)).astype(U)
        extent = mix64(self.strings(low) * _LOW + self.strings(high) * _HIGH + shape * _SHAPE)
        return doc, anchor, low, high, self.grams[anchor], extent


def _sampled(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The sampled suffixes of a batch: ``at`` holds the anchor's place and how far its strings reach left."""
    found = Anchored(batch.column(1))
    doc, anchor, low, high, gram, extent = found.extents()
    at = (anchor - found.offsets[doc]) << 16 | (anchor - low) << 8 | (anchor - high)
    key = batch.column(0).take(pa.array(doc))
    arrays = [key, pa.array(at), pa.array(gram.view(np.int64)), pa.array(extent.view(np.int64))]
    return pa.RecordBatch.from_arrays(arrays, names=["k", "at", "anchor", "extent"])


def _around(data: np.ndarray, first: np.ndarray, count: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """``count`` bytes from each ``first`` on, each raised by one; 0 outside of low .. high (excluded).

    Raised bytes stay below 256: no UTF-8 text holds the byte 255."""
    at = first[:, None] + np.arange(count)
    good = (at >= low[:, None]) & (at < high[:, None])
    out = data[np.clip(at, 0, max(len(data) - 1, 0))] + np.uint8(1)
    out[~good] = 0
    return out


def _transform(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The transform of a shard: the suffixes asked for, in the order of what follows, with what precedes them."""
    data, offsets = flat(batch.column(1))
    doc = pc.list_parent_indices(batch.column(2)).to_numpy()
    asked = pc.list_flatten(batch.column(2))
    at, anchor = asked.field("at").to_numpy(), asked.field("anchor").to_numpy()
    place = offsets[doc] + (at >> 16)
    after = _around(data, place, LENGTH, offsets[doc], offsets[doc + 1])
    before = _around(data, place - REACH, REACH, offsets[doc], offsets[doc + 1])[:, ::-1]
    symbols = np.ascontiguousarray(after).view(">u8")
    order = np.lexsort((*symbols.T[::-1], anchor))
    key = batch.column(0).take(pa.array(doc[order]))
    pack = lambda x: pa.array([r.tobytes() for r in x[order]], pa.binary())
    arrays = [key, asked.take(pa.array(order)).field("whole"), pa.array(at[order]), pa.array(anchor[order])]
    arrays += [pack(np.ascontiguousarray(after)), pack(np.ascontiguousarray(before))]
    return pa.RecordBatch.from_arrays(arrays, names=["k", "whole", "at", "anchor", "after", "before"])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def _merged(table: pa.Table) -> pa.RecordBatch | None:
    """Spans of the strings that two or more of the suffixes of whole groups (in order) have in common."""
    table = table.combine_chunks()
    anchor, at = table.column("anchor").to_numpy(), table.column("at").to_numpy()
    group = np.concatenate([[0], np.cumsum(anchor[1:] != anchor[:-1])])
    after, before = _matrix(table.column("after"), LENGTH), _matrix(table.column("before"), REACH)
    row, step = repeated_offsets(group, after, before, at & 255, at >> 8 & 255, LENGTH)
    new = ~table.column("whole").to_numpy()[row]  # the others are known to repeat
    return _spans(table.column("k").combine_chunks(), at, row[new], step[new])


def _spans(key: pa.Array, at: np.ndarray, row: np.ndarray, step: np.ndarray) -> pa.RecordBatch | None:
    """One span for each run of neighbouring strings of a row."""
    if not len(row):
        return None
    order = np.lexsort((step, row))
    row, step = row[order], step[order]
    begin = np.ones(len(row), bool)
    begin[1:] = (row[1:] != row[:-1]) | (step[1:] != step[:-1] + 1)
    first = np.flatnonzero(begin)
    last = np.append(first[1:], len(row)) - 1
    place = at[row[first]] >> 16
    if isinstance(key, pa.ChunkedArray):
        key = key.combine_chunks()
    arrays = [key.take(pa.array(row[first])), pa.array(place - step[last]), pa.array(place - step[first] + LENGTH)]
    return pa.RecordBatch.from_arrays(arrays, names=["k", "start", "end"])


def _merge_groups(batches):
    """Gathers whole groups of a partition sorted by anchor, and merges some groups at a time."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < CHUNK_ROWS:
            continue
        table = pa.Table.from_batches(held)
        anchor = table.column("anchor").to_numpy()
        cut = int(np.argmax(anchor == anchor[-1]))  # the last group may go on
        if cut:
            if (out := _merged(table.slice(0, cut))) is not None:
                yield out
            held = table.slice(cut).combine_chunks().to_batches()
            rows = len(table) - cut
    if rows and (out := _merged(pa.Table.from_batches(held))) is not None:
        yield out


def _strings(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Hash of each single string of the suffixes of very large groups."""
    at = batch.column("at").to_numpy()
    after, before = _matrix(batch.column("after"), LENGTH), _matrix(batch.column("before"), REACH)
    both = np.ascontiguousarray(np.concatenate([before[:, ::-1], after], axis=1))
    count = (at >> 8 & 255) - (at & 255) + 1
    row = np.repeat(np.arange(len(at)), count)
    step = (at & 255)[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    words = np.lib.stride_tricks.sliding_window_view(both, 8, axis=1)
    total = np.zeros(len(row), U)
    for j in range(LENGTH // 8):
        eight = np.ascontiguousarray(words[row, REACH - step + 8 * j]).view("<u8").ravel()
        total += eight.astype(U) * _WORD[j]
    pick = pa.array(row)
    arrays = [batch.column("k").take(pick), batch.column("whole").take(pick), pa.array((at >> 16)[row] - step)]
    arrays += [batch.column("anchor").take(pick), pa.array(mix64(total).view(np.int64))]
    return pa.RecordBatch.from_arrays(arrays, names=["k", "whole", "start", "anchor", "string"])


def _schema(key: T.DataType, **columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("k", key), *[T.StructField(c, t) for c, t in columns.items()]])


def repeats(rows: DataFrame) -> DataFrame:
    """``k, start, end``: byte spans of ``rows`` (k, text) made of strings that occur more than once."""
    key, long = rows.schema["k"].dataType, T.LongType()
    sampled = rows.mapInArrow(per_batch(lambda: _sampled), _schema(key, at=long, anchor=long, extent=long))
    # 1: intervals of anchors
    counted = sampled.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    hits = sampled.join(pin(counted, "anchors"), "anchor", "left_semi")
    # a place has one anchor; keys without the anchor let Spark split the join
    hits = pin(hits.groupBy("k", "at").agg(F.first("anchor").alias("anchor"), F.first("extent").alias("extent")), "hits")
    # 2: intervals of extents
    first = F.min(F.struct("k", "at")).alias("first")
    extents = pin(hits.groupBy("anchor", "extent").agg(first, F.count(F.lit(1)).alias("n")), "extents")
    known = hits.join(extents.where("n > 1").select("anchor", "extent"), ["anchor", "extent"], "left_semi")
    low = F.shiftright("at", 16) - F.shiftright("at", 8).bitwiseAND(255)
    high = F.shiftright("at", 16) - F.col("at").bitwiseAND(255)
    spans = known.select("k", low.alias("start"), (high + LENGTH).alias("end"))
    # 3: intervals of bytes, where one anchor has different extents
    differ = extents.groupBy("anchor").agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("least"))
    differ = differ.where("m > 1 and least = 1").select("anchor", "m")
    open_ = extents.join(differ, "anchor").select(
        "first.k", F.struct("anchor", "first.at", (F.col("n") > 1).alias("whole"), "m").alias("suffix")
    )
    for large in (False, True):
        test = F.col("suffix.m") > GROUP_ROWS
        asked = open_.where(test if large else ~test).groupBy("k").agg(F.collect_list("suffix").alias("asked"))
        if large and asked.isEmpty():
            break
        schema = _schema(key, whole=T.BooleanType(), at=long, anchor=long, after=T.BinaryType(), before=T.BinaryType())
        shards = rows.join(asked, "k").mapInArrow(per_batch(lambda: _transform), schema)  # asked: of one document
        if large:
            single = _schema(key, whole=T.BooleanType(), start=long, anchor=long, string=long)
            strings = pin(shards.mapInArrow(per_batch(lambda: _strings), single), "strings")
            again = strings.groupBy("anchor", "string").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
            found = strings.where("not whole").join(again, ["anchor", "string"], "left_semi")
            found = found.select("k", "start", (F.col("start") + LENGTH).alias("end"))
        else:
            sorted_ = shards.repartition("anchor").sortWithinPartitions("anchor")
            found = sorted_.mapInArrow(_merge_groups, _schema(key, start=long, end=long))
        spans = spans.union(found)
    return spans


def _keep_bytes(batch: pa.RecordBatch, letters: bool = False) -> pa.RecordBatch:
    """Per text: numbers of bytes, removed bytes and maximal removed runs, the runs, and the bytes that stay,
    with ``letters`` without those of letters that were cut through."""
    data, offsets = flat(batch.column(1))
    spans = batch.column(2)
    doc = pc.list_parent_indices(spans).to_numpy()
    each = pc.list_flatten(spans)
    base = offsets[doc]
    gone = spans_to_mask(len(data), base + each.field("start").to_numpy(), base + each.field("end").to_numpy())
    size = np.diff(offsets)
    removed, kept, runs = np.zeros(len(size), np.int64), [], []
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone[a:b].view(np.int8), [0]])))
        runs.append([{"start": int(x), "end": int(y)} for x, y in zip(edge[::2], edge[1::2], strict=True)])
        stays = data[a:b][~gone[a:b]].tobytes()
        removed[i] = b - a - len(stays)
        kept.append(stays.decode("utf-8", "ignore").encode() if letters else stays)
    arrays = [batch.column(0), pa.array(size), pa.array(removed), pa.array(kept, pa.binary())]
    arrays.append(pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))))
    return pa.RecordBatch.from_arrays(arrays, names=["k", "n_bytes", "n_removed", "kept", "spans"])


def _without(rows: DataFrame, *more: str, letters: bool = False) -> DataFrame:
    spans = repeats(rows.select("k", "text")).groupBy("k")
    spans = pin(spans.agg(F.collect_list(F.struct("start", "end")).alias("spans")), "spans")  # of one document
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    joined = rows.join(spans, "k", "left")
    joined = joined.select(F.struct("k", *more).alias("k"), "text", F.coalesce("spans", none).alias("spans"))
    schema = _schema(
        joined.schema["k"].dataType,
        n_bytes=T.LongType(),
        n_removed=T.LongType(),
        kept=T.BinaryType(),
        spans=spans.schema["spans"].dataType,
    )
    return joined.mapInArrow(per_batch(lambda: partial(_keep_bytes, letters=letters)), schema)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, kept, spans``: what stays of every text, as bytes, and the maximal byte
    spans that went."""
    rows = texts(docs).select(F.struct("doc_id", "th").alias("k"), "text")
    return _without(rows).select(F.col("k.k.doc_id").alias("doc_id"), "n_bytes", "n_removed", "kept", "spans")


def cleaned_documents(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with what stays of each text; bytes of a letter that was cut through go with
    it, and a text of which nothing stays is dropped."""
    columns = docs.columns
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.struct("doc_id", F.xxhash64(text).alias("th"))
    rows = docs.select(F.struct(*columns).alias("own"), key.alias("k"), text.alias("text"))
    done = _without(rows, "own", letters=True)
    kept = F.when(F.col("n_removed") == 0, F.col("k.own.text")).otherwise(F.col("kept").cast("string"))
    done = done.where((F.col("n_removed") == 0) | (F.octet_length(kept) > 0))
    return done.select(*[kept.alias(c) if c == "text" else F.col("k.own")[c].alias(c) for c in columns])
