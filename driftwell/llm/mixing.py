"""Mixing sources to target weights, block by block.

The words of each source are laid end to end in a pseudorandom document order and cut into blocks of a
fixed length. Source counts are drawn for every output shard by a multinomial over what the sources still
have to give, so each shard is a random mix and the totals hold exactly. Slot ``j`` of a source takes
block ``permutation(j)``: each pass over a source is a pseudorandom permutation of its block indexes (a
keyed Feistel network, walked until it falls below the number of blocks), so blocks repeat only after all
have been used, and the mix is the join of slots and blocks by index.

The driver holds one row per source and the shards x sources counts; ``MAX_SOURCES`` checks that. Slots and
blocks are Spark rows, and a source with a third of all rows is spread by document hash before its running
sums are taken.

Defined cases: a null text has no words and is never taken; null is a source of its own, the last;
a source without words has target 0; repeated rows are documents of their own; an empty table gives an
empty mix; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwell.llm.blocks import Words, constants, flat, mix64, spans_to_mask
from driftwell.llm.table import per_batch, word_count
from driftwell.session import pin

WEIGHTS = (5.0, 2.0, 1.0)  # by code point of the source, repeating
MOST_TIMES = 3
BLOCK = 32
SHARDS = 64
ROWS_PER_RUN = 2_000
MAX_SOURCES = 20_000
SEED = 7

U = np.uint64


def targets(sizes: list[int], weights: list[float], most_times: int = MOST_TIMES) -> list[float]:
    """Shares of ``sum(sizes)`` by weight, none above ``most_times`` its size; the excess is reshared by weight."""
    out = [0.0] * len(sizes)
    left, open_ = float(sum(sizes)), set(range(len(sizes)))
    while open_:
        unit = left / sum(weights[i] for i in sorted(open_))
        full = {i for i in open_ if weights[i] * unit >= most_times * sizes[i]}
        for i in full or open_:
            out[i] = float(most_times * sizes[i]) if full else weights[i] * unit
        left -= sum(out[i] for i in full)
        open_ = open_ - full if full else set()
    return out


def shard_counts(slots: list[int], shards: int, seed: int = SEED) -> np.ndarray:
    """Source counts of every shard (shards x sources): multinomial draws over what is left of each source."""
    left = np.array(slots, np.int64)
    rng = np.random.Generator(np.random.Philox(seed))
    out = np.zeros((shards, len(left)), np.int64)
    for h in range(shards):
        want = int(left.sum()) // (shards - h)
        while want > 0:
            drawn = np.minimum(rng.multinomial(want, left / left.sum()), left)
            out[h] += drawn
            left -= drawn
            want -= int(drawn.sum())
    return out


def permutation(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Images of ``index`` under a pseudorandom permutation of 0 .. n - 1."""
    half = U(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    mask = (U(1) << half) - U(1)
    keys = constants(f"mix{key}", 4)
    x = index.astype(U)
    todo = np.arange(len(x))
    while len(todo):
        left, right = x[todo] >> half, x[todo] & mask
        for k in keys:
            left, right = right, left ^ (mix64(right + k) & mask)
        x[todo] = (left << half) | right
        todo = todo[x[todo] >= U(n)]
    return x.astype(np.int64)


class Plan:
    """What the driver knows: sources in order, their sizes, targets, block and slot numbers, shard counts."""

    def __init__(self, sized: DataFrame, block: int, shards: int, seed: int):
        got = sized.groupBy("source").agg(F.sum("size").alias("n")).limit(MAX_SOURCES + 1).collect()
        if len(got) > MAX_SOURCES:
            raise ValueError(f"more than {MAX_SOURCES} sources")
        got = sorted(got, key=lambda r: (r.source is None, r.source or ""))
        self.sources, self.sizes = [r.source for r in got], [int(r.n) for r in got]
        self.weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(got))]
        self.targets = targets(self.sizes, self.weights)
        self.blocks = [-(-n // block) for n in self.sizes]
        self.slots = []
        for n, blocks, target in zip(self.sizes, self.blocks, self.targets, strict=True):
            passes, rest = divmod(target, n) if n else (0, 0)
            self.slots.append(int(passes) * blocks + min(blocks, round(rest / block)))
        self.counts = shard_counts(self.slots, shards, seed)

    def table(self, spark) -> DataFrame:
        rows = list(zip(self.sources, range(len(self.sources)), self.sizes, self.targets, strict=True))
        return F.broadcast(spark.createDataFrame(rows, "source string, s int, source_size long, target double"))


def layout(docs: DataFrame) -> DataFrame:
    """Written once: ``doc_id, th, source, size`` of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return pin(docs.select("doc_id", "source", word_count(text).alias("size"), F.xxhash64(text).alias("th")), "sizes")


def placed(sized: DataFrame, plan: Plan) -> DataFrame:
    """``sized`` with source number, size and target, and ``start``, its first word's place in the source."""
    sized = sized.withColumn("h", F.xxhash64("doc_id", "th", F.lit(SEED)))
    runs = max(1, sized.count() // ROWS_PER_RUN)
    table = plan.table(sized.sparkSession).withColumnRenamed("source", "name")
    rows = sized.join(table, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    rows = rows.withColumn("run", F.pmod("h", F.lit(runs)))
    totals = rows.groupBy("s", "run").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("s").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("s", "run", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    before = Window.partitionBy("s", "run").orderBy("h", "doc_id", "th", "size")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("offset") + F.coalesce(F.sum("size").over(before), F.lit(0))
    return rows.join(offsets, ["s", "run"]).withColumn("start", start).drop("h", "run", "offset")


def slot_rows(spark, plan: Plan, seed: int) -> DataFrame:
    """``shard, slot, s, pass, block``: one row for each block that the mix takes."""
    ends = np.cumsum(plan.slots)
    total = int(ends[-1]) if len(ends) else 0
    until = np.cumsum(plan.counts, axis=0)
    blocks, slots = plan.blocks, plan.slots

    def run(batches):
        for batch in batches:
            g = batch.column(0).to_numpy()
            source = np.searchsorted(ends, g, side="right")
            columns = {k: np.zeros(len(g), np.int64) for k in ("shard", "slot", "pass", "block")}
            for s in np.unique(source):
                mine = np.flatnonzero(source == s)
                j = g[mine] - (ends[s] - slots[s])
                turn, index = np.divmod(j, blocks[s])
                shard = np.searchsorted(until[:, s], j, side="right")
                columns["shard"][mine], columns["slot"][mine], columns["pass"][mine] = shard, j, turn
                for t in np.unique(turn):
                    now = turn == t
                    columns["block"][mine[now]] = permutation(index[now], blocks[s], hash((seed, int(s), int(t))))
            arrays = [pa.array(source.astype(np.int32)), *map(pa.array, columns.values())]
            yield pa.RecordBatch.from_arrays(arrays, names=["s", *columns])

    return spark.range(0, total).mapInArrow(run, "s int, shard long, slot long, pass long, block long")


def mixture(rows: DataFrame, plan: Plan, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """The mix: ``shard, slot, s, pass, block`` and the part of a document it holds: the document's ``start``
    in its source, its first word in the block and the number of words."""
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    parts = rows.where(F.col("size") > 0).select(
        "s", "start", "size", F.explode(F.sequence(first, last)).alias("block")
    )
    low = F.greatest(F.col("start"), F.col("block") * block)
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block)
    parts = parts.select(
        "s", "block", "start", (low - F.col("start")).alias("first_word"), (high - low).alias("n_words")
    )
    return slot_rows(rows.sparkSession, plan, seed).join(parts, ["s", "block"])


def taken_words(docs: DataFrame, block: int = BLOCK, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every row."""
    sized = layout(docs)
    plan = Plan(sized, block, shards, seed)
    rows = placed(sized, plan)
    taken = mixture(rows, plan, block, seed).groupBy("s", "start").agg(F.sum("n_words").alias("taken"))
    taken = taken.select(F.col("s").alias("ts"), F.col("start").alias("tstart"), "taken")
    same = (F.col("s") == F.col("ts")) & (F.col("start") == F.col("tstart")) & (F.col("size") > 0)
    return rows.join(taken, same, "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def mixed_documents(docs: DataFrame, block: int = BLOCK, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The columns of ``docs``: one row for each pass that takes words of a document, its text cut to the
    words taken (a text taken whole is unchanged; separate parts are joined by a line break)."""
    columns = docs.columns
    sized = layout(docs)
    plan = Plan(sized, block, shards, seed)
    rows = placed(sized, plan)
    parts = mixture(rows, plan, block, seed).groupBy("s", "start", "pass")
    parts = parts.agg(F.sort_array(F.collect_list(F.struct("first_word", "n_words"))).alias("parts"))  # of one text
    names = rows.where(F.col("size") > 0).withColumn("copy", _copy("doc_id", "th", "start"))
    parts = parts.join(names.select("s", "start", "size", "copy", F.struct("doc_id", "th").alias("k")), ["s", "start"])
    keyed = docs.select(
        F.struct(*columns).alias("row"),
        F.col("doc_id").alias("doc_id"),
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("th"),
    )
    keyed = keyed.select("row", F.struct("doc_id", "th").alias("k"), _copy("doc_id", "th").alias("copy"))
    joined = keyed.join(parts, ["k", "copy"]).select("row", "size", "parts")
    schema = T.StructType([T.StructField("row", docs.schema), T.StructField("cut", T.StringType())])
    cut = joined.mapInArrow(per_batch(lambda: _cut), schema)
    return cut.select(*[F.col("cut").alias(c) if c == "text" else F.col("row")[c].alias(c) for c in columns])


def _copy(*by: str):
    return F.row_number().over(Window.partitionBy("doc_id", "th").orderBy(*by))


def _cut(batch: pa.RecordBatch) -> pa.RecordBatch:
    row, size, parts = batch.columns
    texts = row.field("text")
    data, offsets = flat(texts)
    words = Words(data, offsets)
    out = []
    for i, (n, spans) in enumerate(zip(size.to_pylist(), parts.to_pylist(), strict=True)):
        first = np.array([p["first_word"] for p in spans])
        mask = spans_to_mask(n, first, first + np.array([p["n_words"] for p in spans]))
        if mask.all():
            out.append(texts[i].as_py())
            continue
        edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
        at = words.first[i]
        pieces = [
            data[words.start[at + a] : words.end[at + b - 1]].tobytes()
            for a, b in zip(edge[::2], edge[1::2], strict=True)
        ]
        out.append(b"\n".join(pieces).decode())
    return pa.RecordBatch.from_arrays([row, pa.array(out, pa.string())], names=["row", "cut"])
