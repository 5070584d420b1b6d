"""Sharding by vector bin packing.

Each row weighs three things: bytes, tokens and rows. Rows of equal text form a group; a group is placed
as one unit on the shard where the dot product of its vector with the residual capacity is highest,
largest units first. To keep the list of units bounded whatever the table holds, groups below
``1 / (shards * CELLS)`` of every total are put together by text hash, so there are at most
``4 * shards * CELLS`` cells. A group above ``1 / shards`` of any total is cut into ``PIECES`` times as many pieces by a
hash of a row number, so a text that fills a third of the table spreads over many shards, also if all its rows
have one id or none. The greedy choice
runs on the driver over that bounded list; rows are only counted, joined and numbered by Spark.

Defined cases: a null text has no bytes and equals the empty text; rows without id, and repeated rows,
are placed and numbered like all others; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftwell.llm.table import word_count
from driftwell.session import pin

ROW_BYTES = 16
CELLS = 256
PIECES = 4  # of a shard's share, into which larger groups are cut


def place(vectors: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unit; ``vectors`` are shares of the totals (bytes first)."""
    left = np.full((shards, vectors.shape[1]), 1.0 / shards)
    out = np.zeros(len(vectors), np.int64)
    order = np.lexsort((np.arange(len(vectors)), -vectors[:, 0], -vectors.max(axis=1)))
    for i in order:
        v = vectors[i]
        score = left @ v
        fits = (left >= v).all(axis=1)
        if not fits.any():
            fits = left[:, 0] >= v[0]
        if fits.any():
            score = np.where(fits, score, -np.inf)
        else:  # no room for its bytes anywhere: where most bytes are free
            score = left[:, 0]
        out[i] = s = int(np.argmax(score))
        left[s] -= v
    return out


def measured(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    raw = F.encode(text, "UTF-8")
    return docs.select(
        "doc_id",
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        word_count(text).alias("tokens"),
        F.crc32(raw).alias("text_crc32"),
        F.xxhash64(text).alias("g1"),
        F.xxhash64(F.lit("second"), text).alias("g2"),
    )


def shard_rows(docs: DataFrame, shards: int) -> DataFrame:
    """``doc_id, size, tokens, text_crc32, shard, slot``: every row with its shard and gapless place in it."""
    spark = docs.sparkSession
    # numbered once, in the written table: pieces of a large group are even whatever its ids are
    rows = pin(measured(docs).withColumn("row", F.monotonically_increasing_id()), "sizes")
    sums = [F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")]
    total = np.array([x or 1 for x in rows.agg(*sums).first()], float)
    total[total == 0] = 1
    share = F.greatest(*[F.col(c) / F.lit(float(t)) for c, t in zip(("size", "tokens", "rows"), total, strict=True)])
    large = (
        rows.groupBy("g1", "g2").agg(*sums).withColumn("share", share).where(F.col("share") > 1.0 / (shards * CELLS))
    )
    # shares of three totals: at most 3 * shards * CELLS groups
    found = sorted((r.g1, r.g2, r.share) for r in large.select("g1", "g2", "share").collect())
    pieces = [int(np.ceil(x[2] * shards * CELLS)) for x in found]
    begins = np.concatenate([[0], np.cumsum(pieces)]).astype(int)
    units = np.empty(begins[-1] + shards * CELLS, np.int64)  # cell -> unit
    n = 0
    for k, (_, _, part) in enumerate(found):
        cut = int(np.ceil(part * shards * PIECES)) if part > 1.0 / shards else 1
        units[begins[k] : begins[k + 1]] = n + np.arange(pieces[k]) * cut // pieces[k]
        n += cut
    units[begins[-1] :] = n + np.arange(shards * CELLS)
    table = [(g1, g2, int(b), p) for (g1, g2, _), b, p in zip(found, begins, pieces, strict=False)]
    groups = F.broadcast(spark.createDataFrame(table, "g1 long, g2 long, first_cell long, pieces int"))
    small = F.lit(int(begins[-1])) + F.pmod(F.col("g2"), F.lit(shards * CELLS))
    celled = rows.join(groups, ["g1", "g2"], "left").withColumn(
        "cell",
        F.when(F.col("pieces").isNull(), small).otherwise(
            F.col("first_cell") + F.pmod(F.xxhash64("row", F.lit("piece")), F.col("pieces"))
        ),
    )
    cells = sorted(tuple(r) for r in celled.groupBy("cell").agg(*sums).collect())  # bounded as above
    at = np.array([c[0] for c in cells], int)
    weights = np.zeros((n + shards * CELLS, 3))
    np.add.at(weights, units[at], np.array([c[1:] for c in cells], float).reshape(-1, 3) / total)
    shard = place(weights, shards)[units[at]]
    filled = np.zeros(shards, np.int64)
    plan = []
    for (cell, _, _, count), s in zip(cells, shard.tolist(), strict=True):
        plan.append((cell, s, int(filled[s])))
        filled[s] += count
    plan = F.broadcast(spark.createDataFrame(plan, "cell long, shard int, before long"))
    inside = Window.partitionBy("cell").orderBy("doc_id", "g1", "row")
    return celled.join(plan, "cell").select(
        "doc_id",
        "size",
        "tokens",
        "text_crc32",
        "shard",
        (F.col("before") + F.row_number().over(inside) - 1).alias("slot"),
    )
