"""Similarities and contrastive loss of view embeddings inside minibatches.

Every pair of a minibatch counts, but no pair is ever a row: views are cut into
tiles of bounded size, a task multiplies two tiles, and what leaves it is one
partial sum per view.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TILE_ROWS = 2048


def _unit(rows: pd.Series) -> np.ndarray:
    m = np.asarray(rows.tolist(), dtype=np.float64)
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norm == 0.0, 1.0, norm)


def _tile_sums(temperature: float):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
        if left.empty or right.empty:
            return pd.DataFrame(columns=["batch_id", "view_id", "n", "exp_sum", "pos_sim", "max_other"])
        sims = _unit(left["embedding"]) @ _unit(right["embedding"]).T
        ids, others = left["view_id"].to_numpy(), right["view_id"].to_numpy()
        self_pair = ids[:, None] == others[None, :]
        positive = (left["pair_id"].to_numpy()[:, None] == right["pair_id"].to_numpy()[None, :]) & ~self_pair
        usable = ~self_pair
        exp = np.where(usable, np.exp((sims - 1.0) / temperature), 0.0)
        other = np.where(usable & ~positive, sims, -np.inf).max(axis=1)
        pos = np.where(positive, sims, -np.inf).max(axis=1)
        return pd.DataFrame(
            {
                "batch_id": key[0],
                "view_id": ids,
                "n": usable.sum(axis=1).astype("int64"),
                "exp_sum": exp.sum(axis=1),
                "pos_sim": np.where(np.isinf(pos), np.nan, pos),
                "max_other": np.where(np.isinf(other), np.nan, other),
            }
        )

    return run


def view_losses(
    df: DataFrame,
    batch: str = "batch_id",
    view: str = "view_id",
    pair: str = "pair_id",
    vector: str = "embedding",
    temperature: float = 1.0,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """Per view: candidates, similarity of its positive pair, closest negative, and loss.

    The loss is minus log softmax of the positive among all other views of the
    minibatch (cosine over ``temperature``). A batch larger than one tile is
    handled by more tiles. A view without a partner has no loss.
    """
    rows = df.select(
        F.col(batch).alias("batch_id"), F.col(view).alias("view_id"), F.col(pair).alias("pair_id"), F.col(vector).alias("embedding")
    )
    sizes = rows.groupBy("batch_id").agg(F.ceil(F.count(F.lit(1)) / tile_rows).cast("int").alias("tiles"))
    sizes = sizes.withColumnRenamed("batch_id", "of")
    rows = rows.join(sizes, F.col("batch_id").eqNullSafe(F.col("of"))).drop("of")
    mine = F.pmod(F.xxhash64("view_id"), F.col("tiles")).cast("int")
    spread = _spread(rows, mine)
    found = spread.groupBy("batch_id", "a", "b").applyInPandas(
        _tile_sums(temperature),
        "batch_id bigint, view_id bigint, n bigint, exp_sum double, pos_sim double, max_other double",
    )
    known = lambda c: F.nanvl(F.col(c), F.lit(None))
    total = found.groupBy("batch_id", "view_id").agg(
        F.sum("n").alias("candidates"),
        F.max(known("pos_sim")).alias("positive_sim"),
        F.max(known("max_other")).alias("closest_negative_sim"),
        F.sum("exp_sum").alias("_e"),
    )
    inverse = F.lit(1.0 / temperature)
    loss = F.log("_e") + inverse - F.col("positive_sim") * inverse
    return total.withColumn("loss", loss).drop("_e")


def _spread(rows: DataFrame, mine) -> DataFrame:
    """Each view once per tile of its batch as left side and once as right side."""
    wide = rows.withColumn("tile", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.col("tile").alias("a"), F.col("other").alias("b")),
        F.struct(F.lit(1).alias("side"), F.col("other").alias("a"), F.col("tile").alias("b")),
    )
    return wide.select("batch_id", "view_id", "pair_id", "embedding", F.inline(sides))


def contrastive_loss(views: DataFrame) -> DataFrame:
    """Mean loss over all views, overall: one row."""
    return views.agg(F.count("loss").alias("views"), F.avg("loss").alias("loss"))


def map_batches(df: DataFrame, fn, schema: str) -> DataFrame:
    """Open hook: a function from pandas block to pandas block, run on Arrow batches."""

    def run(blocks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in blocks:
            yield fn(block)

    return df.mapInPandas(run, schema)


def aggregate_blocks(
    df: DataFrame, by: list[str], partial, partial_schema: str, merge: dict[str, str], finalize
) -> DataFrame:
    """Open hook: aggregate with partial states.

    ``partial`` turns a pandas block into one state row per key, ``merge`` names
    the Spark aggregate of each state column (for example ``{"paid": "sum"}``),
    ``finalize`` maps the merged frame to the result. States, not rows, are shuffled.
    """
    states = map_batches(df, partial, partial_schema)
    merged = states.groupBy(*by).agg(*[F.expr(f"{fn}({c})").alias(c) for c, fn in merge.items()])
    return finalize(merged)
