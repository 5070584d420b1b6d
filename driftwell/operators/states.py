"""Aggregates whose state and combine step are the user's own.

A :class:`Fold` says what an empty state is, how a block of rows enters it, how two states become one, and what the
result of a state is. A task keeps one state per key and sends states, not rows. States of a key are combined in three
levels, dealt by the task they came from, so a key that every task has seen is spread until ``FAN`` states are left.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

FAN = 16  # states of a key that the last level combines; its square: groups of the first
KEYS_HELD = 100_000  # of a task, before their states are sent


@dataclass(frozen=True)
class Fold:
    """``zero() -> state``, ``block(state, rows) -> state``, ``combine(state, state) -> state`` (any order, any
    grouping), ``final(state) -> tuple`` of the result columns."""

    zero: Callable[[], Any]
    block: Callable[[Any, pd.DataFrame], Any]
    combine: Callable[[Any, Any], Any]
    final: Callable[[Any], tuple]


def fold(df: DataFrame, by: Sequence[str], aggregate: Fold, result: str, fan: int = FAN) -> DataFrame:
    """One row per key with the columns of ``result``; without keys one row, also of an empty table."""
    by = list(by)
    keys = T.StructType([df.schema[c] for c in by])
    out = T.StructType([*keys.fields, *T.StructType.fromDDL(result).fields])
    held = T.StructType([*keys.fields, T.StructField("_part", T.LongType()), T.StructField("_state", T.BinaryType())])
    names = [f.name for f in held]

    whole = [isinstance(f.dataType, T.IntegralType) for f in keys]

    def plain(key: tuple) -> tuple:
        """Keys as they were: pandas makes numbers beside a null fractions, and nulls NaN."""
        return tuple(None if pd.isna(k) else int(k) if w else k for k, w in zip(key, whole, strict=True))

    def rows(states: dict[tuple, Any], part: int) -> pd.DataFrame:
        made = [(*key, part, pickle.dumps(state)) for key, state in states.items()]
        return pd.DataFrame(made, columns=names).astype({c: "object" for c in by})

    def own(blocks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        states: dict[tuple, Any] = {}
        part = TaskContext.get().partitionId()
        for block in blocks:
            groups = block.groupby(by, dropna=False, sort=False) if by else [((), block)]
            for key, group in groups:
                key = plain(key)
                states[key] = aggregate.block(states[key] if key in states else aggregate.zero(), group)
            if len(states) >= KEYS_HELD:
                yield rows(states, part)
                states = {}
        if states:
            yield rows(states, part)

    def joined(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        states = iter(group["_state"])
        state = pickle.loads(next(states))
        for other in states:
            state = aggregate.combine(state, pickle.loads(other))
        *own_key, part = key
        return rows({plain(tuple(own_key)): state}, int(part))

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layout = to_arrow_schema(out)  # not through pandas: NaN stays NaN
        for batch in batches:
            made = [aggregate.final(pickle.loads(s.as_py())) for s in batch.column(len(by) + 1)]
            columns = [batch.column(i).cast(layout.field(i).type) for i in range(len(by))]
            for i, values in enumerate(zip(*made, strict=True), len(by)):
                columns.append(pa.array(values, layout.field(i).type))
            yield pa.RecordBatch.from_arrays(columns, names=out.fieldNames())

    states = df.mapInPandas(own, held)
    for groups in (fan * fan, fan, 1):
        part = F.pmod(F.col("_part"), F.lit(groups)).alias("_part")
        states = states.groupBy(*by, part).applyInPandas(joined, held)
    if not by:
        zero = pickle.dumps(aggregate.zero())
        one = df.sparkSession.createDataFrame([(0, bytearray(zero))], held)
        merged = states.unionByName(one).withColumn("_part", F.lit(0).cast("long"))
        states = merged.groupBy("_part").applyInPandas(joined, held)
    return states.mapInArrow(told, out)
