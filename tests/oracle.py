"""Compare registered queries with their SQL on the same tables."""

from __future__ import annotations

import glob
import os
import time

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _rows(pdf: pd.DataFrame) -> list[tuple]:
    pdf = pdf[sorted(pdf.columns)]
    norm = []
    for row in pdf.itertuples(index=False, name=None):
        cells = []
        for v in row:
            if isinstance(v, (list, tuple)) or type(v).__name__ == "ndarray":
                cells.append(str(list(v)))
            elif v is None or v is pd.NaT or (isinstance(v, float) and v != v):
                cells.append("NULL")
            elif isinstance(v, float):
                cells.append(repr(v + 0.0))
            else:
                cells.append(str(v))
        norm.append(tuple(cells))
    return sorted(norm)


def compare(con, query, spark, sf_dir: str) -> tuple[str, float]:
    """``ok`` or what differs, and the Spark seconds."""
    start = time.perf_counter()
    got = query.job(spark, sf_dir).toPandas()
    took = time.perf_counter() - start
    if query.sql is None:
        return f"rows only: {len(got)}", took
    want = con.execute(query.sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} / {sorted(want.columns)}", took
    kinds = {c: (got[c].dtype.kind, want[c].dtype.kind) for c in got.columns}
    odd = {c: (str(got[c].dtype), str(want[c].dtype)) for c, (a, b) in kinds.items() if a != b and len(got)}
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}", took
    a, b = _rows(got), _rows(want)
    if a != b:
        first = next((x, y) for x, y in zip(a, b) if x != y)
        n = sum(x != y for x, y in zip(a, b))
        return f"{n} of {len(a)} rows differ, first {sorted(got.columns)}: {first[0]} / {first[1]} {odd or ''}", took
    return ("ok" if not odd else f"ok but types {odd}") + f" ({len(a)} rows)", took
