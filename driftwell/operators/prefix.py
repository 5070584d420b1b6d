"""Global order without a single partition.

A window with no partition key pulls the whole table into one task. Everything
here first gives each row a coarse bucket along the order, adds up the buckets,
and only then sorts inside buckets. Buckets are a pure function of the order
key, or written down once with the rows, so a lost and recomputed task gives
the same answer. Their number follows the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwell.functions.columns import to_number
from driftwell.session import pin

ROWS_PER_BUCKET = 500_000
LEAST_BUCKETS = 16
HASH_PREFIX = 3
ACCURACY = 2  # rank error of split points: half a bucket


def bucket_count(df: DataFrame) -> int:
    """Buckets of ``ROWS_PER_BUCKET`` rows, and at least one for each task of a shuffle."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(LEAST_BUCKETS, tasks, math.ceil(df.count() / ROWS_PER_BUCKET))


def order_value(df: DataFrame, column: str) -> Column:
    """A double that never decreases along the order of ``column``."""
    kind = df.schema[column].dataType
    c = F.col(column)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        value = F.unix_micros(c.cast("timestamp")).cast("double")
    elif isinstance(kind, T.StringType):
        value = F.conv(F.rpad(F.hex(F.substring(c, 1, 6)), 12, "0"), 16, 10).cast("double")
    else:
        value = c.cast("double")
    return F.coalesce(value, F.lit(float("-inf")))


def _approx(value: Column, buckets: int) -> Column:
    probs = F.expr("array(" + ", ".join(f"{i / buckets!r}D" for i in range(1, buckets)) + ")")
    return F.percentile_approx(F.nanvl(value, F.lit(None)), probs, F.lit(ACCURACY * buckets))


def split_points(df: DataFrame, value: str, buckets: int) -> list[float]:
    """Approximate quantiles of ``value``; a heavy value shows up repeatedly."""
    return sorted(df.agg(_approx(F.col(value), buckets)).first()[0] or [])


def points_by_column(df: DataFrame, columns: Sequence[str], buckets: int) -> dict[str, list[float]]:
    """Split points for several number columns, from one narrow scan."""
    row = df.agg(*[_approx(F.col(c).cast("double"), buckets).alias(c) for c in columns]).first()
    return {c: sorted(row[c] or []) for c in columns}


def column_points(df: DataFrame, columns: Sequence[str], buckets: int | None = None) -> list[float]:
    """One list of split points that serves several columns together."""
    buckets = buckets or bucket_count(df)
    found = points_by_column(df, columns, max(8, buckets // max(len(columns), 1)))
    return sorted({p for points in found.values() for p in points})


def add_bucket(df: DataFrame, value: str, points: Sequence[float], out: str = "_b") -> DataFrame:
    """Bucket number of ``value`` by binary search over the split points."""
    inner = sorted({p for p in points if p not in (float("inf"), float("-inf"))})
    if not inner:
        return df.withColumn(out, F.lit(0))
    splits = [float("-inf"), *inner, float("inf")]
    stage = Bucketizer(splits=splits, inputCol=value, outputCol="_bucket", handleInvalid="keep")
    return stage.transform(df).withColumn(out, F.col("_bucket").cast("int")).drop("_bucket")


def running_total(
    df: DataFrame,
    order_by: str,
    sums: Mapping[str, str],
    by: Sequence[str] = (),
    buckets: int | None = None,
    points: Sequence[float] | None = None,
) -> DataFrame:
    """Inclusive running sums of ``sums`` (new name -> column) along ``order_by``.

    ``(by, order_by)`` must be unique: aggregate to distinct values first. That
    also removes hot values, so each bucket holds about the same number of rows.
    Any split ``points`` give the right sums; pass some to save the scan that finds them.
    """
    by = list(by)
    keyed = df.withColumn("_o", order_value(df, order_by))
    keyed = add_bucket(keyed, "_o", split_points(keyed, "_o", buckets or bucket_count(df)) if points is None else points)
    totals = keyed.groupBy(*by, "_b").agg(*[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()])
    before = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by, "_b", *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_s_{n}") for n in sums]
    )
    offsets = keyed_by(offsets, [*by, "_b"], drop=True)
    if not by:  # at most `buckets` rows by construction
        offsets = F.broadcast(offsets)
    inside = Window.partitionBy("_k").orderBy(order_by).rowsBetween(Window.unboundedPreceding, 0)
    return (
        keyed_by(keyed, [*by, "_b"])
        .join(offsets, "_k")
        .withColumns({n: F.sum(c).over(inside) + F.col(f"_s_{n}") for n, c in sums.items()})
        .drop("_o", "_b", "_k", *[f"_s_{n}" for n in sums])
    )


def keyed_by(df: DataFrame, keys: Sequence[str], drop: bool = False) -> DataFrame:
    """Add ``_k``, one struct of the keys: null fields compare equal, and a join and a
    window on ``_k`` share one shuffle."""
    out = df.withColumn("_k", F.struct(*keys))
    return out.drop(*keys) if drop else out


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where null matches null, keeping the left key columns."""
    return keyed_by(left, keys).join(keyed_by(right, keys, drop=True), "_k", how).drop("_k")


def row_hash(seed: object, keys: Sequence[str]) -> Column:
    """Repeatable pseudo-random order of rows; any engine with md5 agrees."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def global_row_number(
    df: DataFrame,
    order_by: str,
    tie: Sequence[str],
    by: Sequence[str] = (),
    out: str = "row_number",
    buckets: int | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """1-based position along ``(order_by, md5(tie))``, within ``by`` if given.

    Rows are cut into ranges of the whole sort key, of whatever types, so a value
    that holds a third of all rows is cut by its tie hash. The ranges are sorted and
    written once with the number of their task and the place in it, so rows move
    once; totals of the ranges give the first position of each. ``tie`` has to
    identify a row. Nulls come first. ``keep`` names the columns that are wanted (all).
    """
    by = list(by)
    order = list(dict.fromkeys([*by, order_by, "_h", *tie]))
    kept = list(df.columns if keep is None else dict.fromkeys([*by, *keep]))
    keyed = df.withColumn("_h", row_hash("", tie))
    cut = keyed.repartitionByRange(buckets or bucket_count(df), *order).sortWithinPartitions(*order)
    # the id is the number of the task and, in its lower bits, the place of the row there
    placed = pin(cut.select(*kept, F.monotonically_increasing_id().alias("_i")), "ordered")
    task, place = F.shiftright("_i", 33), F.col("_i").bitwiseAND(F.lit(2**33 - 1))
    placed = placed.select(*kept, task.alias("_b"), place.alias("_i"))
    totals = placed.groupBy("_b").agg((F.max("_i") + 1).alias("_n"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    offsets = totals.select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_s"))
    numbered = placed.join(F.broadcast(offsets), "_b").withColumn(out, F.col("_i") + F.col("_s") + 1).drop("_b", "_i", "_s")
    if not by:
        return numbered
    # rows of a group lie side by side
    first = numbered.groupBy(*by).agg(F.min(out).alias("_first"))
    return join_null_safe(numbered, first, by).withColumn(out, F.col(out) - F.col("_first") + 1).drop("_first")


def hash_rank(
    df: DataFrame, keys: Sequence[str], seed: object, by: Sequence[str] = (), out: str = "hash_rank"
) -> DataFrame:
    """1-based rank of each row in md5 order within ``by``; buckets are hash prefixes."""
    by = list(by)
    digits = max(HASH_PREFIX, math.ceil(math.log(bucket_count(df), 16)))
    keyed = df.withColumn("_h", row_hash(seed, keys)).withColumn("_b", F.substring("_h", 1, digits))
    totals = keyed.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by,
        "_b",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_s"),
        F.sum("_n").over(Window.partitionBy(*by)).alias(f"{out}_of"),
    )
    offsets = keyed_by(offsets, [*by, "_b"], drop=True)
    inside = Window.partitionBy("_k").orderBy("_h", *keys)
    return (
        keyed_by(keyed, [*by, "_b"])
        .join(offsets, "_k")
        .withColumn(out, F.row_number().over(inside) + F.col("_s"))
        .drop("_h", "_b", "_s", "_k")
    )


def turned(turn: int, h: str = "_h") -> Column:
    """A row hash read from another digit on: a further order from the same hash."""
    cut = (turn * HASH_PREFIX) % 32
    return F.concat(F.substring(h, cut + 1, 32), F.substring(h, 1, cut)) if cut else F.col(h)


def hash_cuts(df: DataFrame, sizes: Sequence[float | int]) -> list[Column]:
    """One predicate per wanted size, each true for exactly that many rows of a frame with ``_h``.

    A size below 1 is a share of all rows (at least one row), else a row count.
    Predicate ``i`` takes the smallest rows in the order of the hash turned by
    ``i``. Each pass counts the next digits behind the prefix where the wanted
    rank lies, until the rank is the last one of a prefix. Rows are counted,
    never moved, and the result is a comparison with a literal. ``_h`` is a
    :func:`row_hash` of keys that identify a row.
    """
    orders = range(len(sizes))
    prefix = dict.fromkeys(orders, "")
    skipped = dict.fromkeys(orders, 0)
    goal: dict[int, int] = {}
    bound: dict[int, str] = {}
    active = set(orders)
    while active:
        width = len(prefix[min(active)]) + HASH_PREFIX
        # at most sizes x 16**HASH_PREFIX rows
        counted = _next_digits(df, prefix, active, width).groupBy("i", "p").count().collect()
        if not goal:
            rows = sum(r["count"] for r in counted if r["i"] == 0)
            goal = {i: (max(1, int(s * rows)) if 0 < s < 1 else int(s)) for i, s in enumerate(sizes)}
        for i in sorted(active):
            bound[i] = "g" if goal[i] > 0 else ""  # beyond every hex digit: all rows
            last = True
            for p, n in sorted((r["p"], r["count"]) for r in counted if r["i"] == i and goal[i] > 0):
                if skipped[i] + n >= goal[i]:
                    last = skipped[i] + n == goal[i] or width >= 32
                    prefix[i], bound[i] = p, p + "g"
                    break
                skipped[i] += n
            if last:
                active.discard(i)
    return [turned(i) <= F.lit(bound[i]) for i in orders]


def _next_digits(df: DataFrame, prefix: Mapping[int, str], which: set[int], width: int) -> DataFrame:
    """``i, p``: the first digits of each turned hash that goes on a prefix."""
    starts = [
        F.when(turned(i).startswith(prefix[i]), F.struct(F.lit(i).alias("i"), F.substring(turned(i), 1, width).alias("p")))
        for i in sorted(which)
    ]
    return df.select(F.inline(F.filter(F.array(*starts), lambda x: x.isNotNull())))


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    buckets: int | None = None,
    points: Sequence[float] | None = None,
) -> DataFrame:
    """Exact interpolated quantiles, one row per ``(by, prob)``.

    The built-in exact percentile keeps every distinct value of a group in one
    buffer. Here ranks are located by bucket totals, and only the buckets that
    hold a wanted rank are counted value by value.
    """
    by = list(by)
    base = df.select(*by, F.col(value).cast("double").alias("_v")).where(
        F.col("_v").isNotNull() & ~F.isnan("_v")
    )
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    points = split_points(base, "_v", buckets or bucket_count(base)) if points is None else points
    keyed = add_bucket(base, "_v", points)
    totals = keyed.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_c"))
    whole = Window.partitionBy(*by)
    before = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumns(
        {"_s": F.coalesce(F.sum("_c").over(before), F.lit(0)), "_n": F.sum("_c").over(whole)}
    )
    position = F.col("prob") * (F.col("_n") - 1)
    targets = (
        totals.withColumn("prob", F.explode(wanted))
        .withColumn("_side", F.explode(F.array(F.lit(0), F.lit(1))))
        .withColumn("_r", F.when(F.col("_side") == 0, F.floor(position)).otherwise(F.ceil(position)))
        .where((F.col("_r") >= F.col("_s")) & (F.col("_r") < F.col("_s") + F.col("_c")))
        .select(*by, "_b", "prob", "_side", (F.col("_r") - F.col("_s")).alias("_t"), position.alias("_pos"))
    )
    order = Window.partitionBy(*by, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        join_null_safe(keyed, targets.select(*by, "_b").distinct(), [*by, "_b"], "left_semi")
        .groupBy(*by, "_b", "_v")
        .agg(F.count(F.lit(1)).alias("_c"))
        .withColumn("_to", F.sum("_c").over(order))
    )
    picked = join_null_safe(ranked, targets, [*by, "_b"]).where(
        (F.col("_t") < F.col("_to")) & (F.col("_t") >= F.col("_to") - F.col("_c"))
    )
    low = F.max(F.when(F.col("_side") == 0, F.col("_v")))
    high = F.max(F.when(F.col("_side") == 1, F.col("_v")))
    part = F.max(F.col("_pos") - F.floor("_pos"))
    return picked.groupBy(*by, "prob").agg((low + (high - low) * part).alias("value"))


def exact_quantiles_of_columns(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float]
) -> dict[str, list[float | None]]:
    """Quantile lists per column, brought to the driver (columns x probs numbers).

    All columns together: one scan for the split points, and one job on (column, value) rows.
    """
    wide = df.select(*[to_number(c).alias(c) for c in columns])
    long = wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])))
    got = exact_quantiles(long, "value", probs, ["column"], points=column_points(wide, columns)).collect()
    found = {(r["column"], r["prob"]): r["value"] for r in got}
    return {c: [found.get((c, float(p))) for p in probs] for c in columns}
