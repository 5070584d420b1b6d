"""Distributed order helpers against brute force, with heavy values and nulls."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from driftwell.operators import prefix as X


@pytest.fixture(scope="module")
def heavy(spark):
    rnd = random.Random(1)
    # one value holds a third of all rows, one group holds a third as well
    rows = [
        (i, 5.0 if i % 3 == 0 else round(rnd.uniform(-50, 50), 2), None if i % 17 == 0 else ("hot" if i % 3 else f"g{i % 4}"))
        for i in range(3000)
    ]
    return rows, spark.createDataFrame(rows, "id long, v double, g string").repartition(7)


def md5(text):
    import hashlib

    return hashlib.md5(text.encode()).hexdigest()


@pytest.mark.parametrize("buckets", [2, 16, 128])
def test_global_row_number(heavy, buckets):
    rows, df = heavy
    got = {r["id"]: r["row_number"] for r in X.global_row_number(df, "v", ["id"], buckets=buckets).collect()}
    want = sorted(rows, key=lambda r: (r[1], md5("|" + str(r[0]))))
    assert got == {r[0]: i + 1 for i, r in enumerate(want)}


def positions(df, order, tie):
    window = Window.orderBy(F.col(order), F.md5(F.concat(F.lit("|"), F.coalesce(F.col(tie).cast("string"), F.lit("")))), tie)
    return {r[tie]: r["n"] for r in df.withColumn("n", F.row_number().over(window)).collect()}


@pytest.mark.parametrize(
    "value",
    [
        "concat('prefix-', lpad(cast(id * 7919 % 4001 as string), 6, '0'))",
        "9000000000000000000 + id * 31 % 3000",
        "case when id % 10 = 0 then null when id % 7 = 0 then double('-infinity') else double(id % 90) end",
        "if(id % 3 = 0, 'one value', concat('x', id))",
        "timestamp_micros(1700000000000000 + id % 50)",
    ],
)
def test_row_numbers_equal_a_plain_window(spark, value):
    df = spark.range(0, 4000, 1, 7).selectExpr("id", f"{value} as v")
    got = {r["id"]: r["row_number"] for r in X.global_row_number(df, "v", ["id"], buckets=16).collect()}
    assert got == positions(df, "v", "id")


def test_hot_value_is_spread(spark):
    df = spark.range(0, 6000, 1, 5).selectExpr("id", "if(id % 3 = 0, 'one value', concat('x', id)) as v")
    cut = df.withColumn("_h", X.row_hash("", ["id"])).repartitionByRange(12, "v", "_h", "id")
    hot = cut.where("v = 'one value'").groupBy(F.spark_partition_id()).count().count()
    assert hot >= 3


def test_row_number_in_groups_keeps_null_group(heavy):
    rows, df = heavy
    got = {r["id"]: r["row_number"] for r in X.global_row_number(df, "v", ["id"], by=["g"]).collect()}
    for g in {r[2] for r in rows}:
        part = sorted((r for r in rows if r[2] == g), key=lambda r: (r[1], md5("|" + str(r[0]))))
        assert [got[r[0]] for r in part] == list(range(1, len(part) + 1))


def test_row_number_over_text_and_time(spark):
    words = [f"{c}{i}" for c in "xaMé" for i in range(50)]
    df = spark.createDataFrame([(w,) for w in words], "w string").repartition(5)
    got = {r["w"]: r["row_number"] for r in X.global_row_number(df, "w", ["w"], buckets=8).collect()}
    assert got == {w: i + 1 for i, w in enumerate(sorted(words, key=lambda w: w.encode()))}
    timed = df.withColumn("t", F.timestamp_seconds(F.length("w") * 1000 + F.ascii("w")))
    assert X.global_row_number(timed, "t", ["w"]).agg(F.count_distinct("row_number")).first()[0] == len(words)


def test_running_total(heavy):
    rows, df = heavy
    counts = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    got = {(r["g"], r["v"]): r["upto"] for r in X.running_total(counts, "v", {"upto": "n"}, by=["g"]).collect()}
    for (g, v), upto in got.items():
        assert upto == sum(1 for r in rows if r[2] == g and r[1] <= v)
    assert len(got) == len({(r[2], r[1]) for r in rows})


@pytest.mark.parametrize("points", [[], [0.0], [5.0, 5.0, 7.0]])
def test_any_split_points_do(heavy, points):
    rows, df = heavy
    counts = df.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    for r in X.running_total(counts, "v", {"upto": "n"}, points=points).collect():
        assert r["upto"] == sum(1 for x in rows if x[1] <= r["v"])


def test_hash_rank(heavy):
    rows, df = heavy
    got = {r["id"]: (r["hash_rank"], r["hash_rank_of"]) for r in X.hash_rank(df, ["id"], 9, by=["g"]).collect()}
    assert len(got) == len(rows)
    for g in {r[2] for r in rows}:
        part = sorted((md5(f"9|{r[0]}"), r[0]) for r in rows if r[2] == g)
        assert [got[i] for _, i in part] == [(k + 1, len(part)) for k in range(len(part))]


@pytest.mark.parametrize("sizes", [[0.02, 0.5, 1], [0, 7, 3000], [5000, 0.999, 0.0001]])
def test_hash_cuts_take_exactly_k(heavy, sizes):
    rows, df = heavy
    hashed = df.withColumn("_h", X.row_hash(4, ["id"]))
    tests = X.hash_cuts(hashed, sizes)
    got = hashed.agg(*[F.count_if(t).alias(f"n{i}") for i, t in enumerate(tests)]).first()
    want = [max(1, int(s * 3000)) if 0 < s < 1 else min(int(s), 3000) for s in sizes]
    assert list(got) == want


def test_hash_cuts_take_the_smallest(heavy):
    rows, df = heavy
    hashed = df.withColumn("_h", X.row_hash(4, ["id"]))
    (test,) = X.hash_cuts(hashed, [10])
    got = {r["id"] for r in hashed.where(test).collect()}
    assert got == {i for _, i in sorted((md5(f"4|{r[0]}"), r[0]) for r in rows)[:10]}


PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 0.995, 1.0]


@pytest.mark.parametrize("buckets", [2, 16, None])
def test_exact_quantiles(heavy, buckets):
    rows, df = heavy
    got = {(r["g"], r["prob"]): r["value"] for r in X.exact_quantiles(df, "v", PROBS, ["g"], buckets).collect()}
    for g in {r[2] for r in rows}:
        want = np.quantile([r[1] for r in rows if r[2] == g], PROBS)
        assert np.allclose([got[(g, p)] for p in PROBS], want, rtol=0, atol=1e-9)


def test_quantiles_of_columns_skip_missing(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (3.0, None), (None, None)], "a double, b double")
    got = X.exact_quantiles_of_columns(df, ["a", "b"], [0.5, 1.0])
    assert got == {"a": [2.0, 3.0], "b": [None, None]}


def test_empty_frames(spark):
    df = spark.createDataFrame([], "id long, v double, g string")
    assert X.global_row_number(df, "v", ["id"]).count() == 0
    assert X.exact_quantiles(df, "v", [0.5]).count() == 0
    assert X.running_total(df, "v", {"s": "id"}).count() == 0
