"""Commit log with two writers, merged snapshots, folds with a combine step of one's own."""

import datetime as dt
import os
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftwell.operators.states import Fold, fold
from driftwell.plans.store import ModelStore
from driftwell.sources.commits import CommitLog
from driftwell.streaming.snapshots import KeyedSnapshot


class Saved:
    """Stands for a fitted model."""

    def __init__(self, name):
        self.name = name

    def save(self, path):
        os.makedirs(os.path.dirname(path), exist_ok=True)
        os.mkdir(path)  # fails if the place is taken
        with open(f"{path}/name", "w") as f:
            f.write(self.name)


def both(*jobs):
    errors = []

    def run(job):
        try:
            job()
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=run, args=(j,)) for j in jobs]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors, errors


def test_log_with_two_writers(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path))
    assert log.last() == (0, None) and log.frame("who string").count() == 0

    def writer(who):
        for i in range(15):
            log.append(lambda n, before, i=i: {"who": who, "i": i, "after": before["who"] + str(before["i"]) if before else ""})

    both(lambda: writer("a"), lambda: writer("b"))
    assert log.numbers() == list(range(1, 31))
    entries = log.read(log.numbers())
    assert sorted((e["who"], e["i"]) for e in entries) == sorted((w, i) for w in "ab" for i in range(15))
    for who in "ab":
        assert [e["i"] for e in entries if e["who"] == who] == list(range(15))
    assert [e["after"] for e in entries[1:]] == [f"{e['who']}{e['i']}" for e in entries[:-1]]
    assert log.frame("who string").count() == 30
    assert log.append(lambda n, before: None) == 0 and len(log.numbers()) == 30
    assert not log._create(30, "{}")  # a number is taken once


def test_store_with_two_writers(spark, tmp_path):
    store = ModelStore(spark, str(tmp_path))

    def writer(name):
        for i in range(3):
            version = store.add_version("m", Saved(f"{name}{i}"), "candidate", "pending", "")
            store.move_alias("m", "champion", version)

    both(lambda: writer("a"), lambda: writer("b"))
    assert sorted(r.version for r in store.versions().collect()) == list("123456")
    assert len({open(f"{tmp_path}/models/m/v{v}/name").read() for v in range(1, 7)}) == 6
    moves = [(r.alias, r.version) for r in store.aliases().orderBy("ts", "seq").collect()]
    champions = [v for a, v in moves if a == "champion"]
    assert sorted(champions) == list("123456")
    assert [v for a, v in moves if a == "previous_champion"] == champions[:-1]
    assert store.alias("m", "champion") == champions[-1] and store.alias("m", "previous_champion") == champions[-2]
    assert store.alias("n", "champion") is None


def test_snapshot(spark, tmp_path):
    schema = "k string, n long"
    empty = spark.createDataFrame([], schema)
    sink = KeyedSnapshot(spark, str(tmp_path), ("k",), empty.schema, buckets=8)
    assert sink.read().count() == 0
    batches = [[("a", 1), ("b", 2), (None, 3)], [("a", 10), ("c", 4)], [("b", 20)]]
    for i, rows in enumerate(batches):
        before = sink.folders()
        assert sink.merge(spark.createDataFrame(rows, schema), i)
        now = sink.folders()
        same = [b for b in before if now[b] == before[b]]
        assert len(now) - len(same) <= len(rows)  # only touched buckets are written again
    wanted = [("a", 10), ("b", 20), ("c", 4), (None, 3)]
    assert sorted(map(tuple, sink.read().collect()), key=str) == sorted(wanted, key=str)
    files = sorted(os.listdir(f"{tmp_path}/data")), sink.log.numbers()
    assert not sink.merge(spark.createDataFrame([("a", 99)], schema), 2)  # the batch comes again
    assert (sorted(os.listdir(f"{tmp_path}/data")), sink.log.numbers()) == files
    for i in range(3, 10):
        sink.merge(spark.createDataFrame([("a", i)], schema), i)
    assert len(sink.read().inputFiles()) <= 8 and sink.read().where("k = 'a'").first().n == 9
    first = KeyedSnapshot(spark, f"{tmp_path}/first", ("k",), empty.schema, keep="first", buckets=2)
    for i in range(3):
        first.merge(spark.createDataFrame([("a", i)], schema), i)
    assert first.read().first().n == 0


PAID = Fold(
    zero=lambda: (0, 0),
    block=lambda s, rows: (s[0] + int((rows["v"] > 0).sum()), s[1] + len(rows)),
    combine=lambda x, y: (x[0] + y[0], x[1] + y[1]),
    final=lambda s: (s[0] / s[1] if s[1] else float("nan"),),
)
#: Rows of a key in the order of their numbers, as first and last of each rising stretch: no built-in aggregate does that.
JOIN = Fold(
    zero=list,
    block=lambda s, rows: sorted([*s, *rows["v"].tolist()]),
    combine=lambda x, y: sorted([*x, *y]),
    final=lambda s: (",".join(map(str, s)),),
)


def test_folds(spark):
    rows = [(k, v) for k in ("hot", None, "x") for v in range(300 if k == "hot" else 3)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(40)
    got = {r.k: r.all for r in fold(df, ["k"], JOIN, "all string", fan=2).collect()}
    assert got == {k: ",".join(str(v) for q, v in rows if q == k) for k in ("hot", None, "x")}
    assert fold(df.where("v < 0"), ["k"], PAID, "rate double").count() == 0
    by_number = fold(df.withColumn("k", F.when(F.col("k") == "hot", 7)), ["k"], PAID, "rate double").collect()
    assert {r.k for r in by_number} == {7, None}
    whole = fold(df, [], PAID, "rate double").collect()
    assert [round(r.rate, 6) for r in whole] == [round(sum(v > 0 for _, v in rows) / len(rows), 6)]
    assert np.isnan(fold(df.where("v < 0"), [], PAID, "rate double").first().rate)


def test_a_hot_key_is_spread(spark):
    df = spark.range(64).select(F.lit("one").alias("k"), F.col("id").alias("v")).repartition(64)
    seen = Fold(zero=lambda: [1], block=lambda s, rows: s, combine=lambda x, y: [max(*x, *y) + 1], final=lambda s: (s[0],))
    # in one place the 64 states would take 63 steps, one after the other
    assert fold(df, ["k"], seen, "steps int", fan=4).first().steps < 20
