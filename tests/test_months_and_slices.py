"""Month partitions, jobs on whole slices, input that becomes visible later, clean-up of written intermediates."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from driftwell.operators import ticks as T
from driftwell.session import pin, release_pins
from driftwell.sources import slices
from driftwell.sources.months import months_of, read_months, write_months
from driftwell.streaming import ticks as S

T0 = dt.datetime(2020, 1, 6)


def files(folder):
    return {f"{d}/{f}": os.stat(f"{d}/{f}").st_mtime_ns for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_months(spark, tmp_path):
    rows = [(i, dt.datetime(2020 + i % 2, 1 + i % 4, 3)) for i in range(80)] + [(99, None)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz")
    write_months(df, f"{tmp_path}/t", "ts")
    got = read_months(spark, f"{tmp_path}/t", [(2020, 1), (2021, 2), (2021, 2)])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "slice_year" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    opened = {os.path.dirname(r[0]).split("/t/")[1] for r in got.select(F.input_file_name()).distinct().collect()}
    assert opened == {"slice_year=2020/slice_month=1", "slice_year=2021/slice_month=2"}
    assert sorted(r.id for r in got.collect()) == sorted(i for i, t in rows if t and (t.year, t.month) in {(2020, 1), (2021, 2)})
    assert months_of(spark, f"{tmp_path}/t") == [(2020, 1), (2020, 3), (2021, 2), (2021, 4)]
    assert read_months(spark, f"{tmp_path}/t").count() == 81 and read_months(spark, f"{tmp_path}/t", []).count() == 0
    before = files(f"{tmp_path}/t")
    write_months(spark.createDataFrame([(1, dt.datetime(2020, 3, 9))], "id long, ts timestamp_ntz"), f"{tmp_path}/t", "ts")
    after = files(f"{tmp_path}/t")
    other = {f for f in before if "slice_year=2020/slice_month=3" not in f}
    assert {f: after[f] for f in other} == {f: before[f] for f in other} and len(after) == len(other) + 1
    assert read_months(spark, f"{tmp_path}/t", [(2020, 3)]).count() == 1


def test_csv_with_a_schema(spark, tmp_path):
    with open(f"{tmp_path}/a.csv", "w") as f:
        f.write("a,b\n1,x\n2,\n")
    assert slices.load_slice(spark, f"{tmp_path}/a.csv", schema="a long, b string").dtypes == [("a", "bigint"), ("b", "string")]


def test_job_runs_on_whole_slices(spark, tmp_path):
    seen = []

    def job(name, rows):
        seen.append((name, sorted(r.v for r in rows.collect())))

    def deliver(name, parts):
        for part in parts:  # a slice of several files, written one after the other
            spark.createDataFrame([(v,) for v in part], "v long").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/{name}")

    deliver("a", [[1, 2], [3]])
    deliver("b", [[7]])  # not told of yet
    S.finish_slice(spark, f"{tmp_path}/markers", "a", f"{tmp_path}/in/a")
    S.on_whole_slice(spark, f"{tmp_path}/markers", job, f"{tmp_path}/check")
    assert seen == [("a", [1, 2, 3])]
    deliver("b", [[8], [9]])
    S.finish_slice(spark, f"{tmp_path}/markers", "b", f"{tmp_path}/in/b")
    S.on_whole_slice(spark, f"{tmp_path}/markers", job, f"{tmp_path}/check")
    S.on_whole_slice(spark, f"{tmp_path}/markers", job, f"{tmp_path}/check")  # nothing new
    assert seen == [("a", [1, 2, 3]), ("b", [7, 8, 9])]


@pytest.mark.parametrize("ticks", [0, 2])
def test_withheld_stream_equals_the_batch_form(spark, tmp_path, ticks):
    rows = [(z, T0 + dt.timedelta(minutes=15 * t), 10 * t + i) for i, z in enumerate("ab") for t in range(8)]
    demand = spark.createDataFrame(rows, "zone_id string, tick timestamp_ntz, n long")
    at = F.col("tick").cast("timestamp")
    sent = demand.select("zone_id", at.alias("tick"), at.alias("arrival"), F.lit("tick").alias("kind"), F.lit("").alias("decision"), F.col("n").alias("seq"))
    late = S.write_deliveries(sent, f"{tmp_path}/in", 2)
    stream = S.read_stream(spark, f"{tmp_path}/in/delivery=*", S.REPORT_FIELDS, 1).select("zone_id", "tick", F.col("seq").alias("n"))
    run = S.run_to_sink(S.withheld_stream(stream, ticks, late), f"{tmp_path}/out", f"{tmp_path}/check")
    assert S.dropped_rows(run) == 0
    found = spark.read.parquet(f"{tmp_path}/out").where("zone_id <> ''").withColumn("tick", F.col("tick").cast("timestamp_ntz"))
    wanted = T.withheld(demand, ticks).select("zone_id", "tick", "n", "visible_n")
    key = lambda r: (r[0], r[1])
    assert sorted(map(tuple, found.select(*wanted.columns).collect()), key=key) == sorted(map(tuple, wanted.collect()), key=key)


def test_written_intermediates_go(spark):
    df = pin(spark.range(5), "gone")
    folder = os.path.dirname(df.inputFiles()[0].removeprefix("file://"))
    assert os.path.isdir(folder)
    assert release_pins(spark) >= 1 and not os.path.exists(folder) and release_pins(spark) == 0
