"""Ticks that close by the share of zones, as a stream against the batch operators; rows lost over a whole run."""

import datetime as dt
import os
import random

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from driftwell.operators import ticks as T
from driftwell.streaming import ticks as S
from driftwell.streaming.completion import TickState, completed_outcomes

T0 = dt.datetime(2020, 1, 6)
ZONES = [f"z{i}" for i in range(6)]


def replay(seed, ticks=5, most=4):
    """Reports with repeats, silent zones and late ones; latencies are whole microseconds."""
    rnd = random.Random(seed)
    rows = []
    for t in range(ticks):
        for zone in ZONES:
            for _ in range(rnd.randrange(most)):
                decision = rnd.choice(["NEED", "OK"])
                rows.append((zone, T0 + dt.timedelta(minutes=15 * t), decision, rnd.randrange(3_000_000) / 1e6, len(rows)))
    return rows


@pytest.mark.parametrize(("seed", "fraction"), [(1, 0.75), (2, 0.5)])
def test_equals_the_batch_form(spark, tmp_path, seed, fraction):
    spark.conf.set(S.STATE_STORE, S.ROCKSDB)
    cfg = T.TickConfig(completion_fraction=fraction, tick_timeout_s=2.0)
    rows = replay(seed)
    reports = spark.createDataFrame(rows, "zone_id string, tick timestamp_ntz, decision string, latency_s double, seq long")
    grid = spark.createDataFrame([(z, T0 + dt.timedelta(minutes=15 * t)) for z in ZONES for t in range(5)], "zone_id string, tick timestamp_ntz")
    late = S.write_deliveries(S.replay_input(grid, reports), f"{tmp_path}/in", 2)
    stream = S.read_stream(spark, f"{tmp_path}/in/delivery=*", S.REPORT_FIELDS, 1)
    run = S.run_to_sink(completed_outcomes(stream, late, len(ZONES), cfg), f"{tmp_path}/out", f"{tmp_path}/check")
    assert S.dropped_rows(run) == 0
    found = spark.read.parquet(f"{tmp_path}/out").withColumn("tick", F.col("tick").cast("timestamp_ntz"))
    outcomes = sorted(map(tuple, found.where("kind = 'accepted'").select("zone_id", "tick", "decision", "used_fallback").collect()))
    ignored = sorted(map(tuple, found.where("kind <> 'accepted'").select("seq", "kind").collect()))
    first = T.first_reports(reports)
    close = T.tick_close(first, len(ZONES), cfg)
    wanted = T.accepted_decisions(grid, first, close, cfg).select("zone_id", "tick", "decision", "used_fallback")
    assert outcomes == sorted(map(tuple, wanted.collect()))
    kinds = T.classify_reports(reports, first, close).where("kind <> 'accepted'").select("seq", "kind")
    assert ignored == sorted(map(tuple, kinds.collect()))
    assert {"late", "duplicate"} == {k for _, k in ignored}


def test_overlapping_ticks_are_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        completed_outcomes(None, "1 second", 3, T.TickConfig(tick_minutes=1, tick_timeout_s=61))


def test_rows_lost_in_an_early_batch_are_counted(spark, tmp_path):
    """Spark remembers the last hundred batches; the row is lost in the fourth of 105."""
    width = dt.timedelta(hours=1)
    # a batch drops what is behind the watermark that the batch before it began with
    stamps = [T0, T0 + 100 * width, T0 + 100 * width, T0] + [T0 + (101 + i) * width for i in range(101)]
    os.mkdir(f"{tmp_path}/in")
    for i, at in enumerate(stamps):
        one = {"zone_id": [f"z{i}"], "tick": [T0], "kind": ["report"], "decision": ["OK"], "arrival": [at], "seq": [i]}
        pq.write_table(pa.table(one), f"{tmp_path}/in/{i:03d}.parquet")
        os.utime(f"{tmp_path}/in/{i:03d}.parquet", (i, i))  # files come in this order
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    stream = S.read_stream(spark, f"{tmp_path}/in", S.REPORT_FIELDS, 1)
    run = S.run_to_sink(S.drop_repeats(stream, "1 minute"), f"{tmp_path}/out", f"{tmp_path}/check")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert S.dropped_rows(run) == 1
    assert S.drop_counter(spark).batches[str(run.runId)] > 100
    kept = sum(s["numRowsDroppedByWatermark"] for p in run.recentProgress for s in p["stateOperators"])
    assert kept == 0 and spark.read.parquet(f"{tmp_path}/out").count() == 104


class Held:
    """State of one tick without Spark; counts what is put in."""

    def __init__(self):
        self.value, self.rows = None, []

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value if self.value is not None else iter(self.rows)

    def update(self, value):
        self.value = value

    def clear(self):
        self.value, self.rows = None, []

    def appendValue(self, value):
        self.rows.append(value)

    def appendList(self, values):
        self.rows.extend(values)

    def getCurrentWatermarkInMs(self):
        return 0

    def listTimers(self):
        return []

    def registerTimer(self, at):
        pass


def test_a_block_of_reports_is_one_entry_of_state():
    """Reports with ties, an unknown zone and markers between; each counts once whatever the block it comes in."""
    rnd = random.Random(7)
    reports = [(rnd.choice([*ZONES[:3], None]), T0 + dt.timedelta(microseconds=rnd.randrange(3) * 900_000), k // 2, rnd.choice(["NEED", "OK"])) for k in range(300)]
    frame = pd.DataFrame(reports, columns=["zone_id", "arrival", "seq", "decision"]).assign(kind="report")
    frame["arrival"] = pd.to_datetime(frame["arrival"])
    markers = pd.DataFrame({"zone_id": ZONES, "arrival": pd.Timestamp(T0), "seq": -1, "decision": None, "kind": "tick"})
    blocks = [frame[:120], markers, frame[120:]]
    got = []
    for parts in (blocks, [pd.concat(blocks)]):
        state = TickState(T.TickConfig(completion_fraction=0.5, tick_timeout_s=1.0), 6)
        state.handle, state.first, state.lost, state.closed = Held(), Held(), Held(), Held()
        out = list(state.handleInputRows((pd.Timestamp(T0),), iter(parts), Held()))
        assert 0 < len(state.lost.rows) <= 2
        out += list(state.handleExpiredTimer((pd.Timestamp(T0),), Held(), None))
        got.append(sorted(zip(*(pd.concat(out)[c].astype("object").map(str) for c in ("zone_id", "kind", "decision", "seq", "arrival")), strict=True)))
    assert got[0] == got[1] and len(got[0]) == 300 + 3  # and the zones without a report
    firsts = {z: min((a, s, d) for x, a, s, d in reports if x == z) for z in {r[0] for r in reports}}
    accepted = {z: (s, d) for z, kind, d, s, _ in got[0] if kind == "accepted" and d in ("NEED", "OK")}
    assert accepted == {str(z): (str(s), d) for z, (_, s, d) in firsts.items()}
    close = sorted(a for a, _, _ in firsts.values())[2]  # half of the zones
    late = sum(a > close for _, a, _, _ in reports)
    assert sum(kind == "late" for _, kind, *_ in got[0]) == late > 0


def test_a_delivery_is_one_batch_however_many_files_it_has(spark, tmp_path):
    rows = replay(3, ticks=12)
    reports = spark.createDataFrame(rows, "zone_id string, tick timestamp_ntz, decision string, latency_s double, seq long")
    grid = reports.select("zone_id", "tick").distinct()
    S.write_deliveries(S.replay_input(grid, reports).repartition(6), f"{tmp_path}/in", 2)
    stream = S.read_deliveries(spark, f"{tmp_path}/in", S.REPORT_FIELDS)
    S.run_to_sink(stream, f"{tmp_path}/out", f"{tmp_path}/check")
    found = spark.read.parquet(f"{tmp_path}/out")
    files = [len([x for x in os.listdir(f"{tmp_path}/in/delivery={k}") if x.endswith(".parquet")]) for k in range(2)]
    assert max(files) > 3 and found.select("batch_id").distinct().count() <= 3
    assert found.where("kind = 'report'").count() == len(rows)
