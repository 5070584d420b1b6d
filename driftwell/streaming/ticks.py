"""The demand replay as a stream."""

from __future__ import annotations

import threading
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from driftwell.operators.ticks import TickConfig, score
from driftwell.streaming.snapshots import KeyedSnapshot

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

REPORT_FIELDS = "zone_id string, tick timestamp, kind string, decision string, arrival timestamp, seq bigint"
OUTCOME_FIELDS = "zone_id string, tick timestamp, kind string, decision string, used_fallback boolean, latency_s double, seq bigint"


def read_stream(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files as they arrive in a folder, or the files a pattern matches."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def read_deliveries(spark: SparkSession, path: str, schema) -> DataFrame:
    """What :func:`write_deliveries` wrote, as a stream of as many batches as there are deliveries or few more, however
    many files a delivery has."""
    found = spark.read.schema(schema).parquet(f"{path}/delivery=*").inputFiles()
    most = max(Counter(file.rsplit("/", 2)[-2] for file in found).values())
    return read_stream(spark, f"{path}/delivery=*", schema, most)


def tick_counts(stream: DataFrame, zone: str, ts: str, minutes: int = 15, late: str | None = None) -> DataFrame:
    """Event-time tumbling counts per zone; state is one number per open (zone, tick).

    Without ``late`` no row is ever too late: for update mode, with every window kept open. With it, rows that
    come more than ``late`` after a newer one are dropped, and :func:`dropped_rows` tells how many.
    """
    timed = stream.withColumn("_ts", F.col(ts).cast("timestamp"))
    timed = timed.withWatermark("_ts", late) if late else timed
    counts = timed.groupBy(F.window("_ts", f"{minutes} minutes"), F.col(zone).alias("zone_id")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return counts.select("zone_id", F.col("window.start").cast("timestamp_ntz").alias("tick"), "n")


def withheld_stream(demand: DataFrame, ticks: int, late: str, minutes: int = 15) -> DataFrame:
    """``zone_id, tick, n, visible_n`` of a stream of demand: beside each row what has become visible at its tick,
    ``ticks`` ticks late. Both sides wait for each other only as long as the watermark is behind them."""
    shift = F.expr(f"INTERVAL {int(ticks) * int(minutes)} MINUTES")
    seen = demand.select("zone_id", "tick", "n").withWatermark("tick", late)
    released = demand.select(F.col("zone_id").alias("_zone"), (F.col("tick") + shift).alias("_tick"), F.col("n").alias("visible_n"))
    released = released.withWatermark("_tick", late)
    same = (F.col("zone_id") == F.col("_zone")) & (F.col("tick") == F.col("_tick"))
    return seen.join(released, same, "leftOuter").select("zone_id", "tick", "n", "visible_n")


def score_stream(counts: DataFrame, base: DataFrame, factor: float = 1.5) -> DataFrame:
    """Decision per closed (zone, tick): a stream joined with the static norm table."""
    return score(counts, base, factor).select("zone_id", "tick", "n", "mean_n", "decision")


def drop_repeats(reports: DataFrame, late: str | None = None) -> DataFrame:
    """First report per (zone, tick); repeats vanish uncounted. With ``late`` the memory is that long, and
    older rows are dropped; without it nothing is lost and every key is kept."""
    if late is None:
        return reports.dropDuplicates(["zone_id", "tick"])
    return reports.withWatermark("arrival", late).dropDuplicatesWithinWatermark(["zone_id", "tick"])


class DropCounter(StreamingQueryListener):
    """Rows that came too late for their state, over all batches of a run."""

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}
        self.batches: dict[str, int] = {}
        self.ended: dict[str, threading.Event] = {}
        self.lock = threading.Lock()

    def end_of(self, run: str) -> threading.Event:
        with self.lock:
            return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self.end_of(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p, run = event.progress, str(event.progress.runId)
        self.dropped[run] = self.dropped.get(run, 0) + sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        self.batches[run] = self.batches.get(run, 0) + 1

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.end_of(str(event.runId)).set()


_COUNTERS: dict[str, DropCounter] = {}


def drop_counter(spark: SparkSession) -> DropCounter:
    """The counter of a session; it listens from the first call on."""
    app = spark.sparkContext.applicationId
    if app not in _COUNTERS:
        _COUNTERS[app] = DropCounter()
        spark.streams.addListener(_COUNTERS[app])
    return _COUNTERS[app]


def dropped_rows(run: StreamingQuery, wait_s: float = 60) -> int:
    """Rows of a finished run of :func:`run_to_sink` that came too late for their state, in any of its batches."""
    counter = drop_counter(SparkSession.active())
    if not counter.end_of(str(run.runId)).wait(wait_s):
        raise RuntimeError("the run has not ended")
    return counter.dropped.get(str(run.runId), 0)


# ---- state per zone ---------------------------------------------------------


class ZoneState(StatefulProcessor):
    """Everything a zone must remember to accept one outcome per tick.

    A tick closes ``timeout`` after its start. The earliest report in time wins,
    whatever the delivery order, as long as the tick is open; the others are
    duplicates, and a report that arrives after the close is late. Both are put
    out once, so they can be counted, and change nothing. A tick without a
    report falls back on the last outcome. State is the open ticks and five values,
    the last outcome among them, so it does not grow with the stream.
    Rows are taken block by block; one timer per zone closes all ticks that are due.
    """

    def __init__(self, cfg: TickConfig) -> None:
        self.timeout_us = int(cfg.tick_timeout_s * 1_000_000)
        self.first_use = cfg.first_use

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "decision string, closed_us bigint, late bigint, duplicates bigint, fallbacks bigint")
        self.open = handle.getMapState("open", "tick_us bigint", "decision string, arrival_us bigint, seq bigint")

    def _load(self) -> list:
        return list(self.last.get()) if self.last.exists() else [None, -1, 0, 0, 0]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state = self._load()
        pending = {k[0]: tuple(v) for k, v in self.open.iterator()}
        changed: set[int] = set()
        for block in rows:
            yield self._take(key[0], block, state, pending, changed)
        for tick_us in changed:
            self.open.updateValue((tick_us,), pending[tick_us])
        self.last.update(tuple(state))
        self._schedule(pending, timerValues.getCurrentWatermarkInMs())

    def _take(self, zone, block: pd.DataFrame, state: list, pending: dict, changed: set) -> pd.DataFrame:
        """Merge one block into the open ticks; returns the reports that lost."""
        micros = lambda c: block[c].to_numpy().astype("datetime64[us]").astype("int64")
        work = pd.DataFrame(
            {"tick": micros("tick"), "arrival": micros("arrival"), "seq": block["seq"].to_numpy(), "report": block["kind"].to_numpy() == "report", "decision": block["decision"].to_numpy()}
        )
        over = (work["arrival"] > work["tick"] + self.timeout_us) | (work["tick"] <= state[1])
        late = work[over & work["report"]]
        state[2] += len(late)
        for tick_us in work.loc[~over, "tick"].unique():
            if tick_us not in pending:
                pending[int(tick_us)] = (None, None, None)
                changed.add(int(tick_us))
        timely = work[~over & work["report"]].sort_values(["tick", "arrival", "seq"], kind="stable")
        head = ~timely.duplicated("tick")
        lost = [timely[~head]]
        for row in timely[head].itertuples(index=False):
            tick_us, mine = int(row.tick), (row.decision, int(row.arrival), int(row.seq))
            held = pending[tick_us]
            loser = mine
            if held[0] is None or mine[1:] < held[1:]:
                pending[tick_us], loser = mine, held
                changed.add(tick_us)
            if loser[0] is not None:
                lost.append(pd.DataFrame([{"tick": tick_us, "arrival": loser[1], "seq": loser[2], "decision": loser[0]}]))
        duplicate = pd.concat(lost, ignore_index=True)
        state[3] += len(duplicate)
        both = pd.concat([late.assign(kind="late"), duplicate.assign(kind="duplicate")], ignore_index=True)
        return self._frame(zone, both, False)

    def _schedule(self, pending: dict, watermark_ms: int) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer[0] if isinstance(timer, (list, tuple)) else timer)
        if pending:
            due = (min(pending) + self.timeout_us + 999) // 1000
            self.handle.registerTimer(max(due, watermark_ms + 1))  # a timer in the past would never fire

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state, out = self._load(), []
        now_us = timerValues.getCurrentWatermarkInMs() * 1000
        pending = {k[0]: tuple(v) for k, v in self.open.iterator()}
        due = sorted(t for t in pending if t + self.timeout_us <= now_us)
        for tick_us in due:
            decision, arrival, seq = pending.pop(tick_us)
            fallback = decision is None
            if fallback:
                decision = state[0] or self.first_use
                state[4] += 1
            state[0], state[1] = decision, tick_us
            out.append({"tick": tick_us, "arrival": arrival, "seq": seq, "decision": decision, "used_fallback": fallback})
        if due:  # one clear is cheaper than many single removals
            self.open.clear()
            for tick_us, value in pending.items():
                self.open.updateValue((tick_us,), value)
        self.last.update(tuple(state))
        self._schedule(pending, timerValues.getCurrentWatermarkInMs())
        columns = ["tick", "arrival", "seq", "decision", "used_fallback"]
        yield self._frame(key[0], pd.DataFrame(out, columns=columns).assign(kind="accepted"), None)

    @staticmethod
    def _frame(zone, rows: pd.DataFrame, fallback) -> pd.DataFrame:
        latency = (pd.to_numeric(rows["arrival"]) - pd.to_numeric(rows["tick"])) / 1e6
        return pd.DataFrame(
            {
                "zone_id": pd.Series(zone, index=rows.index, dtype="object"),
                "tick": pd.to_datetime(pd.to_numeric(rows["tick"]), unit="us"),
                "kind": rows["kind"].astype("object"),
                "decision": rows["decision"].astype("object"),
                "used_fallback": rows["used_fallback"].astype("bool") if fallback is None else pd.Series(fallback, index=rows.index, dtype="bool"),
                "latency_s": latency.astype("float64"),
                "seq": pd.to_numeric(rows["seq"]).astype("Int64"),
            }
        )

    def close(self) -> None:
        pass


def zone_outcomes(stream: DataFrame, late: str, cfg: TickConfig = TickConfig()) -> DataFrame:
    """Outcomes and ignored reports of a stream of ``kind`` = tick markers and reports.

    ``late`` is how long after a newer row a row may still come; what comes later is dropped and counted
    (:func:`dropped_rows`). Needs the RocksDB state store. Zones are independent, so the work spreads by zone.
    """
    return (
        stream.withWatermark("arrival", late)
        .groupBy("zone_id")
        .transformWithStateInPandas(
            statefulProcessor=ZoneState(cfg), outputStructType=OUTCOME_FIELDS, outputMode="Append", timeMode="EventTime"
        )
    )


def replay_input(grid: DataFrame, reports: DataFrame) -> DataFrame:
    """Tick markers and reports in one frame, as a replay puts them in a folder."""
    markers = grid.select(
        "zone_id", F.col("tick").cast("timestamp").alias("tick"), F.lit("tick").alias("kind"), F.lit(None).cast("string").alias("decision"),
        F.col("tick").cast("timestamp").alias("arrival"), F.lit(-1).cast("bigint").alias("seq"),
    )
    start = F.col("tick").cast("timestamp")
    arrival = F.timestamp_micros(F.unix_micros(start) + F.round(F.col("latency_s") * 1_000_000).cast("bigint"))
    rows = reports.select("zone_id", start.alias("tick"), F.lit("report").alias("kind"), "decision", arrival.alias("arrival"), "seq")
    return markers.unionByName(rows)


def write_deliveries(rows: DataFrame, path: str, deliveries: int) -> str:
    """Writes a replay as ``deliveries`` folders that come one after the other, out of order inside and with a part of
    the rows one delivery late; a marker far ahead ends the last. Returns the lateness that loses no row."""
    spark = rows.sparkSession
    seconds = F.unix_seconds("arrival")
    begin, end = rows.agg(F.min(seconds), F.max(seconds)).first()
    width = max(1, -(-((end or 0) - (begin or 0) + 1) // deliveries))
    late = 2 * width + 1
    behind = F.pmod(F.xxhash64("zone_id", "tick", "seq"), F.lit(5)) == 0
    place = F.floor((seconds - (begin or 0)) / width) + behind.cast("int")
    dealt = rows.withColumn("delivery", F.least(place, F.lit(deliveries - 1)).cast("int"))
    last = F.timestamp_seconds(F.lit((end or 0) + 2 * late))
    ended = spark.range(1).select(
        F.lit("").alias("zone_id"), last.alias("tick"), F.lit("end").alias("kind"), F.lit(None).cast("string").alias("decision"), last.alias("arrival"), F.lit(-1).cast("bigint").alias("seq")
    )
    for k in range(deliveries):
        part = dealt.where(F.col("delivery") == k).drop("delivery")
        part.write.parquet(f"{path}/delivery={k}")
    ended.write.parquet(f"{path}/delivery={deliveries}")
    return f"{late} seconds"


# ---- sinks ------------------------------------------------------------------


def keyed_sink(path: str):
    """``foreachBatch`` writer: a batch owns one folder, so a repeated batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def read_keyed(spark: SparkSession, path: str, keys: list[str], keep: str = "last") -> DataFrame:
    """One row per key from a keyed sink: the latest state, or the first accepted one."""
    df = spark.read.parquet(path)
    rest = [c for c in df.columns if c not in (*keys, "batch_id")]
    pick = F.max_by if keep == "last" else F.min_by
    chosen = df.groupBy(*keys).agg(pick(F.struct(*rest), "batch_id").alias("_row"))
    return chosen.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def run_to_sink(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process what is there into a keyed sink and return when done."""
    return _run(stream, keyed_sink(path), checkpoint, mode)


def run_merged(stream: DataFrame, sink: KeyedSnapshot, checkpoint: str, mode: str = "update") -> StreamingQuery:
    """Process what is there into a merged snapshot and return when done."""

    def write(batch: DataFrame, batch_id: int) -> None:
        sink.merge(batch, batch_id)

    return _run(stream, write, checkpoint, mode)


def _run(stream: DataFrame, write, checkpoint: str, mode: str) -> StreamingQuery:
    drop_counter(stream.sparkSession)
    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


MARKER_FIELDS = "slice string, path string"


def finish_slice(spark: SparkSession, markers: str, name: str, path: str) -> None:
    """Tells that the slice ``name`` in the folder ``path`` is whole; to be called after its last file is written."""
    spark.createDataFrame([(name, path)], MARKER_FIELDS).coalesce(1).write.mode("append").json(markers)


def on_whole_slice(spark: SparkSession, markers: str, job, checkpoint: str) -> StreamingQuery:
    """Runs ``job(name, rows)`` once for every slice that :func:`finish_slice` has told of, on all files of it,
    however many they are and whenever they came. A run that fails is repeated with the same slices."""
    stream = spark.readStream.schema(MARKER_FIELDS).json(markers)

    def each(batch: DataFrame, batch_id: int) -> None:
        for r in batch.dropDuplicates(["slice"]).orderBy("slice").collect():  # one row a slice
            job(r["slice"], batch.sparkSession.read.parquet(r["path"]))

    return _run(stream, each, checkpoint, "append")


def on_new_slice(stream: DataFrame, job, checkpoint: str) -> StreamingQuery:
    """Run ``job(rows, batch_id)`` for the newly arrived files, as they come; a slice of several files may come in
    parts (:func:`on_whole_slice` waits for all of them)."""
    query = (
        stream.writeStream.foreachBatch(job).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


