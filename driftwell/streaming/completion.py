"""Ticks that close when enough zones have reported, as a stream.

Two stateful steps. The first has a state for each open tick: the first report of every zone and the reports that lost
against one. The tick closes at the arrival of the wanted share of zones, or at its timeout if that is earlier; this
is known once the watermark has passed that moment. Then the step tells for every zone whether its report came in
time, and what every other report was. The second step has a state for each zone, the last outcome, and fills the
outcomes of zones without a report in time.

Reports are taken block by block, without a step per row; those that lost are kept as blocks.

State of a tick ends with its timeout: what comes later is late whatever the tick was. So it is bounded by the ticks
between the watermark and the newest row, and by the zones.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from driftwell.operators.ticks import TickConfig
from driftwell.streaming.ticks import OUTCOME_FIELDS

VERDICT_FIELDS = "zone_id string, tick timestamp, kind string, decision string, arrival timestamp, seq bigint, told timestamp"
LOST_LAYOUT = [("zone_id", pa.string()), ("arrival", pa.int64()), ("seq", pa.int64()), ("decision", pa.string())]
LOST = [name for name, _ in LOST_LAYOUT]
Report = tuple[int, int, str]  # arrival, seq, decision: the order of reports


class TickState(StatefulProcessor):
    """One tick: first reports by zone, reports that lost, and when it closed."""

    def __init__(self, cfg: TickConfig, zones: int) -> None:
        self.need = max(1, math.ceil(cfg.completion_fraction * zones))
        self.timeout_us = int(cfg.tick_timeout_s * 1_000_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        lists = "zone_id array<string>, arrival array<bigint>, seq array<bigint>, decision array<string>"
        self.first = handle.getValueState("first", lists)
        self.lost = handle.getListState("lost", "block binary")  # zone_id, arrival, seq, decision as an Arrow stream
        self.closed = handle.getValueState("closed", "close_us bigint")

    def _due(self, first: dict[str, Report | None], end_us: int) -> int:
        """When the tick closes, as far as is known; more rows can only make it earlier."""
        arrivals = sorted(r[0] for r in first.values() if r)
        return min(arrivals[self.need - 1], end_us) if len(arrivals) >= self.need else end_us

    def _load(self) -> dict[str, Report | None]:
        held = self.first.get() if self.first.exists() else ((), (), (), ())
        return {zone: None if report[0] is None else tuple(report) for zone, *report in map(_plain, zip(*held, strict=True))}

    def _save(self, first: dict[str, Report | None]) -> None:
        rows = [(zone, *(report or (None, None, None))) for zone, report in first.items()]
        self.first.update(tuple(map(list, zip(*rows, strict=True))))

    @staticmethod
    def _compete(first: dict[str, Report | None], timely: pd.DataFrame) -> pd.DataFrame:
        """Takes the earliest report of each zone into ``first``; returns the reports that lost."""
        ordered = timely.sort_values(["arrival", "seq", "decision"], kind="stable")
        head = ~ordered.duplicated("zone_id").to_numpy()
        beaten = []
        for zone, arrival, seq, decision in ordered.loc[head, LOST].itertuples(index=False, name=None):
            mine, held = (arrival, seq, decision), first.get(_name(zone))
            first[_name(zone)] = min(held, mine) if held else mine
            if held:
                beaten.append((zone, *max(held, mine)))
        return pd.concat([ordered.loc[~head, LOST], pd.DataFrame(beaten, columns=LOST)]) if beaten else ordered.loc[~head, LOST]

    def _timer(self, at_us: int, watermark_ms: int) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer[0] if isinstance(timer, (list, tuple)) else timer)
        self.handle.registerTimer(max(-(-at_us // 1000), watermark_ms + 1))  # a timer in the past would never fire

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        tick_us = int(pd.Timestamp(key[0]).value // 1000)
        end_us, watermark = tick_us + self.timeout_us, timerValues.getCurrentWatermarkInMs()
        close = self.closed.get()[0] if self.closed.exists() else None
        ended = close is not None or watermark * 1000 >= end_us
        first, changed = {} if ended else self._load(), False
        for block in rows:
            work = block[["zone_id", "seq", "decision"]].reset_index(drop=True)
            work["arrival"] = block["arrival"].to_numpy().astype("datetime64[us]").astype("int64")
            report = block["kind"].to_numpy() == "report"
            late = work["arrival"].to_numpy() > (end_us if close is None else min(close, end_us))
            told = [("late", work[report & late])]
            if ended:
                told.append(("duplicate", work[report & ~late]))
            else:
                for zone in map(_name, work.loc[~report, "zone_id"].unique()):
                    changed |= first.setdefault(zone) is None
                lost = self._compete(first, work[report & ~late])
                changed |= bool((report & ~late).any())
                if len(lost):
                    self.lost.appendValue((_to_bytes(lost),))
            yield from (self._verdicts(tick_us, kind, part, watermark) for kind, part in told if len(part))
        if changed:
            self._save(first)
            self._timer(self._due(first, end_us), watermark)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        tick_us = int(pd.Timestamp(key[0]).value // 1000)
        end_us, watermark = tick_us + self.timeout_us, timerValues.getCurrentWatermarkInMs()
        if self.closed.exists():  # the timeout has passed as well
            self.closed.clear()
            return
        first = self._load()
        close = self._due(first, end_us)
        rows = pd.DataFrame([(zone, *(report or (None, None, None))) for zone, report in first.items()], columns=LOST)
        in_time = pd.to_numeric(rows["arrival"]).to_numpy(float, na_value=np.inf) <= close
        accepted = rows.assign(**{c: rows[c].astype("object").where(in_time, None) for c in LOST[1:]})
        yield self._verdicts(tick_us, "accepted", accepted, watermark)
        missed = rows[~in_time & rows["arrival"].notna().to_numpy()]
        if len(missed):
            yield self._verdicts(tick_us, "late", missed, watermark)
        for (block,) in self.lost.get():
            lost = pa.ipc.open_stream(block).read_pandas()
            yield self._verdicts(tick_us, np.where(lost["arrival"] <= close, "duplicate", "late"), lost, watermark)
        self.first.clear()
        self.lost.clear()
        if watermark * 1000 < end_us:
            self.closed.update((close,))
            self._timer(end_us, watermark)

    @staticmethod
    def _verdicts(tick_us: int, kind, rows: pd.DataFrame, watermark_ms: int) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "zone_id": rows["zone_id"].to_numpy(object),
                "tick": pd.Timestamp(tick_us, unit="us"),
                "kind": kind,
                "decision": rows["decision"].to_numpy(object),
                "arrival": pd.to_datetime(rows["arrival"].astype("Int64"), unit="us").to_numpy(),
                "seq": rows["seq"].astype("Int64").array,
                "told": pd.Timestamp(watermark_ms + 1, unit="ms"),
            }
        )

    def close(self) -> None:
        pass


def _name(zone) -> str | None:
    return None if pd.isna(zone) else zone


def _to_bytes(rows: pd.DataFrame) -> bytes:
    batch = pa.RecordBatch.from_pandas(rows, pa.schema(LOST_LAYOUT), preserve_index=False)
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema) as writer:
        writer.write_batch(batch)
    return out.getvalue().to_pybytes()


def _plain(row) -> tuple:
    """A state row with Python's own numbers."""
    return tuple(x.item() if hasattr(x, "item") else x for x in row)


class ZoneOutcome(StatefulProcessor):
    """The last outcome of a zone; verdicts of different ticks come in the order of ticks."""

    def __init__(self, cfg: TickConfig) -> None:
        self.first_use = cfg.first_use

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "decision string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for block in rows:
            own = block["kind"] == "accepted"
            held.append(block[own])  # one row a tick
            yield self._frame(block[~own], False)
        accepted = pd.concat(held, ignore_index=True).sort_values("tick", kind="stable")
        if not len(accepted):
            return
        before = self.last.get()[0] if self.last.exists() else self.first_use
        fallback = accepted["decision"].isna()
        filled = accepted["decision"].where(~fallback, None).ffill().fillna(before)
        self.last.update((filled.iloc[-1],))
        yield self._frame(accepted.assign(decision=filled), fallback)

    @staticmethod
    def _frame(rows: pd.DataFrame, fallback) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "zone_id": rows["zone_id"].astype("object"),
                "tick": rows["tick"],
                "kind": rows["kind"].astype("object"),
                "decision": rows["decision"].astype("object"),
                "used_fallback": pd.Series(fallback, index=rows.index).astype("bool"),
                "latency_s": (rows["arrival"] - rows["tick"]).dt.total_seconds().astype("float64"),
                "seq": rows["seq"].astype("Int64"),
            }
        )

    def close(self) -> None:
        pass


def completed_outcomes(stream: DataFrame, late: str, zones: int, cfg: TickConfig = TickConfig()) -> DataFrame:
    """Outcome of every (zone, tick) of a stream of ``kind`` = tick markers and reports, and every report that did
    not count, for ticks that close when ``cfg.completion_fraction`` of ``zones`` have reported or time is out.

    ``late`` is how long after a newer row a row may still come. Ticks must not overlap, so that they close in their
    order. Needs the RocksDB state store. The first step spreads by tick, the second by zone.
    """
    if cfg.tick_timeout_s > cfg.tick_minutes * 60:
        raise ValueError("a tick must time out before the next one does")
    verdicts = (
        stream.withWatermark("arrival", late)
        .groupBy("tick")
        .transformWithStateInPandas(
            statefulProcessor=TickState(cfg, zones),
            outputStructType=VERDICT_FIELDS,
            outputMode="Append",
            timeMode="EventTime",
            eventTimeColumnName="told",
        )
    )
    return verdicts.groupBy("zone_id").transformWithStateInPandas(
        statefulProcessor=ZoneOutcome(cfg), outputStructType=OUTCOME_FIELDS, outputMode="Append", timeMode="None"
    )
