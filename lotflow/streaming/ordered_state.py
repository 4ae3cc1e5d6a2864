"""Keyed state in event order: events wait until the watermark has passed them, and then apply in order.

A key's waiting events are sorted runs in a map state, cut into chunks: each Arrow batch that arrives is one run. A timer at
the earliest waiting time merges the runs chunk by chunk and applies what the watermark has passed, so memory holds a
chunk of each run and never all events of a key. An event that comes when the watermark has already passed its time is
late: it changes nothing and comes out as such, for a table of its own.

A chunk is one JSON text, since the state store converts every element of an array by itself. Vehicles, of which there are many
with few events each, share a key (``BUCKETS``), so that frames, chunks and timers are per bucket and not per vehicle.

The watermark column itself is left behind before the state, because Spark would drop late rows unseen there.
"""

from __future__ import annotations

import heapq
import json
from bisect import bisect_right
from collections.abc import Iterator
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lotflow.functions.columns import EVENT_ORDER
from lotflow.operators.quality import billable_events, known_events
from lotflow.schemas import SLOT_ROWS, VISIT_ROWS
from lotflow.settings import Settings
from lotflow.shipping import ship
from lotflow.streaming.state import _SLOT_STATE, _price, advance_slot

#: Rows of a chunk of a run, and rows that a machine is given at a time.
CHUNK_ROWS, STEP_ROWS = 256, 4096
#: Groups of vehicles that share a key; a checkpoint keeps the number it began with.
BUCKETS = 1024
LAST_ID = 2**63 - 1
_WAITING = (*EVENT_ORDER, "status_code", "license_plate", "location")
_time, _place = itemgetter(0), itemgetter(*range(len(EVENT_ORDER)))
_VISIT = "visit_no long, entry_time long, entry_location string, last_unix long, last_status string, last_location string"
_LATE = T.StructField("late", T.BooleanType())
SLOT_OUTPUT = T.StructType([*SLOT_ROWS.fields, _LATE])
VISIT_OUTPUT = T.StructType([*VISIT_ROWS.fields, _LATE])


class Waiting:
    """A key's events that the watermark has not passed: sorted runs of chunks."""

    def __init__(self, handle: StatefulProcessorHandle):
        self.chunks = handle.getMapState("waiting", "run long, chunk long", "events string")
        self.runs = handle.getValueState("runs", "n long")

    def add(self, rows: pd.DataFrame) -> int:
        """One more run; gives the time of its first event."""
        run = (self.runs.get() or (0,))[0]
        self.runs.update((run + 1,))
        values = sorted(zip(*([None if value != value else value for value in rows[name].tolist()] for name in _WAITING)), key=_place)
        for chunk, at in enumerate(range(0, len(values), CHUNK_ROWS)):
            self._put(run, chunk, values[at : at + CHUNK_ROWS])
        return values[0][0]

    def due(self, until: int) -> Iterator[tuple]:
        """Takes out the events up to a second, in order; ``earliest`` is then the time of the first one left."""
        self.earliest: int | None = None
        by_run: dict[int, list[int]] = {}
        for run, chunk in self.chunks.keys():
            by_run.setdefault(run, []).append(chunk)
        yield from heapq.merge(*(self._taken(run, sorted(chunks), until) for run, chunks in sorted(by_run.items())), key=_place)
        if self.earliest is None:
            self.runs.clear()

    def _taken(self, run: int, chunks: list[int], until: int) -> Iterator[tuple]:
        for chunk in chunks:
            rows = [tuple(row) for row in json.loads(self.chunks.getValue((run, chunk))[0])]
            ripe = bisect_right(rows, until, key=_time)
            if ripe == len(rows):
                self.chunks.removeKey((run, chunk))
            elif ripe:
                self._put(run, chunk, rows[ripe:])
            yield from rows[:ripe]
            if ripe < len(rows):
                self.earliest = rows[ripe][0] if self.earliest is None else min(self.earliest, rows[ripe][0])
                return

    def _put(self, run: int, chunk: int, rows: list[tuple]) -> None:
        self.chunks.updateValue((run, chunk), (json.dumps(rows, separators=(",", ":")),))


class InOrder(StatefulProcessor):
    """Keeps events back until the watermark has passed them; subclasses say what applies then and how a late one looks."""

    output: T.StructType

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.waiting = handle, Waiting(handle)
        self.prepare(handle)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() // 1000
        starts = []
        for frame in rows:
            late = frame["timestamp_unix"] <= passed
            if late.any():
                yield self.shaped(self.late(frame[late]), late=True)
                frame = frame[~late]
            if len(frame):
                starts.append(self.waiting.add(frame))
        if starts:
            self.handle.registerTimer(min(starts) * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() // 1000
        ripe = self.waiting.due(passed)
        for frame in self.apply(key, ripe):
            if len(frame):
                yield self.shaped(frame, late=False)
        if self.waiting.earliest is not None:
            self.handle.registerTimer(self.waiting.earliest * 1000)

    def shaped(self, frame: pd.DataFrame, late: bool) -> pd.DataFrame:
        """All output columns, null where the frame has none."""
        columns = {name: frame[name] if name in frame else None for name in self.output.fieldNames()}
        return pd.DataFrame({**columns, "late": late}, index=frame.index)

    def prepare(self, handle: StatefulProcessorHandle) -> None:
        raise NotImplementedError

    def apply(self, key, rows: Iterator[tuple]) -> Iterator[pd.DataFrame]:
        raise NotImplementedError

    def late(self, frame: pd.DataFrame) -> pd.DataFrame:
        raise NotImplementedError

    def close(self) -> None:
        pass


def _steps(rows: Iterator[tuple]) -> Iterator[pd.DataFrame]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == STEP_ROWS:
            yield pd.DataFrame(held, columns=list(_WAITING))
            held = []
    if held:
        yield pd.DataFrame(held, columns=list(_WAITING))


class SlotsInOrder(InOrder):
    """Each release of a slot (status EXITING, with its fee), and its state after what has applied so far."""

    output = SLOT_OUTPUT

    def __init__(self, settings: Settings):
        self.settings = settings

    def prepare(self, handle: StatefulProcessorHandle) -> None:
        self.slot = handle.getValueState("slot", _SLOT_STATE)

    def apply(self, key, rows: Iterator[tuple]) -> Iterator[pd.DataFrame]:
        state = self.slot.get()
        for frame in _steps(rows):
            seq = state[5] if state else 0
            # a slot that was released starts from nothing, but goes on counting
            states = advance_slot(frame, state if state and state[1] != "EXITING" else None, _price(key[0], self.settings))
            states["seq"] = range(seq + 1, seq + 1 + len(states))
            value = states.iloc[-1][["license_plate", "status", "enter_unix", "parked_seconds", "fee_vnd", "seq"]]
            state = tuple(None if pd.isna(v) else v if isinstance(v, str) else int(v) for v in value)
            yield states[(states["status"] == "EXITING") | (states.index == len(states) - 1)]
        if state:
            self.slot.update(state)

    def late(self, frame: pd.DataFrame) -> pd.DataFrame:
        return frame.rename(columns={"status_code": "status", "timestamp_unix": "last_update_unix"})


class VisitsInOrder(InOrder):
    """Each visit that ends, and the open one as last seen, as in the batch form; the key is one vehicle."""

    output = VISIT_OUTPUT

    def prepare(self, handle: StatefulProcessorHandle) -> None:
        self.visit = handle.getValueState("visit", _VISIT)

    def so_far(self, plate: str) -> tuple | None:
        return self.visit.get()

    def keep(self, plate: str, visit: tuple) -> None:
        self.visit.update(visit)

    def apply(self, key, rows: Iterator[tuple]) -> Iterator[pd.DataFrame]:
        names, held = VISIT_ROWS.fieldNames(), []
        visits: dict[str, tuple] = {}  # of the vehicles that have events now
        for time, _, _, status, plate, location in rows:
            visit = visits.get(plate) or self.so_far(plate) or (0, *[None] * 5)
            number, entry, entered_at = visit[:3]
            if status == "PARKED" and entry is None:
                entry, entered_at = time, location
            if status == "EXITING":
                if entry is not None:
                    held.append((plate, number, status, True, entry, time, time, entered_at, location))
                number, entry, entered_at = number + 1, None, None
            visits[plate] = (number, entry, entered_at, time, status, location)
            if len(held) == STEP_ROWS:
                yield pd.DataFrame(held, columns=names)
                held = []
        for plate, visit in visits.items():
            self.keep(plate, visit)
            number, entry, entered_at, last, status, location = visit
            if entry is not None:
                held.append((plate, number, status, False, entry, last, None, entered_at, location))
            if len(held) == STEP_ROWS:
                yield pd.DataFrame(held, columns=names)
                held = []
        if held:
            yield pd.DataFrame(held, columns=names)

    def late(self, frame: pd.DataFrame) -> pd.DataFrame:
        names = {"status_code": "current_status", "timestamp_unix": "last_update", "location": "last_location"}
        return frame.rename(columns=names)


class BucketedVisits(VisitsInOrder):
    """The same where the key is a bucket of vehicles: a map state holds the visit of each, and those without events are not read."""

    def prepare(self, handle: StatefulProcessorHandle) -> None:
        self.visits = handle.getMapState("visits", "license_plate string", _VISIT)

    def so_far(self, plate: str) -> tuple | None:
        return self.visits.getValue((plate,))

    def keep(self, plate: str, visit: tuple) -> None:
        self.visits.updateValue((plate,), visit)


def _in_event_order(events: DataFrame, settings: Settings, key: Column, processor: InOrder) -> DataFrame:
    clock = F.timestamp_seconds("timestamp_unix")
    rows = events.withColumn("__clock", clock).withWatermark("__clock", settings.watermark)
    # an event without an id applies after the others of its time and status
    place = [F.coalesce(name, F.lit(LAST_ID)).alias(name) if name == "event_id" else name for name in EVENT_ORDER]
    rows = rows.select(key.alias("__key"), "license_plate", "location", "status_code", *place)
    ship(events.sparkSession)
    return rows.groupBy("__key").transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=processor.output, outputMode="Update", timeMode="EventTime"
    )


def slots_in_order(events: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Update stream of slot states in event order; ``late`` marks events that came too late (location, status, last_update_unix, plate)."""
    return _in_event_order(known_events(events), settings, F.col("location"), SlotsInOrder(settings))


def visits_in_order(events: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Update stream of visits in event order; ``late`` marks events that came too late (plate, status, last_update, last_location)."""
    rows = billable_events(events).where("license_plate IS NOT NULL")
    bucket = F.pmod(F.xxhash64("license_plate"), F.lit(BUCKETS))
    return _in_event_order(rows, settings, bucket, BucketedVisits())
