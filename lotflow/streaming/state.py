"""Keyed state of slots and vehicles across micro-batches.

Within a batch the events of a key apply in event order; across batches, in the order the
batches arrive. What one call holds is the part of one micro-batch that belongs to one key,
which the rate limit of the source bounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import attrgetter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lotflow.functions.columns import EVENT_ORDER
from lotflow.functions.fees import MINUTES_PER_BLOCK, SECONDS_PER_MINUTE
from lotflow.operators.quality import billable_events, known_events
from lotflow.schemas import SLOT_ROWS, VISIT_ROWS
from lotflow.settings import Settings
from lotflow.shipping import ship

_SLOT_STATE = "license_plate string, status string, enter_unix long, parked_seconds long, fee_vnd long, seq long"

_VISIT_STATE = (
    "visit_no long, entry_time long, entry_location string, "
    "exit_unix long, exit_rank long, exit_id long, last_unix long, last_rank long, last_id long, last_status string, last_location string"
)
_VISIT_OUTPUT = T.StructType([*VISIT_ROWS.fields, T.StructField("late", T.BooleanType())])
_Visit = Row(*_VISIT_OUTPUT.fieldNames())
_place = attrgetter(*EVENT_ORDER)


def _in_order(frames: Iterator[pd.DataFrame]) -> pd.DataFrame:
    rows = pd.concat(frames, ignore_index=True)
    return rows.sort_values(list(EVENT_ORDER), ignore_index=True)


def _price(location: str, settings: Settings) -> int:
    vip = location in settings.vip_locations or location.upper().startswith(tuple(p.upper() for p in settings.vip_prefixes))
    return settings.vip_price_per_10min if vip else settings.price_per_10min


def advance_slot(rows: pd.DataFrame, state: tuple | None, price: int) -> pd.DataFrame:
    """State of one slot after each of its ordered events, from the state before them.

    The same rules as the batch form: a stay ends at EXITING, fields fill forward within a stay,
    and the first stay starts from ``state`` (None where the slot was free).
    """
    plate0, status0, enter0, seconds0, fee0 = state[:5] if state else (None, None, None, 0, 0)
    status, time, plate = rows["status_code"], rows["timestamp_unix"].astype("Int64"), rows["license_plate"]
    before = status.shift()
    before.iloc[0] = status0
    plate_before = plate.shift()
    plate_before.iloc[0] = plate0
    stay = (before == "EXITING").cumsum()
    inherits = stay == 0

    same_plate = (plate == plate_before) | (plate.isna() & plate_before.isna())
    restart = (status == "PARKED") & ~((before == "PARKED") & same_plate)
    charges = status.isin(["MOVING", "EXITING"])

    def forward(values: pd.Series, start: object) -> pd.Series:
        filled = values.groupby(stay).ffill()
        return filled if start is None else filled.where(filled.notna() | ~inherits, start)

    enter = forward(time.where(restart), enter0)
    mark = forward(time.where(restart | charges), None if enter0 is None else enter0 + seconds0)
    seconds = (mark - enter).where(enter.notna(), 0)
    minutes = (time - enter + (SECONDS_PER_MINUTE - 1)) // SECONDS_PER_MINUTE
    fee = forward(((minutes + (MINUTES_PER_BLOCK - 1)) // MINUTES_PER_BLOCK * price).where(charges & enter.notna()), fee0)
    # a plate may be set to null, so the row that set it fills forward, not its value
    row_no = pd.Series(range(len(rows)), dtype="Int64")
    setter = row_no.where(restart | (status == "ENTERING")).groupby(stay).ffill().fillna(-1).to_numpy(dtype="int64")
    plates = np.append(plate.to_numpy(dtype=object), None)[setter]
    plates[(setter < 0) & inherits.to_numpy()] = plate0
    return pd.DataFrame(
        {
            "location": rows["location"],
            "license_plate": pd.Series(plates, dtype="object"),
            "status": status,
            "enter_unix": enter,
            "last_update_unix": time,
            "parked_seconds": seconds,
            "fee_vnd": fee.fillna(0),
        }
    )


class SlotProcessor(StatefulProcessor):
    """Emits each release (status EXITING, with its fee) and, at the end of the batch, a held slot's state."""

    def __init__(self, settings: Settings, ttl_seconds: int | None = None):
        self.settings = settings
        self.ttl_ms = ttl_seconds * 1000 if ttl_seconds else None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.slot = handle.getValueState("slot", _SLOT_STATE, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state = self.slot.get()
        seq = state[5] if state else 0
        states = advance_slot(_in_order(rows), state, _price(key[0], self.settings))
        states["seq"] = range(seq + 1, seq + 1 + len(states))
        last = states.iloc[-1]
        if last["status"] == "EXITING":
            self.slot.clear()
        else:
            value = last[["license_plate", "status", "enter_unix", "parked_seconds", "fee_vnd", "seq"]]
            self.slot.update(tuple(None if pd.isna(v) else v if isinstance(v, str) else int(v) for v in value))
        yield states[(states["status"] == "EXITING") | (states.index == len(states) - 1)]

    def close(self) -> None:
        pass


def slot_states(events: DataFrame, settings: Settings = Settings(), ttl_seconds: int | None = None) -> DataFrame:
    """Update stream of slot states; ``ttl_seconds`` forgets slots that fall silent."""
    ship(events.sparkSession)
    rows = known_events(events).select("location", "license_plate", "status_code", *EVENT_ORDER)
    return rows.groupBy("location").transformWithStateInPandas(
        statefulProcessor=SlotProcessor(settings, ttl_seconds),
        outputStructType=SLOT_ROWS,
        outputMode="Update",
        timeMode="ProcessingTime" if ttl_seconds else "None",
    )


class VisitProcessor(StatefulProcessor):
    """Emits each visit that ends, and at the end of the batch the open one, if it has begun to cost.

    An event at or before the vehicle's last exit belongs to a visit that is closed and booked, and so does
    an exit before the open visit's entry: both are emitted as ``late`` and change nothing. A PARKED event
    that precedes the open visit's entry moves the entry back.
    """

    def __init__(self, ttl_seconds: int | None = None):
        self.ttl_ms = ttl_seconds * 1000 if ttl_seconds else None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.visit = handle.getValueState("visit", _VISIT_STATE, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        visit_no, entry, entry_location, *rest = self.visit.get() or (0, *[None] * 10)
        left, last = tuple(rest[:3]), tuple(rest[3:])  # places of the last exit and of the newest row since, with its status and slot
        for row in sorted(rows, key=_place):
            place, time, status, location = _place(row), row.timestamp_unix, row.status_code, row.location
            closed = status == "EXITING"
            if (left[0] is not None and place <= left) or (closed and entry is not None and time < entry):
                yield _Visit(key[0], None, status, False, None, time, None, None, location, True)
                continue
            if status == "PARKED" and (entry is None or time < entry):
                entry, entry_location = time, location
            if closed:
                if entry is not None:
                    yield _Visit(key[0], visit_no, status, True, entry, time, time, entry_location, location, False)
                visit_no, entry, entry_location, left, last = visit_no + 1, None, None, place, (None,) * 5
            elif last[0] is None or place > last[:3]:
                last = (*place, status, location)
        if entry is not None:
            yield _Visit(key[0], visit_no, last[3], False, entry, last[0], None, entry_location, last[4], False)
        self.visit.update((visit_no, entry, entry_location, *left, *last))

    def close(self) -> None:
        pass


def visit_states(events: DataFrame, ttl_seconds: int | None = None) -> DataFrame:
    """Update stream of visits per vehicle; ``ttl_seconds`` forgets vehicles that fall silent."""
    ship(events.sparkSession)
    rows = billable_events(events).where("license_plate IS NOT NULL")
    return rows.select("license_plate", "location", "status_code", *EVENT_ORDER).groupBy(
        "license_plate"
    ).transformWithState(
        statefulProcessor=VisitProcessor(ttl_seconds),
        outputStructType=_VISIT_OUTPUT,
        outputMode="Update",
        timeMode="ProcessingTime" if ttl_seconds else "None",
    )
