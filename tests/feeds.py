"""Small feeds for tests, and row-by-row readings of the rules to check results with."""

from __future__ import annotations

import datetime
import random

from lotflow.sources.feed import typed_events

SCHEMA = "event_id long, timestamp string, timestamp_unix long, license_plate string, location string, status_code string"
RANK = {"ENTERING": 1, "PARKED": 2, "MOVING": 3, "EXITING": 4}
DAY = 1704067200  # 2024-01-01 00:00:00 UTC


def clock(text: str) -> int:
    hours, minutes = text.split(":")
    return DAY + int(hours) * 3600 + int(minutes) * 60


def row(event_id, unix, plate, location, status):
    text = datetime.datetime.fromtimestamp(unix, datetime.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    return (event_id, text, unix, plate, location, status)


def events(spark, rows):
    return typed_events(spark.createDataFrame(rows, SCHEMA))


FLOW = [("00:10", "ENTERING", "A1"), ("00:15", "PARKED", "A1"), ("00:25", "MOVING", "A1"), ("00:30", "PARKED", "B5"), ("00:45", "EXITING", "B5")]


def flow(spark, steps=FLOW, plate="29A-12345"):
    return events(spark, [row(n, clock(time), plate, location, status) for n, (time, status, location) in enumerate(steps)])


def skewed_rows(count, seed, null_plates=True):
    """A third of the rows share one plate and one slot; times tie, and some statuses are unknown."""
    dice = random.Random(seed)
    rows = []
    for n in range(count):
        hot = dice.random() < 0.34
        plate = "29A-00000" if hot else f"29A-{dice.randrange(12):05d}"
        if null_plates and dice.random() < 0.05:
            plate = None
        location = "A1" if hot or dice.random() < 0.2 else dice.choice("ABF") + str(dice.randrange(1, 11))
        status = dice.choices(["ENTERING", "PARKED", "MOVING", "EXITING", "WHAT"], [2, 6, 3, 1, 1])[0]
        rows.append(row(n, DAY + dice.randrange(count * 2), plate, location, status))
    return rows


def in_order(rows, statuses=tuple(RANK)):
    kept = [r for r in rows if r[5] in statuses]
    return sorted(kept, key=lambda r: (r[2], RANK[r[5]], r[0]))


def ceil_fee(seconds, price):
    return -(-(-(-seconds // 60)) // 10) * price


def walk_slots(rows):
    """State of the slot after each event, one event at a time."""
    slots, seen = {}, []
    for event_id, _, time, plate, location, status in in_order(rows):
        price = 8000 if location.startswith("F") else 5000
        s = slots.setdefault(location, dict(plate=None, status=None, enter=None, seconds=0, fee=0))
        if status == "PARKED" and (s["status"] != "PARKED" or s["plate"] != plate):
            s.update(enter=time, seconds=0, plate=plate)
        elif status == "ENTERING":
            s.update(plate=plate)
        elif status in ("MOVING", "EXITING") and s["enter"] is not None:
            s.update(seconds=time - s["enter"], fee=ceil_fee(time - s["enter"], price))
        s.update(status=status)
        seen.append((event_id, location, s["plate"], status, s["enter"], time, s["seconds"], s["fee"]))
        if status == "EXITING":
            del slots[location]
    return seen


def walk_visits(rows):
    """(plate, visit_no, closed, entry, last, entry slot, last slot), one event at a time."""
    number, open_visits, done = {}, {}, []
    for _, _, time, plate, location, status in in_order(rows, ("PARKED", "MOVING", "EXITING")):
        if plate is None:
            continue
        visit = open_visits.setdefault(plate, dict(entry=None, slot=None))
        if status == "PARKED" and visit["entry"] is None:
            visit.update(entry=time, slot=location)
        visit.update(last=time, place=location)
        if status == "EXITING":
            done.append((plate, number.get(plate, 0), True, open_visits.pop(plate)))
            number[plate] = number.get(plate, 0) + 1
    done += [(plate, number.get(plate, 0), False, visit) for plate, visit in open_visits.items()]
    return {(p, n, c, v["entry"], v["last"], v["slot"], v["place"]) for p, n, c, v in done if v["entry"] is not None}
