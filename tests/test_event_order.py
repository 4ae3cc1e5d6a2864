"""State in event order: late rows, disorder within the delay, and a key with many rows."""

import random
import resource

import pandas as pd
import pytest

import feeds
from lotflow.operators import slot_state, visits
from lotflow.schemas import LATE_EVENTS
from lotflow.settings import Settings
from lotflow.sources.feed import parse_records
from lotflow.streaming import ordered_state, sinks, tables
from test_streaming import Feed, multiset

SETTINGS = Settings(watermark="300 seconds")
DELAY = 300


@pytest.fixture
def feed(spark):
    return Feed(spark)


def kept_and_late(parts):
    """Rows by the rule: late if the newest second of the earlier parts, less the delay, has reached them."""
    newest, kept, late = None, [], []
    for part in parts:
        for row in part:
            (late if newest is not None and row[2] <= newest - DELAY else kept).append(row)
        newest = max([row[2] for row in part] + ([newest] if newest is not None else []))
    return [row for row in kept if row[2] <= newest - DELAY], late


def disordered(rows, parts, seed):
    """Parts in which rows arrive up to some time late, most of them within the delay."""
    draw = random.Random(seed)
    arriving = sorted(rows, key=lambda row: row[2] + draw.choice([0, 0, 50, 200, 1500]))
    size = len(rows) // parts + 1
    return [arriving[at : at + size] for at in range(0, len(rows), size)]


def run_parts(feed, parts, stream, writer):
    mark = feed.folder("mark")
    for part in parts:
        feed.add(part)
        sinks.run(stream(parse_records(feed.records()), SETTINGS), writer, "update", mark)


def test_slots_apply_in_event_order(spark, feed):
    parts = disordered(feeds.skewed_rows(1200, 8), 3, 1)
    kept, late = kept_and_late(parts)
    assert len(late) > 10 and len(kept) > 300
    path = feed.folder("slots")
    run_parts(feed, parts, ordered_state.slots_in_order, sinks.slot_sink(path))
    got = tables.read_all(spark, path, ordered_state.SLOT_ROWS)
    batch = feeds.events(spark, kept)
    current = tables.latest_per_key(got, ["location"], "seq").where("status <> 'EXITING'").drop("seq")
    assert multiset(current) == multiset(slot_state.slot_fsm_current(batch))
    releases = got.where("status = 'EXITING'").drop("seq", "batch_id")
    expected = slot_state.slot_fsm_events(batch).where("status = 'EXITING'")
    assert multiset(releases) == multiset(expected.select(*releases.columns))
    late_rows = tables.read_all(spark, f"{path}_late", LATE_EVENTS).drop("batch_id")
    known = [row for row in late if row[5] in feeds.RANK]
    assert multiset(late_rows) == sorted(((row[3], row[4], row[5], row[2]) for row in known), key=lambda r: str(tuple(r[n] for n in (0, 1, 2, 3))))


def test_visits_apply_in_event_order(spark, feed):
    parts = disordered(feeds.skewed_rows(700, 9), 3, 2)
    # what is no part of any visit does not move the watermark
    kept, late = kept_and_late([[row for row in part if row[3] and row[5] in ("PARKED", "MOVING", "EXITING")] for part in parts])
    path = feed.folder("visits")
    run_parts(feed, parts, ordered_state.visits_in_order, sinks.visit_sink(path))
    got = tables.latest_per_key(tables.read_all(spark, path, ordered_state.VISIT_ROWS), ["license_plate", "visit_no"])
    assert multiset(got) == multiset(visits.visits(feeds.events(spark, kept)))
    late_rows = tables.read_all(spark, f"{path}_late", LATE_EVENTS)
    assert len(late) > 10 and late_rows.count() == len(late)


class Store:
    """Map and value state in memory, counting what is held outside of it."""

    def __init__(self):
        self.data, self.value = {}, None

    def getMapState(self, *_):
        return self

    def getValueState(self, *_):
        return Value()

    def keys(self):
        return list(self.data)

    def getValue(self, key):
        return self.data[key]

    def updateValue(self, key, value):
        self.data[key] = value

    def removeKey(self, key):
        del self.data[key]


class Value:
    held = None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value

    def clear(self):
        self.held = None


def test_runs_merge_in_order_and_leave_the_rest():
    draw = random.Random(0)
    store = Store()
    waiting, rows = ordered_state.Waiting(store), []
    for _ in range(9):
        part = sorted((draw.randrange(1000), draw.randrange(4), draw.randrange(10**6), draw.choice("ab"), None, "A1") for _ in range(draw.randrange(1, 900)))
        waiting.add(pd.DataFrame(part, columns=list(ordered_state._WAITING)))
        rows += part
    key = lambda row: row[:3]
    for low, high in ((-1, 300), (300, 301), (301, 301), (301, 2000)):
        got = list(waiting.due(high))
        wanted = sorted((row for row in rows if low < row[0] <= high), key=key)
        assert [row[:3] for row in got] == [row[:3] for row in wanted] and sorted(got, key=str) == sorted(wanted, key=str)
        left = [row[0] for row in rows if row[0] > high]
        assert waiting.earliest == (min(left) if left else None)
    assert not store.data


def test_one_key_with_many_rows_stays_small():
    """A million events of one plate: what the merge holds is a chunk of each run."""
    processor = ordered_state.VisitsInOrder()
    processor.handle, processor.visit = None, Value()
    store = Store()
    processor.waiting = ordered_state.Waiting(store)
    size, states = 10_000, ("PARKED", "MOVING", "EXITING")
    for run in range(100):
        times = range(run, 100 * size, 100)
        frame = pd.DataFrame({"timestamp_unix": times, "status_rank": 1, "event_id": times, "status_code": [states[t % 3] for t in times], "license_plate": "P", "location": "A1"})
        processor.waiting.add(frame)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    closed = open_rows = 0
    for frame in processor.apply(("P",), processor.waiting.due(10**7)):
        closed, open_rows = closed + int(frame["closed"].sum()), open_rows + int((~frame["closed"]).sum())
    assert (closed, open_rows) == (333_333, 1) and not store.data
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 150_000


class Handle:
    """Timers as they are set, and states in memory."""

    def __init__(self):
        self.timers, self.calls = [], 0

    def getMapState(self, *_):
        return Counted(self)

    def getValueState(self, *_):
        return Value()

    def registerTimer(self, moment):
        self.timers.append(moment)


class Counted(Store):
    def __init__(self, handle):
        super().__init__()
        self.handle = handle

    def getValue(self, key):
        return self.data.get(key)

    def updateValue(self, key, value):
        self.handle.calls += 1
        self.data[key] = value


class Clock:
    def __init__(self, seconds):
        self.seconds = seconds

    def getCurrentWatermarkInMs(self):
        return self.seconds * 1000


def waiting_rows(rows):
    return pd.DataFrame(rows, columns=list(ordered_state._WAITING))


def test_vehicles_of_a_bucket_share_frames_chunks_and_timers():
    """Three thousand vehicles with two events each: what is written grows with the events and not with a frame per vehicle."""
    plates, handle, processor = [f"P{n}" for n in range(3000)], Handle(), ordered_state.BucketedVisits()
    processor.init(handle)
    parked = [(1000 + n, 2, n, "PARKED", plate, "A1") for n, plate in enumerate(plates)]
    left = [(9000 + n, 4, n, "EXITING", plate, "A2") for n, plate in enumerate(plates[::2])]
    assert not list(processor.handleInputRows((7,), iter([waiting_rows(parked + left)]), Clock(0)))
    assert handle.calls <= 4500 // ordered_state.CHUNK_ROWS + 1 and handle.timers == [1_000_000]
    first = list(processor.handleExpiredTimer((7,), Clock(8000), None))
    assert len(first) == 1 and len(first[0]) == 3000 and not first[0]["closed"].any()
    frames = list(processor.handleExpiredTimer((7,), Clock(20_000), None))
    assert len(frames) == 1 and handle.timers == [1_000_000, 9_000_000] and not processor.waiting.chunks.data
    got = frames[0].set_index("license_plate")
    assert set(got.index) == set(plates[::2]) and got["closed"].all() and not got["late"].any()
    assert got.loc["P4", ["visit_no", "entry_time", "exit_time", "entry_location", "last_location"]].tolist() == [0, 1004, 9002, "A1", "A2"]
    late = list(processor.handleInputRows((7,), iter([waiting_rows(parked)]), Clock(20_000)))
    assert len(late) == 1 and late[0]["late"].all() and list(late[0]["last_update"]) == [row[0] for row in parked]


def test_frames_of_one_batch_set_one_timer():
    """Each timer reads the waiting chunks of its key, so a slot with many frames in a batch sets one, at its earliest event."""
    handle, processor = Handle(), ordered_state.SlotsInOrder(SETTINGS)
    processor.init(handle)
    frames = [waiting_rows([(5000 - 10 * n + i, 2, i, "PARKED", "P", "A1") for i in range(10)]) for n in range(20)]
    assert not list(processor.handleInputRows(("A1",), iter(frames), Clock(0)))
    assert handle.timers == [4810_000]
    states = pd.concat(processor.handleExpiredTimer(("A1",), Clock(6000), None))
    assert states[["status", "last_update_unix", "seq"]].values.tolist() == [["PARKED", 5009, 200]]
