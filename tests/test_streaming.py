"""Streams: sinks, restarts, keyed state, late and damaged input."""

import subprocess
import sys
import time

import pandas as pd
import pytest
from pyspark import SparkFiles, cloudpickle

import feeds
from lotflow.operators import lifetime, slot_state, views, visits
from lotflow.schemas import CHECKOUT, SLOT_ROWS, SNAPSHOT, VISIT_ROWS
from lotflow.session import shared_dir, streaming_session
from lotflow.settings import REALTIME_TABLE, Settings
from lotflow.shipping import ship
from lotflow.sources.feed import file_records, parse_records, to_record
from lotflow.streaming import pipelines, sinks, state, tables


class Feed:
    """A folder of records that grows batch by batch, and a stream over it."""

    def __init__(self, spark):
        self.spark, self.session = spark, streaming_session(spark, 2)
        self.path = shared_dir(spark, "test-feed")

    def add(self, rows):
        if rows and not isinstance(rows[0], tuple):
            frame = self.spark.createDataFrame([(text.encode(), n) for n, text in enumerate(rows)], "value binary, offset long")
        else:
            frame = to_record(feeds.events(self.spark, rows))
        frame.coalesce(1).write.mode("append").parquet(self.path)

    def records(self):
        return file_records(self.session, self.path)

    def folder(self, name):
        return shared_dir(self.spark, name)


@pytest.fixture
def feed(spark):
    return Feed(spark)


def flow_rows(steps=feeds.FLOW, first_id=0):
    return [feeds.row(first_id + n, feeds.clock(t), "29A-12345", slot, status) for n, (t, status, slot) in enumerate(steps)]


def multiset(frame):
    return sorted(map(tuple, frame.select(*sorted(frame.columns)).collect()), key=str)


def test_memory_table(feed):
    feed.add(flow_rows())
    query = sinks.watch_in_memory(pipelines.lifetime_totals(feed.records()), feed.folder("memory"), once=True)
    query.awaitTermination()
    shown = feed.session.sql(f"SELECT location, total_fee FROM {REALTIME_TABLE}").collect()
    assert [tuple(r) for r in shown] == [("A1", 5000)]


def test_console(feed):
    feed.add(flow_rows())
    fees = pipelines.windowed_fees(feed.records())
    query = sinks.watch_on_console(fees, "update", 20, once=True)
    query.awaitTermination()
    assert query.exception() is None


def test_checkout_appears_once_per_stay(feed):
    path, checkpoint = feed.folder("out"), feed.folder("checkpoint")
    for part in (flow_rows(), flow_rows([("00:45", "EXITING", "B5")], first_id=9)):
        feed.add(part)
        sinks.run(pipelines.lifetime_totals(feed.records()), sinks.checkout_sink(path), "update", checkpoint)
    every = tables.read_all(feed.spark, path, CHECKOUT)
    assert every.count() == 2  # the repeated EXITING shows up again
    assert tables.latest_per_key(every, ["license_plate", "exit_location", "entry_time"]).count() == 1


def test_a_batch_that_runs_again_replaces_itself(feed):
    path = feed.folder("table")
    rows = feed.spark.range(5)
    tables.write_batch(rows, 0, path)
    tables.write_batch(rows, 0, path)
    assert tables.read_all(feed.spark, path, rows.schema).count() == 5
    # a folder without its commit is not read
    rows.write.parquet(f"{path}/data/batch_id=1")
    assert tables.read_all(feed.spark, path, rows.schema).count() == 5
    assert tables.read_latest(feed.spark, path, rows.schema).count() == 5
    assert tables.read_latest(feed.spark, feed.folder("none"), rows.schema).count() == 0


def test_a_price_change_reaches_the_running_query(feed):
    prices, path, checkpoint = feed.folder("prices"), feed.folder("out"), feed.folder("checkpoint")
    schema = "valid_from long, price long"
    versions = lambda: feed.spark.read.schema(schema).parquet(prices)
    feed.spark.createDataFrame([(0, 5000)], schema).write.parquet(prices)
    writer = sinks.snapshot_sink(path, versions=versions)
    totals = []
    for part, change in ((flow_rows(), (1, 6000)), (flow_rows([("00:45", "EXITING", "B5")], 9), None)):
        feed.add(part)
        sinks.run(pipelines.lifetime_totals(feed.records()), writer, "complete", checkpoint)
        totals.append({r.location: r.total_fee for r in tables.read_latest(feed.spark, path, SNAPSHOT).collect()})
        if change:
            feed.spark.createDataFrame([change], schema).write.mode("append").parquet(prices)
    assert totals == [{"A1": 5000, "B5": 10000}, {"A1": 6000, "B5": 12000}]


def test_repeats_without_a_text_time_come_out_once(feed):
    lines = [f'{{"timestamp":{text},"timestamp_unix":5,"license_plate":"{plate}","location":"A1","status_code":"PARKED"}}'
             for text, plate in (('"never"', "P"), ('"never"', "P"), ("null", "Q"))]
    feed.add(lines)
    path = feed.folder("once")
    rows = pipelines.deduplicated(feed.records()).select(*pipelines.DEDUP_KEYS)
    sinks.run(rows, sinks.table_sink(path), "append", feed.folder("checkpoint"))
    assert sorted(r.license_plate for r in tables.read_all(feed.spark, path, rows.schema).collect()) == ["P", "Q"]


def test_damaged_records_do_not_stop_the_stream(feed):
    feed.add(["garbage", '{"timestamp_unix":"abc","location":"A1"}', '{"timestamp":"never","timestamp_unix":5,"license_plate":"P","location":"A1","status_code":"PARKED"}'])
    path = feed.folder("out")
    sinks.run(pipelines.lifetime_totals(feed.records()), sinks.snapshot_sink(path), "complete", feed.folder("checkpoint"))
    assert [r.license_plate for r in tables.read_latest(feed.spark, path, SNAPSHOT).collect()] == ["P"]


def test_lifetime_takes_late_rows(feed):
    late = [feeds.row(50, feeds.clock("00:01"), "29A-12345", "A1", "PARKED")]
    path, checkpoint = feed.folder("out"), feed.folder("checkpoint")
    for part in (flow_rows([("06:00", "PARKED", "A1")]), flow_rows([("06:10", "MOVING", "A1")], 7), late):
        feed.add(part)
        sinks.run(pipelines.lifetime_totals(feed.records()), sinks.table_sink(path), "complete", checkpoint)
    totals = tables.read_latest(feed.spark, path, feed.spark.createDataFrame([], "location string, entry_time long").schema)
    assert totals.first().entry_time == feeds.clock("00:01")


def test_windows_drop_late_rows(feed):
    late = [feeds.row(50, feeds.clock("00:01"), "29A-12345", "A1", "PARKED")]
    path, checkpoint = feed.folder("out"), feed.folder("checkpoint")
    dropped = []
    for part in (flow_rows([("06:00", "PARKED", "A1")]), flow_rows([("06:10", "MOVING", "A1")], 7), late):
        feed.add(part)
        query = sinks.run(pipelines.windowed_fees(feed.records()), sinks.table_sink(path), "update", checkpoint)
        dropped.append(sinks.dropped_late_rows(query))
    assert dropped == [0, 0, 1]


def test_compaction_changes_nothing(feed):
    path, checkpoint = feed.folder("out"), feed.folder("checkpoint")
    keys, seen = ["location", "license_plate"], []
    writer = sinks.table_sink(path, lambda batch: views.snapshot(sinks.priced(batch, Settings(), None)))
    for n, step in enumerate([("00:15", "PARKED", "A1"), ("00:25", "MOVING", "A1"), ("00:30", "PARKED", "B5")]):
        feed.add(flow_rows([step], n))
        sinks.run(pipelines.lifetime_totals(feed.records()), writer, "update", checkpoint)
        before = multiset(tables.latest_per_key(tables.read_all(feed.spark, path, SNAPSHOT), keys))
        if n < 2:
            tables.compact(feed.spark, path, SNAPSHOT, keys)
        rows = tables.read_all(feed.spark, path, SNAPSHOT)
        assert multiset(tables.latest_per_key(rows, keys)) == before
        seen.append(rows.count())
    assert seen == [1, 1, 2]


@pytest.mark.parametrize("parts", [1, 3])
def test_keyed_state_equals_batch(spark, feed, parts):
    rows = sorted(feeds.skewed_rows(600, 5), key=lambda r: r[2])
    # cut between seconds, so that no tie spans two batches
    cuts = [0, *[rows[len(rows) * n // parts][2] for n in range(1, parts)], 10**12]
    slots, vehicles = feed.folder("slots"), feed.folder("vehicles")
    marks = feed.folder("slot-mark"), feed.folder("vehicle-mark")
    for low, high in zip(cuts, cuts[1:]):
        feed.add([r for r in rows if low <= r[2] < high])
        events = parse_records(feed.records())
        sinks.run(state.slot_states(events), sinks.table_sink(slots), "update", marks[0])
        sinks.run(state.visit_states(events), sinks.visit_sink(vehicles), "update", marks[1])
    batch = feeds.events(spark, rows)
    got = tables.read_all(spark, slots, SLOT_ROWS)
    current = tables.latest_per_key(got, ["location"], "seq").where("status <> 'EXITING'").drop("seq")
    assert multiset(current) == multiset(slot_state.slot_fsm_current(batch))
    releases = got.where("status = 'EXITING'").drop("seq", "batch_id")
    expected = slot_state.slot_fsm_events(batch).where("status = 'EXITING'")
    assert multiset(releases) == multiset(expected.select(*releases.columns))
    got = tables.read_all(spark, vehicles, VISIT_ROWS)
    assert multiset(tables.latest_per_key(got, ["license_plate", "visit_no"])) == multiset(visits.visits(batch))


def test_late_rows_open_no_ghost_visit(spark, feed):
    vehicles, mark = feed.folder("late-vehicles"), feed.folder("late-mark")
    clock = feeds.clock
    rows = lambda first, *marks: [feeds.row(first + n, clock(at), plate, "A1", status) for n, (at, plate, status) in enumerate(marks)]
    for part in (
        rows(0, ("00:10", "P1", "PARKED"), ("00:40", "P1", "EXITING"), ("00:20", "P2", "PARKED"), ("00:30", "P2", "MOVING")),
        rows(10, ("00:05", "P1", "PARKED"), ("00:15", "P2", "PARKED"), ("00:02", "P2", "EXITING")),
    ):
        feed.add(part)
        sinks.run(state.visit_states(parse_records(feed.records())), sinks.visit_sink(vehicles), "update", mark)
    got = tables.latest_per_key(tables.read_all(spark, vehicles, VISIT_ROWS), ["license_plate", "visit_no"]).collect()
    assert {(r.license_plate, r.closed, r.entry_time, r.last_update) for r in got} == {
        ("P1", True, clock("00:10"), clock("00:40")),
        ("P2", False, clock("00:15"), clock("00:30")),
    }
    late = spark.createDataFrame([], "license_plate string, timestamp_unix long").schema
    assert {tuple(r)[:2] for r in tables.read_all(spark, f"{vehicles}_late", late).collect()} == {("P1", clock("00:05")), ("P2", clock("00:02"))}


@pytest.mark.parametrize("processor", [state.SlotProcessor(Settings()), state.VisitProcessor()], ids=["slot", "visit"])
def test_state_classes_load_from_the_shipped_package(spark, processor):
    ship(spark)
    load = "import pickle, sys; sys.path.insert(0, sys.argv[1]); pickle.load(sys.stdin.buffer); import lotflow; assert 'lotflow.zip' in lotflow.__file__"
    package = SparkFiles.get("lotflow.zip")
    subprocess.run([sys.executable, "-c", load, package], input=cloudpickle.dumps(processor), cwd="/", check=True)


def test_advance_slot_row_by_row():
    rows = feeds.in_order([r for r in feeds.skewed_rows(800, 3) if r[4] == "A1"])
    frame = pd.DataFrame(
        [(r[4], r[3], r[5], r[2], feeds.RANK[r[5]], r[0]) for r in rows],
        columns=["location", "license_plate", "status_code", "timestamp_unix", "status_rank", "event_id"],
    )
    got = state.advance_slot(frame, None, 5000)
    names = ["license_plate", "status", "enter_unix", "last_update_unix", "parked_seconds", "fee_vnd"]
    got = [tuple(None if pd.isna(v) else v for v in values) for values in got[names].itertuples(index=False)]
    assert got == [seen[2:] for seen in feeds.walk_slots(rows)]


def test_state_can_expire(feed):
    feed.add(flow_rows())
    path = feed.folder("out")
    stream = state.slot_states(parse_records(feed.records()), ttl_seconds=3600)
    # a query on processing time has no last batch, so it is stopped and not waited for
    query = sinks.start(stream, sinks.table_sink(path), "update", feed.folder("checkpoint"), interval_seconds=1)
    try:
        for _ in range(60):
            if tables.last_commit(feed.spark, path) is not None:
                break
            time.sleep(1)
    finally:
        query.stop()
    assert tables.read_all(feed.spark, path, SLOT_ROWS).count() == 2


def test_fan_out_skips_an_empty_batch(feed):
    root = feed.folder("fan")
    empty = feed.spark.createDataFrame([], lifetime.lifetime(feeds.flow(feed.spark)).schema)
    sinks.fan_out_sink(root)(empty, 0)
    assert tables.last_commit(feed.spark, f"{root}/counts") is None


def test_order_by_slot_is_refused_on_update_streams(feed):
    feed.add(flow_rows())
    fees = lifetime.with_fees(pipelines.lifetime_totals(feed.records()), 5000)
    with pytest.raises(Exception, match="(?i)sort"):
        views.by_slot(views.active_vehicles(fees)).writeStream.outputMode("update").format("noop").option(
            "checkpointLocation", feed.folder("checkpoint")
        ).start()


def test_kafka_reader_is_wired(spark):
    from lotflow.sources.feed import kafka_records

    settings = Settings(kafka_bootstrap="broker:9092", kafka_topic="events", max_offsets_per_trigger=1000)
    with pytest.raises(Exception, match="(?i)kafka"):  # the connector is not on the class path here
        kafka_records(spark, settings)


def test_processing_time_query_stops(feed):
    feed.add(flow_rows())
    path = feed.folder("out")
    query = sinks.start(
        pipelines.lifetime_totals(feed.records()), sinks.snapshot_sink(path), "complete", feed.folder("checkpoint"), interval_seconds=1, name="live"
    )
    try:
        query.processAllAvailable()
        assert query.name == "live" and tables.last_commit(feed.spark, path) is not None
    finally:
        query.stop()
