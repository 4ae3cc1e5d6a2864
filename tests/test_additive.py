"""Things that add up: parts of windows, pairs of sightings, price intervals, sketches."""

import json
import random

import pytest
from pyspark.sql import functions as F

import feeds
from lotflow.operators import lifetime, pricing, quality, sketches, transitions, visits
from lotflow.settings import Settings
from lotflow.sources.feed import parse_records
from lotflow.streaming import pairs, parted, sinks
from test_event_order import disordered
from test_streaming import Feed, multiset

SETTINGS = Settings(watermark="300 seconds")


@pytest.fixture
def feed(spark):
    return Feed(spark)


def test_kept_and_late_windows_are_all_rows(spark, feed):
    parts = disordered(feeds.skewed_rows(900, 4), 4, 5)
    path, mark = feed.folder("windows"), feed.folder("mark")
    newest, kept, late = None, [], []
    for part in parts:
        for row in part:
            ends = row[2] // 30 * 30 + 30
            (late if newest is not None and ends <= newest - 300 else kept).append(row)
        newest = max([row[2] for row in part] + ([newest] if newest is not None else []))
        feed.add(part)
        # a fresh run of the query each time: the clock comes from the table
        sinks.run(parse_records(feed.records()), parted.window_sink(path, SETTINGS), "append", mark)
    assert len(late) > 20 and len(kept) + len(late) == 900
    assert multiset(parted.read_windows(spark, path, SETTINGS)) == multiset(lifetime.window_fees(feeds.events(spark, kept), SETTINGS))
    want = feeds.events(spark, late).select("license_plate", "status_code", "timestamp_unix", "location")
    assert multiset(parted.read_late(spark, path)) == multiset(want)


def test_a_batch_that_runs_again_changes_nothing(spark, feed):
    path = feed.folder("again")
    first, second = (feeds.events(spark, part) for part in disordered(feeds.skewed_rows(300, 6), 2, 7))
    write = parted.window_sink(path, SETTINGS)
    write(first, 0)
    write(second, 1)
    before = multiset(parted.read_windows(spark, path)), multiset(parted.read_late(spark, path))
    write(second, 1)
    assert (multiset(parted.read_windows(spark, path)), multiset(parted.read_late(spark, path))) == before
    write(first.limit(0), 2)
    assert parted._newest_before(spark, path, 3) == parted._newest_before(spark, path, 2)


def test_empty_batch_first(spark, feed):
    path = feed.folder("empty")
    write = parted.window_sink(path, SETTINGS)
    write(feeds.events(spark, feeds.skewed_rows(10, 1)).limit(0), 0)
    write(feeds.events(spark, feeds.skewed_rows(10, 1)), 1)
    assert parted.read_late(spark, path).count() == 0 and parted.read_windows(spark, path).count() > 0


def joined(feed, parts, longest):
    path, mark = feed.folder("pairs"), feed.folder("mark")
    for part in parts:
        feed.add(part)
        stream = pairs.park_exit_stream(feed.records(), feed.records(), SETTINGS, longest)
        sinks.run(stream, pairs.pair_sink(path), "append", mark)
    return pairs.read_pairs(feed.spark, path)


def test_stay_join_is_the_batch_form(spark, feed):
    rows = [row for row in feeds.skewed_rows(600, 11) if row[1]]
    # later arrivals within the delay change which exit is nearest
    draw = random.Random(3)
    arriving = sorted(rows, key=lambda row: row[2] + draw.choice([0, 0, 100, 250]))
    got = joined(feed, [arriving[:250], arriving[250:400], arriving[400:]], "1 day")
    assert multiset(got) == multiset(visits.park_exit_pairs(visits.visits(feeds.events(spark, rows))))


def test_stay_join_within_the_longest_stay(spark, feed):
    steps = [("00:00", "PARKED", "A1"), ("00:50", "PARKED", "B1"), ("01:10", "EXITING", "B1"), ("02:00", "PARKED", "A2"), ("04:00", "EXITING", "A2")]
    rows = [feeds.row(n, feeds.clock(time), "29A-1", slot, status) for n, (time, status, slot) in enumerate(steps)]
    got = [tuple(row) for row in joined(feed, [rows], "1 hour").collect()]
    # the first PARKED is out of range of the exit, and the last exit of its PARKED
    assert got == [("29A-1", feeds.clock("00:50"), "B1", feeds.clock("01:10"), "B1")]


def document(price, updated_at):
    return (json.dumps({"price": {"price_per_10min": price, "updated_at": updated_at}}),)


def test_price_history(spark):
    rows = [
        document(5000, "2024-01-01 00:00:00"),
        document(5000, "2024-01-02 00:00:00"),  # unchanged
        document(6000, "2024-01-03 00:00:00"),
        document(5500, "2024-01-03 00:00:00"),  # of one second the greater holds
        document(5000, "2024-06-01 12:00:00"),
        document(7000, None), document(7000, "soon"), document(None, "2024-03-01 00:00:00"), ("not json",), (None,),
    ]
    found = pricing.price_history(spark.createDataFrame(rows, "value string")).orderBy("valid_from").collect()
    assert [tuple(row) for row in found] == [(5000, 1704067200, 1704240000), (6000, 1704240000, 1717243200), (5000, 1717243200, None)]
    assert pricing.price_history(spark.createDataFrame([], "value string")).count() == 0


def test_config_price_before_the_first_document(spark):
    fees = lifetime.lifetime_fees(feeds.flow(spark))
    early = pricing.config_price_fees(fees, spark.createDataFrame([document(9000, "2025-01-01 00:00:00")], "value string"))
    assert {row.price_per_block for row in early.collect()} == {5000}
    later = pricing.config_price_fees(fees, spark.createDataFrame([document(9000, "2023-01-01 00:00:00")], "value string"))
    assert {row.price_per_block for row in later.collect()} == {9000}


def test_plate_sketches_add_up(spark):
    rows = [feeds.row(n, feeds.DAY + n % 3 * 86400, f"29A-{n % 2000:05d}", f"A{n % 10 + 1}", "PARKED") for n in range(6000)]
    events = feeds.events(spark, rows)
    parts = [sketches.plate_sketches(events.where(F.col("event_id") % 3 == part)) for part in range(3)]
    together = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[0])
    for found in (together, sketches.plate_sketches(events)):
        assert abs(sketches.distinct_plates(found).first().plates - 2000) <= sketches.PLATE_ERROR * 2000
    by_slot = sketches.distinct_plates(together, "location").collect()
    assert len(by_slot) == 10 and all(abs(row.plates - 200) <= sketches.PLATE_ERROR * 200 for row in by_slot)
    nothing = sketches.plate_sketches(quality.valid_events(events).withColumn("license_plate", F.lit(None).cast("string")))
    assert nothing.count() == 0


def test_dwell_quantiles(spark):
    spells = spark.range(20000).selectExpr("'PARKED' AS status_code", "id * 7 AS timestamp_unix", "id AS dwell_seconds")
    found = {row.level: row.seconds for row in sketches.dwell_quantiles(sketches.dwell_sketches(spells), (0.1, 0.5, 0.95)).collect()}
    assert all(abs(found[level] - level * 20000) <= sketches.RANK_ERROR * 20000 for level in (0.1, 0.5, 0.95))
    none = transitions.status_spells(feeds.events(spark, [feeds.row(0, feeds.DAY, "29A-1", "A1", "PARKED")]))
    assert sketches.dwell_quantiles(sketches.dwell_sketches(none)).count() == 0
