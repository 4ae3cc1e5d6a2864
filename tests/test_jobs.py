"""The jobs end to end: feed, tables, questions, payment."""

import feeds
from lotflow.jobs import Lot, start_jobs
from lotflow.session import shared_dir, streaming_session
from lotflow.sources.feed import file_records, to_record


def test_feed_to_payment(spark):
    source, root = shared_dir(spark, "job-feed"), shared_dir(spark, "job-root")
    damaged = spark.sql("SELECT CAST('{' AS BINARY) AS value, 0 AS partition, 900L AS offset")
    to_record(feeds.flow(spark)).unionByName(damaged).coalesce(1).write.parquet(source)
    queries = start_jobs(file_records(streaming_session(spark, 2), source), root, once=True)
    for query in queries:
        query.awaitTermination()

    lot = Lot(spark, root)
    assert {(r.location, r.total_fee) for r in lot.status().collect()} == {("A1", 5000), ("B5", 10000)}
    assert lot.summary().first().available == 58
    assert lot.location("b5").first().vehicles == 1
    assert lot.vehicle("29a-12345").count() == 2 and lot.vehicles().first().location_count == 2
    assert lot.vehicles_on("a").count() == 1 and lot.vehicles_at("b5").count() == 1
    assert {r.floor: r.occupied_slots for r in lot.floors().collect()} == dict(A=1, B=1, C=0, D=0, E=0, F=0)
    assert lot.free().count() == 59
    live = lot.live(feeds.clock("00:50")).collect()
    assert [(r.location, r.status, r.parked_seconds, r.fee_vnd, r.is_vip) for r in live] == [("A1", "MOVING", 600, 5000, False)]
    assert lot.checkouts().count() == 1 and lot.history().count() == 1

    assert lot.checkouts().where("processed_time IS NOT NULL").count() == 1
    assert [(r.event_id, r.reason) for r in lot.quarantine().collect()] == [(900, "not_json")]
    assert [(r.entry_location, r.last_location, r.total_fee) for r in lot.visits().where("closed").collect()] == [("A1", "B5", 15000)]
    assert lot.late_events().count() == 0 and lot.windows().count() > 0

    assert lot.late_in_windows().count() == 0 and lot.distinct_plates().first().plates == 1
    released = lot.releases().collect()
    assert [(r.location, r.fee_vnd) for r in released] == [("B5", 10000)]

    lot.compact()
    assert lot.releases().collect() == released
    assert {(r.location, r.total_fee) for r in lot.status().collect()} == {("A1", 5000), ("B5", 10000)}
    assert [r.location for r in lot.slot_states().collect()] == ["A1"]
    lot.register_views()
    assert [r.location for r in spark.sql("SELECT location FROM parking_realtime").collect()] == ["A1"]

    asks = spark.createDataFrame([(1, "29a-12345", "b5"), (2, "29A-12345", "A1")], "request_id long, license_plate string, location string")
    assert {r.request_id: r.outcome for r in lot.settle(asks).collect()} == {1: "success", 2: "not_exiting"}
    assert [r.location for r in lot.status().collect()] == ["A1"]
    assert {r.request_id: r.outcome for r in lot.settle(asks).collect()} == {1: "not_found", 2: "not_exiting"}
    assert lot.ledger().count() == 1


def test_a_vehicle_that_paid_and_came_back(spark):
    """It is shown again, and charged again for its second stay alone."""
    plate, root = "29A-12345", shared_dir(spark, "stay-root")
    source = shared_dir(spark, "stay-feed")
    clock = feeds.clock

    def come(first, *steps):
        rows = [feeds.row(first + n, clock(at), plate, "A1", status) for n, (at, status) in enumerate(steps)]
        to_record(feeds.events(spark, rows)).coalesce(1).write.mode("append").parquet(source)
        for query in start_jobs(file_records(streaming_session(spark, 2), source), root, once=True):
            query.awaitTermination()

    def asked(*times):
        rows = [(n, plate.lower(), "a1", clock(at)) for n, at in enumerate(times)]
        return spark.createDataFrame(rows, "request_id long, license_plate string, location string, requested_unix long")

    lot = Lot(spark, root)
    come(0, ("00:10", "PARKED"), ("00:40", "EXITING"))
    answers = {r.request_id: (r.outcome, r.total_fee) for r in lot.settle_stays(asked("00:05", "00:20", "00:45", "00:50")).collect()}
    assert answers == {0: ("not_found", None), 1: ("not_exiting", None), 2: ("success", 15000), 3: ("not_found", None)}
    assert lot.unpaid().count() == 0
    come(10, ("06:00", "PARKED"), ("06:10", "EXITING"))
    assert [(r.entry_time, r.total_fee) for r in lot.unpaid().collect()] == [(clock("06:00"), 5000)]
    answers = [(r.outcome, r.total_fee) for r in lot.settle_stays(asked("00:50", "06:15")).orderBy("request_id").collect()]
    assert answers == [("not_found", None), ("success", 5000)]
    assert lot.unpaid().count() == 0 and lot.stay_ledger().count() == 2
    assert lot.record_gaps().select("first_missing", "last_missing").collect() == [(2, 9)]
