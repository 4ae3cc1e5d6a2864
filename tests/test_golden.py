"""Worked examples with known answers."""

import random

import pytest
from pyspark.sql import functions as F

import feeds
from lotflow.functions.display import amount_text, duration_text, status_label
from lotflow.functions.fees import fee_ceil_minutes, fee_floor_minutes
from lotflow.operators import checkout, lifetime, pricing, quality, records, slot_state, slots, views, visits
from lotflow.settings import Settings, from_env
from lotflow.sources import config
from lotflow.sources.feed import parse_records
from lotflow.sources.slots import slot_dimension


def rows(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


FEE = ("location", "current_status", "parked_minutes", "fee_blocks", "total_fee")


def test_flow_lifetime(spark):
    fees = lifetime.lifetime_fees(feeds.flow(spark))
    assert rows(fees, *FEE) == [("A1", "MOVING", 10, 1, 5000), ("B5", "EXITING", 15, 2, 10000)]
    assert rows(views.active_vehicles(fees), "location") == [("A1",)]
    assert rows(checkout.checkout_records(fees), "exit_location", "total_fee") == [("B5", 10000)]
    assert "processed_time" in checkout.checkout_records(fees, processed=True).columns


def test_flow_from_entering(spark):
    fees = lifetime.lifetime_fees_entering(feeds.flow(spark))
    assert rows(fees, "location", "entry_timestamp", "parked_minutes", "fee_blocks", "total_fee") == [
        ("A1", "2024-01-01 00:10:00", 15, 2, 10000),
        ("B5", None, 0, 0, 0),
    ]


@pytest.mark.parametrize("leave, expected", [("00:45", (30, 3, 15000)), ("00:46", (31, 4, 20000))])
def test_flow_visit(spark, leave, expected):
    steps = [*feeds.FLOW[:-1], (leave, "EXITING", "B5")]
    fees = visits.visit_fees(feeds.flow(spark, steps))
    assert rows(fees, "closed", "entry_location", "last_location", "parked_minutes", "fee_blocks", "total_fee") == [
        (True, "A1", "B5", *expected)
    ]


def test_flow_slot_state(spark):
    state = slot_state.slot_fsm_current(feeds.flow(spark))
    assert rows(state, "location", "status", "parked_seconds", "fee_vnd") == [("A1", "MOVING", 600, 5000)]


def test_fee_rules(spark):
    seconds = [0, 1, 59, 60, 300, 600, 601, 659, 660, 1380]
    df = spark.createDataFrame([(s,) for s in seconds], "s long")
    got = df.orderBy("s").select(fee_floor_minutes(F.col("s"), 1), fee_ceil_minutes(F.col("s"), 1)).collect()
    assert [r[0] for r in got] == [0, 0, 0, 1, 1, 1, 1, 1, 2, 3]
    assert [r[1] for r in got] == [0, 1, 1, 1, 1, 1, 2, 2, 2, 3]


def test_fee_properties(spark):
    s = F.col("id")
    fees = spark.range(0, 20000).select("id", fee_floor_minutes(s, 5000).alias("a"), fee_ceil_minutes(s, 5000).alias("b"),
                                        fee_floor_minutes(s + 1, 5000).alias("a1"), fee_ceil_minutes(s + 1, 5000).alias("b1"))
    assert fees.where("a > b OR a1 < a OR b1 < b").isEmpty()


@pytest.mark.parametrize("count", [0, 3, 500])
def test_price_in_force(spark, count):
    dice = random.Random(count)
    versions = [(dice.randrange(0, 10 * 86400), 1000 + n) for n in range(count)]
    versions = sorted({start: price for start, price in versions}.items())
    times = [dice.randrange(0, 12 * 86400) for _ in range(400)] + [start for start, _ in versions[:50]]
    rows_ = spark.createDataFrame([(n, time) for n, time in enumerate(times)], "n long, t long")
    listed = spark.createDataFrame(versions, "valid_from long, price long")

    def expected(time):
        known = [price for start, price in versions if start <= time]
        return known[-1] if known else None

    want = {n: expected(time) for n, time in enumerate(times)}
    assert {r.n: r.p for r in pricing.price_asof(rows_, listed, "t", "p").collect()} == want


def test_prices_without_time_or_amount(spark):
    schema = "valid_from long, price long"
    listed = spark.createDataFrame([(0, 5000), (None, 1), (10, None), (20, 7000), (20, 6000), (20, None), (90_000_000, 1)], schema)
    rows_ = spark.createDataFrame([(-5,), (0,), (9,), (10,), (19,), (20,), (89_999_999,), (90_000_001,), (None,)], "t long")
    got = {r.t: r.p for r in pricing.price_asof(rows_, listed, "t", "p").collect()}
    assert got == {-5: None, 0: 5000, 9: 5000, 10: None, 19: None, 20: 7000, 89_999_999: 7000, 90_000_001: 1, None: None}


def test_slot_sets(spark):
    dimension = slot_dimension(spark)
    used = spark.createDataFrame([("A1",), ("B2",), ("F3",)], "location string")
    free = slots.free_slots(dimension, used)
    assert free.count() == 57 and dimension.count() == 60
    listed = spark.createDataFrame([("A1",), ("Z9",)], "location string")
    assert rows(slots.vip_slots(dimension, listed), "location") == sorted([("A1",), ("Z9",)] + [(f"F{n}",) for n in range(1, 11)])
    first = [r.location for r in dimension.orderBy("location").limit(3).collect()]
    assert first == ["A1", "A10", "A2"]


def test_ties_do_not_depend_on_input_order(spark):
    tied = [feeds.row(1, feeds.DAY, "P", "A1", "MOVING"), feeds.row(2, feeds.DAY, "P", "A1", "PARKED")]
    for some in (tied, tied[::-1]):
        df = feeds.events(spark, some)
        assert rows(lifetime.lifetime(df), "current_status") == [("MOVING",)]
        assert rows(lifetime.lifetime_entering(df), "current_status") == [("MOVING",)]
        assert rows(visits.visits(df), "current_status") == [("MOVING",)]


def test_return_visit(spark):
    steps = [*feeds.FLOW, ("07:00", "PARKED", "A1"), ("07:05", "MOVING", "A1")]
    df = feeds.flow(spark, steps)
    fees = lifetime.lifetime_fees(df).where("location = 'A1'")
    assert rows(fees, "parked_minutes", "fee_blocks", "total_fee") == [(410, 41, 205000)]
    second = visits.visit_fees(df).where("NOT closed")
    assert rows(second, "parked_minutes", "fee_blocks", "total_fee") == [(5, 1, 5000)]
    assert rows(visits.occupied_by_visits(visits.visits(df)), "location") == [("A1",)]


def test_only_the_latest_slot_of_an_open_visit_is_taken(spark):
    df = feeds.flow(spark, feeds.FLOW[:-1])
    assert rows(visits.occupied_by_visits(visits.visits(df)), "location") == [("B5",)]
    assert rows(visits.visit_paths(df), "step_no", "location") == [(1, "A1"), (2, "B5")]


def test_requests(spark):
    view = views.status_view(
        views.snapshot(lifetime.lifetime_fees(feeds.flow(spark))),
        spark.createDataFrame([], "license_plate string, location string"),
    )
    requests = spark.createDataFrame(
        [(1, "29a-12345", "b5"), (2, "29A-12345", "A1"), (3, None, "A1"), (4, "X", "A1"), (5, "29A-12345", "")],
        "request_id long, license_plate string, location string",
    )
    outcomes = checkout.checkout_requests(requests, view)
    assert rows(outcomes, "request_id", "outcome", "total_fee") == [
        (1, "success", 10000), (2, "not_exiting", None), (3, "missing_field", None), (4, "not_found", None), (5, "missing_field", None),
    ]
    paid = checkout.payments_of(outcomes, F.lit("2024-01-02 00:00:00"))
    later = views.status_view(views.snapshot(lifetime.lifetime_fees(feeds.flow(spark))), paid)
    assert rows(checkout.checkout_requests(requests.limit(1), later), "outcome") == [("not_found",)]


def test_a_stay_is_charged_once_and_as_it_is_written(spark):
    view = spark.createDataFrame([("b5-x", "A1", "EXITING", 10000, 7)], "license_plate string, location string, current_status string, total_fee long, parked_minutes long")
    requests = spark.createDataFrame([(2, "B5-X", "a1"), (1, "b5-X", "A1"), (3, "b5-x", "A1")], "request_id long, license_plate string, location string")
    outcomes = checkout.checkout_requests(requests, view)
    assert rows(outcomes, "request_id", "outcome", "total_fee") == [(1, "success", 10000), (2, "not_found", None), (3, "not_found", None)]
    paid = checkout.payments_of(outcomes, F.lit("2024-01-02 00:00:00"))
    assert rows(paid, "license_plate", "location") == [("b5-x", "A1")]
    assert view.join(paid, ["license_plate", "location"], "left_anti").count() == 0


def test_a_paid_stay_does_not_hide_the_next_one(spark):
    keys = "license_plate string, location string, entry_time long"
    stays = spark.createDataFrame([("P", "A1", 1), ("P", "A1", 9)], keys)
    ledger = spark.createDataFrame([("P", "A1", 1)], keys)
    assert rows(checkout.unpaid_stays(stays, ledger), "entry_time") == [(9,)]


def test_ledger_keeps_the_latest_entry(spark):
    schema = "license_plate string, location string, total_fee long, parked_minutes long, checkout_time string"
    old = spark.createDataFrame([("P", "A1", 1, 1, "2024-01-01"), ("Q", "A1", 2, 2, "2024-01-01")], schema)
    new = spark.createDataFrame([("P", "A1", 5, 5, "2024-01-03")], schema)
    assert rows(checkout.ledger_upsert(old, new), "license_plate", "total_fee") == [("P", 5), ("Q", 2)]


def test_config_layers(spark):
    text = lambda value: spark.createDataFrame([(value,)] if value else [], "value string")

    def price(file, legacy):
        effective = config.effective_config(config.config_layer(text(file), 1), config.legacy_layer(text(legacy), 2))
        return config.settings_from(effective).price_per_10min

    file = '{"price": {"price_per_10min": 6000}}'
    assert price(file, '{"price_per_10min": 7000}') == 7000
    assert price(file, None) == 6000
    assert price(None, None) == 5000
    assert price("{ not json", None) == 5000


def test_config_files(spark, tmp_path):
    path = tmp_path / "config.json"
    path.write_text('{\n "price": {"price_per_10min": 6500},\n "parking": {"floors": ["A", "B"], "slots_per_floor": 3},\n "spark": {"watermark_duration": "5 minutes"}\n}')
    settings = config.load_settings(spark, str(path), str(tmp_path / "none.json"))
    assert (settings.price_per_10min, settings.floors, settings.watermark) == (6500, ("A", "B"), "5 minutes")
    assert slot_dimension(spark, settings).count() == 6


def test_settings_from_environment():
    settings = from_env({"PRICE_PER_10MIN_BLOCK": "4000", "VIP_LOCATIONS": "A1, B2,", "VIP_PREFIXES": "e,f"})
    assert (settings.price_per_10min, settings.vip_locations, settings.vip_prefixes) == (4000, ("A1", "B2"), ("E", "F"))
    assert from_env({}) == Settings()


def test_malformed(spark):
    good = '{"timestamp":"2024-01-01 00:00:00","timestamp_unix":1704067200,"license_plate":"P","location":"A1","status_code":"PARKED"%s}'
    texts = [
        "garbage",
        '{"timestamp_unix":"abc","location":"A1"}',
        good.replace("2024-01-01 00:00:00", "yesterday") % "",
        good.replace("PARKED", "WHAT") % "",
        good.replace('"P"', "null") % "",
        good % ',"extra":1',
        good.replace("1704067200", "0") % "",
        good.replace("1704067200", "9223372036854775807") % "",
        good.replace('"A1"', '""') % "",
    ]
    records = spark.createDataFrame(list(enumerate(texts)), "offset long, text string").selectExpr("CAST(text AS BINARY) value", "offset")
    parsed = parse_records(records)
    faults = quality.malformed_events(parsed)
    assert rows(faults, "event_id", "reason", "set_aside") == [
        (0, "not_json", True), (1, "no_unix_time", True), (2, "bad_timestamp", False), (3, "unknown_status", False),
        (4, "no_plate", False), (6, "bad_unix_time", True), (7, "bad_unix_time", True), (8, "no_location", True),
    ]
    fees = lifetime.lifetime_fees(parsed)
    assert rows(fees, "license_plate", "location") == [("P", "A1"), (None, "A1")]
    lifetime.window_fees(parsed).collect()


def test_display(spark):
    df = spark.createDataFrame([(0, "PARKED"), (59, "MOVING"), (60, "EXITING"), (283 * 60 + 38, "WHAT")], "m long, s string")
    got = df.orderBy("m").select(duration_text(F.col("m")), status_label(F.col("s")), amount_text(F.col("m") * 1000)).collect()
    assert [r[0] for r in got] == ["0 phút", "59 phút", "1h 0p", "283h 38p"]
    assert [r[1] for r in got] == ["Đã đỗ", "Di chuyển", "Đang ra", "WHAT"]
    assert got[3][2] == "17.018.000 ₫"


def test_lookups(spark):
    fees = lifetime.lifetime_fees(feeds.flow(spark))
    view = views.status_view(views.snapshot(fees), spark.createDataFrame([], "license_plate string, location string"))
    assert views.at_location(view, "b5").count() == 1
    assert views.of_vehicle(view, "29a-12345").count() == 2
    assert views.on_floor(view, "a").count() == 1
    detail = views.location_detail(view, slot_dimension(spark), "c3")
    assert rows(detail, "status", "vehicles") == [("available", 0)]
    totals = views.vehicle_totals(view)
    assert rows(totals, "location_count", "total_fee_all_locations") == [(2, 15000)]


def test_views_add_up(spark, sf_dir):
    from lotflow.plans import catalogue as c

    view, snap = c._view(spark, sf_dir), c.snapshot_all(spark, sf_dir)
    paid = snap.join(c._ledger(spark, sf_dir).select("license_plate", "location"), ["license_plate", "location"], "left_semi")
    assert view.count() + paid.count() == snap.count()
    total = views.vehicle_totals(view).agg(F.sum("total_fee_all_locations")).first()[0]
    assert total == view.agg(F.sum("total_fee")).first()[0]
    used = slots.used_slots(c.slot_fsm_current(spark, sf_dir)).count()
    assert used + c.free_slots(spark, sf_dir).count() == 60
    exact, rough = views.summary_stats(view).first(), views.summary_stats(view, approximate=True).first()
    assert abs(exact.unique_vehicles - rough.unique_vehicles) <= max(1, 0.1 * exact.unique_vehicles)


def test_equal_offsets_of_two_partitions(spark):
    body = '{"timestamp_unix": 60, "license_plate": "P", "location": "A1", "status_code": "EXITING"}'
    records = spark.createDataFrame([(body.encode(), n, 7) for n in (0, 1)], "value binary, partition int, offset long")
    parsed = parse_records(records)
    assert {r.event_id for r in parsed.collect()} == {7, (1 << 44) + 7}
    assert checkout.checkout_history(parsed).select("event_id").distinct().count() == 2


def test_equal_and_nameless_requests_pay_once(spark):
    view = spark.createDataFrame([("A1", "P1", "EXITING", "x", 10, 5000, 9)], "location string, license_plate string, current_status string, entry_timestamp string, parked_minutes long, total_fee long, last_update long")
    asks = spark.createDataFrame([(1, "p1", "a1"), (1, "P1", "A1"), (None, "P1", "A1"), (None, "P1", "A1"), (2, "P1", "A1")], "request_id long, license_plate string, location string")
    outcomes = checkout.checkout_requests(asks, view).collect()
    assert sorted((str(r.request_id), r.outcome) for r in outcomes) == [("1", "not_found"), ("1", "success"), ("2", "not_found"), ("None", "missing_field"), ("None", "missing_field")]


def test_gaps_between_islands(spark):
    rows = [(0, n) for n in (5, 6, 7, 7, 10, 11, 20)] + [(1, records.BLOCK - 1), (1, records.BLOCK), (1, 3 * records.BLOCK), (1, None), (None, 4)]
    offsets = spark.createDataFrame(rows, "partition int, offset long")
    found = sorted(tuple(r) for r in records.gaps(records.islands(offsets)).collect())
    assert found == [(0, 8, 9, 2), (0, 12, 19, 8), (1, records.BLOCK + 1, 3 * records.BLOCK - 1, 2 * records.BLOCK - 1)]
    halves = records.islands(offsets.where("offset % 2 = 0")).unionAll(records.islands(offsets.where("offset % 2 = 1")))
    assert sorted(tuple(r) for r in records.gaps(halves).collect()) == found
