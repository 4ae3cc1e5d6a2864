"""Ordered operators give the same rows with a hot key cut in pieces, with none, and row by row."""

import pytest
from pyspark.sql import functions as F

import feeds
from lotflow.operators import slot_state, transitions, visits
from lotflow.plans.ordered import HotKeys, order_key, split_hot

PLAIN = HotKeys(hot_rows=10**9)
SPLITS = [PLAIN, HotKeys(hot_rows=50, width=200, ids=10**6), HotKeys(hot_rows=3, width=60, ids=40)]


@pytest.fixture(scope="module")
def rows():
    return feeds.skewed_rows(1500, 1)


@pytest.fixture(scope="module")
def df(spark, rows):
    return feeds.events(spark, rows).repartition(8, "event_id").cache()


def multiset(frame):
    return sorted(map(tuple, frame.select(*sorted(frame.columns)).collect()), key=str)


def test_paths_row_by_row(df, rows):
    steps, last = {}, {}
    for _, _, _, plate, location, status in feeds.in_order(rows, ("PARKED", "MOVING", "EXITING")):
        if plate is not None:
            visit, place = last.get(plate, (0, None))
            if place != location:
                steps.setdefault((plate, visit), []).append(location)
            last[plate] = (visit + 1, None) if status == "EXITING" else (visit, location)
    for hot in SPLITS:
        got = {}
        for r in sorted(visits.visit_paths(df, hot).collect(), key=lambda r: (r.license_plate, r.visit_no, r.step_no)):
            path = got.setdefault((r.license_plate, r.visit_no), [])
            path.append(r.location)
            assert r.step_no == len(path)
        assert got == steps


def test_the_fixture_is_skewed(df):
    assert df.where("location = 'A1'").count() > 0.34 * 1500
    pieces = split_hot(df, ["location"], SPLITS[1]).where("_hot").groupBy("location").agg(F.countDistinct("_piece").alias("n"))
    assert pieces.where("location = 'A1'").first().n > 10


@pytest.mark.parametrize("hot", SPLITS)
def test_slot_states_row_by_row(df, rows, hot):
    states = slot_state.slot_fsm_events(df, hot=hot).select(
        "event_id", "location", "license_plate", "status", "enter_unix", "last_update_unix", "parked_seconds", "fee_vnd"
    )
    assert sorted(map(tuple, states.collect()), key=str) == sorted(feeds.walk_slots(rows), key=str)


@pytest.mark.parametrize("hot", SPLITS)
def test_visits_row_by_row(df, rows, hot):
    got = visits.visits(df, hot).select(
        "license_plate", "visit_no", "closed", "entry_time", "last_update", "entry_location", "last_location"
    )
    assert set(map(tuple, got.collect())) == feeds.walk_visits(rows)


@pytest.mark.parametrize("hot", SPLITS[1:])
@pytest.mark.parametrize(
    "operator",
    [
        visits.visit_paths,
        lambda df, hot: visits.visits(df, hot, max_gap_seconds=40),
        transitions.status_changes,
        lambda df, hot: transitions.status_spells(df, hot),
        lambda df, hot: slot_state.slot_fsm_current(df, hot=hot),
    ],
    ids=["paths", "gap_visits", "changes", "spells", "current"],
)
def test_pieces_change_nothing(df, operator, hot):
    assert multiset(operator(df, hot)) == multiset(operator(df, PLAIN))


def test_copies_of_one_event_are_cut_by_id(spark):
    copies = [feeds.row(n, feeds.DAY, "P", "A1", "PARKED") for n in range(300)]
    rest = [feeds.row(1000, feeds.DAY + 90, "P", "A1", "MOVING"), feeds.row(1001, feeds.DAY + 95, "P", "A1", "EXITING")]
    df = feeds.events(spark, copies + rest)
    hot = HotKeys(hot_rows=50, width=300, ids=25)
    sizes = split_hot(df, ["license_plate"], hot).groupBy("_piece").count()
    assert sizes.agg(F.max("count")).first()[0] <= 25
    assert multiset(visits.visits(df, hot)) == multiset(visits.visits(df, PLAIN))
    assert multiset(slot_state.slot_fsm_events(df, hot=hot)) == multiset(slot_state.slot_fsm_events(df, hot=PLAIN))




def test_current_state_needs_only_events_since_the_release(df):
    every = slot_state.slot_fsm_events(df).groupBy("location").agg(
        F.max_by(F.struct("status", "enter_unix", "fee_vnd"), order_key()).alias("s")
    )
    every = every.select("location", "s.*").where("status <> 'EXITING'")
    current = slot_state.slot_fsm_current(df).select("location", "status", "enter_unix", "fee_vnd")
    assert multiset(current) == multiset(every)
    assert slot_state.since_release(df).count() < df.count()


def test_audit_and_dwell(df):
    changes = transitions.status_changes(df)
    audit = transitions.transition_audit(changes)
    assert audit.agg(F.sum("changes")).first()[0] == changes.count()
    assert audit.where("prev_status = 'PARKED' AND status_code = 'MOVING'").first().allowed
    assert not audit.where("prev_status = 'PARKED' AND status_code = 'ENTERING'").first().allowed
    spells = transitions.status_spells(df)
    assert spells.where("dwell_seconds < 0").isEmpty()
    assert transitions.dwell_percentiles(spells).count() == transitions.status_dwell(spells).count()
