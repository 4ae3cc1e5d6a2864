"""What the plans must and must not hold."""

import contextlib
import io

import pytest

import feeds
from lotflow.operators import lifetime, slot_state, visits
from lotflow.plans.catalogue import BATCH
from lotflow.sources.feed import parse_records, to_record, typed_events

CORE = ("event_id", "timestamp", "timestamp_unix", "license_plate", "location", "status_code")


def text(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("events") / "events")
    feeds.flow(spark).select(*CORE).write.parquet(path)
    return typed_events(spark.read.schema(feeds.SCHEMA).parquet(path))


@pytest.mark.parametrize("name", sorted(BATCH))
def test_no_product_of_tables(spark, sf_dir, name):
    plan = text(BATCH[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_lifetime_hashes_and_pushes_its_filter(stored):
    plan = text(lifetime.lifetime_fees(stored))
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert plan.count("Exchange ") == 1
    assert "In(status_code, [EXITING,MOVING,PARKED])" in plan
    assert "event_id" not in plan.split("ReadSchema")[1]


def test_large_step_of_the_older_form_hashes(stored):
    plan = text(lifetime.lifetime_fees_entering(stored))
    below_exchange = plan.split("Exchange ")[-1]
    assert "HashAggregate" in below_exchange and "SortAggregate" not in below_exchange


def test_ordered_operators_spread_by_piece(stored):
    for df in (visits.visit_fees(stored), slot_state.slot_fsm_events(stored)):
        plan = text(df)
        assert "_piece" in plan and "In(status_code" in plan
        for line in plan.splitlines():
            if "Window [" in line:
                assert "_piece" in line


def test_json_is_parsed_once(spark, stored):
    parsed = parse_records(to_record(stored))
    assert text(lifetime.lifetime_fees(parsed)).count("from_json(") == 1


def test_window_form_takes_one_shuffle(stored):
    assert text(lifetime.window_fees(stored)).count("Exchange ") == 1
