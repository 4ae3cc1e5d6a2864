"""The engine as a service: streaming jobs that keep tables under one root, and questions to them.

Run ``python -m lotflow.jobs <root>`` with the Kafka connector on the class path; settings come
from the environment, or from JSON files named by ``LOT_CONFIG`` and ``LOT_LEGACY_PRICE``.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lotflow.operators import checkout, sketches, slot_state, slots, views
from lotflow.operators.lifetime import with_fees
from lotflow.operators.records import islands
from lotflow.schemas import CHECKOUT_LOG, HISTORY, LATE_EVENTS, LEDGER_ENTRY, PLATE_SKETCHES, QUARANTINE, SLOT_ROWS, SNAPSHOT, TIMESTAMP_PATTERN, VISIT_ROWS
from lotflow.session import build_session, prepare, streaming_session
from lotflow.settings import REALTIME_TABLE, Settings, from_env
from lotflow.sources.config import load_settings
from lotflow.sources.feed import kafka_records, parse_records
from lotflow.sources.slots import slot_dimension
from lotflow.streaming import ordered_state, parted, pipelines, sinks, state, tables

_OUTCOME = T.StructType(
    [
        T.StructField("request_id", T.LongType()),
        *[T.StructField(name, T.StringType()) for name in ("license_plate", "location", "outcome", "current_status")],
        T.StructField("total_fee", T.LongType()),
        T.StructField("parked_minutes", T.LongType()),
    ]
)


_STAY_OUTCOME = T.StructType([*[f for f in _OUTCOME.fields if f.name != "current_status"], T.StructField("entry_time", T.LongType())])
_STAY_ENTRY = T.StructType([*LEDGER_ENTRY.fields, T.StructField("entry_time", T.LongType())])

# A release starts the count of its slot anew, so its time tells it from others with the same number.
_RELEASE = "CASE WHEN status = 'EXITING' THEN struct(last_update_unix, seq, batch_id) END"


def start_jobs(
    records: DataFrame,
    root: str,
    settings: Settings = Settings(),
    versions: Callable[[], DataFrame] | None = None,
    once: bool = False,
) -> list[StreamingQuery]:
    """Starts the queries over a record stream, each with its own checkpoint.

    fees: changed (slot, vehicle) rows, checkouts and counts, from one keyed aggregate.
    slots: the state of each slot as events arrive, and its releases with their fee. slots_in_order: the same once the
    watermark has passed, in event order, and beside it the late events. records: runs of offsets, which show gaps. history: EXITING events.
    visits: each stay of a vehicle, and beside them its late events. windows: parts of fees per 30 seconds, and the rows late for theirs.
    plates: sketches of the plates of each slot and day.
    quarantine: events that are booked nowhere, with their fault.
    """
    events = parse_records(records)
    plan = {
        "fees": (pipelines.lifetime_totals(records, settings), sinks.fan_out_sink(f"{root}/fees", settings, versions), "update"),
        "slots": (state.slot_states(events, settings), sinks.table_sink(f"{root}/slots"), "update"),
        "slots_in_order": (ordered_state.slots_in_order(events, settings), sinks.slot_sink(f"{root}/slots_in_order"), "update"),
        "records": (records.select("partition", "offset"), sinks.table_sink(f"{root}/records", islands), "append"),
        "history": (events, sinks.history_sink(f"{root}/history"), "append"),
        "visits": (state.visit_states(events), sinks.visit_sink(f"{root}/visits"), "update"),
        "windows": (events, parted.window_sink(f"{root}/windows", settings), "append"),
        "plates": (events, sinks.table_sink(f"{root}/plates", sketches.plate_sketches), "append"),
        "quarantine": (sinks.quarantine(events), sinks.table_sink(f"{root}/quarantine"), "append"),
    }
    checkpoints = settings.checkpoint_dir or f"{root}/checkpoints"
    interval = None if once else settings.processing_interval_seconds
    return [
        sinks.start(stream, writer, mode, f"{checkpoints}/{name}", interval, name)
        for name, (stream, writer, mode) in plan.items()
    ]


class Lot:
    """Questions to the tables under a root; each answer is a DataFrame."""

    def __init__(self, spark: SparkSession, root: str, settings: Settings = Settings()):
        self.spark, self.root, self.settings = prepare(spark), root, settings

    def slots(self) -> DataFrame:
        return slot_dimension(self.spark, self.settings)

    def snapshot(self) -> DataFrame:
        changes = tables.read_all(self.spark, f"{self.root}/fees/snapshot_changes", SNAPSHOT)
        return tables.latest_per_key(changes, ["location", "license_plate"])

    def compact(self) -> None:
        """Folds the update logs; run it now and then beside the jobs."""
        tables.compact(self.spark, f"{self.root}/fees/snapshot_changes", SNAPSHOT, ["location", "license_plate"])
        tables.compact(self.spark, f"{self.root}/slots", SLOT_ROWS, ["location"], "seq", apart=_RELEASE)

    def register_views(self) -> None:
        """The tables by name, for SQL."""
        active = self.snapshot().where(F.col("current_status") != "EXITING")
        named = {REALTIME_TABLE: active, "lot_status": self.status(), "lot_ledger": self.ledger(), "lot_slots": self.slots()}
        for name, rows in named.items():
            rows.createOrReplaceTempView(name)

    def ledger(self) -> DataFrame:
        """The log of payments, the latest per (plate, slot)."""
        return checkout.ledger_latest(tables.read_all(self.spark, f"{self.root}/ledger", LEDGER_ENTRY))

    def status(self) -> DataFrame:
        return views.status_view(self.snapshot(), self.ledger())

    def summary(self) -> DataFrame:
        return views.summary_stats(self.status(), self.settings)

    def location(self, name: str) -> DataFrame:
        return views.location_detail(self.status(), self.slots(), name)

    def vehicles_at(self, name: str) -> DataFrame:
        return views.at_location(self.status(), name)

    def floors(self) -> DataFrame:
        return views.floor_summary(self.status(), self.slots())

    def vehicles_on(self, floor: str) -> DataFrame:
        return views.on_floor(self.status(), floor)

    def vehicles(self) -> DataFrame:
        return views.vehicle_totals(self.status())

    def vehicle(self, plate: str) -> DataFrame:
        return views.of_vehicle(self.status(), plate)

    def slot_states(self) -> DataFrame:
        rows = tables.read_all(self.spark, f"{self.root}/slots", SLOT_ROWS)
        return tables.latest_per_key(rows, ["location"], "seq").where(F.col("status") != "EXITING").drop("seq")

    def releases(self) -> DataFrame:
        """Every stay that ended at a slot, with its final fee."""
        rows = tables.read_all(self.spark, f"{self.root}/slots", SLOT_ROWS)
        return rows.where("status = 'EXITING'").drop("seq", "batch_id")

    def live(self, as_of: int | None = None) -> DataFrame:
        """Slot states at a moment, now unless one is given."""
        moment = F.unix_timestamp(F.current_timestamp()) if as_of is None else as_of
        return slot_state.live_state(self.slot_states(), moment, self.settings).orderBy("location")

    def free(self) -> DataFrame:
        return slots.free_slots(self.slots(), self.slot_states()).orderBy("location")

    def checkouts(self) -> DataFrame:
        rows = tables.read_all(self.spark, f"{self.root}/fees/checkouts", CHECKOUT_LOG)
        return tables.latest_per_key(rows, ["license_plate", "exit_location", "entry_time"])

    def visits(self) -> DataFrame:
        """Every stay of every vehicle with its fee; an open one as last seen."""
        rows = tables.read_all(self.spark, f"{self.root}/visits", VISIT_ROWS)
        return with_fees(tables.latest_per_key(rows, ["license_plate", "visit_no"]), self.settings.price_per_10min)

    def unpaid(self) -> DataFrame:
        """Stays that no payment names by plate, slot and entry time, so that a vehicle that paid and came back is here again."""
        stays = self.visits().withColumnRenamed("last_location", "location")
        return checkout.unpaid_stays(stays, self.stay_ledger())

    def stay_ledger(self) -> DataFrame:
        """Payments stay by stay."""
        return checkout.ledger_latest(tables.read_all(self.spark, f"{self.root}/stay_ledger", _STAY_ENTRY), per_stay=True)

    def settled_slots(self) -> DataFrame:
        """The state of each slot after all events up to the watermark, in event order."""
        rows = tables.read_all(self.spark, f"{self.root}/slots_in_order", SLOT_ROWS)
        return tables.latest_per_key(rows, ["location"], "seq").where(F.col("status") != "EXITING").drop("seq")

    def late_at_slots(self) -> DataFrame:
        """Events that came after the watermark had passed them; they changed no slot."""
        return tables.read_all(self.spark, f"{self.root}/slots_in_order_late", LATE_EVENTS).drop("batch_id")

    def record_gaps(self) -> DataFrame:
        """Offsets that never came from the topic."""
        return sinks.record_gaps(self.spark, f"{self.root}/records")

    def late_events(self) -> DataFrame:
        """Events that came after the visit they belong to was closed."""
        schema = "license_plate string, status_code string, timestamp_unix long, location string"
        return tables.read_all(self.spark, f"{self.root}/visits_late", T.StructType.fromDDL(schema)).drop("batch_id")

    def windows(self) -> DataFrame:
        return parted.read_windows(self.spark, f"{self.root}/windows", self.settings)

    def late_in_windows(self) -> DataFrame:
        """Rows that came when their window was over by more than the delay."""
        return parted.read_late(self.spark, f"{self.root}/windows")

    def distinct_plates(self, *by) -> DataFrame:
        """Estimated distinct plates by slot, ``day`` (since 1970) or any column of them; no event is read."""
        return sketches.distinct_plates(tables.read_all(self.spark, f"{self.root}/plates", PLATE_SKETCHES), *by)

    def quarantine(self) -> DataFrame:
        return tables.read_all(self.spark, f"{self.root}/quarantine", QUARANTINE).drop("batch_id")

    def history(self) -> DataFrame:
        return tables.read_all(self.spark, f"{self.root}/history", HISTORY).select(*HISTORY.fieldNames())

    def settle(self, requests: DataFrame) -> DataFrame:
        """Answers payment requests in bulk by (plate, slot), and books the ones that succeed.

        Outcomes are written first and payments derived from what was written, so both agree; a stop
        between the two is made good by the next call, which books the last outcomes first. One caller
        at a time: each call is one batch of the ledger.
        """
        return self._settled(lambda: checkout.checkout_requests(requests, self.status()), "outcomes", "ledger", _OUTCOME)

    def settle_stays(self, requests: DataFrame) -> DataFrame:
        """The same stay by stay; a request is for the stay under way at ``requested_unix``, now unless the requests bring one."""
        now = F.unix_timestamp(F.current_timestamp())
        asked = requests if "requested_unix" in requests.columns else requests.withColumn("requested_unix", now)
        answers = lambda: checkout.stay_requests(asked, self.visits(), self.stay_ledger())
        return self._settled(answers, "stay_outcomes", "stay_ledger", _STAY_OUTCOME)

    def _settled(self, answers: Callable[[], DataFrame], outcomes: str, ledger: str, schema: T.StructType) -> DataFrame:
        last = tables.last_commit(self.spark, f"{self.root}/{outcomes}")
        batch = 0 if last is None else last + 1
        booked = tables.last_commit(self.spark, f"{self.root}/{ledger}")
        if last is not None and (booked is None or booked < last):
            self._book(last, outcomes, ledger, schema)
        tables.write_batch(answers(), batch, f"{self.root}/{outcomes}")
        return self._book(batch, outcomes, ledger, schema)

    def _book(self, batch: int, outcomes: str, ledger: str, schema: T.StructType) -> DataFrame:
        """Write the payments of the last outcomes to the ledger."""
        answered = tables.read_latest(self.spark, f"{self.root}/{outcomes}", schema)
        now = F.date_format(F.current_timestamp(), TIMESTAMP_PATTERN)
        tables.write_batch(checkout.payments_of(answered, now), batch, f"{self.root}/{ledger}")
        return answered


def main(root: str) -> None:
    spark = build_session()
    settings = from_env(os.environ)
    if "LOT_CONFIG" in os.environ:
        settings = load_settings(spark, os.environ["LOT_CONFIG"], os.environ.get("LOT_LEGACY_PRICE", ""), settings)
    start_jobs(kafka_records(streaming_session(spark, settings.state_partitions), settings), root, settings)
    sinks.wait_for_any(spark)


if __name__ == "__main__":
    main(sys.argv[1])
