"""Registered queries that run as streams: the whole feed arrives in three parts, cut by time.

Each query runs until the feed is used up, writes its tables to the shared folder, and returns
them as a DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotflow.functions.columns import BILLABLE, floor_of
from lotflow.operators import lifetime, sketches, views, visits
from lotflow.operators.quality import is_usable
from lotflow.operators.records import islands
from lotflow.plans.catalogue import SETTINGS, Query, _fees, exact_plates, torn_records
from lotflow.schemas import CHECKOUT, HISTORY, LATE_EVENTS, PLATE_SKETCHES, QUARANTINE, SLOT_ROWS, SNAPSHOT, VISIT_ROWS, WINDOW_FEES
from lotflow.session import shared_dir, streaming_session
from lotflow.sources.feed import file_records, parse_records, to_record
from lotflow.sources.tables import as_sightings, noisy_records, raw_events
from lotflow.streaming import ordered_state, pairs, parted, pipelines, sinks, state, tables

# The parts of the feed: before the first cut, between the cuts, and the rest.
CUTS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")

_feeds: dict[tuple, str] = {}


def write_part(spark: SparkSession, sf: str, part: int, path: str) -> int:
    """Adds one part of the feed to a folder, as a fixed number of files."""
    raw = raw_events(spark, sf)
    bounds = (None, *CUTS, None)
    low, high = bounds[part], bounds[part + 1]
    if low:
        raw = raw.where(F.col("ts") >= F.lit(low).cast("timestamp_ntz"))
    if high:
        raw = raw.where(F.col("ts") < F.lit(high).cast("timestamp_ntz"))
    files = spark.sparkContext.defaultParallelism
    # dealt out as read: the scan may be a few tasks, and the work on each record comes after
    to_record(as_sightings(raw.repartition(files))).write.mode("append").parquet(path)
    return files


def feed(spark: SparkSession, sf: str, order: tuple[int, ...] = (0, 1, 2)) -> str:
    """Folder with the parts of the feed, written one after the other; made once per session."""
    key = (spark.sparkContext.applicationId, sf, order)
    if key not in _feeds:
        path = shared_dir(spark, "feed")
        for part in order:
            write_part(spark, sf, part, path)
        _feeds[key] = path
    return _feeds[key]


def _records(spark: SparkSession, sf: str, order: tuple[int, ...] = (0, 1, 2)) -> DataFrame:
    """The feed as a stream, one part per micro-batch."""
    path = feed(spark, sf, order)
    return file_records(streaming_session(spark), path, spark.sparkContext.defaultParallelism)


def _run(spark: SparkSession, name: str, stream: DataFrame, writer, mode: str) -> None:
    sinks.run(stream, writer, mode, shared_dir(spark, f"checkpoint-{name}"))


def snapshot_roundtrip(spark, sf):
    """Snapshot written as a version of a table and read back with its declared schema."""
    path = shared_dir(spark, "snapshot")
    tables.write_batch(views.snapshot(_fees(spark, sf)), 0, path)
    return tables.read_latest(spark, path, SNAPSHOT)


def stream_lifetime_complete(spark, sf):
    path = shared_dir(spark, "active")
    writer = sinks.table_sink(path, lambda batch: views.active_vehicles(sinks.priced(batch, SETTINGS, None)))
    _run(spark, "active", pipelines.lifetime_totals(_records(spark, sf), SETTINGS), writer, "complete")
    return views.by_slot(tables.read_latest(spark, path, SNAPSHOT))


_FEES = T.StructType(
    [
        *[T.StructField(name, T.StringType()) for name in ("location", "license_plate", "current_status", "entry_timestamp", "exit_timestamp")],
        *[T.StructField(name, T.LongType()) for name in ("entry_time", "last_update", "parked_seconds", "parked_minutes", "fee_blocks", "total_fee")],
    ]
)


def stream_lifetime_update(spark, sf):
    """Changed rows of each batch; the newest of each key make the whole table."""
    path = shared_dir(spark, "changes")
    writer = sinks.table_sink(path, lambda batch: sinks.priced(batch, SETTINGS, None))
    _run(spark, "changes", pipelines.lifetime_totals(_records(spark, sf), SETTINGS), writer, "update")
    return tables.latest_per_key(tables.read_all(spark, path, _FEES), ["location", "license_plate"])


def stream_snapshot(spark, sf):
    path = shared_dir(spark, "snapshot")
    totals = pipelines.lifetime_totals(_records(spark, sf), SETTINGS)
    _run(spark, "snapshot", totals, sinks.snapshot_sink(path, SETTINGS), "complete")
    return views.by_slot(tables.read_latest(spark, path, SNAPSHOT))


def stream_checkout(spark, sf):
    """Every stay that was EXITING at the end of some batch, once."""
    path = shared_dir(spark, "checkouts")
    totals = pipelines.lifetime_totals(_records(spark, sf), SETTINGS)
    _run(spark, "checkouts", totals, sinks.checkout_sink(path, SETTINGS), "update")
    return tables.latest_per_key(
        tables.read_all(spark, path, CHECKOUT), ["license_plate", "exit_location", "entry_time"]
    )


def stream_fanout(spark, sf):
    """Snapshot rows with the mark of those that have been checked out: two tables of one query."""
    root = shared_dir(spark, "fanout")
    totals = pipelines.lifetime_totals(_records(spark, sf), SETTINGS)
    _run(spark, "fanout", totals, sinks.fan_out_sink(root, SETTINGS), "update")
    keys = ["license_plate", "location"]
    rows = tables.latest_per_key(tables.read_all(spark, f"{root}/snapshot_changes", SNAPSHOT), keys)
    left = tables.read_all(spark, f"{root}/checkouts", CHECKOUT)
    left = left.select("license_plate", F.col("exit_location").alias("location"), F.lit(True).alias("left")).distinct()
    marked = rows.join(left, keys, "left").withColumn("checked_out", F.coalesce("left", F.lit(False)))
    return marked.select(*SNAPSHOT.fieldNames(), "checked_out")


def _flagged(spark: SparkSession, sf: str) -> DataFrame:
    events = parse_records(_records(spark, sf))
    return events.select(
        is_usable().alias("usable"), (is_usable() & F.col("status_code").isin(*BILLABLE)).alias("billable")
    )


def stream_metrics(spark, sf):
    """Records of each batch: all, usable, billable."""
    path = shared_dir(spark, "metrics")

    def counts(batch: DataFrame) -> DataFrame:
        is_in = lambda rows: F.count(F.when(rows, 1))
        return batch.agg(
            F.count(F.lit(1)).alias("records"),
            is_in(F.col("usable")).alias("usable"),
            is_in(F.col("billable")).alias("billable"),
        )

    _run(spark, "metrics", _flagged(spark, sf), sinks.table_sink(path, counts), "append")
    schema = T.StructType([T.StructField(name, T.LongType()) for name in ("records", "usable", "billable")])
    return tables.read_all(spark, path, schema)


def stream_restart(spark, sf):
    """The update stream stopped after the first part and resumed from its checkpoint for the rest."""
    source, path, checkpoint = (shared_dir(spark, name) for name in ("restart-feed", "restart", "checkpoint-restart"))
    writer = sinks.table_sink(path, lambda batch: sinks.priced(batch, SETTINGS, None))
    for parts in ((0,), (1, 2)):
        for part in parts:
            files = write_part(spark, sf, part, source)
        records = file_records(streaming_session(spark), source, files)
        sinks.run(pipelines.lifetime_totals(records, SETTINGS), writer, "update", checkpoint)
    return tables.latest_per_key(tables.read_all(spark, path, _FEES), ["location", "license_plate"])


_WINDOW_KEYS = ["window_start", "location", "license_plate"]


def _windowed(spark, sf, order):
    path = shared_dir(spark, "windows")
    fees = pipelines.windowed_fees(_records(spark, sf, order), SETTINGS)
    _run(spark, "windows", fees, sinks.table_sink(path), "update")
    return tables.latest_per_key(tables.read_all(spark, path, WINDOW_FEES), _WINDOW_KEYS)


def stream_window_update(spark, sf):
    return _windowed(spark, sf, (0, 1, 2))


def stream_late_data(spark, sf):
    """The first part of the feed arrives last, behind the watermark, and all of it is dropped.

    A batch drops rows by the watermark that the batch before it started with, so the late part
    follows two others.
    """
    return _windowed(spark, sf, (1, 2, 0))


def stream_dedup(spark, sf):
    """Every record is sent twice and comes out once."""
    path = shared_dir(spark, "dedup")
    records = _records(spark, sf)
    twice = records.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    rows = pipelines.deduplicated(twice, SETTINGS).select("timestamp", *pipelines.DEDUP_KEYS)
    _run(spark, "dedup", rows, sinks.table_sink(path), "append")
    schema = T.StructType(
        [*[T.StructField(name, T.StringType()) for name in ("timestamp", "license_plate", "location", "status_code")],
         T.StructField("timestamp_unix", T.LongType())]
    )
    return tables.read_all(spark, path, schema).drop("batch_id")


def _slot_rows(spark, sf):
    path = shared_dir(spark, "slots")
    stream = state.slot_states(parse_records(_records(spark, sf)), SETTINGS)
    _run(spark, "slots", stream, sinks.table_sink(path), "update")
    return tables.read_all(spark, path, SLOT_ROWS)


def stream_slot_fsm(spark, sf):
    return tables.latest_per_key(_slot_rows(spark, sf), ["location"], "seq").where(F.col("status") != "EXITING").drop("seq")


def stream_slot_releases(spark, sf):
    """Each release of a slot with its final fee."""
    return _slot_rows(spark, sf).where(F.col("status") == "EXITING").drop("seq", "batch_id")


def _visit_rows(spark, sf):
    path = shared_dir(spark, "visits")
    stream = state.visit_states(parse_records(_records(spark, sf)))
    _run(spark, "visits", stream, sinks.visit_sink(path), "update")
    rows = tables.read_all(spark, path, VISIT_ROWS)
    return tables.latest_per_key(rows, ["license_plate", "visit_no"])


def stream_visits(spark, sf):
    return lifetime.with_fees(_visit_rows(spark, sf), SETTINGS.price_per_10min)


def stream_park_exit_pairs(spark, sf):
    return visits.park_exit_pairs(_visit_rows(spark, sf))


def stream_late_rows(spark, sf):
    """The first part of the feed arrives last: its events that belong to visits closed by then, as a table."""
    path = shared_dir(spark, "visits")
    stream = state.visit_states(parse_records(_records(spark, sf, (1, 2, 0))))
    _run(spark, "late-rows", stream, sinks.visit_sink(path), "update")
    late = T.StructType.fromDDL("license_plate string, status_code string, timestamp_unix long, location string")
    return tables.read_all(spark, f"{path}_late", late).drop("batch_id")


def _straggling(spark: SparkSession, sf: str) -> DataFrame:
    """The feed with every fifth event a part late, as a stream of one part per micro-batch; made once per session."""
    key = (spark.sparkContext.applicationId, sf, "straggling")
    files = spark.sparkContext.defaultParallelism
    if key not in _feeds:
        path = shared_dir(spark, "straggling")
        part = F.when(F.col("ts") < F.lit(CUTS[0]).cast("timestamp_ntz"), 0).when(F.col("ts") < F.lit(CUTS[1]).cast("timestamp_ntz"), 1).otherwise(2)
        arrives = F.least(part + (F.col("event_id") % 5 == 0).cast("int"), F.lit(2))
        for number in range(3):
            rows = as_sightings(raw_events(spark, sf).where(arrives == number).repartition(files))
            to_record(rows).write.mode("append").parquet(path)
        _feeds[key] = path
    return file_records(streaming_session(spark), _feeds[key], files)


_ordered: dict[tuple, str] = {}


def _slots_in_order(spark, sf) -> str:
    """Folder of the slot states in event order and of the late events beside them; run once per session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _ordered:
        path = shared_dir(spark, "slots-in-order")
        stream = ordered_state.slots_in_order(parse_records(_straggling(spark, sf)), SETTINGS)
        _run(spark, "slots-in-order", stream, sinks.slot_sink(path), "update")
        _ordered[key] = path
    return _ordered[key]


def stream_slots_in_order(spark, sf):
    """The state of each slot when the watermark has passed, though every fifth event comes a part late."""
    rows = tables.read_all(spark, _slots_in_order(spark, sf), SLOT_ROWS)
    return tables.latest_per_key(rows, ["location"], "seq").where(F.col("status") != "EXITING").drop("seq")


def stream_slot_releases_in_order(spark, sf):
    rows = tables.read_all(spark, _slots_in_order(spark, sf), SLOT_ROWS)
    return rows.where(F.col("status") == "EXITING").drop("seq", "batch_id")


def stream_late_at_slots(spark, sf):
    """Events that came after the watermark had passed them."""
    return tables.read_all(spark, f"{_slots_in_order(spark, sf)}_late", LATE_EVENTS).drop("batch_id")


def stream_visits_in_order(spark, sf):
    path = shared_dir(spark, "visits-in-order")
    stream = ordered_state.visits_in_order(parse_records(_straggling(spark, sf)), SETTINGS)
    _run(spark, "visits-in-order", stream, sinks.visit_sink(path), "update")
    rows = tables.latest_per_key(tables.read_all(spark, path, VISIT_ROWS), ["license_plate", "visit_no"])
    return lifetime.with_fees(rows, SETTINGS.price_per_10min)


def stream_record_gaps(spark, sf):
    """Ranges of offsets that never came, from the runs of offsets of each batch."""
    path = shared_dir(spark, "islands")
    records = torn_records(_records(spark, sf))
    _run(spark, "islands", records, sinks.table_sink(path, islands), "append")
    return sinks.record_gaps(spark, path)


_windows: dict[tuple, str] = {}


def _parted_windows(spark, sf) -> str:
    """Folder of the parts of windows, and beside it the late rows; run once per session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _windows:
        path = shared_dir(spark, "parted-windows")
        _run(spark, "parted-windows", parse_records(_straggling(spark, sf)), parted.window_sink(path, SETTINGS), "append")
        _windows[key] = path
    return _windows[key]


def stream_windows_parted(spark, sf):
    """Fees per window from its parts, without what came after the clock had passed the window."""
    return parted.read_windows(spark, _parted_windows(spark, sf), SETTINGS)


def stream_late_in_windows(spark, sf):
    """The rows that came too late for their window."""
    return parted.read_late(spark, _parted_windows(spark, sf))


def stream_stay_join(spark, sf):
    """PARKED and EXITING as two streams, joined; the longest stay is as long as the feed."""
    path, folder, session = shared_dir(spark, "stay-join"), feed(spark, sf), streaming_session(spark)
    sides = [file_records(session, folder, spark.sparkContext.defaultParallelism) for _ in range(2)]
    _run(spark, "stay-join", pairs.park_exit_stream(*sides, SETTINGS, "31 days"), pairs.pair_sink(path), "append")
    return pairs.read_pairs(spark, path)


def stream_plate_sketches(spark, sf):
    """Floors from the sketches that each batch wrote."""
    path = shared_dir(spark, "sketches")
    events = parse_records(_records(spark, sf))
    _run(spark, "sketches", events, sinks.table_sink(path, sketches.plate_sketches), "append")
    found = tables.read_all(spark, path, PLATE_SKETCHES)
    return exact_plates(spark, sf, sketches.distinct_plates(found, floor_of("location").alias("floor")))


def stream_observed(spark, sf):
    """The same counts as ``stream_metrics``, observed while another table is written."""
    path = shared_dir(spark, "observed")
    is_in = lambda name: F.count(F.when(F.col(name), 1)).alias(name)
    flagged = _flagged(spark, sf).observe("counts", F.count(F.lit(1)).alias("records"), is_in("usable"), is_in("billable"))
    query = sinks.run(flagged, sinks.table_sink(path), "append", shared_dir(spark, "checkpoint-observed"))
    return sinks.observed(spark, query, "counts", ("records", "usable", "billable"))


def stream_quarantine(spark, sf):
    """Damaged records of the feed that are booked nowhere."""
    source, path = shared_dir(spark, "noisy"), shared_dir(spark, "quarantine")
    noisy_records(spark, sf).write.parquet(source)
    events = parse_records(file_records(streaming_session(spark), source))
    _run(spark, "quarantine", sinks.quarantine(events), sinks.table_sink(path), "append")
    return tables.read_all(spark, path, QUARANTINE).drop("batch_id")


def stream_history(spark, sf):
    path = shared_dir(spark, "history")
    _run(spark, "history", parse_records(_records(spark, sf)), sinks.history_sink(path), "append")
    with_date = T.StructType([*HISTORY.fields, T.StructField("event_date", T.DateType())])
    return tables.read_all(spark, path, with_date).drop("batch_id", "event_date")


STREAMS: dict[str, Query] = {
    "snapshot_roundtrip": snapshot_roundtrip,
    "stream_lifetime_complete": stream_lifetime_complete,
    "stream_lifetime_update": stream_lifetime_update,
    "stream_snapshot": stream_snapshot,
    "stream_checkout": stream_checkout,
    "stream_fanout": stream_fanout,
    "stream_metrics": stream_metrics,
    "stream_restart": stream_restart,
    "stream_window_update": stream_window_update,
    "stream_late_data": stream_late_data,
    "stream_dedup": stream_dedup,
    "stream_slot_fsm": stream_slot_fsm,
    "stream_slot_releases": stream_slot_releases,
    "stream_visits": stream_visits,
    "stream_park_exit_pairs": stream_park_exit_pairs,
    "stream_late_rows": stream_late_rows,
    "stream_slots_in_order": stream_slots_in_order,
    "stream_slot_releases_in_order": stream_slot_releases_in_order,
    "stream_late_at_slots": stream_late_at_slots,
    "stream_visits_in_order": stream_visits_in_order,
    "stream_record_gaps": stream_record_gaps,
    "stream_windows_parted": stream_windows_parted,
    "stream_late_in_windows": stream_late_in_windows,
    "stream_stay_join": stream_stay_join,
    "stream_plate_sketches": stream_plate_sketches,
    "stream_observed": stream_observed,
    "stream_quarantine": stream_quarantine,
    "stream_history": stream_history,
}
