"""Where streaming results go: versioned tables, and the memory and console sinks for watching."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lotflow.operators.checkout import checkout_history, checkout_records
from lotflow.operators.lifetime import with_fees
from lotflow.operators.pricing import price_asof
from lotflow.operators.quality import malformed_events
from lotflow.operators.records import gaps
from lotflow.operators.views import active_vehicles, by_slot, snapshot
from lotflow.schemas import ISLANDS, LATE_EVENTS
from lotflow.settings import REALTIME_TABLE, Settings
from lotflow.streaming.tables import read_all, write_batch

BatchWriter = Callable[[DataFrame, int], None]


def priced(totals: DataFrame, settings: Settings, versions: Callable[[], DataFrame] | None) -> DataFrame:
    """Fees at the set price, or at the price in force at the last sighting.

    ``versions`` is called for every batch, so a price change reaches the running query. With
    versions the totals are read twice: keep them before (``kept``).
    """
    if versions is None:
        return with_fees(totals, settings.price_per_10min)
    return with_fees(price_asof(totals, versions(), "last_update"), F.col("price_per_block")).drop("price_per_block")


@contextmanager
def kept(rows: DataFrame, keep: bool = True) -> Iterator[DataFrame]:
    """Rows of a batch that are read more than once, held while the block runs."""
    if not keep:
        yield rows
        return
    held = rows.persist()
    try:
        yield held
    finally:
        held.unpersist()


def table_sink(path: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> BatchWriter:
    """Writes each batch, transformed, as a version of a table."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(transform(batch) if transform else batch, batch_id, path)

    return write


def _priced_sink(path: str, transform: Callable[[DataFrame], DataFrame], settings: Settings, versions) -> BatchWriter:
    def write(batch: DataFrame, batch_id: int) -> None:
        with kept(batch, versions is not None) as totals:
            write_batch(transform(priced(totals, settings, versions)), batch_id, path)

    return write


def snapshot_sink(path: str, settings: Settings = Settings(), versions=None) -> BatchWriter:
    """All (slot, vehicle) rows, anew in every version; for complete mode."""
    return _priced_sink(path, snapshot, settings, versions)


def _checkouts_now(fees: DataFrame) -> DataFrame:
    return checkout_records(fees, processed=True)


def checkout_sink(path: str, settings: Settings = Settings(), versions=None) -> BatchWriter:
    """Rows that are EXITING; a stay that shows up again is read once, by its key."""
    return _priced_sink(path, _checkouts_now, settings, versions)


def visit_sink(path: str) -> BatchWriter:
    """Changed visits, and beside them (``<path>_late``) the events that came too late for theirs."""

    def write(batch: DataFrame, batch_id: int) -> None:
        with kept(batch) as rows:
            write_batch(rows.where("NOT late").drop("late"), batch_id, path)
            write_batch(late_rows(rows), batch_id, f"{path}_late")

    return write


_VISIT_NAMES = ("license_plate", "current_status", "last_update", "last_location")
_SLOT_NAMES = ("license_plate", "status", "last_update_unix", "location")


def late_rows(rows: DataFrame, names: tuple[str, ...] = _VISIT_NAMES) -> DataFrame:
    return rows.where("late").select(*[F.col(name).alias(as_name) for name, as_name in zip(names, LATE_EVENTS.fieldNames())])


def slot_sink(path: str) -> BatchWriter:
    """Changed slot states, and beside them (``<path>_late``) the events that came too late."""

    def write(batch: DataFrame, batch_id: int) -> None:
        with kept(batch) as rows:
            write_batch(rows.where("NOT late").drop("late"), batch_id, path)
            write_batch(late_rows(rows, _SLOT_NAMES), batch_id, f"{path}_late")

    return write


def quarantine(events: DataFrame) -> DataFrame:
    """Events that are booked nowhere, with their first fault."""
    return malformed_events(events).where("set_aside").drop("set_aside")


def record_gaps(spark: SparkSession, path: str) -> DataFrame:
    """Offsets that no batch brought, from the islands of all batches (``table_sink(path, islands)``)."""
    return gaps(read_all(spark, path, ISLANDS).drop("batch_id"))


def history_sink(path: str) -> BatchWriter:
    """EXITING events by day; each task writes the days it holds, nothing is moved."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = checkout_history(batch)
        day = F.to_date(F.timestamp_seconds("event_time_unix"))
        write_batch(rows.withColumn("event_date", day), batch_id, path, partition_by="event_date")

    return write


def fan_out_sink(root: str, settings: Settings = Settings(), versions=None) -> BatchWriter:
    """One stateful query, several tables: changed snapshot rows, checkouts and counts.

    The batch is kept while it is written more than once; an empty one writes nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        with kept(batch) as totals:
            if totals.isEmpty():
                return
            fees = priced(totals, settings, versions)
            write_batch(snapshot(fees), batch_id, f"{root}/snapshot_changes")
            write_batch(_checkouts_now(fees), batch_id, f"{root}/checkouts")
            counts = totals.agg(F.count(F.lit(1)).alias("changed_rows"))
            write_batch(counts, batch_id, f"{root}/counts")

    return write


def start(
    stream: DataFrame, writer: BatchWriter, mode: str, checkpoint: str, interval_seconds: int | None = None, name: str | None = None
) -> StreamingQuery:
    """Starts a query with its own checkpoint; without an interval it takes what is there and ends."""
    query = stream.writeStream.outputMode(mode).foreachBatch(writer).option("checkpointLocation", checkpoint)
    if name:
        query = query.queryName(name)
    if interval_seconds is None:
        return query.trigger(availableNow=True).start()
    return query.trigger(processingTime=f"{interval_seconds} seconds").start()


def run(stream: DataFrame, writer: BatchWriter, mode: str, checkpoint: str) -> StreamingQuery:
    """Runs a query over everything available and waits for its end."""
    query = start(stream, writer, mode, checkpoint)
    query.awaitTermination()
    return query


def dropped_late_rows(query: StreamingQuery) -> int:
    """Rows the query's recent batches dropped because they were behind the watermark."""
    operators = (operator for progress in query.recentProgress for operator in progress["stateOperators"])
    return sum(operator["numRowsDroppedByWatermark"] for operator in operators)


def observed(spark: SparkSession, query: StreamingQuery, name: str, columns: tuple[str, ...]) -> DataFrame:
    """What the query's recent batches observed under a name (``DataFrame.observe``), a row per batch."""
    rows = [
        (progress["batchId"], *[progress["observedMetrics"][name][column] for column in columns])
        for progress in query.recentProgress
        if name in progress["observedMetrics"]
    ]
    return spark.createDataFrame(rows, ", ".join(f"{column} long" for column in ("batch_id", *columns)))


def watch_in_memory(totals: DataFrame, checkpoint: str | None, settings: Settings = Settings(), once: bool = False) -> StreamingQuery:
    """Active vehicles as a table in the driver's memory, for small lots and for debugging."""
    rows = by_slot(active_vehicles(with_fees(totals, settings.price_per_10min)))
    query = rows.writeStream.outputMode("complete").format("memory").queryName(REALTIME_TABLE)
    if checkpoint:
        query = query.option("checkpointLocation", checkpoint)
    return _trigger(query, settings.processing_interval_seconds, once).start()


def watch_on_console(rows: DataFrame, mode: str, lines: int, settings: Settings = Settings(), once: bool = False) -> StreamingQuery:
    """Prints the first ``lines`` rows of each batch, for debugging."""
    query = rows.writeStream.outputMode(mode).format("console").option("truncate", "false").option("numRows", lines)
    return _trigger(query, settings.console_interval_seconds, once).start()


def _trigger(query, seconds: int, once: bool):
    return query.trigger(availableNow=True) if once else query.trigger(processingTime=f"{seconds} seconds")


def wait_for_any(spark) -> None:
    """Blocks until a query ends, then stops the others."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in spark.streams.active:
            query.stop()
