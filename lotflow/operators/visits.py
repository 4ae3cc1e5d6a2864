"""Visits of a vehicle: from its first PARKED to its next EXITING, over all its slots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotflow.functions.columns import EVENT_ORDER, pack_latest, packed_status, packed_time
from lotflow.operators.lifetime import with_fees
from lotflow.operators.quality import billable_events
from lotflow.plans.ordered import HotKeys, neighbour, order_key, running, split_hot, unsplit
from lotflow.settings import Settings

_PLATE = ["license_plate"]


def _split_by_plate(events: DataFrame, hot: HotKeys) -> DataFrame:
    rows = billable_events(events).where(F.col("license_plate").isNotNull())
    return split_hot(
        rows.select(*_PLATE, "location", "status_code", "parked_time", *EVENT_ORDER), _PLATE, hot
    )


def _exiting() -> Column:
    return (F.col("status_code") == "EXITING").cast("long")


def numbered_events(events: DataFrame, hot: HotKeys = HotKeys(), max_gap_seconds: int | None = None) -> DataFrame:
    """Billable events with ``visit_no``: the EXITING rows of the vehicle before each.

    With ``max_gap_seconds`` a silence of more than that also ends a visit, for vehicles whose
    EXITING never came.
    """
    split = _split_by_plate(events, hot)
    if max_gap_seconds is None:
        numbered = running(split, _PLATE, {"exits": _exiting()})
        return unsplit(numbered.withColumn("visit_no", F.col("exits") - _exiting()).drop("exits"))
    near = neighbour(split, _PLATE, ["timestamp_unix", "status_code"], "prev")
    silent = F.col("timestamp_unix") - F.col("prev.timestamp_unix") > max_gap_seconds
    starts = F.coalesce((F.col("prev.status_code") == "EXITING") | silent, F.lit(False))
    marked = near.withColumn("starts", starts.cast("long")).drop("prev")
    return unsplit(running(marked, _PLATE, {"visit_no": F.col("starts")})).drop("starts")


def visits(events: DataFrame, hot: HotKeys = HotKeys(), max_gap_seconds: int | None = None) -> DataFrame:
    """One row per visit that has a PARKED row: its ends, its slots at both, its latest status."""
    parked = F.col("status_code") == "PARKED"
    exiting = F.col("status_code") == "EXITING"
    totals = (
        numbered_events(events, hot, max_gap_seconds)
        .groupBy("license_plate", "visit_no")
        .agg(
            F.min("parked_time").alias("entry_time"),
            F.max(pack_latest(F.col("timestamp_unix"), F.col("status_rank"))).alias("latest"),
            F.max(F.when(exiting, F.col("timestamp_unix"))).alias("exit_time"),
            F.min_by("location", F.when(parked, order_key())).alias("entry_location"),
            F.max_by("location", order_key()).alias("last_location"),
        )
        .where(F.col("entry_time").isNotNull())
    )
    return totals.select(
        "license_plate",
        "visit_no",
        packed_status(F.col("latest")).alias("current_status"),
        F.col("exit_time").isNotNull().alias("closed"),
        "entry_time",
        packed_time(F.col("latest")).alias("last_update"),
        "exit_time",
        "entry_location",
        "last_location",
    )


def visit_fees(
    events: DataFrame, settings: Settings = Settings(), hot: HotKeys = HotKeys(), max_gap_seconds: int | None = None
) -> DataFrame:
    return with_fees(visits(events, hot, max_gap_seconds), settings.price_per_10min)


def park_exit_pairs(visit_rows: DataFrame) -> DataFrame:
    """The first PARKED of a visit with the EXITING that ends it: one pair per closed visit."""
    return visit_rows.where("closed").select(
        "license_plate",
        F.col("entry_time").alias("parked_unix"),
        F.col("entry_location").alias("parked_location"),
        F.col("exit_time").alias("exit_unix"),
        F.col("last_location").alias("exit_location"),
    )


def occupied_by_visits(visit_rows: DataFrame) -> DataFrame:
    """Where vehicles stand now: the latest slot of each open visit, so no slot stays taken after a move."""
    return visit_rows.where(~F.col("closed")).select(
        F.col("last_location").alias("location"), "license_plate", "current_status", "entry_time", "last_update"
    )


def visit_paths(events: DataFrame, hot: HotKeys = HotKeys()) -> DataFrame:
    """The slots of each visit in order, a row per change of slot, numbered from 1.

    Changes are counted along the vehicle; a step's number is that count less the count at the
    start of its visit. So one spread of the rows by vehicle serves visits and steps.
    """
    near = neighbour(_split_by_plate(events, hot), _PLATE, ["location", "status_code"], "prev")
    starts = F.col("prev").isNull() | (F.col("prev.status_code") == "EXITING")
    moves = starts | (F.col("prev.location") != F.col("location"))
    marked = near.withColumns({"starts": starts, "moves": moves}).drop("prev")
    counted = running(marked, _PLATE, {"exits": _exiting(), "move_no": F.col("moves").cast("long")})
    first = running(counted, _PLATE, {"first_no": F.when(F.col("starts"), F.col("move_no"))}, F.max)
    return first.where("moves").select(
        *_PLATE,
        (F.col("exits") - _exiting()).alias("visit_no"),
        (F.col("move_no") - F.col("first_no") + 1).alias("step_no"),
        "location",
        F.col("timestamp_unix").alias("arrived_unix"),
    )
