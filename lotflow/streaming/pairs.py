"""PARKED and EXITING sightings of a vehicle joined stream to stream.

Two watermarked inputs meet on the plate and a range of time, so Spark forgets a sighting once the watermark is further
than the longest stay. Each PARKED keeps its nearest exit and each exit its first PARKED; both are minima, which are
taken per batch and again on reading, so that pairs of different batches add up.

A vehicle's PARKED rows meet all its exits within the longest stay. Where a plate may hold a large share of the feed,
``ordered_state.visits_in_order`` gives the same pairs with a few values of state per vehicle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotflow.functions.columns import EVENT_ORDER
from lotflow.operators.quality import billable_events
from lotflow.schemas import STAY_PAIRS
from lotflow.settings import Settings
from lotflow.sources.feed import parse_records
from lotflow.streaming.sinks import BatchWriter
from lotflow.streaming.tables import read_all, write_batch


def _sightings(records: DataFrame, status: str, name: str, settings: Settings) -> DataFrame:
    rows = billable_events(parse_records(records)).where((F.col("status_code") == status) & F.col("license_plate").isNotNull())
    clock = F.timestamp_seconds("timestamp_unix").alias(f"{name}_at")
    order = [F.col(column).cast("int").alias(column) if column == "status_rank" else F.col(column) for column in EVENT_ORDER]
    sighting = F.struct(*order, "location").alias(name)
    return rows.select(F.col("license_plate").alias(f"{name}_plate"), clock, sighting).withWatermark(f"{name}_at", settings.watermark)


def park_exit_stream(parked: DataFrame, exits: DataFrame, settings: Settings = Settings(), longest_stay: str = "1 day") -> DataFrame:
    """Rows (license_plate, parked, exit) of an exit not before a PARKED and at most ``longest_stay`` after it.

    Both arguments are record streams, of the same feed or of two.
    """
    left, right = _sightings(parked, "PARKED", "parked", settings), _sightings(exits, "EXITING", "exit", settings)
    within = F.col("exit_at").between(F.col("parked_at"), F.col("parked_at") + F.expr(f"INTERVAL {longest_stay}"))
    joined = left.join(right, (F.col("parked_plate") == F.col("exit_plate")) & within)
    return joined.select(F.col("parked_plate").alias("license_plate"), "parked", "exit")


def nearest_pairs(pairs: DataFrame) -> DataFrame:
    """Of each PARKED the nearest exit."""
    return pairs.groupBy("license_plate", "parked").agg(F.min("exit").alias("exit"))


def pair_sink(path: str) -> BatchWriter:
    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(nearest_pairs(batch), batch_id, path)

    return write


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """The first PARKED of a visit with the EXITING that ends it, as in the batch form."""
    nearest = nearest_pairs(read_all(spark, path, STAY_PAIRS))
    first = nearest.groupBy("license_plate", "exit").agg(F.min("parked").alias("parked"))
    return first.select(
        "license_plate",
        F.col("parked.timestamp_unix").alias("parked_unix"),
        F.col("parked.location").alias("parked_location"),
        F.col("exit.timestamp_unix").alias("exit_unix"),
        F.col("exit.location").alias("exit_location"),
    )
