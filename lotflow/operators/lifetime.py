"""Running totals per (slot, vehicle) that never end, and their 30-second form.

A vehicle that comes back to a slot is billed from its first stay on; ``visits`` has the form
that ends at EXITING.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotflow.functions.columns import (
    pack_latest,
    packed_status,
    packed_time,
    status_rank,
    time_text,
)
from lotflow.functions.fees import started_blocks, whole_minutes
from lotflow.operators.quality import billable_events, valid_events
from lotflow.settings import Settings

KEYS = ("location", "license_plate")


def lifetime(events: DataFrame) -> DataFrame:
    """Latest status, first PARKED, last sighting and last EXITING per (slot, vehicle).

    All buffers are fixed-width (times and a packed status), so the aggregate hashes on the map
    side and a busy key leaves each input partition as one row.
    """
    is_status = lambda name: F.col("status_code") == name
    totals = (
        billable_events(events)
        .groupBy(*KEYS)
        .agg(
            F.max(pack_latest(F.col("timestamp_unix"), F.col("status_rank"))).alias("latest"),
            F.min("parked_time").alias("entry_time"),
            F.min(F.when(is_status("PARKED"), F.col("event_time"))).alias("entry_at"),
            F.max(F.when(is_status("EXITING"), F.col("event_time"))).alias("exit_at"),
        )
    )
    return totals.select(
        *KEYS,
        packed_status(F.col("latest")).alias("current_status"),
        "entry_time",
        time_text("entry_at").alias("entry_timestamp"),
        packed_time(F.col("latest")).alias("last_update"),
        time_text("exit_at").alias("exit_timestamp"),
    )


def lifetime_entering(events: DataFrame, window: str | None = None) -> DataFrame:
    """The older form: the clock starts at ENTERING and every status counts, known or not.

    With ``window`` the key also holds the tumbling window of the event time; a window holds an event
    or two, so one step with one shuffle does it all. Without it the status is first a grouping key on
    batch data, which keeps the large step on the hash path; on a stream aggregates do not chain.
    """
    rows = valid_events(events)
    keys: list[Column] = [F.col(name) for name in KEYS]
    if window:
        rows = rows.where(F.col("event_time").isNotNull())
        keys = [F.window("event_time", window).alias("window"), *keys]
    entering = F.col("status_code") == "ENTERING"
    if window or rows.isStreaming:
        totals = rows.groupBy(*keys).agg(
            F.max_by("status_code", F.struct("timestamp_unix", "status_rank", "status_code")).alias("current_status"),
            F.min(F.when(entering, F.col("timestamp_unix"))).alias("entry_time"),
            F.min(F.when(entering, F.col("event_time"))).alias("entry_at"),
            F.max("timestamp_unix").alias("last_update"),
        )
    else:
        by_status = rows.groupBy(*keys, "status_code").agg(
            F.min("timestamp_unix").alias("first_unix"),
            F.max("timestamp_unix").alias("last_unix"),
            F.min("event_time").alias("first_at"),
        )
        totals = by_status.groupBy(*KEYS).agg(
            F.max_by("status_code", F.struct("last_unix", status_rank("status_code"), "status_code")).alias("current_status"),
            F.min(F.when(entering, F.col("first_unix"))).alias("entry_time"),
            F.min(F.when(entering, F.col("first_at"))).alias("entry_at"),
            F.max("last_unix").alias("last_update"),
        )
    return totals.select(
        *([F.unix_timestamp("window.start").alias("window_start")] if window else []),
        *KEYS,
        "current_status",
        "entry_time",
        time_text("entry_at").alias("entry_timestamp"),
        "last_update",
    )


def with_fees(totals: DataFrame, price: Column | int) -> DataFrame:
    """Seconds, whole minutes, started blocks and fee; nothing where the clock never started."""
    price = price if isinstance(price, Column) else F.lit(price).cast("long")
    seconds = F.when(F.col("entry_time").isNotNull(), F.col("last_update") - F.col("entry_time")).otherwise(F.lit(0).cast("long"))
    minutes = whole_minutes(seconds)
    blocks = started_blocks(minutes)
    return totals.select(
        "*",
        seconds.alias("parked_seconds"),
        minutes.alias("parked_minutes"),
        blocks.alias("fee_blocks"),
        (blocks * price).alias("total_fee"),
    )


def lifetime_fees(events: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return with_fees(lifetime(events), settings.price_per_10min)


def lifetime_fees_entering(events: DataFrame, settings: Settings = Settings()) -> DataFrame:
    fees = with_fees(lifetime_entering(events), settings.price_per_10min)
    return fees.where(F.col("current_status").isNotNull())


def window_fees(events: DataFrame, settings: Settings = Settings()) -> DataFrame:
    fees = with_fees(lifetime_entering(events, settings.window), settings.price_per_10min)
    return fees.where(F.col("current_status").isNotNull())
