"""Which events the engine takes, which it sets aside, and why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotflow.functions.columns import BILLABLE, STATUSES

# Fixed value: the last second of year 9999; later times are clock faults.
LAST_UNIX = 253402300799


def _blank(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")) == ""


def is_usable() -> Column:
    """A time in range, a slot and a status; without them an event can be booked nowhere."""
    time = F.col("timestamp_unix")
    in_range = F.coalesce((time > 0) & (time <= LAST_UNIX), F.lit(False))
    return in_range & ~_blank("location") & ~_blank("status_code")


def valid_events(events: DataFrame) -> DataFrame:
    return events.where(is_usable())


def known_events(events: DataFrame) -> DataFrame:
    """Usable events with one of the four statuses."""
    return events.where(F.col("status_code").isin(*STATUSES)).where(is_usable())


def billable_events(events: DataFrame) -> DataFrame:
    """Events that count for the fee, with the time marks of PARKED rows (null on others)."""
    parked = F.col("status_code") == "PARKED"
    return (
        events.where(F.col("status_code").isin(*BILLABLE))
        .where(is_usable())
        .select(
            "*",
            F.when(parked, F.col("timestamp_unix")).alias("parked_time"),
            F.when(parked, F.col("timestamp")).alias("parked_timestamp"),
        )
    )


def malformed_events(events: DataFrame) -> DataFrame:
    """Every event with a fault, its first fault, and whether the engine sets it aside."""
    time = F.col("timestamp_unix")
    nothing = F.coalesce("timestamp", time.cast("string"), "license_plate", "location", "status_code").isNull()
    reason = (
        F.when(nothing, "not_json")
        .when(time.isNull(), "no_unix_time")
        .when((time <= 0) | (time > LAST_UNIX), "bad_unix_time")
        .when(_blank("location"), "no_location")
        .when(_blank("status_code"), "no_status")
        .when(~F.col("status_code").isin(*STATUSES), "unknown_status")
        .when(F.col("event_time").isNull(), "bad_timestamp")
        .when(_blank("license_plate"), "no_plate")
    )
    return (
        events.select(
            "event_id",
            *[name for name in events.columns if name in ("timestamp", "timestamp_unix", "license_plate", "location", "status_code")],
            reason.alias("reason"),
            (~is_usable()).alias("set_aside"),
        )
        .where(F.col("reason").isNotNull())
    )


def clock_check(events: DataFrame) -> DataFrame:
    """Per slot: events whose text time and unix time differ, and the largest difference."""
    skew = F.abs(F.unix_timestamp("event_time") - F.col("timestamp_unix"))
    return (
        valid_events(events)
        .where(F.col("event_time").isNotNull())
        .groupBy("location")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.count(F.when(skew > 0, 1)).alias("differing"),
            F.max(skew).alias("max_skew_seconds"),
        )
    )
