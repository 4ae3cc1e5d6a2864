"""Slots as sets: used, free, VIP, and claimed by more than one vehicle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotflow.operators.quality import known_events
from lotflow.plans.ordered import order_key


def used_slots(state: DataFrame) -> DataFrame:
    return state.select("location").distinct()


def free_slots(slots: DataFrame, state: DataFrame) -> DataFrame:
    """Slots of the lot that no state names."""
    return slots.join(used_slots(state), "location", "left_anti").select("location", "floor", "is_vip")


def vip_slots(slots: DataFrame, listed: DataFrame) -> DataFrame:
    """Slots that are VIP by rule, with those on a list, also where the lot does not know them."""
    return slots.where("is_vip").select("location").union(listed.select("location")).distinct()


def slot_sightings(slots: DataFrame, events: DataFrame) -> DataFrame:
    """The dimension with the number of usable sightings at each slot."""
    counts = events.groupBy("location").agg(F.count(F.lit(1)).alias("n"))
    return slots.join(counts, "location", "left").select(
        "location", "floor", "slot_no", "is_vip", F.coalesce("n", F.lit(0).cast("long")).alias("sightings")
    )


def latest_places(events: DataFrame) -> DataFrame:
    """Where each vehicle was last seen, unless that was on its way out."""
    rows = known_events(events).where(F.col("license_plate").isNotNull())
    latest = rows.groupBy("license_plate").agg(
        F.max_by(F.struct("location", "status_code", "timestamp_unix"), order_key()).alias("seen")
    )
    return latest.select("license_plate", "seen.*").where(F.col("status_code") != "EXITING")


def slot_conflicts(places: DataFrame) -> DataFrame:
    """Slots that are the latest place of more than one vehicle; a vehicle has one place."""
    claims = places.groupBy("location").agg(
        F.count(F.lit(1)).alias("vehicles"),
        F.min("timestamp_unix").alias("first_seen"),
        F.max("timestamp_unix").alias("last_seen"),
    )
    return claims.where(F.col("vehicles") > 1)
