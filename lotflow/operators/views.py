"""What people ask of the fee table: active vehicles, snapshot, status, lot, floor, slot, vehicle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotflow.functions.columns import floor_of
from lotflow.functions.display import amount_text, clock_text, duration_text, status_label
from lotflow.schemas import SNAPSHOT
from lotflow.settings import Settings

_COLUMNS = SNAPSHOT.fieldNames()


def snapshot(fees: DataFrame) -> DataFrame:
    """Every (slot, vehicle) whose clock has started, EXITING rows too."""
    return fees.where(F.col("entry_time").isNotNull()).select(*_COLUMNS)


def active_vehicles(fees: DataFrame) -> DataFrame:
    """Rows of the snapshot that are not on their way out (a null status is not active)."""
    return snapshot(fees.where(F.col("current_status") != "EXITING"))


def by_slot(rows: DataFrame) -> DataFrame:
    """Order by slot name as text, then plate, so that a crowded slot can span sort ranges."""
    return rows.orderBy("location", "license_plate")


def status_view(snapshot_rows: DataFrame, ledger: DataFrame) -> DataFrame:
    """Unpaid rows of the snapshot, with empty text as null and missing numbers as zero.

    Both sides hold a (plate, slot) pair at most once, so the anti join has no heavy key; its
    strategy is left to the optimizer, as the ledger grows without bound.
    """
    paid = ledger.select("license_plate", "location")
    text = lambda name: F.nullif(F.col(name), F.lit("")).alias(name)
    number = lambda name: F.coalesce(F.col(name), F.lit(0).cast("long")).alias(name)
    return (
        snapshot_rows.where(F.col("current_status").isNotNull())
        .join(paid, ["license_plate", "location"], "left_anti")
        .select(
            text("location"),
            text("license_plate"),
            text("current_status"),
            text("entry_timestamp"),
            number("parked_minutes"),
            number("total_fee"),
            "last_update",
        )
    )


def summary_stats(view: DataFrame, settings: Settings = Settings(), approximate: bool = False) -> DataFrame:
    """One row for the lot.

    ``available`` takes every row for an occupied slot and can be negative; ``free_slots``
    counts distinct slots. ``approximate`` swaps the exact distinct counts for sketches.
    """
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    totals = view.agg(
        F.count(F.lit(1)).alias("occupied_locations"),
        distinct(F.col("location")).alias("occupied_slots"),
        distinct(F.col("license_plate")).alias("unique_vehicles"),
    )
    total = F.lit(settings.total_slots).cast("long")
    return totals.select(
        total.alias("total"),
        "occupied_locations",
        "occupied_slots",
        "unique_vehicles",
        (total - F.col("occupied_locations")).alias("available"),
        F.greatest(total - F.col("occupied_slots"), F.lit(0).cast("long")).alias("free_slots"),
    )


def on_floor(view: DataFrame, floor: str) -> DataFrame:
    """Rows whose slot name starts with ``floor``, in any letter case of the argument."""
    return view.where(F.col("location").startswith(floor.upper()))


def floor_summary(view: DataFrame, slots: DataFrame) -> DataFrame:
    """One row per floor of the lot, empty floors included.

    Members of a floor are rows of ``on_floor``: a floor can hold any number of them, so they
    are not gathered into one value.
    """
    used = (
        view.where(F.col("location").isNotNull())
        .groupBy(floor_of("location").alias("floor"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_distinct("location").alias("slots_used"),
            F.count_distinct("license_plate").alias("plates"),
        )
    )
    floors = slots.groupBy("floor").agg(F.count(F.lit(1)).alias("total_slots"))
    zero = F.lit(0).cast("long")
    rows, plates = F.coalesce("rows", zero), F.coalesce("plates", zero)
    return floors.join(used, "floor", "left").select(
        "floor",
        "total_slots",
        rows.alias("occupied_locations"),
        F.coalesce("slots_used", zero).alias("occupied_slots"),
        plates.alias("unique_vehicles"),
        (F.col("total_slots") - rows).alias("available"),
        F.greatest(F.col("total_slots") - F.coalesce("slots_used", zero), zero).alias("free_slots"),
        F.round(rows * 100.0 / F.col("total_slots"), 2).alias("percent_occupied"),
    )


def location_detail(view: DataFrame, slots: DataFrame, location: str | None = None) -> DataFrame:
    """Vehicles counted per slot, "available" where there is none; vehicles are rows of ``at_location``."""
    counts = view.groupBy("location").agg(F.count(F.lit(1)).alias("n"))
    if location is not None:
        slots = slots.where(F.col("location") == location.upper())
    n = F.coalesce("n", F.lit(0).cast("long"))
    return slots.join(counts, "location", "left").select(
        "location",
        "floor",
        F.when(n > 0, "occupied").otherwise("available").alias("status"),
        n.alias("vehicles"),
    )


def at_location(view: DataFrame, location: str) -> DataFrame:
    return view.where(F.col("location") == location.upper())


def of_vehicle(view: DataFrame, plate: str) -> DataFrame:
    return view.where(F.upper("license_plate") == plate.upper())


def vehicle_totals(view: DataFrame) -> DataFrame:
    """Slots and fees per vehicle, plates in upper case; rows without a plate belong to none."""
    return (
        view.where(F.col("license_plate").isNotNull())
        .groupBy(F.upper("license_plate").alias("license_plate"))
        .agg(
            F.count(F.lit(1)).alias("location_count"),
            F.sum("total_fee").alias("total_fee_all_locations"),
            F.max("last_update").alias("last_update"),
        )
    )


def vehicle_locations(view: DataFrame) -> DataFrame:
    """The slots of each vehicle, a row per slot, with the text shown beside the total."""
    detail = F.concat(
        F.col("location"), F.lit(" ("), duration_text(F.col("parked_minutes")),
        F.lit(", "), amount_text(F.col("total_fee")), F.lit(")"),
    )
    return view.where(F.col("license_plate").isNotNull()).select(
        F.upper("license_plate").alias("license_plate"),
        "location",
        "current_status",
        "entry_timestamp",
        "parked_minutes",
        "total_fee",
        detail.alias("detail"),
    )


def display_columns(view: DataFrame) -> DataFrame:
    """Labels and texts for a table on screen."""
    return view.select(
        "location",
        "license_plate",
        status_label(F.col("current_status")).alias("status_text"),
        F.coalesce("entry_timestamp", F.lit("-")).alias("entry_text"),
        duration_text(F.col("parked_minutes")).alias("duration_text"),
        amount_text(F.col("total_fee")).alias("fee_text"),
        clock_text(F.col("last_update")).alias("updated_text"),
        (F.col("current_status") == "EXITING").alias("can_check_out"),
    )
