"""How vehicles go from status to status: changes, their audit, and time spent in each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotflow.functions.columns import EVENT_ORDER, div
from lotflow.operators.quality import known_events
from lotflow.plans.ordered import HotKeys, neighbour, split_hot

_KEYS = ["license_plate", "location"]

# The steps a stay may take, and the usual seconds in a status.
ALLOWED_STEPS = (("ENTERING", "PARKED"), ("PARKED", "MOVING"), ("MOVING", "EXITING"), ("EXITING", "ENTERING"))
USUAL_SECONDS = {"PARKED": (60, 300), "MOVING": (10, 30)}


def _changes(events: DataFrame, hot: HotKeys) -> DataFrame:
    """Changes of status, still split by (vehicle, slot)."""
    rows = known_events(events).where(F.col("license_plate").isNotNull())
    rows = rows.select(*_KEYS, "status_code", *EVENT_ORDER)
    near = neighbour(split_hot(rows, _KEYS, hot), _KEYS, ["status_code"], "prev")
    changed = F.col("prev").isNull() | (F.col("prev.status_code") != F.col("status_code"))
    return near.where(changed).withColumn("prev_status", F.col("prev.status_code")).drop("prev")


def status_changes(events: DataFrame, hot: HotKeys = HotKeys()) -> DataFrame:
    """Events of a (vehicle, slot) whose status differs from the one before."""
    return _changes(events, hot).select(*_KEYS, "prev_status", "status_code", "timestamp_unix", "event_id")


def is_allowed(previous: Column, status: Column) -> Column:
    """A known step, or ENTERING as the first sighting."""
    allowed = previous.isNull() & (status == "ENTERING")
    for start, end in ALLOWED_STEPS:
        allowed = allowed | ((previous == start) & (status == end))
    return F.coalesce(allowed, F.lit(False))


def transition_audit(changes: DataFrame) -> DataFrame:
    """Changes counted by (status before, status, allowed or not)."""
    counts = changes.groupBy("prev_status", "status_code").agg(F.count(F.lit(1)).alias("changes"))
    return counts.withColumn("allowed", is_allowed(F.col("prev_status"), F.col("status_code")))


def status_spells(events: DataFrame, hot: HotKeys = HotKeys()) -> DataFrame:
    """Each change with the seconds until the next one of its (vehicle, slot); the last has none."""
    near = neighbour(_changes(events, hot), _KEYS, ["timestamp_unix"], "next", following=True)
    return near.select(
        *_KEYS,
        "status_code",
        "timestamp_unix",
        (F.col("next.timestamp_unix") - F.col("timestamp_unix")).alias("dwell_seconds"),
    )


def status_dwell(spells: DataFrame) -> DataFrame:
    """Seconds per status over ended spells, and how many lie in the usual range."""
    seconds = F.col("dwell_seconds")
    usual = F.lit(None).cast("boolean")
    for status, (low, high) in USUAL_SECONDS.items():
        usual = F.when(F.col("status_code") == status, seconds.between(low, high)).otherwise(usual)
    return (
        spells.where(seconds.isNotNull())
        .groupBy("status_code")
        .agg(
            F.count(F.lit(1)).alias("spells"),
            F.sum(seconds).alias("total_seconds"),
            F.min(seconds).alias("min_seconds"),
            F.max(seconds).alias("max_seconds"),
            F.count(F.when(usual, 1)).alias("usual_spells"),
        )
        .withColumn("mean_seconds", div("total_seconds", F.col("spells")))
    )


def dwell_percentiles(spells: DataFrame, levels: tuple[float, ...] = (0.5, 0.95), accuracy: int = 10000) -> DataFrame:
    """Approximate percentiles of the seconds per status, from sketches of bounded size."""
    ended = spells.where(F.col("dwell_seconds").isNotNull())
    return ended.groupBy("status_code").agg(
        F.percentile_approx("dwell_seconds", [float(level) for level in levels], accuracy).alias("percentiles")
    )
