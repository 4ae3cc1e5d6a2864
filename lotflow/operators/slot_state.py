"""State of each slot from its own sightings: who stands there, since when, and the fee so far.

The rules, per slot in event order. EXITING releases the slot, and the next event starts from
nothing. A PARKED that does not follow a PARKED of the same plate restarts the clock. ENTERING
and a restart set the plate. MOVING and EXITING take the time since the clock started and the
fee for it; the fee then stays until the next one or the release.

Each field is thus "the last value set since the last release", which a running
``last(ignorenulls)`` over one-field structs gives: a set value is a struct, a release is a
struct holding null, and any other row is null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotflow.functions.columns import is_vip
from lotflow.functions.fees import fee_ceil_minutes, slot_price
from lotflow.operators.quality import known_events
from lotflow.plans.ordered import (
    HotKeys,
    carried,
    earlier_pieces,
    neighbour,
    order_key,
    piece,
    piece_window,
    split_hot,
    unsplit,
)
from lotflow.settings import Settings
from lotflow.sources.slots import slot_dimension

_SLOT = ["location"]
_STATE = ("license_plate", "status", "enter_unix", "last_update_unix", "parked_seconds", "fee_vnd")


def _set(value: Column) -> Column:
    return F.struct(value.alias("v"))


def _last(value: Column) -> Column:
    return F.last(value, ignorenulls=True)


def _pieces(split: DataFrame, settings: Settings) -> DataFrame:
    """Each field as far as the rows of the same piece tell; null where an earlier piece decides."""
    time = F.col("timestamp_unix")
    status = F.col("status_code")
    fresh = F.coalesce(F.col("prev.status_code") == "EXITING", F.lit(False))
    follows = (F.col("prev.status_code") == "PARKED") & F.col("prev.license_plate").eqNullSafe(F.col("license_plate"))
    restart = (status == "PARKED") & ~F.coalesce(follows, F.lit(False))
    charges = status.isin("MOVING", "EXITING")
    so_far = piece_window(_SLOT).rowsBetween(Window.unboundedPreceding, 0)

    none = F.lit(None)
    clock = F.when(restart, _set(time)).when(fresh, _set(none.cast("long")))
    plate = F.when(restart | (status == "ENTERING"), _set(F.col("license_plate"))).when(fresh, _set(none.cast("string")))
    rows = split.withColumns(
        {
            "_clock": _last(clock).over(so_far),
            "_plate": _last(plate).over(so_far),
            "_mark": _last(F.when(restart | charges, time)).over(so_far),
            "_fresh": fresh,
            "_charges": charges,
        }
    )
    # a charge on a clock this piece knows gives a fee; on one it does not know, only its time
    known = F.col("_charges") & F.col("_clock.v").isNotNull()
    fee = fee_ceil_minutes(time - F.col("_clock.v"), slot_price(F.col("location"), settings))
    fee_set = F.when(known, _set(fee)).when(F.col("_fresh"), _set(F.lit(0).cast("long")))
    open_charge = F.when(F.col("_charges") & F.col("_clock").isNull(), time)
    return rows.withColumns({"_fee": _last(fee_set).over(so_far), "_open": _last(open_charge).over(so_far)})


def _carry(hot_rows: DataFrame, settings: Settings) -> DataFrame:
    """Per piece of a hot slot: the fields as they stand when the piece begins."""
    fields = ("_clock", "_plate", "_mark", "_fee", "_open")
    ends = hot_rows.groupBy(*piece(_SLOT)).agg(F.max_by(F.struct(*fields), order_key()).alias("end"))
    before = earlier_pieces(_SLOT)
    ends = ends.select(
        *piece(_SLOT),
        "end",
        _last(F.col("end._clock")).over(before).alias("_clock0"),
        _last(F.col("end._plate")).over(before).alias("_plate0"),
        _last(F.col("end._mark")).over(before).alias("_mark0"),
    )
    late = F.when(
        F.col("end._open").isNotNull() & F.col("_clock0.v").isNotNull(),
        _set(fee_ceil_minutes(F.col("end._open") - F.col("_clock0.v"), slot_price(F.col("location"), settings))),
    )
    ends = ends.withColumn("_fee_end", F.coalesce("end._fee", late))
    return ends.select(
        *piece(_SLOT), "_clock0", "_plate0", "_mark0", _last(F.col("_fee_end")).over(before).alias("_fee0")
    )


def slot_fsm_events(events: DataFrame, settings: Settings = Settings(), hot: HotKeys = HotKeys()) -> DataFrame:
    """The state of the slot after each event."""
    rows = known_events(events).select(
        "location", "license_plate", "status_code", "timestamp_unix", "status_rank", "event_id"
    )
    split = neighbour(split_hot(rows, _SLOT, hot), _SLOT, ["status_code", "license_plate"], "prev")
    pieces = _pieces(split, settings)
    joined = carried(pieces, _carry(pieces.where("_hot"), settings), _SLOT)

    enter = F.coalesce("_clock", "_clock0")["v"]
    price = slot_price(F.col("location"), settings)
    open_fee = F.when(
        F.col("_open").isNotNull() & F.col("_clock0.v").isNotNull(),
        _set(fee_ceil_minutes(F.col("_open") - F.col("_clock0.v"), price)),
    )
    zero = F.lit(0).cast("long")
    return unsplit(
        joined.select(
            "event_id",
            "location",
            F.coalesce("_plate", "_plate0")["v"].alias("license_plate"),
            F.col("status_code").alias("status"),
            enter.alias("enter_unix"),
            F.col("timestamp_unix").alias("last_update_unix"),
            F.when(enter.isNotNull(), F.coalesce("_mark", "_mark0") - enter).otherwise(zero).alias("parked_seconds"),
            F.coalesce(F.coalesce("_fee", open_fee, "_fee0")["v"], zero).alias("fee_vnd"),
            "timestamp_unix",
            "status_rank",
        )
    )


def since_release(events: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Events that can bear on the current state: those from the second of the last EXITING on.

    A release forgets what came before, so most of the history stays out of the shuffle. The
    broadcast side has at most one row per slot of the configured lot; slots outside of it keep
    all their events.
    """
    lot = F.broadcast(slot_dimension(events.sparkSession, settings).select("location"))
    rows = known_events(events)
    released = (
        rows.where(F.col("status_code") == "EXITING")
        .join(lot, "location", "left_semi")
        .groupBy("location")
        .agg(F.max("timestamp_unix").alias("_released"))
    )
    kept = rows.join(F.broadcast(released), "location", "left")
    return kept.where(F.col("timestamp_unix") >= F.coalesce("_released", F.lit(0).cast("long"))).drop("_released")


def slot_fsm_current(events: DataFrame, settings: Settings = Settings(), hot: HotKeys = HotKeys()) -> DataFrame:
    """The state of each slot after its last event; released slots have none."""
    latest = (
        slot_fsm_events(since_release(events, settings), settings, hot)
        .groupBy("location")
        .agg(F.max_by(F.struct(*_STATE), order_key()).alias("state"))
    )
    return latest.select("location", "state.*").where(F.col("status") != "EXITING")


def live_state(current: DataFrame, as_of: Column | int, settings: Settings = Settings()) -> DataFrame:
    """State as shown at a moment: the clock of PARKED slots runs on until ``as_of``."""
    now = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("long")
    running = (F.col("status") == "PARKED") & F.col("enter_unix").isNotNull()
    seconds = now - F.col("enter_unix")
    location = F.col("location")
    return current.select(
        "location",
        "license_plate",
        "status",
        "enter_unix",
        "last_update_unix",
        F.when(running, seconds).otherwise(F.col("parked_seconds")).alias("parked_seconds"),
        F.when(running, fee_ceil_minutes(seconds, slot_price(location, settings)))
        .otherwise(F.col("fee_vnd"))
        .alias("fee_vnd"),
        is_vip(location, settings.vip_locations, settings.vip_prefixes).alias("is_vip"),
    )
