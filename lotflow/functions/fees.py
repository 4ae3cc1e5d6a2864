"""Fees in started blocks of ten minutes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotflow.functions.columns import div, is_vip
from lotflow.settings import Settings

# Fixed values of both tariffs.
SECONDS_PER_MINUTE = 60
MINUTES_PER_BLOCK = 10


def whole_minutes(seconds: Column) -> Column:
    return div(seconds, SECONDS_PER_MINUTE)


def started_minutes(seconds: Column) -> Column:
    return div(seconds + (SECONDS_PER_MINUTE - 1), SECONDS_PER_MINUTE)


def started_blocks(minutes: Column) -> Column:
    return div(minutes + (MINUTES_PER_BLOCK - 1), MINUTES_PER_BLOCK)


def fee_floor_minutes(seconds: Column, price: Column | int) -> Column:
    """Whole minutes, then started blocks: the first 59 seconds are free."""
    return started_blocks(whole_minutes(seconds)) * _long(price)


def fee_ceil_minutes(seconds: Column, price: Column | int) -> Column:
    """Started minutes, then started blocks: the first second costs a block."""
    return started_blocks(started_minutes(seconds)) * _long(price)


def slot_price(location: Column, settings: Settings) -> Column:
    """Price of a block at a slot: VIP slots have their own."""
    vip = is_vip(location, settings.vip_locations, settings.vip_prefixes)
    return F.when(vip, _long(settings.vip_price_per_10min)).otherwise(_long(settings.price_per_10min))


def _long(price: Column | int) -> Column:
    return price if isinstance(price, Column) else F.lit(price).cast("long")
