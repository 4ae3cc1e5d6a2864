"""Prices by slot class, and prices that change over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotflow.functions.columns import div, is_vip
from lotflow.functions.fees import (
    fee_ceil_minutes,
    fee_floor_minutes,
    slot_price,
    started_blocks,
    started_minutes,
    whole_minutes,
)
from lotflow.schemas import CONFIG
from lotflow.settings import Settings

# Pieces in which seconds are put in order: a day, then a thousand days.
_STEPS = (86_400, 1_000)


def vip_tier_fees(fees: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Fees by the tariff of the slot, in started minutes."""
    location = F.col("location")
    price = slot_price(location, settings)
    return fees.where(F.col("entry_time").isNotNull()).select(
        "location",
        "license_plate",
        is_vip(location, settings.vip_locations, settings.vip_prefixes).alias("is_vip"),
        price.alias("price_per_block"),
        "parked_seconds",
        fee_ceil_minutes(F.col("parked_seconds"), price).alias("fee_vnd"),
    )


def price_asof(rows: DataFrame, versions: DataFrame, time: str, name: str = "price_per_block") -> DataFrame:
    """Adds the price in force at ``time``: of the version with the latest ``valid_from`` not after it.

    Of versions of one second the greatest price holds. A version without ``valid_from`` never holds;
    one whose price is null sets no price, so rows under it get null, as do rows before the first
    version and rows without a time.

    Each second that occurs is priced once and joined back, so the sorted part is as long as the
    seconds, not the rows, whatever the length of the list.
    """
    seconds = rows.where(F.col(time).isNotNull()).select(
        F.col(time).cast("long").alias("at"), F.lit(None).cast("long").alias("price"), F.lit(False).alias("changes")
    )
    listed = versions.where(F.col("valid_from").isNotNull()).select(
        F.col("valid_from").cast("long").alias("at"), F.col("price").cast("long").alias("price"), F.lit(True).alias("changes")
    )
    marks = (
        seconds.unionByName(listed)
        .groupBy("at")
        .agg(F.max("price").alias("price"), F.max("changes").alias("changes"))
        .select("at", F.when(F.col("changes"), F.struct("price")).alias("version"))
    )
    priced = _with_earlier(marks, _STEPS).select(
        F.col("at").alias("_priced_at"), F.coalesce("version", "earlier")["price"].alias(name)
    )
    return rows.join(priced, rows[time] == priced["_priced_at"], "left").drop("_priced_at")


def _with_earlier(marks: DataFrame, steps: tuple[int, ...]) -> DataFrame:
    """Adds ``earlier``, the last version before each mark (at, version); ``at`` is unique.

    Marks are ordered within pieces of ``steps[0]``; what a piece opens with comes from the last
    versions of the pieces, found the same way. The last level is one order, of years at most.
    """
    before = Window.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    if not steps:
        return marks.withColumn("earlier", F.last("version", ignorenulls=True).over(before))
    pieces = marks.withColumn("piece", div("at", steps[0]))
    in_piece = Window.partitionBy("piece").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    closing = pieces.groupBy("piece").agg(F.max_by("version", F.when(F.col("version").isNotNull(), F.col("at"))).alias("version"))
    opening = _with_earlier(closing.withColumnRenamed("piece", "at"), steps[1:]).select(
        F.col("at").alias("piece"), F.col("earlier").alias("opening")
    )
    near = pieces.withColumn("near", F.last("version", ignorenulls=True).over(in_piece))
    return near.join(opening, "piece").select("at", "version", F.coalesce("near", "opening").alias("earlier"))


def price_history(documents: DataFrame) -> DataFrame:
    """Rows (price, valid_from, valid_until) from configuration documents (value), by the time each was updated at.

    Documents that leave the price as it was open no interval; the last interval has no end. Of documents of one second
    the greatest price holds. A document that does not parse, or lacks the price or its time, has no part.
    """
    parsed = documents.select(F.from_json("value", CONFIG)["price"].alias("set"))
    dated = parsed.select(
        F.unix_timestamp(F.try_to_timestamp("set.updated_at")).alias("at"), F.col("set.price_per_10min").alias("price")
    )
    marks = dated.where(F.col("at").isNotNull()).groupBy("at").agg(F.max("price").alias("price"))
    versions = marks.where(F.col("price").isNotNull()).select("at", F.struct("price").alias("version"))
    before = F.col("earlier.price")
    changes = _with_earlier(versions, _STEPS).where(before.isNull() | (before != F.col("version.price")))
    # against the clock, the version before a change is the one after it
    backwards = changes.select((-F.col("at")).alias("at"), F.struct("at", F.col("version.price").alias("price")).alias("version"))
    return _with_earlier(backwards, _STEPS).select(
        "version.price", F.col("version.at").alias("valid_from"), F.col("earlier.at").alias("valid_until")
    )


def config_price_fees(fees: DataFrame, documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Fees at the configured price in force when the vehicle was last seen; before the first document the set price."""
    priced = price_asof(fees.where(F.col("entry_time").isNotNull()), price_history(documents), "last_update")
    price = F.coalesce("price_per_block", F.lit(settings.price_per_10min).cast("long"))
    return priced.select(
        "location", "license_plate", "last_update", "fee_blocks", price.alias("price_per_block"), (F.col("fee_blocks") * price).alias("total_fee")
    )


def price_asof_fees(fees: DataFrame, versions: DataFrame) -> DataFrame:
    """Fees at the price in force when the vehicle was last seen."""
    priced = price_asof(fees.where(F.col("entry_time").isNotNull()), versions, "last_update")
    return priced.select(
        "location",
        "license_plate",
        "last_update",
        "fee_blocks",
        "price_per_block",
        (F.col("fee_blocks") * F.col("price_per_block")).alias("total_fee"),
    )


def fee_table(fees: DataFrame, price: int) -> DataFrame:
    """Both fee rules side by side for every stay length that occurs."""
    seconds = F.col("parked_seconds")
    return fees.select("parked_seconds").distinct().select(
        "parked_seconds",
        started_blocks(whole_minutes(seconds)).alias("blocks_floor"),
        fee_floor_minutes(seconds, price).alias("fee_floor"),
        started_blocks(started_minutes(seconds)).alias("blocks_ceil"),
        fee_ceil_minutes(seconds, price).alias("fee_ceil"),
    )
