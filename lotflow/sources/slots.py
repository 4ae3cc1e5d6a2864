"""The slot dimension: floors times slots per floor, or a configured list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotflow.functions.columns import floor_of, is_vip
from lotflow.settings import Settings


def slot_dimension(spark: SparkSession, settings: Settings = Settings()) -> DataFrame:
    """(location, floor, slot_no, is_vip): one row per slot, its size set by configuration alone."""
    one = spark.range(1)
    if settings.locations:
        slots = one.select(F.explode(F.array(*[F.lit(name) for name in settings.locations])).alias("location"))
    else:
        slots = (
            one.select(F.explode(F.array(*[F.lit(name) for name in settings.floors])).alias("floor"))
            .select("floor", F.explode(F.sequence(F.lit(1), F.lit(settings.slots_per_floor))).alias("slot_no"))
            .select(F.concat("floor", F.col("slot_no").cast("string")).alias("location"))
        )
    return slots.select(
        "location",
        floor_of("location").alias("floor"),
        F.regexp_extract("location", "([0-9]+)$", 1).cast("int").alias("slot_no"),
        is_vip(F.col("location"), settings.vip_locations, settings.vip_prefixes).alias("is_vip"),
    )
