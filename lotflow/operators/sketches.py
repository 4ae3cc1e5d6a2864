"""Distinct plates and dwell times as sketches that add up: days, slots and batches unite without a second look at the events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotflow.functions.columns import div
from lotflow.operators.quality import valid_events

#: Log2 of the registers of a HyperLogLog sketch, and the relative error that three standard deviations stay within.
PLATE_REGISTERS, PLATE_ERROR = 12, 0.05
#: Size of a quantile sketch, and the error of the rank of its answers.
DWELL_SIZE, RANK_ERROR = 800, 0.01
SECONDS_PER_DAY = 86_400


def plate_sketches(events: DataFrame) -> DataFrame:
    """One row per slot and day with a sketch of its plates; events without a plate have no part."""
    rows = valid_events(events).where(F.col("license_plate").isNotNull())
    return rows.groupBy("location", div("timestamp_unix", SECONDS_PER_DAY).alias("day")).agg(
        F.hll_sketch_agg("license_plate", F.lit(PLATE_REGISTERS)).alias("plates")
    )


def distinct_plates(sketches: DataFrame, *by) -> DataFrame:
    """Estimated distinct plates of any union of sketches."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("plates")).alias("plates"))


def dwell_sketches(spells: DataFrame) -> DataFrame:
    """One row per status and day with a sketch of the seconds of spells that ended; the day is that of the start."""
    ended = spells.where(F.col("dwell_seconds").isNotNull())
    return ended.groupBy("status_code", div("timestamp_unix", SECONDS_PER_DAY).alias("day")).agg(
        F.kll_sketch_agg_bigint("dwell_seconds", F.lit(DWELL_SIZE)).alias("dwell")
    )


def dwell_quantiles(sketches: DataFrame, levels: tuple[float, ...] = (0.5, 0.95)) -> DataFrame:
    """Rows (status_code, level, seconds) from any union of sketches."""
    united = sketches.groupBy("status_code").agg(F.kll_merge_agg_bigint("dwell", F.lit(DWELL_SIZE)).alias("dwell"))
    answers = F.array(
        *[F.struct(F.lit(float(at)).alias("level"), F.kll_sketch_get_quantile_bigint("dwell", F.lit(float(at))).alias("seconds")) for at in levels]
    )
    return united.select("status_code", F.inline(answers))
