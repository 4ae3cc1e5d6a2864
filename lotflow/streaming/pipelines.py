"""Streaming forms of the operators, from feed records to result streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotflow.operators.lifetime import lifetime, window_fees
from lotflow.operators.quality import valid_events
from lotflow.settings import Settings
from lotflow.sources.feed import parse_records

DEDUP_KEYS = ["license_plate", "location", "status_code", "timestamp_unix"]


def watermarked(records: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Typed events of a record stream, late by at most the watermark delay."""
    return parse_records(records).withWatermark("event_time", settings.watermark)


def lifetime_totals(records: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Running totals per (slot, vehicle). The key holds no time, so no watermark ends them and
    late rows still count. Prices are applied by the sink, batch by batch."""
    return lifetime(watermarked(records, settings))


def windowed_fees(records: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Fees per 30-second window; windows behind the watermark are done and late rows are dropped."""
    return window_fees(watermarked(records, settings), settings)


def deduplicated(records: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Each sighting once, where its repeats arrive within the watermark delay.

    Where the text time does not parse, the unix time stands for it, so no usable row is lost.
    """
    time = F.coalesce("event_time", F.timestamp_seconds("timestamp_unix"))
    rows = valid_events(parse_records(records)).withColumn("event_time", time)
    return rows.withWatermark("event_time", settings.watermark).dropDuplicatesWithinWatermark(DEDUP_KEYS)
