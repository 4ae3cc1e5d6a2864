"""Windows as parts that add up, and late rows as a table of their own.

Each micro-batch writes one row per window it meets, from an aggregate that Spark combines before the shuffle, and a read
merges the parts of a window. So no state is held, and what the clock of the earlier batches has passed can be parted
off instead of dropped: kept and late rows together are all usable rows with a time. A batch that runs again sees the
same clock and overwrites its own folders.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotflow.functions.columns import time_text
from lotflow.operators.lifetime import KEYS, with_fees
from lotflow.operators.quality import valid_events
from lotflow.schemas import LATE_EVENTS, WINDOW_PARTS
from lotflow.settings import Settings
from lotflow.streaming.sinks import BatchWriter, kept
from lotflow.streaming.tables import read_all, write_batch


def window_parts(events: DataFrame, window: str) -> DataFrame:
    """Per window, slot and vehicle: the latest sighting and the first ENTERING among these events."""
    entering = F.col("status_code") == "ENTERING"
    latest = F.struct("timestamp_unix", F.col("status_rank").cast("int").alias("status_rank"), "status_code")
    parts = events.groupBy(F.window("event_time", window).alias("window"), *KEYS).agg(
        F.max(latest).alias("latest"),
        F.min(F.when(entering, F.col("timestamp_unix"))).alias("entry_time"),
        F.min(F.when(entering, F.col("event_time"))).alias("entry_at"),
    )
    return parts.select(F.unix_timestamp("window.start").alias("window_start"), *KEYS, "latest", "entry_time", "entry_at")


def merged_windows(parts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Fees per window from any number of its parts, in any order; a part that comes twice changes nothing."""
    whole = parts.groupBy("window_start", *KEYS).agg(
        F.max("latest").alias("latest"), F.min("entry_time").alias("entry_time"), F.min("entry_at").alias("entry_at")
    )
    totals = whole.select(
        "window_start",
        *KEYS,
        F.col("latest.status_code").alias("current_status"),
        "entry_time",
        time_text("entry_at").alias("entry_timestamp"),
        F.col("latest.timestamp_unix").alias("last_update"),
    )
    return with_fees(totals, settings.price_per_10min)


def _newest_before(spark: SparkSession, path: str, batch_id: int) -> int | None:
    """The newest second of all batches before this one: one row, carried on from batch to batch."""
    try:
        row = spark.read.schema("newest long").parquet(f"{path}_clock/data/batch_id={batch_id - 1}").first()
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return row[0] if row else None


def is_late(newest: int | None, settings: Settings) -> Column:
    """Whether the window of a row ended before the clock, less the delay."""
    if newest is None:
        return F.lit(False)
    passed = F.timestamp_seconds(F.lit(newest)) - F.expr(f"INTERVAL {settings.watermark}")
    return F.window("event_time", settings.window)["end"] <= passed


def window_sink(path: str, settings: Settings = Settings()) -> BatchWriter:
    """Writes the parts of each batch of typed events, its late rows (``<path>_late``) and the clock (``<path>_clock``)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        newest = _newest_before(batch.sparkSession, path, batch_id)
        timed = valid_events(batch).where(F.col("event_time").isNotNull())
        with kept(timed.withColumn("late", is_late(newest, settings))) as rows:
            write_batch(window_parts(rows.where("NOT late"), settings.window), batch_id, path)
            write_batch(rows.where("late").select(*LATE_EVENTS.fieldNames()), batch_id, f"{path}_late")
            reached = F.greatest(F.max(F.unix_timestamp("event_time")), F.lit(newest).cast("long"))
            write_batch(rows.agg(reached.alias("newest")), batch_id, f"{path}_clock")

    return write


def read_windows(spark: SparkSession, path: str, settings: Settings = Settings()) -> DataFrame:
    return merged_windows(read_all(spark, path, WINDOW_PARTS), settings)


def read_late(spark: SparkSession, path: str) -> DataFrame:
    return read_all(spark, f"{path}_late", LATE_EVENTS).drop("batch_id")
