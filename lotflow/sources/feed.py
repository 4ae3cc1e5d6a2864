"""The event feed: Kafka records, their JSON, and the typed event columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotflow.functions.columns import status_rank
from lotflow.schemas import EVENT_JSON, FEED_RECORD, TIMESTAMP_PATTERN
from lotflow.settings import Settings

#: Bits of an event id that hold the offset; the partition stands above them.
OFFSET_BITS = 44


def kafka_records(spark: SparkSession, settings: Settings) -> DataFrame:
    """Streaming scan of the topic: (value, partition, offset).

    Needs the Kafka connector of the Spark version on the class path. The rate limit bounds a
    micro-batch, and with it what one key can hold at a time.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", settings.kafka_bootstrap)
        .option("subscribe", settings.kafka_topic)
        .option("startingOffsets", settings.starting_offsets)
        .option("maxOffsetsPerTrigger", settings.max_offsets_per_trigger)
        .option("failOnDataLoss", "false")
    )
    return reader.load().select("value", "partition", "offset")


def file_records(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of records kept on files, in the layout of the topic."""
    reader = spark.readStream.schema(FEED_RECORD).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def record_id(records: DataFrame) -> Column:
    """Number of a record: its offset, with the partition above it, so that no two records share one."""
    offset = F.col("offset")
    if "partition" not in records.columns:
        return offset
    partition = F.coalesce(F.col("partition").cast("long"), F.lit(0))
    too_far = F.raise_error(F.concat(F.lit("offset beyond the width of an event id: "), offset.cast("string"))).cast("long")
    return F.when(offset >= 1 << OFFSET_BITS, too_far).otherwise(F.shiftleft(partition, OFFSET_BITS) + offset)


def parse_records(records: DataFrame) -> DataFrame:
    """JSON in ``value`` to event columns; text that does not parse gives nulls, never an error.

    The struct is flattened by ``inline`` and not by ``data.*``: a filter on the columns would
    else be pushed below the flattening and parse the text again for each column it names.
    """
    data = F.from_json(F.col("value").cast("string"), EVENT_JSON)
    return typed_events(records.select(record_id(records).alias("event_id"), F.inline(F.array(data))))


def typed_events(events: DataFrame) -> DataFrame:
    """Adds the parsed event time and the rank that orders events of one second."""
    return events.select(
        "event_id",
        *EVENT_JSON.fieldNames(),
        F.try_to_timestamp("timestamp", F.lit(TIMESTAMP_PATTERN)).alias("event_time"),
        status_rank("status_code").alias("status_rank"),
    )


def to_record(events: DataFrame) -> DataFrame:
    """The inverse of ``parse_records``: each event as the JSON bytes a producer sends."""
    body: Column = F.to_json(F.struct(*EVENT_JSON.fieldNames()))
    return events.select(body.cast("binary").alias("value"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"))
