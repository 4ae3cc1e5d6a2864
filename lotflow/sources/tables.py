"""Reads the ``events`` table of the test data as a feed of sightings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotflow.functions.columns import status_rank
from lotflow.schemas import RAW_EVENTS, TIMESTAMP_PATTERN
from lotflow.session import prepare

_STATUS_OF_TYPE = "CASE event_type WHEN 'signup' THEN 'ENTERING' WHEN 'view' THEN 'PARKED' " + (
    "WHEN 'click' THEN 'MOVING' WHEN 'purchase' THEN 'EXITING' ELSE 'UNKNOWN' END"
)
_SLOT = "(user_id * 7 + CAST(get_json_object(props, '$.k') AS INT) % 3) % 60"


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(spark).read.schema(RAW_EVENTS).parquet(f"{sf_dir}/events.parquet")


def as_sightings(raw: DataFrame, *keep: str) -> DataFrame:
    """Each user is a vehicle with up to three slots; each event type is a status."""
    return raw.selectExpr("*", f"{_SLOT} AS slot", "CAST(ts AS TIMESTAMP) AS moment").selectExpr(
        "event_id",
        f"date_format(moment, '{TIMESTAMP_PATTERN}') AS timestamp",
        "unix_seconds(moment) AS timestamp_unix",
        "concat('29A-', lpad(CAST(user_id AS STRING), greatest(5, length(CAST(user_id AS STRING))), '0')) AS license_plate",
        "concat(substring('ABCDEF', CAST(slot div 10 + 1 AS INT), 1), CAST(slot % 10 + 1 AS STRING)) AS location",
        f"{_STATUS_OF_TYPE} AS status_code",
        *keep,
    )


def table_events(spark: SparkSession, sf_dir: str, until: str | None = None) -> DataFrame:
    """Typed events of the whole table, or of its part before ``until`` (cut in the scan).

    The time of the text is the source's time to the second, so it is not parsed back from it.
    """
    raw = raw_events(spark, sf_dir).withColumn("event_time", F.expr("date_trunc('second', CAST(ts AS TIMESTAMP))"))
    if until:
        raw = raw.where(F.col("ts") < F.lit(until).cast("timestamp_ntz"))
    return as_sightings(raw, "event_time").withColumn("status_rank", status_rank("status_code"))


def noisy_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole feed as JSON records, where events of type ``error`` arrive damaged in six ways."""
    kind = F.when(F.col("event_type") == "error", F.get_json_object("props", "$.k").cast("int") % 6).otherwise(-1)
    rows = as_sightings(raw_events(spark, sf_dir).withColumn("damage", kind), "damage")
    hit = lambda n: F.col("damage") == n
    fields = {
        "timestamp": F.when(hit(2), F.lit("no time")).otherwise(F.col("timestamp")),
        "timestamp_unix": F.col("timestamp_unix"),
        "license_plate": F.when(hit(4), F.lit(None)).otherwise(F.col("license_plate")),
        "location": F.when(hit(5), F.lit("")).otherwise(F.col("location")),
        "status_code": F.when(hit(3), "WHAT").when(F.col("damage") >= 0, "PARKED").otherwise(F.col("status_code")),
    }
    body = F.to_json(F.struct(*[column.alias(name) for name, column in fields.items()]))
    not_a_number = {**fields, "timestamp_unix": F.lit("abc")}
    bad_number = F.to_json(F.struct(*[column.alias(name) for name, column in not_a_number.items()]))
    value = F.when(hit(0), F.lit("garbage")).when(hit(1), bad_number).otherwise(body)
    return rows.select(value.cast("binary").alias("value"), F.col("event_id").alias("offset"))
