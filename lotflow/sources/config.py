"""Configuration in three layers: defaults, a JSON file, and an older file with only the price."""

from __future__ import annotations

from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotflow.schemas import CONFIG, LEGACY_PRICE
from lotflow.settings import Settings

# field of the effective row -> path in the JSON document
_FIELDS = {
    "price_per_10min": "price.price_per_10min",
    "currency": "price.currency",
    "updated_at": "price.updated_at",
    "total_slots": "parking.total_slots",
    "slots_per_floor": "parking.slots_per_floor",
    "floors": "parking.floors",
    "bootstrap_servers": "kafka.bootstrap_servers",
    "topic": "kafka.topic",
    "starting_offsets": "kafka.starting_offsets",
    "shuffle_partitions": "spark.shuffle_partitions",
    "checkpoint_dir": "spark.checkpoint_dir",
    "watermark_duration": "spark.watermark_duration",
    "processing_interval_seconds": "streaming.processing_interval_seconds",
    "console_interval_seconds": "streaming.console_interval_seconds",
}


def json_text(spark: SparkSession, path: str) -> DataFrame:
    """One row (value) with the whole document, or no row where there is no such file; other faults are raised."""
    try:
        if path:
            return spark.read.text(path, wholetext=True)
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
    return spark.createDataFrame([], "value string")


def config_layer(documents: DataFrame, priority: int) -> DataFrame:
    """Documents of the full form; a document that does not parse sets nothing."""
    parsed = documents.select(F.from_json("value", CONFIG).alias("c"))
    return parsed.select(
        F.lit(priority).alias("priority"),
        *[F.col(f"c.{path}").alias(name) for name, path in _FIELDS.items()],
    )


def legacy_layer(documents: DataFrame, priority: int) -> DataFrame:
    """Documents of the older form, which set the price alone."""
    parsed = documents.select(F.from_json("value", LEGACY_PRICE).alias("c"))
    return parsed.select(F.lit(priority).alias("priority"), F.col("c.price_per_10min").alias("price_per_10min"))


def effective_config(*layers: DataFrame) -> DataFrame:
    """One row: each field from the highest layer that sets it."""
    stacked = layers[0]
    for layer in layers[1:]:
        stacked = stacked.unionByName(layer, allowMissingColumns=True)
    return stacked.agg(
        *[F.max_by(name, F.when(F.col(name).isNotNull(), F.col("priority"))).alias(name) for name in _FIELDS]
    )


def load_settings(spark: SparkSession, config_path: str, legacy_path: str, base: Settings = Settings()) -> Settings:
    """``base`` with the file laid over it and the older price file over both."""
    layers = (config_layer(json_text(spark, config_path), 1), legacy_layer(json_text(spark, legacy_path), 2))
    return settings_from(effective_config(*layers), base)


def settings_from(effective: DataFrame, base: Settings = Settings()) -> Settings:
    """Settings from the one effective row."""
    row = effective.first().asDict()
    names = {
        "price_per_10min": "price_per_10min",
        "currency": "currency",
        "total_slots": "total_slots",
        "slots_per_floor": "slots_per_floor",
        "bootstrap_servers": "kafka_bootstrap",
        "topic": "kafka_topic",
        "starting_offsets": "starting_offsets",
        "watermark_duration": "watermark",
        "shuffle_partitions": "state_partitions",
        "checkpoint_dir": "checkpoint_dir",
        "processing_interval_seconds": "processing_interval_seconds",
        "console_interval_seconds": "console_interval_seconds",
    }
    changes = {field: row[name] for name, field in names.items() if row[name] is not None}
    if row["floors"]:
        changes["floors"] = tuple(row["floors"])
    return replace(base, **changes)
