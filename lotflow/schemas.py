"""Declared schemas; no read in the engine infers one."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_text, _long = T.StringType(), T.LongType()

TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss"

EVENT_JSON = _struct(
    ("timestamp", _text),
    ("timestamp_unix", _long),
    ("license_plate", _text),
    ("location", _text),
    ("status_code", _text),
)

# What the engine uses of a Kafka record; also the layout of a replayed feed on files.
FEED_RECORD = _struct(("value", T.BinaryType()), ("partition", T.IntegerType()), ("offset", _long))

SNAPSHOT = _struct(
    ("location", _text),
    ("license_plate", _text),
    ("current_status", _text),
    ("entry_timestamp", _text),
    ("parked_minutes", _long),
    ("total_fee", _long),
    ("last_update", _long),
)

CHECKOUT = _struct(
    ("license_plate", _text),
    ("exit_location", _text),
    ("entry_time", _long),
    ("entry_timestamp", _text),
    ("exit_timestamp", _text),
    ("parked_minutes", _long),
    ("total_fee", _long),
)

# As the sinks write it: with the wall clock of the batch.
CHECKOUT_LOG = T.StructType([*CHECKOUT.fields, T.StructField("processed_time", T.TimestampType())])

LEDGER_ENTRY = _struct(
    ("license_plate", _text),
    ("location", _text),
    ("total_fee", _long),
    ("parked_minutes", _long),
    ("checkout_time", _text),
)
LEDGER_JSON = T.MapType(_text, LEDGER_ENTRY)

# Emitted by the keyed state of slots and of vehicles.
SLOT_ROWS = _struct(
    ("location", _text),
    ("license_plate", _text),
    ("status", _text),
    ("enter_unix", _long),
    ("last_update_unix", _long),
    ("parked_seconds", _long),
    ("fee_vnd", _long),
    ("seq", _long),
)
VISIT_ROWS = _struct(
    ("license_plate", _text),
    ("visit_no", _long),
    ("current_status", _text),
    ("closed", T.BooleanType()),
    ("entry_time", _long),
    ("last_update", _long),
    ("exit_time", _long),
    ("entry_location", _text),
    ("last_location", _text),
)

WINDOW_FEES = _struct(
    ("window_start", _long),
    ("location", _text),
    ("license_plate", _text),
    ("current_status", _text),
    ("entry_timestamp", _text),
    ("entry_time", _long),
    ("last_update", _long),
    ("parked_seconds", _long),
    ("parked_minutes", _long),
    ("fee_blocks", _long),
    ("total_fee", _long),
)

# Events set aside, with their first fault.
QUARANTINE = T.StructType([T.StructField("event_id", _long), *EVENT_JSON.fields, T.StructField("reason", _text)])

HISTORY = _struct(
    ("event_id", _text),
    ("event_time_unix", _long),
    ("license_plate", _text),
    ("location", _text),
    ("status", _text),
)

RAW_EVENTS = _struct(
    ("event_id", _long),
    ("ts", T.TimestampNTZType()),
    ("user_id", _long),
    ("event_type", _text),
    ("value", T.DoubleType()),
    ("props", _text),
)

CONFIG = _struct(
    ("price", _struct(("price_per_10min", _long), ("currency", _text), ("updated_at", _text))),
    ("parking", _struct(("total_slots", _long), ("slots_per_floor", _long), ("floors", T.ArrayType(_text)))),
    ("kafka", _struct(("bootstrap_servers", _text), ("topic", _text), ("starting_offsets", _text))),
    ("spark", _struct(("master", _text), ("checkpoint_dir", _text), ("shuffle_partitions", _long), ("watermark_duration", _text))),
    ("api", _struct(("host", _text), ("port", _long), ("refresh_interval_seconds", _long))),
    ("streaming", _struct(("processing_interval_seconds", _long), ("console_interval_seconds", _long))),
)
LEGACY_PRICE = _struct(("price_per_10min", _long))

# Events that came too late to change anything.
LATE_EVENTS = _struct(
    ("license_plate", _text),
    ("status_code", _text),
    ("timestamp_unix", _long),
    ("location", _text),
)

# Runs of offsets that came without a gap.
ISLANDS = T.StructType(
    [T.StructField("partition", T.IntegerType()), T.StructField("first_offset", _long), T.StructField("last_offset", _long)]
)

# Parts of a window, which add up to it.
WINDOW_PARTS = _struct(
    ("window_start", _long),
    ("location", _text),
    ("license_plate", _text),
    ("latest", _struct(("timestamp_unix", _long), ("status_rank", T.IntegerType()), ("status_code", _text))),
    ("entry_time", _long),
    ("entry_at", T.TimestampType()),
)

# A PARKED and an exit that follows it.
_sighting = _struct(("timestamp_unix", _long), ("status_rank", T.IntegerType()), ("event_id", _long), ("location", _text))
STAY_PAIRS = _struct(("license_plate", _text), ("parked", _sighting), ("exit", _sighting))

# Sketches of the plates of a slot and day.
PLATE_SKETCHES = _struct(("location", _text), ("day", _long), ("plates", T.BinaryType()))
