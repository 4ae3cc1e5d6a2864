"""Run settings: prices, lot layout, VIP rules, stream timing.

Three ways in: the defaults below, JSON documents (``sources.config``) and
environment variables (``from_env``).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

# Defaults every user of the engine can rely on.
PRICE_PER_10MIN = 5000
VIP_PRICE_PER_10MIN = 8000
CURRENCY = "VND"
FLOORS = ("A", "B", "C", "D", "E", "F")
SLOTS_PER_FLOOR = 10
TOTAL_SLOTS = 60
VIP_PREFIXES = ("F",)
WATERMARK = "2 minutes"
WINDOW = "30 seconds"
PROCESSING_INTERVAL_SECONDS = 5
CONSOLE_INTERVAL_SECONDS = 10
# Partitions of keyed state; a checkpoint keeps the number it began with, whatever the cluster's size.
STATE_PARTITIONS = 200
REALTIME_TABLE = "parking_realtime"


@dataclass(frozen=True)
class Settings:
    price_per_10min: int = PRICE_PER_10MIN
    vip_price_per_10min: int = VIP_PRICE_PER_10MIN
    currency: str = CURRENCY
    floors: tuple[str, ...] = FLOORS
    slots_per_floor: int = SLOTS_PER_FLOOR
    total_slots: int = TOTAL_SLOTS
    locations: tuple[str, ...] = ()
    vip_locations: tuple[str, ...] = ()
    vip_prefixes: tuple[str, ...] = VIP_PREFIXES
    kafka_bootstrap: str | None = None
    kafka_topic: str | None = None
    starting_offsets: str = "latest"
    max_offsets_per_trigger: int = 5_000_000
    watermark: str = WATERMARK
    window: str = WINDOW
    processing_interval_seconds: int = PROCESSING_INTERVAL_SECONDS
    console_interval_seconds: int = CONSOLE_INTERVAL_SECONDS
    state_partitions: int = STATE_PARTITIONS
    checkpoint_dir: str | None = None


def _names(text: str | None) -> tuple[str, ...]:
    return tuple(name for name in (part.strip() for part in (text or "").split(",")) if name)


def from_env(env: Mapping[str, str], base: Settings = Settings()) -> Settings:
    """Settings with the environment variables of the service laid over ``base``."""
    changes: dict[str, object] = {}
    # The names of the environment variables.
    for field, variable, convert in (
        ("price_per_10min", "PRICE_PER_10MIN_BLOCK", int),
        ("vip_price_per_10min", "VIP_PRICE_PER_10MIN_BLOCK", int),
        ("locations", "PARKING_LOCATIONS", _names),
        ("vip_locations", "VIP_LOCATIONS", _names),
        ("vip_prefixes", "VIP_PREFIXES", lambda text: tuple(name.upper() for name in _names(text))),
        ("kafka_bootstrap", "KAFKA_BOOTSTRAP", str),
        ("kafka_topic", "KAFKA_TOPIC", str),
    ):
        if variable in env:
            changes[field] = convert(env[variable])
    return replace(base, **changes)
