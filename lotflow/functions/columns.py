"""Column helpers shared by the operators; all stay in JVM code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotflow.schemas import TIMESTAMP_PATTERN

# The status codes in the order a stay goes through them.
STATUSES = ("ENTERING", "PARKED", "MOVING", "EXITING")
BILLABLE = ("PARKED", "MOVING", "EXITING")

# Order in which events of one key apply: time, then status, then arrival.
EVENT_ORDER = ("timestamp_unix", "status_rank", "event_id")

_RANKS = 8


def div(left: Column | str, right: Column | int) -> Column:
    """Whole-number division, never through a double."""
    left = F.col(left) if isinstance(left, str) else left
    return F.call_function("div", left, right if isinstance(right, Column) else F.lit(right).cast("long"))


def status_rank(status: Column | str) -> Column:
    """1 to 4 along ``STATUSES``; 0 for any other code."""
    status = F.col(status) if isinstance(status, str) else status
    rank = F.lit(0)
    for place, name in enumerate(STATUSES, start=1):
        rank = F.when(status == name, place).otherwise(rank)
    return rank


def pack_latest(time: Column, rank: Column) -> Column:
    """(time, rank) as one long, so that a plain ``max`` keeps the latest status.

    A fixed-width buffer keeps the aggregate on the hash path; a text buffer would sort every
    input partition first.
    """
    return time * F.lit(_RANKS) + rank


def packed_time(packed: Column) -> Column:
    return div(packed - packed_rank(packed), _RANKS)


def packed_rank(packed: Column) -> Column:
    return F.pmod(packed, F.lit(_RANKS))


def packed_status(packed: Column) -> Column:
    names = F.array(*[F.lit(name) for name in STATUSES])
    return F.get(names, (packed_rank(packed) - 1).cast("int"))


def time_text(moment: Column | str) -> Column:
    return F.date_format(moment, TIMESTAMP_PATTERN)


def floor_of(location: Column | str) -> Column:
    """The letter part of a slot name."""
    return F.regexp_extract(location, "^[A-Z]+", 0)


def is_vip(location: Column, listed: tuple[str, ...], prefixes: tuple[str, ...]) -> Column:
    """On the list as written, or below a prefix in any letter case."""
    hit = F.lit(False)
    if listed:
        hit = hit | F.coalesce(location.isin(*listed), F.lit(False))
    for prefix in prefixes:
        hit = hit | F.coalesce(F.upper(location).startswith(prefix.upper()), F.lit(False))
    return hit
