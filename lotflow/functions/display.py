"""Text for people: status labels, durations, amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotflow.functions.columns import div

# Label of each status code on screen, and in the feed's own list.
SCREEN_LABELS = {"PARKED": "Đã đỗ", "MOVING": "Di chuyển", "EXITING": "Đang ra"}
FEED_LABELS = {"ENTERING": "Đang vào", "PARKED": "Đã đỗ", "MOVING": "Đang di chuyển", "EXITING": "Đang ra"}
HOURS_PATTERN = "%dh %dp"
MINUTES_PATTERN = "%d phút"
CLOCK_PATTERN = "HH:mm:ss"
DONG_SUFFIX = "\u00a0₫"


def status_label(status: Column, labels: dict[str, str] = SCREEN_LABELS) -> Column:
    """The label, or the code itself where it has none."""
    text = status
    for code, label in labels.items():
        text = F.when(status == code, F.lit(label)).otherwise(text)
    return text


def duration_text(minutes: Column) -> Column:
    hours = div(minutes, 60)
    return F.when(hours > 0, F.format_string(HOURS_PATTERN, hours, minutes % 60)).otherwise(
        F.format_string(MINUTES_PATTERN, minutes % 60)
    )


def amount_text(amount: Column) -> Column:
    """Whole dong, dots between thousands."""
    return F.concat(F.translate(F.format_number(amount, 0), ",", "."), F.lit(DONG_SUFFIX))


def clock_text(unix: Column) -> Column:
    """Time of day of a unix time, in the zone of the session."""
    return F.date_format(F.timestamp_seconds(unix), CLOCK_PATTERN)
