"""Timestamps and durations."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def micros(duration: str | timedelta) -> int:
    """Length of a fixed duration such as ``"5 minutes"`` in microseconds."""
    if isinstance(duration, timedelta):
        return duration // timedelta(microseconds=1)
    words = duration.split()
    if not words or len(words) % 2:
        raise ValueError(f"not a duration: {duration!r}")
    length = 0
    for amount, unit in zip(words[::2], words[1::2]):
        name = unit.lower().rstrip("s")
        if name not in _MICROS:
            raise ValueError(f"not a fixed unit of time: {unit!r}")
        length += int(amount) * _MICROS[name]
    return length


def interval(length: int) -> Column:
    """A day-time interval of so many microseconds."""
    return F.lit(timedelta(microseconds=length))


def parse_ts(value: Column | str) -> Column:
    """Timestamp of an ISO 8601 text (``Z`` or offset allowed); NULL if it is not one."""
    text = F.col(value) if isinstance(value, str) else value
    dated = text.rlike(r"^\d{4}-\d{2}-\d{2}([T ]|$)")
    return F.when(dated, F.try_to_timestamp(text))
