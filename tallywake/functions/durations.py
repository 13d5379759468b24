"""Durations written as Spark writes them ('1 hour', '5 seconds'), and columns made from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def micros(duration: str) -> int:
    """'15 minutes' -> 900000000."""
    amount, unit = duration.split()
    return int(amount) * _UNIT_MICROS[unit.lower().rstrip("s")]


def interval(duration: str | int) -> Column:
    """A day-time interval literal; an int is microseconds."""
    us = duration if isinstance(duration, int) else micros(duration)
    return F.expr(f"interval '{us}' microseconds")


def text(us: int) -> str:
    """Microseconds as a duration that F.window and withWatermark take."""
    return f"{us} microseconds"
