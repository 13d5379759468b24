"""Event-time columns: epoch numbers to timestamps, window arithmetic, printed bounds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallywake.functions.durations import interval, micros


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def from_epoch(epoch: Column | str, unit: str) -> Column:
    """Epoch seconds ('s') or milliseconds ('ms') to event time."""
    return F.timestamp_seconds(_col(epoch)) if unit == "s" else F.timestamp_millis(_col(epoch))


def epoch_micros(ts: Column | str) -> Column:
    """Event time as epoch microseconds. The session zone is UTC (see `session`), so a timestamp
    without zone reads as UTC."""
    return F.unix_micros(_col(ts).cast("timestamp"))


def epoch_millis(ts: Column | str) -> Column:
    return F.unix_millis(_col(ts).cast("timestamp"))


def window_start(ts: Column | str, size: str, offset: str = "0 seconds") -> Column:
    """Start of the tumbling window a time falls in, windows shifted by `offset` from the epoch. Plain
    arithmetic: several can stand in one select, and a null time stays null."""
    past = F.pmod(epoch_micros(ts) - F.lit(micros(offset)), F.lit(micros(size)))
    return _col(ts) - past * F.expr("interval '1' microsecond")


def window_start_epoch(epoch: Column, offset: int, size: int) -> Column:
    """`window_start` on plain epoch numbers of any unit."""
    return epoch - F.pmod(epoch - F.lit(offset), F.lit(size))


def window_end(ts: Column | str, size: str, offset: str = "0 seconds") -> Column:
    return window_start(ts, size, offset) + interval(size)


def last_window_end(ts: Column | str, size: str, slide: str) -> Column:
    """End of the last sliding window that holds a time."""
    return window_start(ts, slide) + interval(size)


def next_midnight(ts: Column | str) -> Column:
    """The first UTC midnight after a time."""
    return window_end(ts, "1 day")


def printed(ts: Column | str) -> Column:
    """A time as text with one fraction digit, e.g. `2017-11-26 09:05:00.0`."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.S")
