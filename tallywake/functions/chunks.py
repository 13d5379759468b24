"""Cutting one key's events into time chunks, so that a hot key is worked on by many tasks.

An operator that only looks `before` / `after` a bounded time around a row gives the same answer on a
chunk plus its margins as on the whole key. Rows in a margin are copied into the chunk that needs them;
with chunks many times the margin that is a few per cent of the rows, and one shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywake.functions.times import epoch_micros

CHUNK = "_chunk"
OWN = "_own"

# A chunk is this many margins long unless the caller says otherwise.
MARGINS_PER_CHUNK = 32


def chunk_of(us: Column, width: int) -> Column:
    """Number of the `width`-microsecond chunk an epoch-microsecond value falls in (exact, rounds down)."""
    return F.call_function("div", us - F.pmod(us, F.lit(width)), F.lit(width))


def with_margins(df: DataFrame, ts: str, width: int, before: int = 0, after: int = 0,
                 copy_if: Column | None = None) -> DataFrame:
    """Give each row its chunk number and a copy in every other chunk whose margins hold it.

    A chunk holds the rows from `before` ahead of its start to `after` past its end (microseconds, both
    ends inclusive). `_own` is true in the chunk the row itself falls in. `copy_if` limits the copies to
    the rows a margin needs. A row without time is kept, with no chunk.
    """
    us = epoch_micros(ts)
    own = chunk_of(us, width)
    lowest, highest = chunk_of(us - F.lit(after), width), chunk_of(us + F.lit(before), width)
    chunks = F.sequence(lowest, highest)
    if copy_if is not None:
        chunks = F.when(copy_if, chunks).otherwise(F.array(own))
    return df.withColumn("_home", own).withColumn(CHUNK, F.explode_outer(chunks)).withColumn(
        OWN, F.col(CHUNK) == F.col("_home")).drop("_home")
