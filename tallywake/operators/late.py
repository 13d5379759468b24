"""Late rows of a source: rows that arrive after all their windows are closed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tallywake.functions.chunks import CHUNK, chunk_of
from tallywake.functions.durations import interval, micros
from tallywake.functions.times import last_window_end, window_end


def tag_late(df: DataFrame, ts: str, source: str, position: Sequence[str], size: str, slide: str | None = None,
             delay: str = "10 seconds", lateness: str = "0 seconds", chunk_rows: int = 1_000_000,
             newest: DataFrame | None = None) -> DataFrame:
    """Add `watermark` (newest event time of the source's earlier rows, less `delay`) and `is_late`.

    `position` orders the rows of a source by arrival; its first column is a bigint such as an offset. A
    row is late when its last window, kept open for `lateness`, was closed by the watermark.

    A source may hold a large part of all rows, so the running maximum is made per stretch of
    `chunk_rows` positions and carried over from the stretches' own maxima, one row each. `newest`, one row (source, newest)
    for each, is the newest event time of rows that came before those of `df`.
    """
    df = df.withColumn(CHUNK, chunk_of(F.col(position[0]), chunk_rows))
    stretch_max = df.groupBy(source, CHUNK).agg(F.max(ts).alias("_max"))
    if newest is not None:
        # As a stretch before all others.
        first = newest.select(F.col(source), F.lit(-(1 << 62)).alias(CHUNK), F.col("newest").alias("_max"))
        stretch_max = stretch_max.unionByName(first)
    earlier = Window.partitionBy(source).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = stretch_max.select(F.col(source).alias("_s"), F.col(CHUNK).alias("_c"),
                                 F.max("_max").over(earlier).alias("_carried"))
    before = Window.partitionBy(source, CHUNK).orderBy(*position).rowsBetween(Window.unboundedPreceding, -1)
    same = F.col(source).eqNullSafe(F.col("_s")) & F.col(CHUNK).eqNullSafe(F.col("_c"))
    seen = df.join(carried, same).drop("_s", "_c").withColumn(
        "watermark", F.greatest("_carried", F.max(ts).over(before)) - interval(delay))
    closes = last_window_end(F.col(ts), size, slide or size) - interval(1_000) + interval(lateness)
    late = F.coalesce(closes <= F.col("watermark"), F.lit(False))
    return seen.withColumn("is_late", late).drop(CHUNK, "_carried")


def first_open_end(slide: str, lateness: str = "0 seconds") -> Column:
    """End of the earliest window still open for a row tagged by `tag_late` (null: all are open).

    A window takes rows while end - 1 ms + lateness is after the watermark.
    """
    return window_end(F.col("watermark") - interval(lateness) + interval(1_000), slide)
