"""Event time of streams: setting the watermark, and choosing rows without holding it back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_event_time(df: DataFrame, ts: str, delay: str | None) -> DataFrame:
    """Set the watermark, which needs a timestamp with zone; None keeps the one `ts` has already."""
    if delay is None:
        return df
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def after_watermark(df: DataFrame, ts: str, condition: Column) -> DataFrame:
    """The rows that meet a condition, chosen after all rows have moved the watermark of `ts`.

    A plain filter would be moved to the source, and rows that fail it would be no sign of time passing: then windows stay open
    for as long as no row of the wanted kind comes. This one asks for the time of the rows that count.
    """
    return df.where(F.when(condition, F.col(ts)).isNotNull())
