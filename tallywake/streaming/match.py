"""Two-stream match on a key and a time span."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywake.functions.durations import interval
from tallywake.operators.match import MATCHED, NO_LEFT, NO_RIGHT
from tallywake.streaming.event_time import with_event_time


def interval_match_stream(left: DataFrame, right: DataFrame, keys: list[str], ts: str, before: str = "3 seconds",
                          after: str = "5 seconds", delay: str | None = "0 seconds") -> DataFrame:
    """Batch form: operators.match.interval_match, all pairs. State of both sides is dropped once the
    slower stream's watermark is past the span; then unmatched rows come out."""
    def side(df: DataFrame, prefix: str) -> DataFrame:
        return with_event_time(df, ts, delay).select(*[F.col(c).alias(f"{prefix}_{c}") for c in df.columns])

    l_ts, r_ts = F.col(f"l_{ts}"), F.col(f"r_{ts}")
    on = (r_ts >= l_ts - interval(before)) & (r_ts <= l_ts + interval(after))
    for k in keys:
        on = on & (F.col(f"l_{k}") == F.col(f"r_{k}"))
    joined = side(left, "l").join(side(right, "r"), on, "full_outer")
    outcome = F.when(r_ts.isNull(), NO_RIGHT).when(l_ts.isNull(), NO_LEFT).otherwise(MATCHED)
    return joined.select(
        *[F.coalesce(f"l_{k}", f"r_{k}").alias(k) for k in keys],
        *[f"l_{c}" for c in left.columns if c not in keys], *[f"r_{c}" for c in right.columns if c not in keys],
        outcome.alias("outcome"))
