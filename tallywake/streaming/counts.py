"""Window counts on streams, final once the watermark has passed a window's end."""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tallywake.functions.durations import micros
from tallywake.functions.times import epoch_micros
from tallywake.operators.counts import tumbling_count
from tallywake.streaming.event_time import with_event_time
from tallywake.streaming.in_order import row_maker


def tumbling_count_stream(df: DataFrame, ts: str, size: str, keys: Sequence[str] = (),
                          delay: str | None = "0 seconds") -> DataFrame:
    return tumbling_count(with_event_time(df, ts, delay), ts, size, keys)


def salted_count_stream(df: DataFrame, ts: str, size: str, spread_by: Sequence[str], salts: int = 64,
                        delay: str | None = "0 seconds") -> DataFrame:
    """Two chained counts: per (salt, window), then per window."""
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).alias("salt")
    partial = with_event_time(df, ts, delay).groupBy(salt, F.window(ts, size).alias("w")).agg(
        F.count(F.lit(1)).alias("part"))
    total = partial.groupBy(F.window(F.window_time("w"), size).alias("w")).agg(F.sum("part").alias("cnt"))
    return total.select(F.col("w.end").alias("window_end"), "cnt")


def distinct_count_stream(df: DataFrame, ts: str, size: str, of: str, delay: str | None = "0 seconds") -> DataFrame:
    """Exact distinct values per window: one state entry per (window, value), dropped with the window."""
    rows = with_event_time(df, ts, delay).select(F.window(ts, size).alias("w"), of)
    return rows.dropDuplicates(["w", of]).groupBy("w").agg(F.count(F.lit(1)).alias("cnt")).select(
        F.col("w.end").alias("window_end"), "cnt")


def sliding_count_stream(df: DataFrame, keys: Sequence[str], ts: str, size: str, slide: str,
                         delay: str | None = "0 seconds") -> DataFrame:
    """Rows per (keys, sliding window). Each row enters size / slide windows, so for small ratios; for
    large ones use `sliding_intervals_stream`."""
    w = F.window(ts, size, slide).alias("w")
    counted = with_event_time(df, ts, delay).groupBy(*keys, w).agg(F.count(F.lit(1)).alias("cnt"))
    return counted.select(*keys, F.col("w.end").alias("window_end"), "cnt")


class Stretches(StatefulProcessor):
    """Pane counts of one key to stretches of constant sliding count (see operators.counts)."""

    def __init__(self, size: int, names: Sequence[str]):
        self.size, self.names = size, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # The open stretch, and the changes still to come in order. One value, as each state call leaves
        # the process.
        self.state = handle.getValueState("state", "since bigint, cnt bigint, at array<bigint>, delta array<bigint>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        yield from self._advance(key, [(r["_end"], r["_n"]) for r in rows], timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._advance(key, [], timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass

    def _advance(self, key: tuple, panes: list[tuple[int, int]], watermark_ms: int) -> Iterator[Row]:
        named = row_maker(self.names)
        since, cnt, at, delta = self.state.get() or (0, 0, [], [])
        changes = Counter(dict(zip(at, delta)))
        for end, n in panes:
            changes[end] += n
            changes[end + self.size] -= n
        coming = sorted(changes.items())
        due = bisect_right(coming, watermark_ms * 1000, key=lambda change: change[0])
        for at_us, n in coming[:due]:
            if n:
                if cnt:
                    yield named((*key, since, at_us, cnt))
                since, cnt = at_us, cnt + n
        later = coming[due:]
        if later:
            self.state.update((since, cnt, [a for a, _ in later], [n for _, n in later]))
            self.handle.registerTimer(-(-later[0][0] // 1000))
        else:
            self.state.clear()


def sliding_intervals_stream(df: DataFrame, keys: Sequence[str], ts: str, size: str, slide: str,
                             delay: str | None = "0 seconds") -> DataFrame:
    """Sliding counts in compact form. Panes are counted first, with partial counts before the shuffle;
    then each key turns its pane counts into stretches. State per key is its panes of one window.
    `operators.counts.expand_intervals` makes one row per window of the result."""
    panes = with_event_time(df, ts, delay).groupBy(*keys, F.window(ts, slide).alias("w")).agg(
        F.count(F.lit(1)).alias("_n"))
    panes = panes.select(*keys, epoch_micros("w.end").alias("_end"), "_n", F.window_time("w").alias("_at"))
    key_fields = [f for f in panes.schema.fields if f.name in keys]
    out = T.StructType(key_fields + T.StructType.fromDDL("from_us bigint, to_us bigint, cnt bigint").fields)
    found = panes.groupBy(*keys).transformWithState(
        statefulProcessor=Stretches(micros(size), out.names), outputStructType=out, outputMode="Append", timeMode="EventTime")
    return found.select(*keys, F.timestamp_micros("from_us").alias("from_end"),
                        F.timestamp_micros("to_us").alias("to_end"), "cnt")
