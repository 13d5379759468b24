"""Sliding counts that are shown when a window ends and shown again for each late row, and their ranks, both kept in state
only as long as a late row may still come."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tallywake.functions.durations import micros
from tallywake.functions.times import epoch_micros


class Firing(StatefulProcessor):
    """Pane counts of one key to the counts of its windows, as micro-batches come.

    A window comes out when the watermark passes its end, and again in every micro-batch with late rows in it, until
    `lateness` later; only windows that a late row touches do. State: the panes of windows that may still come out, and how
    far windows have.
    """

    def __init__(self, keys: Sequence[str], size: int, slide: int, lateness: int):
        self.keys, self.size, self.slide, self.lateness = list(keys), size, slide, lateness

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("panes", "upto bigint, ends array<bigint>, counts array<bigint>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = [(r["end_us"].to_numpy(), r["n_rows"].to_numpy()) for r in rows]
        yield from self._advance(key, np.concatenate([e for e, _ in new]), np.concatenate([n for _, n in new]), timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        none = np.zeros(0, np.int64)
        yield from self._advance(key, none, none, timerValues)

    def close(self) -> None:
        pass

    def windows(self, ends: np.ndarray) -> np.ndarray:
        """Ends of the windows that hold the panes."""
        return np.unique((ends[:, None] + np.arange(0, self.size, self.slide)).ravel())

    def sums(self, ends: np.ndarray, counts: np.ndarray, windows: np.ndarray) -> np.ndarray:
        """Counts of windows from those of panes, both by their ends in order."""
        total = np.r_[0, np.cumsum(counts)]
        return total[np.searchsorted(ends, windows, "right")] - total[np.searchsorted(ends, windows - self.size, "right")]

    def _advance(self, key: tuple, ends: np.ndarray, counts: np.ndarray, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        upto, old_ends, old_counts = self.state.get() or (0, [], [])
        # Windows this late are closed for good; a pane of none but such is late and not counted.
        closed = now - self.lateness
        still = ends + self.size - self.slide > closed
        ends, counts = ends[still], counts[still]
        before, before_n = np.array(old_ends, np.int64), np.array(old_counts, np.int64)
        panes, inverse = np.unique(np.r_[before, ends], return_inverse=True)
        sums = np.bincount(inverse, np.r_[before_n, counts], len(panes)).astype(np.int64)
        # What the watermark has gone past: windows too old for the new rows have the rows from before, the others all.
        known, touched, due = self.windows(before), self.windows(ends), self.windows(panes)
        past = known[(known > upto) & (known <= closed)]
        fired = np.union1d(touched[(touched <= upto) & (touched > closed)], due[(due > max(upto, closed)) & (due <= now)])
        cnt = np.r_[self.sums(before, before_n, past), self.sums(panes, sums, fired)]
        fired = np.r_[past, fired]
        fired, cnt = fired[cnt > 0], cnt[cnt > 0]
        if len(fired):
            yield pd.DataFrame({**{k: [v] * len(fired) for k, v in zip(self.keys, key)}, "end_us": fired, "cnt": cnt, "is_again": fired <= upto})
        kept = panes + self.size - self.slide + self.lateness > now
        if not kept.any():
            self.state.clear()
            return
        panes, sums = panes[kept], sums[kept]
        self.state.update((max(upto, now), panes.tolist(), sums.tolist()))
        ahead = self.windows(panes)
        ahead = ahead[ahead > now]
        at = ahead[0] if len(ahead) else panes[0] + self.size - self.slide + self.lateness
        self.handle.registerTimer(max(-(-int(at) // 1000), now // 1000 + 1))


class Ranks(StatefulProcessor):
    """Counts of the windows of a stretch of time to ranks, again for each window whose counts change. State: the newest
    count of each key and window, dropped as a whole when the last window of the stretch can change no more."""

    def __init__(self, key: str, kind: T.DataType, n: int, stretch: int, lateness: int):
        self.key, self.kind, self.n, self.stretch, self.lateness = key, kind, n, stretch, lateness

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        fields = T.StructType().add("keys", T.ArrayType(self.kind)).add("ends", T.ArrayType(T.LongType())).add("counts", T.ArrayType(T.LongType()))
        self.state = handle.getValueState("ranked", fields)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat([r[[self.key, "end_us", "cnt"]] for r in rows])
        old = self.state.get()
        known = pd.DataFrame(dict(zip((self.key, "end_us", "cnt"), old))) if old else new.iloc[:0]
        whole = pd.concat([known, new]).drop_duplicates([self.key, "end_us"], keep="last")
        touched = whole[whole["end_us"].isin(new["end_us"].unique())].sort_values(["end_us", "cnt", self.key], ascending=[True, False, True])
        nth = touched.groupby("end_us").cumcount() + 1
        yield touched.assign(row_num=nth.astype("int32"))[nth <= self.n][[self.key, "end_us", "cnt", "row_num"]]
        gone = (key[0] + 1) * self.stretch + self.lateness
        if gone > timerValues.getCurrentWatermarkInMs() * 1000:
            self.state.update(tuple(whole[c].tolist() for c in (self.key, "end_us", "cnt")))
            self.handle.registerTimer(-(-gone // 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


def _pane_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, end_us, n_rows): rows counted by pane within each batch of a task, so a key with very many rows sends few."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted = pa.Table.from_batches([batch]).group_by([*keys, "end_us"]).aggregate([([], "count_all")])
            yield from counted.select([*keys, "end_us", "count_all"]).rename_columns([*keys, "end_us", "n_rows"]).to_batches()

    schema = T.StructType([*df.select(*keys, "end_us").schema.fields]).add("n_rows", "long")
    return df.mapInArrow(step, schema)


def refiring_counts(df: DataFrame, keys: Sequence[str], ts: str, size: str, slide: str, lateness: str) -> DataFrame:
    """(keys, window_end, cnt, again) of sliding windows over a stream that has its watermark on `ts`.

    A count comes when its window ends and again, with `again` set, after late rows, up to `lateness` later. `size` is a
    multiple of `slide`.
    """
    step = F.lit(micros(slide))
    us = epoch_micros(ts)
    panes = df.select(*keys, (us - F.pmod(us, step) + step).alias("end_us"))
    out = T.StructType([f for f in panes.schema.fields if f.name in keys]).add("end_us", "long").add("cnt", "long").add("is_again", "boolean")
    found = _pane_counts(panes, keys).groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=Firing(keys, micros(size), micros(slide), micros(lateness)), outputStructType=out, outputMode="Append",
        timeMode="EventTime")
    return found.select(*keys, F.timestamp_micros("end_us").alias("window_end"), "cnt", F.col("is_again").alias("again"))


def refiring_ranks(counts: DataFrame, key: str, n: int, lateness: str, stretch: str = "1 hour") -> DataFrame:
    """(key, window_end, cnt, row_num) of `refiring_counts`: the n largest of each window (ties by key), again as a whole
    whenever one of its counts changes; the newest micro-batch of a window has its last ranks. Windows of one `stretch` of time
    share a state."""
    width = micros(stretch)
    us = epoch_micros("window_end")
    rows = counts.select(F.floor((us - 1) / width).cast("bigint").alias("stretch_no"), key, us.alias("end_us"), "cnt")
    kind = rows.schema[key].dataType
    out = T.StructType([rows.schema[key]]).add("end_us", "long").add("cnt", "long").add("row_num", "integer")
    found = rows.groupBy("stretch_no").transformWithStateInPandas(
        statefulProcessor=Ranks(key, kind, n, width, micros(lateness)), outputStructType=out, outputMode="Append", timeMode="EventTime")
    return found.select(key, F.timestamp_micros("end_us").alias("window_end"), "cnt", "row_num")
