"""One-to-one pairing on streams: both sides of a key in one queue, settled as the watermark passes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tallywake.functions.durations import micros
from tallywake.functions.times import epoch_micros
from tallywake.operators.match import MATCHED, NO_LEFT, NO_RIGHT
from tallywake.operators.pairs import LEFT, RIGHT, Queue
from tallywake.streaming.event_time import after_watermark, with_event_time
from tallywake.streaming.in_order import row_maker


class Pairing(StatefulProcessor):
    """State of a key: the rows not settled yet, those ahead of the watermark and those that wait for a partner.

    Settled rows have left the queue, so what is kept tells all there is to know of the past: taken again in order of
    time, the rows that wait are in the queue just as before.
    """

    def __init__(self, held_schema: T.StructType, names: Sequence[str], after: int, before: int, n_left: int):
        self.held_schema, self.names = held_schema, list(names)
        self.after, self.before, self.n_left = after, before, n_left

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", self.held_schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        yield from self._settle(key, [tuple(r)[len(key):] for r in rows], timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._settle(key, [], timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass

    def _settle(self, key: tuple, new: list[tuple], watermark_ms: int) -> Iterator[Row]:
        now, named = watermark_ms * 1000, row_maker(self.names)
        # A row: time, side, tie, the left columns, the right columns, time.
        rows = sorted([*(tuple(r) for r in self.held.get()), *new], key=lambda r: (r[0], r[1], r[2]))
        cut, queue = 3 + self.n_left, Queue(self.after, self.before)
        none_left, none_right = (None,) * self.n_left, (None,) * (len(self.held_schema) - cut - 1)

        def result(left: tuple | None, right: tuple | None) -> Row:
            outcome = NO_RIGHT if right is None else NO_LEFT if left is None else MATCHED
            return named((*key, *(left[3:cut] if left else none_left), *(right[cut:-1] if right else none_right), outcome))

        def lone(row: tuple) -> Row:
            return result(row, None) if row[1] == LEFT else result(None, row)

        ahead = len(rows)
        for i, row in enumerate(rows):
            if row[0] > now:
                ahead = i
                break
            for gone in queue.expired(row[0]):
                yield lone(gone)
            partner = queue.take(row[0], row[1], row)
            if partner is not None:
                yield result(*((row, partner) if row[1] == LEFT else (partner, row)))
        # All rows up to the watermark are here; the next one comes after it.
        for gone in queue.expired(now + 1):
            yield lone(gone)
        kept = [row for _, row in queue.rows] + rows[ahead:]
        if kept:
            self.held.put(kept)
            waits = self.after, self.before
            due = [rows[ahead][0]] if ahead < len(rows) else []
            due += [us + waits[queue.side] for us, _ in list(queue.rows)[:1]]
            # Not before the next watermark: a timer at or before this one would never be reached again.
            self.handle.registerTimer(max(-(-min(due) // 1000), watermark_ms + 1))
        else:
            self.held.clear()


def pair_match_stream(left: DataFrame, right: DataFrame, keys: list[str], ts: str, seq: str, before: str = "3 seconds",
                      after: str = "5 seconds", delay: str | None = "0 seconds") -> DataFrame:
    """Batch form: operators.pairs.pair_match. A row is settled once the watermark of the slower side is past all rows it could
    pair with; until then it is state. Rows with a null key or time are left out."""
    lefts, rights = ([c for c in df.columns if c not in keys] for df in (left, right))

    def side(df: DataFrame, number: int) -> DataFrame:
        timed = with_event_time(df.withColumn(ts, F.col(ts).cast("timestamp")) if delay is not None else df, ts, delay)
        # One column alone may carry the watermark: the time among the results is a copy without it.
        own = [(F.timestamp_micros(epoch_micros(c)) if c == ts else F.col(c)).alias(f"{'lr'[number]}_{c}") for c in df.columns if c not in keys]
        other, names = ((right, rights), (left, lefts))[number]
        types = other.withColumn(ts, F.col(ts).cast("timestamp")).schema
        none = [F.lit(None).cast(types[c].dataType).alias(f"{'rl'[number]}_{c}") for c in names]
        known = F.lit(True)
        for k in keys:
            known = known & F.col(k).isNotNull()
        return after_watermark(timed, ts, known).select(
            *keys, epoch_micros(ts).alias("_us"), F.lit(number).alias("_side"), F.col(seq).cast("bigint").alias("_tie"),
            *(own + none if number == LEFT else none + own), F.col(ts).alias("_ts"))

    rows = side(left, LEFT).unionByName(side(right, RIGHT))
    fields = {f.name: f for f in rows.schema.fields}
    columns = [f"l_{c}" for c in lefts] + [f"r_{c}" for c in rights]
    held = T.StructType([fields[c] for c in ("_us", "_side", "_tie", *columns, "_ts")])
    out = T.StructType([*(fields[k] for k in keys), *(fields[c] for c in columns), T.StructField("outcome", T.StringType())])
    processor = Pairing(held, out.names, micros(after), micros(before), len(lefts))
    return rows.select(*keys, *held.names).groupBy(*keys).transformWithState(
        statefulProcessor=processor, outputStructType=out, outputMode="Append", timeMode="EventTime")
