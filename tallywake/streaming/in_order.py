"""Event-time order on streams: rows of a key are held until the watermark passes them, then taken one
by one in (time, seq) order. So a stream gives what the batch operator gives, however rows arrive
inside the watermark's delay.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tallywake.functions.times import epoch_micros
from tallywake.streaming.event_time import after_watermark, with_event_time


# Keys that share a hash share a state, of which there are so many: what a visit to a state costs (calls out of the process, a timer)
# is paid once for all its keys, so it does not grow with their number.
GROUPS = 1 << 14
# Rows that wait are kept so many to a value, as each value is converted on its own.
BLOCK = 10_000


def row_maker(names: Sequence[str]) -> Callable[[tuple], Row]:
    """Rows with these column names from tuples."""
    make = Row(*names)
    return lambda values: make(*values)


def hashable(value: Any) -> Any:
    """A key's value as Spark groups it: NaN equals NaN."""
    if isinstance(value, (list, tuple)):
        return tuple(map(hashable, value))
    if isinstance(value, bytearray):
        return bytes(value)
    return "NaN" if value != value else value


def blobs(rows: list[tuple]) -> list[tuple[bytes]]:
    """Rows as values of binary state."""
    return [(pickle.dumps(rows[at:at + BLOCK], pickle.HIGHEST_PROTOCOL),) for at in range(0, len(rows), BLOCK)]


class InOrder(StatefulProcessor):
    """A detector of keys, many of which share a state. Subclasses say what they remember of one and how one row, or the passing of
    time, changes it; the remembered tuple holds plain values."""

    memory_schema = ""
    start: tuple = ()
    names: list[str] = []  # of the result columns, the key's first
    key_fields: list[T.StructField] = []
    memory_fields: list[T.StructField] = []

    def step(self, memory: tuple, row: tuple) -> tuple[tuple, list[tuple]]:
        """Take the next row `(us, seq, ...)`: new memory and the results it gives."""
        raise NotImplementedError

    def passed(self, memory: tuple, us: int) -> tuple[tuple, list[tuple]]:
        """All rows up to `us` have been taken."""
        return memory, []

    def wake(self, memory: tuple, us: int) -> int | None:
        """The next time after `us` at which there is something to do."""
        return None

    def taken(self, memory: tuple, rows: list[tuple], us: int) -> tuple[tuple, list[tuple], list[tuple]]:
        """Of one key: new memory, the rows ahead of `us`, which wait, and the results."""
        results, ahead = [], len(rows)
        rows.sort(key=lambda r: (r[0], r[1]))
        for i, row in enumerate(rows):
            if row[0] > us:
                ahead = i
                break
            memory, more = self.step(memory, row)
            results += more
        memory, more = self.passed(memory, us)
        return memory, rows[ahead:], results + more

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "rows binary")
        self.memory = handle.getListState("memory", T.StructType([*self.key_fields, *self.memory_fields]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        yield from self._advance([tuple(r)[len(key):] for r in rows], timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._advance([], timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass

    def _advance(self, new: list[tuple], watermark_ms: int) -> Iterator[Row]:
        now, n = watermark_ms * 1000, len(self.key_fields)
        named = row_maker(self.names)
        held = [row for blob, in self.held.get() for row in pickle.loads(blob)]
        stored = [tuple(r) for r in self.memory.get()]
        # By key, as it is compared: the key, its memory, its rows.
        keys: dict[tuple, tuple[tuple, tuple, list[tuple]]] = {hashable(r[:n]): (r[:n], r[n:], []) for r in stored}
        for row in (*held, *new):
            keys.setdefault(hashable(row[:n]), (row[:n], self.start, []))[2].append(row[n:])
        waiting, memories, times, changed = [], [], [], False
        for key, before, rows in keys.values():
            memory, ahead, results = self.taken(before, rows, now)
            for result in results:
                yield named((*key, *result))
            changed |= memory != before
            if memory != self.start:
                memories.append((*key, *memory))
            waiting += [(*key, *row) for row in ahead]
            times += [t for t in (ahead[0][0] if ahead else None, self.wake(memory, now)) if t is not None]

        # Every state call leaves the process, so only changes are written.
        if len(waiting) == len(held) + len(new):
            if new:
                self.held.appendList(blobs(new))
        elif waiting:
            self.held.put(blobs(waiting))
        elif held:
            self.held.clear()
        if changed and memories:
            self.memory.put(memories)
        elif changed:
            self.memory.clear()
        if times:
            # Not before the next watermark: a timer at or before this one would never be reached again.
            self.handle.registerTimer(max(-(-min(times) // 1000), watermark_ms + 1))


def in_order(df: DataFrame, keys: Sequence[str], ts: str, seq: str, delay: str | None, columns: Sequence[Column],
             processor: type[InOrder], *args: Any, results: str, event_time: str = "", only: Column | None = None,
             groups: int = GROUPS) -> DataFrame:
    """Run a detector over a stream: `columns` are what it sees of a row after its time and seq, `only` which rows it
    sees (all move the watermark). A `delay` of None keeps the watermark set before. The `event_time` result column, if any, carries the watermark on to windows later in the query; its rows
    come out in the micro-batch whose watermark passes them, so they are in time for those. Keys are dealt to `groups` states by hash; a state is
    rewritten as a whole, so there should be as many as make some hundreds of keys each at most."""
    timed = with_event_time(df, ts, delay)
    group = F.pmod(F.xxhash64(*keys), F.lit(groups)).cast("int").alias("_group")
    rows = (timed if only is None else after_watermark(timed, ts, only)).select(
        group, *keys, epoch_micros(ts).alias("_us"), F.col(seq).alias("_seq"), *columns, ts)
    key_fields = rows.schema.fields[1:len(keys) + 1]
    out = T.StructType(key_fields + T.StructType.fromDDL(results).fields)
    detector = processor(*args)
    detector.names, detector.key_fields = out.names, key_fields
    detector.memory_fields = T.StructType.fromDDL(processor.memory_schema).fields
    return rows.groupBy("_group").transformWithState(
        statefulProcessor=detector, outputStructType=out, outputMode="Append", timeMode="EventTime",
        eventTimeColumnName=event_time)
