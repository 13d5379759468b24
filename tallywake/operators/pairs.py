"""One-to-one pairing of two event tables on a key and a time span, in time order; lone rows of both sides kept.

Rows of a key are taken in order of time (a left row before a right row of the same time, then by seq). A row pairs with
the row of the other side that has waited longest and still may; if there is none it waits itself: a left row until `after` has
passed, a right row until `before` has. So every row comes out once, in a pair or alone.

What a key does in a time chunk depends on the past by the rows that still wait when it begins, and by nothing else. All
chunks of all keys are worked on at once, as if nobody waited. Chunks that are handed waiting rows are then worked on again
with them, which may change what they hand on, until no chunk is handed anything else than it was worked on with. A key
with very many rows is so spread over as many tasks as it has chunks; where queues run empty now and then, as they
do when rows find their partners, that takes two or three rounds.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallywake.functions.chunks import CHUNK, MARGINS_PER_CHUNK, chunk_of
from tallywake.functions.durations import micros
from tallywake.functions.times import epoch_micros
from tallywake.operators.match import MATCHED, NO_LEFT, NO_RIGHT
from tallywake.session import stored

LEFT, RIGHT = 0, 1


class Queue:
    """The rows of a key that wait, all of one side, by time; refs are the caller's."""

    def __init__(self, after: int, before: int) -> None:
        self.waits = (after, before)
        self.rows: deque = deque()
        self.side = LEFT

    def expired(self, us: int) -> Iterator:
        """Rows that can no longer pair with one at `us` or later."""
        while self.rows and self.rows[0][0] + self.waits[self.side] < us:
            yield self.rows.popleft()[1]

    def take(self, us: int, side: int, ref):
        """The partner of a row, or None if the row has to wait now. Rows that are `expired` at `us` must be gone."""
        if self.rows and self.side != side:
            return self.rows.popleft()[1]
        self.side = side
        self.rows.append((us, ref))
        return None


def _changes(batch: pa.RecordBatch, names: list[str], last: pa.RecordBatch | None) -> np.ndarray:
    """Whether each row differs from the one before it in the columns."""
    changed = np.zeros(batch.num_rows, bool)
    changed[0] = last is None or any(batch.column(c)[0] != last.column(c)[0] for c in names)
    for c in names:
        column = batch.column(c)
        changed[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    return changed


def _worked(rows: DataFrame, keys: list[str], width: int, after: int, before: int) -> DataFrame:
    """`l`, `r` of the pairs and lone rows of chunks, and rows that chunks hand on (`handed`, with the next chunk's number).

    `rows` has the keys, _chunk, _us, _side, _tie, l and r; a chunk's include those it is handed. A task holds a batch of rows
    and those that wait.
    """
    group = [*keys, CHUNK]
    rows = rows.select(*group, "_us", "_side", "_tie", "l", "r")
    schema = StructType([*rows.schema.fields]).add("handed", "boolean")
    dealt = rows.repartition(*group).sortWithinPartitions(*group, "_us", "_side", "_tie")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue, kept, last, end = Queue(after, before), None, None, 0

        def lone(refs: Iterator) -> list[tuple[int | None, int | None]]:
            side = queue.side
            return [(ref, None) if side == LEFT else (None, ref) for ref in refs]

        def closed() -> tuple[list, list[int]]:
            """At the end of a chunk: who has waited in vain, and who waits on in the next."""
            found = lone(queue.expired(end))
            rest = [ref for _, ref in queue.rows]
            queue.rows.clear()
            return found, rest

        def record(whole: pa.Table, found: list[tuple[int | None, int | None]], handed: list[int]) -> Iterator[pa.RecordBatch]:
            firsts = [b if a is None else a for a, b in found]
            own = whole.take(pa.array(firsts + handed, pa.int64()))
            sides = {c: whole.column(c).take(pa.array([pair[i] for pair in found] + handed, pa.int64())) for i, c in enumerate("lr")}
            on = pa.array(np.r_[np.zeros(len(found), np.int64), np.ones(len(handed), np.int64)])
            columns = [pc.add(own.column(c), on) if c == CHUNK else sides.get(c, own.column(c)) for c in own.column_names]
            flags = pa.array([False] * len(found) + [True] * len(handed), pa.bool_())
            yield from pa.Table.from_arrays([*columns, flags], schema.names).to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            whole = pa.Table.from_batches([batch]) if kept is None else pa.concat_tables([kept, pa.Table.from_batches([batch])])
            ahead = whole.num_rows - batch.num_rows
            found, handed = [], []
            new = _changes(batch, group, last).tolist()
            chunks = batch.column(CHUNK).to_pylist()
            for i, (us, side) in enumerate(zip(batch.column("_us").to_pylist(), batch.column("_side").to_pylist())):
                if new[i]:
                    alone, rest = closed()
                    found += alone
                    handed += rest
                    end = (chunks[i] + 1) * width
                found += lone(queue.expired(us))
                partner = queue.take(us, side, ahead + i)
                if partner is not None:
                    found.append((ahead + i, partner) if side == LEFT else (partner, ahead + i))
            last = batch.slice(batch.num_rows - 1)
            yield from record(whole, found, handed)
            kept = whole.take(pa.array([ref for _, ref in queue.rows], pa.int64()))
            queue.rows = deque((us, n) for n, (us, _) in enumerate(queue.rows))
        if kept is not None:
            yield from record(kept, *closed())

    return dealt.mapInArrow(step, schema)


def pair_match(left: DataFrame, right: DataFrame, keys: list[str], ts: str, seq: str, before: str = "3 seconds",
               after: str = "5 seconds", chunk: str | None = None) -> DataFrame:
    """One-to-one match: the keys, both sides' other columns as `l_*` / `r_*`, and `outcome`.

    A pair has equal keys and left.ts - before <= right.ts <= left.ts + after, first come first served. `seq` orders rows of
    one key, time and side. Rows that repeat are rows of their own. A row with a null key or time is alone. Chunks are
    `chunk` long, a few dozen times the waits unless given.
    """
    waits = micros(after), micros(before)
    width = micros(chunk) if chunk else MARGINS_PER_CHUNK * sum(waits)
    if width <= max(waits):
        raise ValueError("a chunk must be longer than the waits")

    def side(df: DataFrame, number: int) -> DataFrame:
        own = F.struct(*[c for c in df.columns if c not in keys])
        none = [F.lit(None).cast(t.select(F.struct(*[c for c in t.columns if c not in keys]).alias("_")).schema["_"].dataType)
                for t in (left, right)]
        us = epoch_micros(ts)
        return df.select(
            *keys, chunk_of(us, width).cast("bigint").alias(CHUNK), us.alias("_us"), F.lit(number).alias("_side"), F.col(seq).cast("bigint").alias("_tie"),
            *[(own if i == number else none[i]).alias(c) for i, c in enumerate("lr")])

    rows = side(left, LEFT).unionByName(side(right, RIGHT))
    known = F.col("_us").isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    own = stored(rows.where(known), "pair-rows")
    group = [*keys, CHUNK]
    kept = [*keys, "l", "r"]
    done = stored(_worked(own, keys, width, *waits), "pairs")
    handed = done.where("handed").drop("handed")
    results = done.where("NOT handed").select(*group, "l", "r")

    def prints(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*group).agg(F.sum(F.xxhash64("_us", "_side", "_tie", "l", "r").cast("decimal(38,0)")).alias(name))

    before_that = None
    while True:
        # Chunks that are handed other rows than they were worked on with.
        now = prints(handed, "now")
        if before_that is not None:
            was = prints(before_that, "was")
            now = now.join(was, group, "full").where("NOT now <=> was")
        changed = stored(now.select(*group), "pair-changes")
        if changed.isEmpty():
            break
        again = own.join(changed, group, "left_semi").unionByName(handed.join(changed, group, "left_semi"))
        done = stored(_worked(again, keys, width, *waits), "pairs")
        results = stored(results.join(changed, group, "left_anti").unionByName(done.where("NOT handed").select(*group, "l", "r")), "pair-results")
        # What a chunk hands on is known by the chunk after it.
        source = changed.withColumn(CHUNK, F.col(CHUNK) + 1)
        before_that, handed = handed, stored(
            handed.join(source, group, "left_anti").unionByName(done.where("handed").drop("handed")), "pair-handed")
    alone = rows.where(~F.coalesce(known, F.lit(False)))
    both = results.select(*kept).unionByName(alone.select(*kept))
    outcome = F.when(F.col("r").isNull(), NO_RIGHT).when(F.col("l").isNull(), NO_LEFT).otherwise(MATCHED)
    return both.select(
        *keys, *[F.col(f"{p}.{c}").alias(f"{p}_{c}") for p, df in (("l", left), ("r", right)) for c in df.columns if c not in keys],
        outcome.alias("outcome"))
