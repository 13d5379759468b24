"""Late rows of a stream, told apart instead of dropped."""

from __future__ import annotations

import pickle
import tempfile
from collections.abc import Callable, Iterator, Sequence
from heapq import merge
from itertools import islice

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tallywake.functions.durations import interval, micros
from tallywake.functions.times import epoch_micros, last_window_end
from tallywake.operators.late import tag_late
from tallywake.session import removed
from tallywake.streaming.in_order import row_maker
from tallywake.streaming.sinks import EachBatch

BLOCK = 100  # rows of a stretch that are read back at once


def sorted_rows(rows: Iterator[tuple], key: Callable[[tuple], tuple], most: int = 20_000) -> Iterator[tuple]:
    """The rows in order, of which `most` are in memory at once, and besides a block of each stretch of so many: sorted stretches
    wait in a local file until all have come."""
    stretch = sorted(islice(rows, most), key=key)
    if len(stretch) < most:
        yield from stretch
        return
    with tempfile.TemporaryFile() as file:
        def written(stretch: list[tuple]) -> list[int]:
            places = []
            for at in range(0, len(stretch), BLOCK):
                places.append(file.tell())
                pickle.dump(stretch[at:at + BLOCK], file, pickle.HIGHEST_PROTOCOL)
            return places

        def read(places: list[int]) -> Iterator[tuple]:
            for place in places:
                file.seek(place)
                yield from pickle.load(file)

        stretches = []
        while stretch:
            stretches.append(written(stretch))
            stretch = sorted(islice(rows, most), key=key)
        yield from merge(*map(read, stretches), key=key)


class NewestSoFar(StatefulProcessor):
    """Adds to each row of a source the newest event time of the rows before it."""

    def __init__(self, places: int, names: Sequence[str]):
        self.places, self.names = places, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", "us bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        named = row_maker(self.names)
        stored = self.newest.get()
        newest = stored[0] if stored else None
        for row in sorted_rows((tuple(r) for r in rows), lambda r: r[-self.places:]):
            us = row[-self.places - 1]
            yield named((*row[: -self.places - 1], newest))
            newest = us if newest is None or (us is not None and us > newest) else newest
        if newest is not None:
            self.newest.update((newest,))

    def close(self) -> None:
        pass


def tagging_late(ts: str, source: str, position: Sequence[str], size: str, state_folder: str, sink: EachBatch, slide: str | None = None,
                 delay: str = "10 seconds", lateness: str = "0 seconds", chunk_rows: int = 1_000_000) -> EachBatch:
    """`tag_late` on each micro-batch, for sources that hold a large part of all rows: a source's rows are spread over tasks by
    stretches of positions. The newest event time of each source, one row, is a small table of the micro-batch, which the next one
    reads; a micro-batch that runs again replaces its own, and the one two before is deleted."""
    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            own = batch.groupBy(source).agg(F.max(ts).alias("newest"))
            before = spark.read.schema(own.schema).parquet(f"{state_folder}/batch={batch_id - 1}") if batch_id else None
            both = own if before is None else own.unionByName(before.select(*own.columns))
            both.groupBy(source).agg(F.max("newest").alias("newest")).write.mode("overwrite").parquet(f"{state_folder}/batch={batch_id}")
            sink(tag_late(batch, ts, source, position, size, slide, delay, lateness, chunk_rows, before), batch_id)
        finally:
            batch.unpersist()
        removed(spark, f"{state_folder}/batch={batch_id - 2}")

    return each


def tag_late_stream(df: DataFrame, ts: str, source: str, position: Sequence[str], size: str, slide: str | None = None,
                    delay: str = "10 seconds", lateness: str = "0 seconds") -> DataFrame:
    """Batch form: operators.late.tag_late. State is one time per source, whose rows pass one task of a micro-batch and are
    sorted there with few in memory (see `tagging_late` for sources that are too large for one task); positions must rise from one
    micro-batch to the next, as offsets do."""
    columns = [source, *[c for c in df.columns if c != source]]
    places = [F.col(c).alias(f"_p{i}") for i, c in enumerate(position)]
    rows = df.select(*columns, epoch_micros(ts).alias("_us"), *places)
    out = T.StructType([*df.select(*columns).schema.fields, T.StructField("_newest", T.LongType())])
    seen = rows.groupBy(source).transformWithState(
        statefulProcessor=NewestSoFar(len(places), out.names), outputStructType=out, outputMode="Append", timeMode="None")
    watermark = F.timestamp_micros(F.col("_newest") - F.lit(micros(delay)))
    closes = last_window_end(F.col(ts).cast("timestamp"), size, slide or size) - interval(1_000) + interval(lateness)
    return seen.withColumn("watermark", watermark).withColumn(
        "is_late", F.coalesce(closes <= F.col("watermark"), F.lit(False))).select(*df.columns, "watermark", "is_late")
