"""Writing streams: labelled sinks, one sink per outcome, ranks per micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallywake.operators.rank import top_n
from tallywake.session import checkpoint_root

EachBatch = Callable[[DataFrame, int], None]


def to_console(label: str) -> EachBatch:
    """Print every row of a micro-batch, one partition at a time."""
    def each(batch: DataFrame, batch_id: int) -> None:
        print(f"{label}> batch {batch_id}")
        for row in batch.toLocalIterator():
            print(*row, sep="\t")

    return each


def write_stream(df: DataFrame, name: str, sink: str | EachBatch | None = None, mode: str = "append",
                 checkpoint: str | None = None, trigger: Mapping | None = None, **options: str) -> StreamingQuery:
    """Start a query labelled `name`. `sink` is a format (memory, parquet, kafka) or a function called with every micro-batch;
    without one all rows are printed."""
    sink = sink or to_console(name)
    folder = checkpoint or f"{checkpoint_root(df.sparkSession)}/{name}"
    writer = df.writeStream.queryName(name).outputMode(mode).option("checkpointLocation", folder).options(**options)
    writer = writer.foreachBatch(sink) if callable(sink) else writer.format(sink)
    return (writer.trigger(**trigger) if trigger else writer).start()


def by_outcome(sinks: Mapping[str, EachBatch], rest: EachBatch, column: str = "outcome") -> EachBatch:
    """Send the rows of each outcome to its own sink, those of any other outcome or none to `rest`. The micro-batch is kept while they are written, so
    the operator before it runs once."""
    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for value, sink in sinks.items():
                sink(batch.where(F.col(column) == value), batch_id)
            rest(batch.where(~F.coalesce(F.col(column).isin(*sinks), F.lit(False))), batch_id)
        finally:
            batch.unpersist()

    return each


def to_folder(path: str) -> EachBatch:
    """A micro-batch in its own folder, replaced as a whole if the batch runs again."""
    def each(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return each


def ranked(key: str, n: int, sink: EachBatch, window_end: str = "window_end") -> EachBatch:
    """Top-n per window of final counts (append mode). All counts of a window become final in one
    micro-batch, so it is ranked as a batch table: n rows a task and window are shuffled."""
    def each(batch: DataFrame, batch_id: int) -> None:
        sink(top_n(batch, key, n, window_end), batch_id)

    return each


def reranked(key: str, n: int, counts_folder: str, sink: EachBatch, window_end: str = "window_end") -> EachBatch:
    """Top-n of counts that change (update mode): ranks again the windows a micro-batch touches, from
    the newest count of each of their keys. Counts are kept in a folder by the day of their window's end;
    a batch that runs again replaces its own."""
    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mine = f"{counts_folder}/batch={batch_id}"
        batch.select(key, window_end, "cnt", F.col(window_end).cast("date").alias("day")).write.mode(
            "overwrite").partitionBy("day").parquet(mine)
        changed = f"{key} {batch.schema[key].dataType.simpleString()}, {window_end} timestamp, cnt bigint, day date"
        touched = spark.read.schema(changed).parquet(mine).select("day", window_end).distinct()
        counts = spark.read.schema(f"{changed}, batch bigint").parquet(counts_folder).where(F.col("batch") <= batch_id)
        newest = counts.join(touched, ["day", window_end], "left_semi").groupBy(key, window_end).agg(
            F.max_by("cnt", "batch").alias("cnt"))
        sink(top_n(newest, key, n, window_end), batch_id)

    return each
