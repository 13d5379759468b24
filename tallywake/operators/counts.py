"""Counts per key and event-time window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tallywake.functions.chunks import CHUNK, chunk_of
from tallywake.functions.durations import interval, micros
from tallywake.functions.times import epoch_micros


# Above this many windows a row, expanding is the larger part of a sliding count.
MANY_WINDOWS = 24
# Panes of a key that one task sums.
CHUNK_PANES = 4096


def tumbling_count(df: DataFrame, ts: str, size: str, keys: Sequence[str] = (), **more: Column) -> DataFrame:
    """Rows per (keys, window) as `cnt`, and any further aggregates by name; no keys gives one count per window. A null key is
    a key. Runs on batch and stream; partial results are made before the shuffle."""
    w = F.window(ts, size)
    counted = df.groupBy(*keys, w.alias("w")).agg(F.count(F.lit(1)).alias("cnt"), *[c.alias(name) for name, c in more.items()])
    return counted.select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "cnt", *more)


def salted_count(df: DataFrame, ts: str, size: str, spread_by: Sequence[str], salts: int = 64) -> DataFrame:
    """Count per window in two steps: first per (salt, window), then summed per window end.

    The salt is a hash of columns of the row, so a task that runs again makes the same one.
    """
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).alias("salt")
    partial = df.groupBy(salt, F.window(ts, size).alias("w")).agg(F.count(F.lit(1)).alias("part"))
    total = partial.groupBy(F.col("w.end").alias("window_end")).agg(F.sum("part").alias("cnt"))
    return total.select("window_end", "cnt")


def distinct_count(df: DataFrame, ts: str, size: str, of: str, approximate: float | None = None) -> DataFrame:
    """Distinct values of a column per window. Exact by default: Spark drops duplicates per
    (window, value) on both sides of the shuffle, so one busy window is still spread over all tasks.
    `approximate` is a relative error for a sketch of fixed size instead."""
    w = F.window(ts, size)
    counter = F.count_distinct(of) if approximate is None else F.approx_count_distinct(of, approximate)
    return df.groupBy(w.alias("w")).agg(counter.alias("cnt")).select(F.col("w.end").alias("window_end"), "cnt")


def intervals_from_changes(changes: DataFrame, keys: Sequence[str], width: int, at: str = "at", delta: str = "delta") -> DataFrame:
    """Add up changes (+n at one time, -n at a later one) into stretches of constant count.

    Gives `from_end` inclusive, `to_end` exclusive and `cnt`; stretches of count 0 are left out. A key's changes are cut into
    chunks of `width` microseconds: a chunk starts from the level that the sums of the chunks before it give, so the long
    running sum is over one row a chunk, and changes are shuffled and sorted by (key, chunk).
    """
    us = epoch_micros(at)
    chunked = changes.select(*keys, at, F.col(delta).alias("_delta"), chunk_of(us, width).alias(CHUNK), F.lit(False).alias("_carried"))
    chunks = Window.partitionBy(*keys).orderBy(CHUNK)
    sums = chunked.groupBy(*keys, CHUNK).agg(F.sum("_delta").alias("_sum"))
    levels = sums.withColumn("_delta", F.sum("_sum").over(chunks.rowsBetween(Window.unboundedPreceding, -1))).where("_delta <> 0")
    # The level carried in is a change just before the chunk, so it needs no join, and null keys no care.
    start = F.timestamp_micros(F.col(CHUNK) * width - 1).cast(changes.schema[at].dataType)
    carried = levels.select(*keys, start.alias(at), "_delta", CHUNK, F.lit(True).alias("_carried"))
    by_time = Window.partitionBy(*keys, CHUNK).orderBy(at)
    running = chunked.unionByName(carried).withColumn("cnt", F.sum("_delta").over(by_time))
    # Changes at one time share a running sum, so every row but the first of them equals its predecessor.
    changed = running.withColumn("_before", F.lag("cnt", 1, 0).over(by_time)).where((F.col("cnt") != F.col("_before")) & ~F.col("_carried"))
    within = Window.partitionBy(*keys, CHUNK).orderBy(at)
    stretches = changed.withColumns({"to_end": F.lead(at).over(within), "_first": F.row_number().over(within) == 1})
    # The last stretch of a chunk goes on to the first change of a later one; of each chunk these two rows meet.
    borders = stretches.where("_first OR to_end IS NULL").withColumn(
        "_next", F.lead(at).over(Window.partitionBy(*keys).orderBy(at)))
    open_ = borders.where("to_end IS NULL").drop("to_end").withColumnRenamed("_next", "to_end")
    whole = stretches.where("to_end IS NOT NULL").unionByName(open_.select(*stretches.columns))
    return whole.where("cnt > 0").select(*keys, F.col(at).alias("from_end"), "to_end", "cnt")


def sliding_intervals(df: DataFrame, keys: Sequence[str], ts: str, size: str, slide: str,
                      first_end: str | None = None) -> DataFrame:
    """Sliding counts in compact form: for every key, the stretches of window ends with one same count.

    A row enters the windows that end from its pane's end up to `size` later, so panes turn into two
    changes each and a running sum gives the counts. Work and output grow with the panes, not with
    size / slide. A key's panes are summed in chunks of time, so a key over a long time is many tasks' work.

    `first_end`, when given, names a window-end column before which a row does not count any more
    (a late row misses the windows closed by then).
    """
    if micros(size) % micros(slide):
        raise ValueError("the window size must be a multiple of the slide")
    panes = df.groupBy(*keys, F.window(ts, slide).alias("w"), *([first_end] if first_end else [])).agg(
        F.count(F.lit(1)).alias("cnt"))
    pane_end = F.col("w.end")
    enter = F.greatest(pane_end, F.col(first_end)) if first_end else pane_end
    changes = panes.select(*keys, F.explode(F.array(
        F.struct(enter.alias("at"), F.col("cnt").alias("delta")),
        F.struct((pane_end + interval(size)).alias("at"), (-F.col("cnt")).alias("delta")),
    )).alias("c")).select(*keys, "c.at", "c.delta")
    return intervals_from_changes(changes, keys, CHUNK_PANES * micros(slide))


def expand_intervals(intervals: DataFrame, keys: Sequence[str], slide: str) -> DataFrame:
    """One row per (keys, window) from the compact form; no shuffle."""
    ends = F.sequence("from_end", F.col("to_end") - interval(slide), interval(slide))
    return intervals.select(*keys, F.explode(ends).alias("window_end"), "cnt")


def sliding_count(df: DataFrame, keys: Sequence[str], ts: str, size: str, slide: str,
                  first_end: str | None = None) -> DataFrame:
    """Rows per (keys, sliding window), one output row per window that holds any.

    With many windows a row, the stretches are small next to what they expand to, and a few keys may
    hold them all: they are dealt out over all tasks first, by key and time.
    """
    stretches = sliding_intervals(df, keys, ts, size, slide, first_end)
    if micros(size) > MANY_WINDOWS * micros(slide):
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        stretches = stretches.repartition(tasks, *keys, "from_end")
    return expand_intervals(stretches, keys, slide)


def sliding_count_sql(df: DataFrame, key: str, ts: str, size: str, slide: str) -> DataFrame:
    """Sliding count of a nullable key in SQL: pane counts first, so each pane and not each row is
    put into its size / slide windows. For small ratios."""
    return df.sparkSession.sql(
        f"""
        SELECT {key}, w.end AS window_end, sum(n) AS cnt
        FROM (
            SELECT {key}, n, window(pane, '{size}', '{slide}') AS w
            FROM (
                SELECT {key}, window({ts}, '{slide}').start AS pane, count({key}) AS n
                FROM {{events}}
                GROUP BY ALL
            )
        )
        GROUP BY {key}, w.end
        """,
        events=df,
    )
