"""Failure bursts: too many failures of one key inside a window that its first failure opens."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from tallywake.functions.chunks import CHUNK, MARGINS_PER_CHUNK, OWN, with_margins
from tallywake.functions.durations import micros
from tallywake.functions.times import epoch_micros

# Fixed value: text of the warning.
WARNING = "说你又有不听，听你又不做，做了又做错，错了你也不认，认了还不改，改了也不服"

_NEVER = np.iinfo(np.int64).max


def failure_bursts(df: DataFrame, key: str, ts: str, seq: str, failed: Column, min_fails: int = 2,
                   within: str = "2 seconds", chunk: str | None = None) -> DataFrame:
    """Warnings (key, first_ts, last_ts, msg), one per burst, in event-time order (ts, seq).

    The first failure opens a window [t0, t0 + within]. If it ends with at least `min_fails` failures and
    no success inside, there is a warning. The next failure after the window, or after a success, opens
    another. So which failures open windows depends on all failures before them.

    All steps work on (key, time chunk) or less, so a key with very many rows is shared out:

    1. Window functions keep the runs of failures (no success between, no gap over `within`). The first
       failure of a run always opens a window, so runs do not depend on each other, and one no longer
       than `within` is a single burst. Rows other than failures go no further.
    2. Longer runs hold several bursts. Where one goes on into the next chunk, its chunk yields a table
       from the failure that opens its first window to the one that opens the next chunk's. Read off in
       order, the tables give each such chunk its first opening failure.
    3. Each chunk of a longer run steps from window to window.
    """
    span = micros(within)
    width = micros(chunk) if chunk else MARGINS_PER_CHUNK * span
    if width < 2 * span:
        raise ValueError("a chunk must be at least twice as long as the window")
    runs = _failure_runs(df, key, ts, seq, failed, span, width, min_fails)
    key_field, chunk_field = T.StructField(key, df.schema[key].dataType), T.StructField(CHUNK, T.LongType())

    single = runs.where(F.col("_single") & F.col("_opens") & F.col(OWN) & (F.col("_fails") >= min_fails) &
                        F.coalesce(F.col("_run_stop") > F.col("_us") + span, F.lit(True)))
    long = runs.where("NOT _single").select(key, CHUNK, OWN, "_us", "_seq", "_opens", "_stop")
    crosses = F.max(~F.col(OWN) & ~F.col("_opens")).over(Window.partitionBy(key, CHUNK))
    links = long.withColumn("_crosses", crosses).where("_crosses").groupBy(key, CHUNK).applyInArrow(
        _link_maker(key, span, width),
        T.StructType([key_field, chunk_field, T.StructField("upto", T.LongType()), T.StructField("exit", T.LongType())]))
    # Only streamed through: no table of a key is held longer than it takes to read its line.
    entries = links.repartition(F.col(key)).sortWithinPartitions(key, CHUNK, "upto").mapInArrow(
        _entry_reader(key), T.StructType([key_field, chunk_field, T.StructField("_entry", T.LongType())]))
    entries = entries.select(F.col(key).alias("_k"), F.col(CHUNK).alias("_c"), "_entry")
    entered = long.join(entries, F.col(key).eqNullSafe(F.col("_k")) & (F.col(CHUNK) == F.col("_c")), "left").drop(
        "_k", "_c")
    stepped = entered.groupBy(key, CHUNK).applyInArrow(
        _burst_stepper(key, span, width, min_fails),
        T.StructType([key_field, T.StructField("first_us", T.LongType()), T.StructField("last_us", T.LongType())]))

    found = single.select(key, F.col("_us").alias("first_us"), F.col("_last").alias("last_us")).unionByName(stepped)
    time_type = df.schema[ts].dataType
    return found.select(key, F.timestamp_micros("first_us").cast(time_type).alias("first_ts"),
                        F.timestamp_micros("last_us").cast(time_type).alias("last_ts"), F.lit(WARNING).alias("msg"))


def _failure_runs(df: DataFrame, key: str, ts: str, seq: str, failed: Column, span: int, width: int,
                  min_fails: int) -> DataFrame:
    """Failures in runs, per chunk plus the `span` after it.

    `_opens`: first of a run. `_stop`: time of the success right after, if within `span`. `_single`: the
    run is seen whole and lasts no longer than `span`; `_fails`, `_last` and `_run_stop` describe it.
    """
    rows = df.select(F.col(key), F.col(ts).alias("_ts"), F.col(seq).alias("_seq"),
                     F.coalesce(failed, F.lit(False)).alias("_fail"))
    rows = with_margins(rows, "_ts", width, before=span, after=2 * span).withColumn("_us", epoch_micros("_ts"))
    order = Window.partitionBy(key, CHUNK).orderBy("_ts", "_seq")
    linked_back = F.lag("_fail").over(order) & (F.col("_us") - F.lag("_us").over(order) <= span)
    next_near = F.lead("_us").over(order) - F.col("_us") <= span
    next_fail = F.lead("_fail").over(order)
    looked = rows.withColumns({
        "_opens": ~F.coalesce(linked_back, F.lit(False)),
        "_goes_on": F.coalesce(next_fail & next_near, F.lit(False)),
        "_stop": F.when(~next_fail & next_near, F.lead("_us").over(order)),
    })
    past_chunk = F.col("_us") - (F.col(CHUNK) + 1) * F.lit(width)
    kept = looked.where(F.col("_fail") & (F.col(OWN) | past_chunk.between(0, span - 1)))
    if min_fails > 1:
        kept = kept.where("NOT _opens OR _goes_on")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = Window.partitionBy(key, CHUNK, "_run")
    numbered = kept.withColumn("_run", F.sum(F.col("_opens").cast("int")).over(so_far)).withColumns({
        "_fails": F.count(F.lit(1)).over(run),
        "_last": F.max("_us").over(run),
        "_run_stop": F.max("_stop").over(run),
        # A row of the run without a next one is its end; rows before the first opening are number 0.
        "_whole": ~F.min("_goes_on").over(run) & (F.col("_run") > 0),
        "_long": F.max("_us").over(run) - F.min("_us").over(run) > span,
    })
    return numbered.withColumn("_single", F.col("_whole") & ~F.col("_long"))


def _steps(rows: pa.Table, span: int) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """Rows in order, their times, and for each the row that opens the window after the one it would open."""
    rows = rows.sort_by([("_us", "ascending"), ("_seq", "ascending")])
    us = rows["_us"].to_numpy()
    after_window = np.searchsorted(us, us + span, side="right")
    openings = np.append(np.flatnonzero(rows["_opens"].to_numpy()), len(us))
    after_run = openings[np.searchsorted(openings, np.arange(len(us)), side="right")]
    return rows, us, np.minimum(after_window, after_run)


def _settled(rows: pa.Table, us: np.ndarray, carried_until: int) -> int:
    """The first row that opens a window whatever came before the chunk: the first of a run, or the first
    that no window from before the chunk can reach."""
    return min(int(np.argmax(np.append(rows["_opens"].to_numpy(), True))),
               int(np.searchsorted(us, carried_until, side="left")))


def _result(rows: pa.Table, key: str, columns: dict[str, np.ndarray | list]) -> pa.Table:
    n = len(next(iter(columns.values())))
    keys = pa.array([rows[key][0].as_py()] * n, rows.schema.field(key).type)
    return pa.table({key: keys, **{c: pa.array(v, pa.int64()) for c, v in columns.items()}})


def _link_maker(key: str, span: int, width: int):
    def links(rows: pa.Table) -> pa.Table:
        rows, us, following = _steps(rows, span)
        chunk, n_own, n = rows[CHUNK][0].as_py(), int(rows[OWN].to_numpy().sum()), len(us)
        # Follow all rows at once until they leave the chunk; row n stands for "past the margin".
        hop = np.append(np.where(np.arange(n) < n_own, following, np.arange(n)), n)
        while (hop[hop] != hop).any():
            hop = hop[hop]
        times = np.append(us, _NEVER)
        last = _settled(rows, us, chunk * width + span)
        exits = hop[: last + 1]
        ends = np.append(np.flatnonzero(np.diff(exits)), last)
        upto = times[ends]
        upto[-1] = _NEVER
        return _result(rows, key, {CHUNK: np.full(len(ends), chunk), "upto": upto, "exit": times[exits[ends]]})

    return links


def _entry_reader(key: str):
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, handed_from, entry, read = None, None, _NEVER, False
        for batch in batches:
            keys, chunks, found = [], [], []
            for k, chunk, upto, leaves in zip(*(batch.column(c).to_pylist() for c in (key, CHUNK, "upto", "exit"))):
                if (k, chunk) != at:
                    at, read = (k, chunk), False
                    came = entry if handed_from == (k, chunk - 1) else _NEVER
                if not read and came <= upto:
                    entry, handed_from, read = leaves, at, True
                    keys.append(k)
                    chunks.append(chunk + 1)
                    found.append(leaves)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, batch.schema.field(key).type), pa.array(chunks, pa.int64()),
                 pa.array(found, pa.int64())], [key, CHUNK, "_entry"])

    return entries


def _burst_stepper(key: str, span: int, width: int, min_fails: int):
    def bursts(rows: pa.Table) -> pa.Table:
        rows, us, following = _steps(rows, span)
        n_own = int(rows[OWN].to_numpy().sum())
        stop = rows["_stop"].fill_null(_NEVER).to_numpy()
        entry = rows["_entry"][0].as_py()
        i = _settled(rows, us, rows[CHUNK][0].as_py() * width + span)
        if entry is not None:
            i = min(i, int(np.searchsorted(us, entry, side="left")))
        firsts, lasts = [], []
        while i < n_own:
            end = following[i]
            if end - i >= min_fails and stop[end - 1] > us[i] + span:
                firsts.append(us[i])
                lasts.append(us[end - 1])
            i = end
        return _result(rows, key, {"first_us": firsts, "last_us": lasts})

    return bursts
