"""Strictly contiguous event patterns of one key: n rows in a row, each meeting its own condition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tallywake.functions.chunks import CHUNK, MARGINS_PER_CHUNK, OWN, chunk_of, with_margins
from tallywake.functions.durations import micros
from tallywake.functions.times import epoch_micros


def consecutive_pattern(df: DataFrame, key: str, ts: str, seq: str, conditions: Sequence[Column],
                        within: str | None = None, chunk: str | None = None) -> DataFrame:
    """Every run of len(conditions) neighbouring rows of a key that meets the conditions in order.

    Rows are ordered by (ts, seq); overlapping matches are all reported, as (key, first_ts, last_ts).
    `within` asks for last_ts - first_ts < within. A key's rows are cut into time chunks, so that no
    task gets more of it than one chunk.
    """
    meets = [F.coalesce(c, F.lit(False)).alias(f"_is{i}") for i, c in enumerate(conditions)]
    rows = df.select(F.col(key), F.col(ts).alias("_ts"), F.col(seq).alias("_seq"), *meets)
    back = len(meets) - 1
    if within is None:
        return _unbounded(rows, key, back, micros(chunk or "1 hour"))
    span = micros(within)
    rows = with_margins(rows, "_ts", micros(chunk) if chunk else MARGINS_PER_CHUNK * span, before=span)
    matched = _looked_back(rows, Window.partitionBy(key, CHUNK).orderBy("_ts", "_seq"), back).where(OWN)
    close = epoch_micros("_ts") - epoch_micros("_first") < span
    return _matches(matched.where(close), key, back)


def _looked_back(rows: DataFrame, order, back: int) -> DataFrame:
    """Add `_first`, the time `back` rows ago, and whether each of those rows met its condition."""
    cols = {f"_was{i}": F.lag(f"_is{i}", back - i).over(order) for i in range(back)}
    return rows.withColumns({**cols, "_first": F.lag("_ts", back).over(order)})


def _matches(looked: DataFrame, key: str, back: int) -> DataFrame:
    hit = F.col(f"_is{back}") & F.col("_first").isNotNull()
    for i in range(back):
        hit = hit & F.col(f"_was{i}")
    return looked.where(hit).select(key, F.col("_first").alias("first_ts"), F.col("_ts").alias("last_ts"))


def _unbounded(rows: DataFrame, key: str, back: int, width: int) -> DataFrame:
    """Without a time bound the rows before may lie in any earlier chunk. Rows past the first `back` of
    their chunk find them inside it. The others find them among the first and last `back` rows of all
    chunks of the key, which is a small part of a key with many rows a chunk."""
    rows = rows.withColumn(CHUNK, chunk_of(epoch_micros("_ts"), width))
    in_chunk = Window.partitionBy(key, CHUNK).orderBy("_ts", "_seq")
    placed = _looked_back(rows, in_chunk, back).withColumns({
        "_from_start": F.row_number().over(in_chunk),
        # The row `back` places on exists in this chunk unless the row is one of the last `back`.
        "_is_tail": F.lead("_ts", back).over(in_chunk).isNull(),
    })
    inside = placed.where(F.col("_from_start") > back)
    edges = placed.where((F.col("_from_start") <= back) | F.col("_is_tail"))
    across = _looked_back(edges, Window.partitionBy(key).orderBy("_ts", "_seq"), back).where(
        F.col("_from_start") <= back)
    return _matches(inside, key, back).unionByName(_matches(across, key, back))
