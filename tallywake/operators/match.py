"""Matching two event tables on a key and a time span, unmatched rows of both sides kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywake.functions.chunks import CHUNK, MARGINS_PER_CHUNK, chunk_of, with_margins
from tallywake.functions.durations import interval, micros
from tallywake.functions.times import epoch_micros

MATCHED, NO_RIGHT, NO_LEFT = "matched", "no_receipt", "no_pay"


def first_per_key(df: DataFrame, keys: list[str], ts: str, seq: str) -> DataFrame:
    """The earliest row of each key; a two-step aggregate, so a repeated key costs one row a task."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(ts, seq)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, *[F.col(f"_first.{c}").alias(c) for c in rest])


def interval_match(left: DataFrame, right: DataFrame, keys: list[str], ts: str, seq: str, before: str = "3 seconds",
                   after: str = "5 seconds", unique: str | None = None, chunk: str | None = None) -> DataFrame:
    """Full outer match: equal keys and left.ts - before <= right.ts <= left.ts + after.

    Gives the keys, both sides' other columns as `l_*` / `r_*`, and `outcome`. Both sides need `ts` and
    a `seq` that tells rows of one key and time apart. All pairs are kept unless unique='first', which
    first reduces each side to the earliest row of a key.

    The join is on (key, time chunk): a left row has one chunk, a right row is in each chunk its span
    touches, one for nearly all rows. So a key (or null) with very many rows is joined by many tasks.
    """
    if unique == "first":
        left, right = first_per_key(left, keys, ts, seq), first_per_key(right, keys, ts, seq)
    elif unique is not None:
        raise ValueError(f"unique must be None or 'first', not {unique!r}")
    back, ahead = micros(before), micros(after)
    width = micros(chunk) if chunk else MARGINS_PER_CHUNK * (back + ahead)
    l = left.select(F.struct(*left.columns).alias("l")).withColumn("l_chunk", chunk_of(epoch_micros(f"l.{ts}"), width))
    copies = with_margins(right.select(F.struct(*right.columns).alias("r"), F.col(ts).alias("_t")), "_t", width,
                          before=back, after=ahead)
    us = epoch_micros("_t")
    n_copies = chunk_of(us + F.lit(back), width) - chunk_of(us - F.lit(ahead), width) + 1
    r = copies.withColumn("n_copies", F.coalesce(n_copies, F.lit(1)))
    on = F.col("l_chunk") == F.col(CHUNK)
    for k in keys:
        on = on & (F.col(f"l.{k}") == F.col(f"r.{k}"))
    on = on & F.col(f"r.{ts}").between(F.col(f"l.{ts}") - interval(before), F.col(f"l.{ts}") + interval(after))
    joined = l.join(r, on, "full_outer")
    settled = joined.where(F.col("l").isNotNull() | (F.col("n_copies") == 1)).select("l", "r")

    # A right row with several copies is unmatched only if every copy is. Such rows, and the left rows
    # they can match, lie by a chunk border. Equal rows are counted, and come out as often as they came.
    to_border = F.pmod(epoch_micros(f"l.{ts}"), F.lit(width))
    by_border = l.where((to_border <= back + ahead) | (to_border >= width - back - ahead))
    lone = r.where("n_copies > 1").join(by_border, on, "left_anti").groupBy("r", "n_copies").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(CHUNK).alias("chunks")).where("chunks = n_copies").select(
        F.lit(None).cast(l.schema["l"].dataType).alias("l"), "r", F.explode(F.expr("sequence(1, n div n_copies)"))).select("l", "r")
    both = settled.unionByName(lone)
    outcome = (F.when(F.col("r").isNull(), NO_RIGHT).when(F.col("l").isNull(), NO_LEFT).otherwise(MATCHED))
    return both.select(
        *[F.coalesce(f"l.{k}", f"r.{k}").alias(k) for k in keys],
        *[F.col(f"l.{c}").alias(f"l_{c}") for c in left.columns if c not in keys],
        *[F.col(f"r.{c}").alias(f"r_{c}") for c in right.columns if c not in keys],
        outcome.alias("outcome"),
    )
