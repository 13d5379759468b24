"""Order payment within a time limit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tallywake.functions.chunks import CHUNK, OWN, with_margins
from tallywake.functions.durations import interval, micros


def followed_by(df: DataFrame, keys: Sequence[str], ts: str, seq: str, start: Column, then: Column,
                within: str = "15 minutes", chunk: str | None = None) -> DataFrame:
    """For every `start` row, the next `then` row of its key, other rows between them or not.

    Gives (keys, start_ts, then_ts, outcome, timeout_ts): 'paid' when then_ts < start_ts + within,
    else 'timeout' with the time the wait ended. A `then` row with no start before it is ignored. A key
    is cut into time chunks, four waits long: only `then` rows are copied into the chunk before theirs.
    """
    span = micros(within)
    rows = df.select(*keys, F.col(ts).alias("_ts"), F.col(seq).alias("_seq"), start.alias("_start"),
                     then.alias("_then")).where("_start OR _then")
    rows = with_margins(rows, "_ts", micros(chunk) if chunk else 4 * span, after=span, copy_if=F.col("_then"))
    # Latest first, so the frame over the rows that follow in time grows row by row.
    later = (Window.partitionBy(*keys, CHUNK).orderBy(F.desc("_ts"), F.desc("_seq"))
             .rowsBetween(Window.unboundedPreceding, -1))
    nexts = rows.withColumn("_next", F.min(F.when(F.col("_then"), F.col("_ts"))).over(later)).where(
        F.col(OWN) & F.col("_start"))
    limit = F.col("_ts") + interval(within)
    paid = F.col("_next") < limit
    return nexts.select(
        *keys,
        F.col("_ts").alias("start_ts"),
        F.when(paid, F.col("_next")).alias("then_ts"),
        F.when(paid, "paid").otherwise("timeout").alias("outcome"),
        F.when(paid, F.lit(None)).otherwise(limit).alias("timeout_ts"),
    )


def order_lifecycle(df: DataFrame, keys: Sequence[str], ts: str, created: Column, paid: Column,
                    limit: str = "15 minutes", late_grace: str = "1 day") -> DataFrame:
    """One outcome per order from its first create and first pay, whichever order they arrive in.

    paid: in the limit. paid_late: after it, within the grace. unpaid: neither. paid_no_create: the pay
    has no create at or before it. Two minima a key, so partial results are made before the shuffle.
    """
    firsts = df.where(created | paid).groupBy(*keys).agg(
        F.min(F.when(created, F.col(ts))).alias("create_ts"), F.min(F.when(paid, F.col(ts))).alias("pay_ts"))
    return firsts.withColumn("outcome", lifecycle_outcome(F.col("create_ts"), F.col("pay_ts"), limit, late_grace))


def lifecycle_outcome(create_ts: Column, pay_ts: Column, limit: str, late_grace: str) -> Column:
    deadline = create_ts + interval(limit)
    return (F.when(create_ts.isNull() | (pay_ts < create_ts), "paid_no_create")
            .when(pay_ts < deadline, "paid")
            .when(pay_ts <= deadline + interval(late_grace), "paid_late")
            .otherwise("unpaid"))
