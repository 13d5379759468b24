"""Top-N per window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tallywake.functions.times import printed
from tallywake.session import stored

# The wording of the printed rank reports.
RULE = "==================================\n"
TIME_LABEL = "时间:"
ITEM_LINE = "No%d:商品ID=%s浏览量=%d\n"
PAGE_LINE = "No%d:URL=%s\t热度=%d\n"


# Up to here Spark limits ranks in each task before the shuffle (spark.sql.optimizer.windowGroupLimitThreshold).
LIMIT_BEFORE_SHUFFLE = 1000


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], out: str) -> DataFrame:
    """`out`: the place of each row within its keys by the order, from 1, for keys of any size.

    Rows are dealt by range of (keys, order) and numbered within their range; the rows of the ranges before are added. So
    a key with very many rows is shared by many tasks, and what is ordered of a key as a whole is one row per range.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(df.repartitionByRange(parts, *keys, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    own = F.row_number().over(Window.partitionBy(*keys, "_range").orderBy(*order))
    sizes = dealt.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.withColumn("_before", F.sum("_n").over(earlier)).where("_before IS NOT NULL").drop("_n")
    before = before.select(*[F.col(c).alias(f"_b_{c}") for c in (*keys, "_range")], "_before")
    same = F.lit(True)
    for c in (*keys, "_range"):
        same = same & F.col(c).eqNullSafe(F.col(f"_b_{c}"))
    met = dealt.withColumn("_own", own).join(before, same, "left")
    return met.select(*df.columns, (F.col("_own") + F.coalesce("_before", F.lit(0))).alias(out))


def top_n(counts: DataFrame, key: str, n: int, window_end: str = "window_end", cnt: str = "cnt") -> DataFrame:
    """The n largest counts of each window end, as `row_num` 1..n; equal counts are ordered by key.

    Spark limits each map task to its own top n of every window before the shuffle, so a window is
    ranked from n rows a task and never gathered whole. For n too large for that the rows are numbered by range.
    """
    if n >= LIMIT_BEFORE_SHUFFLE:
        place = numbered(counts, [window_end], [F.desc(cnt), F.asc(key)], "row_num")
        return place.where(F.col("row_num") <= n).withColumn("row_num", F.col("row_num").cast("int"))
    order = Window.partitionBy(window_end).orderBy(F.desc(cnt), F.asc(key))
    return counts.withColumn("row_num", F.row_number().over(order)).where(F.col("row_num") <= n)


def top_n_sql(counts: DataFrame, key: str, n: int) -> DataFrame:
    """`top_n` as SQL text."""
    return counts.sparkSession.sql(
        f"""
        SELECT {key}, window_end, cnt, row_num
        FROM (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, {key}) AS row_num FROM {{counts}})
        WHERE row_num <= {int(n)}
        """,
        counts=counts,
    )


def rank_report(ranked: DataFrame, key: str, line: str = ITEM_LINE, window_end: str = "window_end") -> DataFrame:
    """One text block per window from `top_n` rows: rule, time, a line per rank, rule.

    A block joins at most n lines, the n of the ranking it is made from.
    """
    lines = ranked.withColumn("line", F.format_string(line, "row_num", F.col(key).cast("string"), "cnt"))
    joined: Column = F.expr("listagg(line, '') WITHIN GROUP (ORDER BY row_num)")
    return lines.groupBy(window_end).agg(joined.alias("body")).select(
        window_end,
        F.concat(F.lit(RULE + TIME_LABEL), printed(window_end), F.lit("\n"), "body", F.lit(RULE)).alias("report"),
    )
