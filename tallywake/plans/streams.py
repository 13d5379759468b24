"""The jobs as streams over the given tables, run to the end of what is there.

A stream gives only what its watermark has made final, so the end of the input has to be told: after the table a closing
row comes, far ahead in time, which moves the watermark and is no part of any result. So each stream gives what its
batch job gives, the last windows and waits included.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywake.plans import queries as batch
from tallywake.plans import stream_jobs as jobs
from tallywake.plans.tables import table
from tallywake.session import checkpoint_root
from tallywake.sources.lines import decode_access_log
from tallywake.streaming.event_time import after_watermark, with_event_time
from tallywake.streaming.late import tagging_late
from tallywake.streaming.sinks import EachBatch, by_outcome, ranked, to_folder, write_stream

CLOSING = "TIMESTAMP '2999-12-31 00:00:00'"
# The closing row's event_id; those of the table are not negative.
CLOSING_ID = -1

Source = Callable[[], DataFrame]


def run(spark: SparkSession, folder: str, build: Callable[[Source], DataFrame], mode: str = "append",
        through: Callable[[str, EachBatch], EachBatch] | None = None, files: int | None = None) -> DataFrame:
    """Run the stream that `build` makes of the table `events` to its end; its output as a table, `batch` being the
    micro-batch of a row. `through` puts a step before the sink, given a scratch folder; `files` is the most files of a micro-batch.

    First all files are taken. Then the closing row is put in a folder the stream watches as well, and the query goes on from its
    checkpoint: the row can so be in no micro-batch before the last.
    """
    home = f"{checkpoint_root(spark)}/run-{uuid.uuid4().hex}"
    given = table(spark, folder, "events")
    closing = spark.range(1).select(*[F.expr({
        "event_id": str(CLOSING_ID), "ts": CLOSING, "event_type": "'closing'", "props": "'{\"k\": 0}'"}.get(f.name, "0")).cast(
        f.dataType).alias(f.name) for f in given.schema.fields])
    closing.limit(0).write.parquet(f"{home}/closing")

    def source() -> DataFrame:
        # The pattern takes a file as well as a folder of files.
        reader = spark.readStream.schema(given.schema)
        most = {"maxFilesPerTrigger": files} if files else {}
        rows = reader.options(**most).parquet(f"{folder}/events.parque[t]").unionByName(reader.parquet(f"{home}/closing"))
        return rows.withColumn("item_id", F.get_json_object("props", "$.k").cast("bigint"))

    sink = to_folder(f"{home}/out")
    stream = build(source)
    for last in (False, True):
        if last:
            closing.write.mode("append").parquet(f"{home}/closing")
        write_stream(stream, f"run-{uuid.uuid4().hex}", through(f"{home}/scratch", sink) if through else sink, mode, f"{home}/state",
                     {"availableNow": True}).awaitTermination()
    return batch.plain(spark.read.parquet(f"{home}/out"))


def timed(rows: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """The rows of the table, with the watermark of all rows, the closing one included."""
    return after_watermark(with_event_time(rows, "ts", delay), "ts", F.col("event_id") != CLOSING_ID)


def behavior(source: Source) -> DataFrame:
    return timed(source()).withColumnRenamed("event_type", "behavior")


def orders(source: Source) -> DataFrame:
    kind = F.when(F.col("event_type") == "signup", "create").when(F.col("event_type") == "purchase", "pay")
    return timed(source()).withColumn("event_type", kind)


def stream_hot_items_topn(spark, folder):
    out = run(spark, folder, lambda ev: jobs.item_counts(behavior(ev), "view", None), through=lambda _, sink: ranked("item_id", 3, sink))
    return out.select("item_id", "window_end", "cnt", "row_num")


def stream_hot_pages_topn(spark, folder):
    """Ranks as windows end, and again with every late row; those last shown."""
    out = run(spark, folder, lambda ev: jobs.page_ranks(decode_access_log(batch.log_lines_of(ev())), 5))
    last = out.groupBy("window_end").agg(F.max("batch").alias("batch"))
    return out.join(last, ["window_end", "batch"]).select("url", "window_end", "cnt", "row_num")


def stream_page_views_hourly(spark, folder):
    return run(spark, folder, lambda ev: jobs.page_views(behavior(ev), "view", delay=None)).drop("batch")


def stream_page_views_salted(spark, folder):
    return run(spark, folder, lambda ev: jobs.page_views(behavior(ev), "view", 16, None)).drop("batch")


def stream_unique_visitors_hourly(spark, folder):
    return run(spark, folder, lambda ev: jobs.unique_visitors(behavior(ev), "view", None)).drop("batch")


def _outcomes(source: Source, max_count: int = 10, reset: str = "never") -> DataFrame:
    clicks = timed(source()).select(
        "event_id", "user_id", F.col("event_type").alias("ad_id"), F.col("event_type").alias("province"), "ts")
    return jobs.ad_outcomes(clicks, "event_id", max_count, reset, None)


def stream_click_outcomes(spark, folder):
    return run(spark, folder, _outcomes).select("event_id", "user_id", "ad_id", "ts", "outcome")


def stream_click_sides(spark, folder):
    """Each outcome in a sink of its own; rows without an outcome, here those of one kind, in the sink for the rest."""
    def outcomes(source: Source) -> DataFrame:
        return _outcomes(source).withColumn("outcome", F.when(F.col("ad_id") != "signup", F.col("outcome")))

    def sides(_: str, sink: EachBatch) -> EachBatch:
        def to(side: str, place: int) -> EachBatch:
            return lambda rows, batch_id: sink(rows.withColumn("side", F.lit(side)), 3 * batch_id + place)

        return by_outcome({"pass": to("clicks", 0), "blacklist": to("warnings", 1)}, to("others", 2))

    return run(spark, folder, outcomes, through=sides).select("event_id", "ts", "outcome", "side")


def stream_click_cap_daily(spark, folder):
    """One click a day (UTC+8) of each user and kind, and the first one over it."""
    out = run(spark, folder, lambda ev: _outcomes(ev, 1, "daily"))
    return out.select("event_id", "user_id", "ad_id", "ts", "outcome")


def stream_ad_clicks_sliding(spark, folder):
    """Cap and sliding counts in one query, in compact form."""
    return run(spark, folder, lambda ev: jobs.ad_clicks(_outcomes(ev))).drop("batch")


def stream_market_by_channel(spark, folder):
    def counts(source: Source) -> DataFrame:
        channel = F.concat(F.lit("c"), (F.col("item_id") % 6).cast("string")).alias("channel")
        return jobs.market_counts(timed(source()).select(channel, F.upper("event_type").alias("behavior"), "ts"), "signup", delay=None)

    return run(spark, folder, counts).drop("batch")


def stream_login_fail_burst(spark, folder):
    return run(spark, folder, lambda ev: jobs.login_bursts(timed(ev(), "3 seconds"), "event_id", "error", 2, "24 hours", None)).drop("batch")


def stream_login_fail_pair(spark, folder):
    return run(spark, folder, lambda ev: jobs.login_pairs(timed(ev(), "3 seconds"), "event_id", "error", "12 hours", None)).drop("batch")


def stream_login_fail_pattern(spark, folder):
    return run(spark, folder, lambda ev: jobs.login_pattern(timed(ev(), "3 seconds"), "event_id", "error", "1 day", None)).drop("batch")


def stream_order_pay_pattern(spark, folder):
    return run(spark, folder, lambda ev: jobs.order_payments(orders(ev), ["user_id"], "event_id", "1 day", None)).drop("batch")


def stream_order_lifecycle(spark, folder):
    """The last outcome given for each order."""
    found = run(spark, folder, lambda ev: jobs.order_outcomes(
        orders(ev), ["user_id", "item_id"], "event_id", "3 days", "7 days", None, "60 days"))
    last = found.groupBy("user_id", "item_id").agg(
        F.max_by(F.struct("create_ts", "pay_ts", "outcome"), "batch").alias("last"))
    return last.select("user_id", "item_id", "last.*")


def _sides(source: Source, *columns: str) -> tuple[DataFrame, DataFrame]:
    """Payments (of all orders) and receipts, as two streams of the table."""
    receipts = after_watermark(timed(source()), "ts", F.col("event_type") == "click")
    return orders(source).select(*columns, "event_type"), receipts.select(*columns)


def stream_pay_receipt_match(spark, folder):
    return run(spark, folder, lambda ev: jobs.payment_receipts(
        *_sides(ev, "user_id", "item_id", "ts", "event_id"), ["user_id", "item_id"], "3 days", "5 days", None)).drop("batch")


def stream_pay_receipt_pairs(spark, folder):
    """One to one, by user."""
    return run(spark, folder, lambda ev: jobs.payment_receipt_pairs(
        *_sides(ev, "user_id", "ts", "event_id", "value"), ["user_id"], "event_id", "12 hours", "1 day", None)).drop("batch")


def stream_late_rows(spark, folder):
    """Every row with its source's watermark at its arrival; a source is worked on by many tasks."""
    def arrivals(source: Source) -> DataFrame:
        return source().where(F.col("event_id") != CLOSING_ID).select(
            "event_id", "ts", (F.col("event_id") % 4).alias("source"),
            (F.col("event_id") + (F.col("event_id") * 7919) % 97).alias("arrival"))

    return run(spark, folder, arrivals, through=lambda scratch, sink: tagging_late(
        "ts", "source", ["arrival", "event_id"], "1 hour", scratch, sink, delay="4 hours", chunk_rows=1000)).drop("batch")


def stream_late_requests(spark, folder):
    """Page requests that arrive after all their windows are closed."""
    def log(source: Source) -> DataFrame:
        lines = batch.log_lines_of(source().where(F.col("event_id") != CLOSING_ID))
        return decode_access_log(lines, keep=("event_id", "arrival", "source"))

    out = run(spark, folder, log, through=lambda scratch, sink: jobs.late_requests(
        "source", ["arrival", "event_id"], scratch, sink, "2 hours", "5 minutes", "4 hours", "30 minutes"))
    return out.select("event_id", "url", "ts", "watermark")


STREAMS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        stream_hot_items_topn, stream_hot_pages_topn, stream_page_views_hourly, stream_page_views_salted,
        stream_unique_visitors_hourly, stream_click_outcomes, stream_click_sides, stream_click_cap_daily, stream_ad_clicks_sliding, stream_market_by_channel,
        stream_login_fail_burst, stream_login_fail_pair, stream_login_fail_pattern, stream_order_pay_pattern,
        stream_order_lifecycle, stream_pay_receipt_match, stream_pay_receipt_pairs, stream_late_rows, stream_late_requests,
    )
}
