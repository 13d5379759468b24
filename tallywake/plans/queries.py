"""The operators and jobs on the given tables.

`events` plays every source: `view` is a page view, `error` a failed login and all else a successful
one, `signup` an order and `purchase` its payment, the number in `props` an item. Its rows are hours
apart for a user, so time bounds are wider than the defaults.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywake.functions.filters import is_page
from tallywake.functions.times import (epoch_millis, next_midnight, printed, window_start, window_start_epoch)
from tallywake.operators.caps import blacklist, cap_outcomes, click_cap
from tallywake.operators.counts import distinct_count, tumbling_count
from tallywake.operators.late import tag_late
from tallywake.operators.rank import PAGE_LINE, rank_report
from tallywake.plans import jobs
from tallywake.plans.tables import events, item_events, table
from tallywake.schemas import AD_CLICK, LOGIN, MARKET, ORDER, RECEIPT, USER_BEHAVIOR
from tallywake.sources.lines import decode_access_log, decode_records, encode_records

NTZ = "timestamp_ntz"


def behavior(spark: SparkSession, folder: str) -> DataFrame:
    return item_events(spark, folder).withColumnRenamed("event_type", "behavior")


def clicks(spark: SparkSession, folder: str) -> DataFrame:
    """Clicks capped per (user, event type); the event type is the province too."""
    return events(spark, folder).select(
        "event_id", "user_id", F.col("event_type").alias("ad_id"), F.col("event_type").alias("province"), "ts")


def logins(spark: SparkSession, folder: str) -> DataFrame:
    return events(spark, folder).select("user_id", "event_type", "ts", "event_id")


def orders(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "signup", "create").when(F.col("event_type") == "purchase", "pay")
    return item_events(spark, folder).select("user_id", "item_id", "ts", "event_id", kind.alias("event_type"))


def log_lines(spark: SparkSession, folder: str) -> DataFrame:
    return log_lines_of(item_events(spark, folder))


def log_lines_of(items: DataFrame) -> DataFrame:
    """One access-log line per event, with its arrival place: up to 97 places out of order."""
    k, kind = F.col("item_id"), F.col("event_type")
    url = F.concat(F.lit("/"), kind, F.lit("/"), (k % 10).cast("string"),
                   F.element_at(F.array(*map(F.lit, [".css", ".js", ".html", ""])), (k % 4 + 1).cast("int")))
    line = F.concat_ws(
        " ", F.concat(F.lit("10.0.0."), (F.col("user_id") % 256).cast("string")), F.lit("-"),
        F.col("user_id").cast("string"), F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"), F.lit("+0000"),
        F.when(kind.isin("view", "click"), "GET").otherwise("POST"), url)
    arrival = F.col("event_id") + (F.col("event_id") * 7919) % 97
    return items.select(
        "event_id", arrival.alias("arrival"), (F.col("event_id") % 4).alias("source"), line.alias("value"))


def access_log(spark: SparkSession, folder: str) -> DataFrame:
    return decode_access_log(log_lines(spark, folder), keep=("event_id", "arrival", "source"))


def plain(df: DataFrame) -> DataFrame:
    """Event times without zone."""
    return df.select(*[F.col(f.name).cast(NTZ).alias(f.name) if f.dataType.typeName() == "timestamp" else F.col(f.name)
                       for f in df.schema.fields])


def hot_items_topn(spark, folder):
    return jobs.hot_items(behavior(spark, folder), 3, "view")


def hot_items_all(spark, folder):
    """Ranks of any depth: more than Spark limits before the shuffle."""
    return jobs.hot_items(behavior(spark, folder), 2000, "view")


def hot_items_sql(spark, folder):
    return jobs.hot_items_sql(behavior(spark, folder), 5, "view")


def rank_report_items(spark, folder):
    return rank_report(jobs.hot_items(behavior(spark, folder), 3, "view"), "item_id")


def hot_pages_topn(spark, folder):
    return plain(jobs.hot_pages(access_log(spark, folder), 5))


def rank_report_pages(spark, folder):
    return plain(rank_report(jobs.hot_pages(access_log(spark, folder), 5), "url", PAGE_LINE))


def hot_pages_by_arrival(spark, folder):
    ranks, _ = jobs.hot_pages_by_arrival(access_log(spark, folder), "source", ["arrival", "event_id"], 5,
                                         delay="4 hours", lateness="30 minutes", size="2 hours", slide="5 minutes")
    return plain(ranks)


def hot_pages_late_rows(spark, folder):
    _, late = jobs.hot_pages_by_arrival(access_log(spark, folder), "source", ["arrival", "event_id"], 5,
                                        delay="4 hours", lateness="30 minutes", size="2 hours", slide="5 minutes")
    return plain(late.select("event_id", "url", "ts", "watermark"))


def static_asset_filter(spark, folder):
    ext = F.element_at(F.array(*map(F.lit, ["css", "js", "png", "html"])), (F.col("page_id") % 4 + 1).cast("int"))
    named = table(spark, folder, "pages").select("page_id", F.concat("url", F.lit("."), ext).alias("url"))
    return named.where(is_page("url"))


def page_views_hourly(spark, folder):
    return jobs.page_views(behavior(spark, folder), "view")


def page_views_salted(spark, folder):
    return jobs.page_views(behavior(spark, folder), "view", salts=16)


def unique_visitors_hourly(spark, folder):
    return jobs.unique_visitors(behavior(spark, folder), "view")


def behavior_counts_hourly(spark, folder):
    """Count and largest value per (event type, hour): any aggregate column fits the window count."""
    return tumbling_count(events(spark, folder), "ts", "1 hour", ["event_type"], max_value=F.max("value"))


def daily_unique_users(spark, folder):
    return distinct_count(events(spark, folder), "ts", "1 day", "user_id")


def click_outcomes(spark, folder, max_count=10, reset="never"):
    return jobs.ad_outcomes(clicks(spark, folder), "event_id", max_count, reset)


def click_cap_total(spark, folder):
    return click_cap(click_outcomes(spark, folder)).select("event_id", "user_id", "ad_id", "ts")


def click_cap_large(spark, folder):
    """A cap beyond what Spark limits before the shuffle, per kind of event: outcomes of all rows up to it and the first over it."""
    rows = clicks(spark, folder)
    return cap_outcomes(rows, ["ad_id"], "ts", "event_id", 1500).select("event_id", "ad_id", "ts", "nth", "outcome")


def click_blacklist(spark, folder):
    return blacklist(click_outcomes(spark, folder), ["user_id", "ad_id"], "ts")


def click_cap_daily(spark, folder):
    return click_outcomes(spark, folder, 1, "daily").select(
        "event_id", "user_id", "ad_id", "ts", F.col("day").cast("string").alias("day"), "outcome")


def ad_clicks_sliding(spark, folder):
    return jobs.ad_clicks(click_outcomes(spark, folder))


def _actions(spark, folder):
    return item_events(spark, folder).select(
        F.concat(F.lit("c"), (F.col("item_id") % 6).cast("string")).alias("channel"),
        F.upper("event_type").alias("behavior"), "ts")


def market_by_channel(spark, folder):
    return jobs.market_counts(_actions(spark, folder), "signup")


def market_by_channel_windows(spark, folder):
    """One row a window, every hour."""
    return jobs.market_windows(_actions(spark, folder), "signup", slide="1 hour")


def login_fail_burst(spark, folder):
    return jobs.login_bursts(logins(spark, folder), "event_id", "error", 2, "24 hours")


def login_fail_burst_long(spark, folder):
    """Three failures in 2 days: windows long enough that runs of failures go through several."""
    failing = logins(spark, folder).where("event_type IN ('error', 'purchase')")
    return jobs.login_bursts(failing, "event_id", "error", 3, "2 days")


def login_fail_pair(spark, folder):
    return jobs.login_pairs(logins(spark, folder), "event_id", "error", "12 hours")


def login_fail_pair_unbounded(spark, folder):
    return jobs.login_pairs(logins(spark, folder), "event_id", "error", None)


def login_fail_pattern(spark, folder):
    return jobs.login_pattern(logins(spark, folder), "event_id", "error", "1 day")


def order_pay_pattern(spark, folder):
    return jobs.order_payments(orders(spark, folder), ["user_id"], "event_id", "1 day")


def order_lifecycle(spark, folder):
    return jobs.order_outcomes(orders(spark, folder), ["user_id", "item_id"], "3 days", "7 days")


def _payments_and_receipts(spark, folder):
    ev = item_events(spark, folder).select("user_id", "item_id", "ts", "event_id", "event_type", "value")
    pays = ev.where("event_type = 'purchase'").withColumn("event_type", F.lit("pay"))
    return pays, ev.where("event_type = 'click'").drop("event_type")


def pay_receipt_match(spark, folder):
    pays, receipts = _payments_and_receipts(spark, folder)
    return jobs.payment_receipts(pays, receipts, ["user_id", "item_id"], "event_id", "3 days", "5 days")


def pay_receipt_match_first(spark, folder):
    """One payment and one receipt per key, the earliest."""
    pays, receipts = _payments_and_receipts(spark, folder)
    return jobs.payment_receipts(pays, receipts, ["user_id", "item_id"], "event_id", "3 days", "5 days", "first")


def pay_receipt_match_users(spark, folder):
    """Keyed by user alone: many rows on both sides of a key, chunks a few hours long."""
    pays, receipts = _payments_and_receipts(spark, folder)
    return jobs.payment_receipts(pays.drop("item_id"), receipts.drop("item_id"), ["user_id"], "event_id",
                                 "10 minutes", "20 minutes")


def pay_receipt_match_pairs(spark, folder):
    """One to one, by user: every payment and receipt comes out once."""
    pays, receipts = _payments_and_receipts(spark, folder)
    return jobs.payment_receipt_pairs(pays.drop("item_id"), receipts.drop("item_id"), ["user_id"], "event_id",
                                      "12 hours", "1 day", "10 days")


def late_rows(spark, folder):
    ev = events(spark, folder).select(
        "event_id", "ts", (F.col("event_id") % 4).alias("source"),
        (F.col("event_id") + (F.col("event_id") * 7919) % 97).alias("arrival"))
    return tag_late(ev, "ts", "source", ["arrival", "event_id"], "1 hour", delay="4 hours", chunk_rows=1000)


def log_lines_parse(spark, folder):
    return plain(access_log(spark, folder).drop("arrival", "source"))


def record_lines(spark, folder):
    """Rows as comma-separated lines, as they are published to a topic."""
    rows = item_events(spark, folder).withColumn("timestamp", F.unix_seconds(F.col("ts").cast("timestamp"))).withColumn(
        "category_id", F.col("item_id") % 7)
    return encode_records(rows, ["user_id", "item_id", "category_id", "event_type", "timestamp"], keep=("event_id",))


def record_lines_parse(spark, folder):
    return plain(decode_records(record_lines(spark, folder), USER_BEHAVIOR, keep=("event_id",)))


def _through_lines(spark, folder, layout: str, unit: str = "s", where: str = "true", **columns: Column) -> DataFrame:
    """Events written as comma-separated lines of a layout and read back."""
    ts = F.col("ts").cast("timestamp")
    rows = item_events(spark, folder).where(where).select(
        "event_id", *[c.alias(n) for n, c in columns.items()], (F.unix_millis(ts) if unit == "ms" else F.unix_seconds(ts)).alias("timestamp"))
    return plain(decode_records(encode_records(rows, [*columns, "timestamp"], keep=("event_id",)), layout, keep=("event_id",)))


def record_lines_ad_clicks(spark, folder):
    return _through_lines(spark, folder, AD_CLICK, user_id=F.col("user_id"), ad_id=F.col("item_id"), province=F.col("event_type"),
                          city=F.concat(F.lit("c"), (F.col("user_id") % 3).cast("string")))


def record_lines_logins(spark, folder):
    return _through_lines(spark, folder, LOGIN, user_id=F.col("user_id"), ip=F.concat(F.lit("10.0.0."), (F.col("user_id") % 256).cast("string")),
                          event_type=F.when(F.col("event_type") == "error", "fail").otherwise("success"))


def record_lines_orders(spark, folder):
    """A created order has no transaction yet: an empty field, read as null."""
    pay = F.col("event_type") == "purchase"
    return _through_lines(spark, folder, ORDER, where="event_type IN ('signup', 'purchase')", order_id=F.col("user_id"),
                          event_type=F.when(pay, "pay").otherwise("create"), tx_id=F.when(pay, F.concat(F.lit("t"), F.col("item_id").cast("string"))))


def record_lines_receipts(spark, folder):
    return _through_lines(spark, folder, RECEIPT, where="event_type = 'click'", tx_id=F.concat(F.lit("t"), F.col("item_id").cast("string")),
                          pay_channel=F.when(F.col("user_id") % 2 == 0, "wechat").otherwise("alipay"))


def record_lines_market(spark, folder):
    """Times in milliseconds."""
    return _through_lines(spark, folder, MARKET, "ms", user_id=F.col("user_id").cast("string"), behavior=F.upper("event_type"),
                          channel=F.concat(F.lit("c"), (F.col("item_id") % 6).cast("string")))


def window_arith(spark, folder):
    ts = F.col("ts")
    return events(spark, folder).select(
        "event_id", window_start(ts, "1 hour", "15 minutes").alias("hour_start"),
        window_start_epoch(epoch_millis(ts), 0, 5_000).alias("five_second_start_ms"),
        next_midnight(ts).alias("midnight"), epoch_millis(ts).alias("ms"),
        printed(window_start(ts, "1 second")).alias("printed"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        hot_items_topn, hot_items_all, hot_items_sql, rank_report_items, hot_pages_topn, rank_report_pages, hot_pages_by_arrival,
        hot_pages_late_rows, static_asset_filter, page_views_hourly, page_views_salted, unique_visitors_hourly,
        behavior_counts_hourly, daily_unique_users, click_cap_total, click_cap_large, click_blacklist, click_cap_daily,
        ad_clicks_sliding, market_by_channel, market_by_channel_windows, login_fail_burst, login_fail_burst_long, login_fail_pair,
        login_fail_pair_unbounded, login_fail_pattern, order_pay_pattern, order_lifecycle, pay_receipt_match,
        pay_receipt_match_first, pay_receipt_match_users, pay_receipt_match_pairs, late_rows, log_lines_parse, record_lines,
        record_lines_parse, record_lines_ad_clicks, record_lines_logins, record_lines_orders, record_lines_receipts, record_lines_market,
        window_arith,
    )
}
