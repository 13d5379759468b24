"""The end-to-end jobs, from typed event rows to results. Defaults are the usual settings of each job.

Every job takes and gives DataFrames, so a source of any kind can be put in front of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywake.functions.durations import interval
from tallywake.functions.filters import is_page, not_equal
from tallywake.operators.bursts import failure_bursts
from tallywake.operators.caps import cap_outcomes
from tallywake.operators.consecutive import consecutive_pattern
from tallywake.operators.counts import (distinct_count, salted_count, sliding_count, sliding_count_sql,
                                        sliding_intervals, tumbling_count)
from tallywake.operators.late import first_open_end, tag_late
from tallywake.operators.match import interval_match
from tallywake.operators.orders import followed_by, order_lifecycle
from tallywake.operators.pairs import pair_match
from tallywake.operators.rank import top_n, top_n_sql


# Texts of the warnings of two and of three failed logins in a row.
PAIR_WARNING = "login fail 2 times in 2s"
PATTERN_WARNING = "login fail"


def hot_items(behavior: DataFrame, n: int = 3, viewed: str = "pv") -> DataFrame:
    """Most viewed items of the last hour, every 5 minutes."""
    views = behavior.where(F.col("behavior") == viewed)
    return top_n(sliding_count(views, ["item_id"], "ts", "1 hour", "5 minutes"), "item_id", n)


def hot_items_sql(behavior: DataFrame, n: int = 5, viewed: str = "pv") -> DataFrame:
    """`hot_items` written in SQL."""
    views = behavior.select("item_id", "behavior", "ts").where(F.col("behavior") == viewed)
    return top_n_sql(sliding_count_sql(views, "item_id", "ts", "1 hour", "5 minutes"), "item_id", n)


def is_page_request() -> Column:
    """Whether a log row asks for a page with GET; static assets are none."""
    return is_page("url") & (F.col("method") == "GET")


def page_requests(log: DataFrame) -> DataFrame:
    return log.where(is_page_request())


def hot_pages(log: DataFrame, n: int = 5) -> DataFrame:
    """Most requested pages of the last 10 minutes, every 5 seconds."""
    return top_n(sliding_count(page_requests(log), ["url"], "ts", "10 minutes", "5 seconds"), "url", n)


def hot_pages_by_arrival(log: DataFrame, source: str, position: Sequence[str], n: int = 5, delay: str = "10 seconds",
                         lateness: str = "1 minute", size: str = "10 minutes",
                         slide: str = "5 seconds") -> tuple[DataFrame, DataFrame]:
    """`hot_pages` for rows in the order they arrived: (final ranks, late rows). A row counts in those
    of its windows that are still open; with none open it is late."""
    seen = tag_late(log, "ts", source, position, size, slide, delay, lateness)
    requests = page_requests(seen)
    on_time = requests.where(~F.col("is_late")).select("url", "ts", first_open_end(slide, lateness).alias("_open"))
    ranks = top_n(sliding_count(on_time, ["url"], "ts", size, slide, first_end="_open"), "url", n)
    return ranks, requests.where("is_late")


def page_views(behavior: DataFrame, viewed: str = "pv", salts: int | None = None) -> DataFrame:
    """Views per hour; `salts` counts in two steps over a salted key."""
    views = behavior.where(F.col("behavior") == viewed)
    if salts:
        return salted_count(views, "ts", "1 hour", ["user_id"], salts)
    return tumbling_count(views, "ts", "1 hour").select("window_end", "cnt")


def unique_visitors(behavior: DataFrame, viewed: str = "pv", approximate: float | None = None) -> DataFrame:
    """Distinct viewing users per hour."""
    return distinct_count(behavior.where(F.col("behavior") == viewed), "ts", "1 hour", "user_id", approximate)


def ad_outcomes(clicks: DataFrame, seq: str = "seq", max_count: int = 20, reset: str = "never") -> DataFrame:
    """Ad clicks within each (user, ad)'s cap, and the first one over it, told apart by `outcome`."""
    return cap_outcomes(clicks, ["user_id", "ad_id"], "ts", seq, max_count, reset)


def ad_clicks(outcomes: DataFrame) -> DataFrame:
    """Clicks within the cap per province, of the last hour, every 5 seconds."""
    return sliding_count(outcomes.where("outcome = 'pass'"), ["province"], "ts", "1 hour", "5 seconds")


def market_counts(behavior: DataFrame, dropped: str = "uninstall", ignore_case: bool = True, size: str = "1 day",
                  slide: str = "5 seconds") -> DataFrame:
    """Actions per (channel, behaviour) of the last day, every 5 seconds, as stretches of window ends
    (see `sliding_intervals`; `market_windows` gives one row a window)."""
    kept = behavior.where(not_equal("behavior", dropped, ignore_case))
    return sliding_intervals(kept, ["channel", "behavior"], "ts", size, slide)


def market_windows(behavior: DataFrame, dropped: str = "uninstall", ignore_case: bool = True, size: str = "1 day",
                   slide: str = "5 seconds") -> DataFrame:
    """`market_counts` with one row per window: window_start, window_end, channel, behavior, cnt."""
    counts = sliding_count(behavior.where(not_equal("behavior", dropped, ignore_case)), ["channel", "behavior"], "ts", size, slide)
    return counts.select((F.col("window_end") - interval(size)).alias("window_start"), "window_end", "channel", "behavior", "cnt")


def login_bursts(logins: DataFrame, seq: str = "seq", fail: str = "fail", min_fails: int = 2,
                 within: str = "2 seconds") -> DataFrame:
    return failure_bursts(logins, "user_id", "ts", seq, F.col("event_type") == fail, min_fails, within)


def login_pairs(logins: DataFrame, seq: str = "seq", fail: str = "fail", within: str | None = "2 seconds") -> DataFrame:
    """Two failures in a row; `within=None` sets no time bound."""
    failed = F.col("event_type") == fail
    return consecutive_pattern(logins, "user_id", "ts", seq, [failed, failed], within).withColumn("msg", F.lit(PAIR_WARNING))


def login_pattern(logins: DataFrame, seq: str = "seq", fail: str = "fail", within: str = "3 seconds") -> DataFrame:
    """Three failures in a row."""
    failed = F.col("event_type") == fail
    return consecutive_pattern(logins, "user_id", "ts", seq, [failed, failed, failed], within).withColumn("msg", F.lit(PATTERN_WARNING))


def order_payments(orders: DataFrame, keys: Sequence[str] = ("order_id",), seq: str = "seq",
                   within: str = "15 minutes") -> DataFrame:
    """Each created order's next payment, or its timeout."""
    kind = F.col("event_type")
    return followed_by(orders, keys, "ts", seq, kind == "create", kind == "pay", within)


def order_outcomes(orders: DataFrame, keys: Sequence[str] = ("order_id",), limit: str = "15 minutes",
                   late_grace: str = "1 day") -> DataFrame:
    """One outcome per order."""
    kind = F.col("event_type")
    return order_lifecycle(orders, keys, "ts", kind == "create", kind == "pay", limit, late_grace)


def payment_receipts(orders: DataFrame, receipts: DataFrame, keys: Sequence[str] = ("tx_id",), seq: str = "seq",
                     before: str = "3 seconds", after: str = "5 seconds", unique: str | None = None) -> DataFrame:
    """Payments and receipts of one transaction, with the lone ones of both sides."""
    pays = orders.where(F.col("event_type") == "pay").drop("event_type")
    return interval_match(pays, receipts, list(keys), "ts", seq, before, after, unique)


def payment_receipt_pairs(orders: DataFrame, receipts: DataFrame, keys: Sequence[str] = ("tx_id",), seq: str = "seq",
                          before: str = "3 seconds", after: str = "5 seconds", chunk: str | None = None) -> DataFrame:
    """`payment_receipts` one to one: each payment with the receipt that has waited longest, each receipt with the payment."""
    pays = orders.where(F.col("event_type") == "pay").drop("event_type")
    return pair_match(pays, receipts, list(keys), "ts", seq, before, after, chunk)
