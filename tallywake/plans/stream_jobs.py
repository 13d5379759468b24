"""The end-to-end jobs as streams, from typed event rows to the final results of each.

The same jobs as in `jobs`, each with its usual watermark delay. What a job gives is appended once the
watermark has passed it. `delay=None` keeps a watermark set before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallywake.functions.filters import not_equal
from tallywake.operators.rank import ITEM_LINE, PAGE_LINE, rank_report
from tallywake.plans.jobs import PAIR_WARNING, PATTERN_WARNING, is_page_request, page_requests
from tallywake.schemas import USER_BEHAVIOR
from tallywake.sources.lines import decode_records
from tallywake.streaming.counts import (distinct_count_stream, salted_count_stream, sliding_count_stream,
                                        sliding_intervals_stream, tumbling_count_stream)
from tallywake.streaming.detectors import (cap_outcomes_stream, consecutive_pattern_stream, failure_bursts_stream,
                                           followed_by_stream, order_lifecycle_stream)
from tallywake.streaming.event_time import after_watermark, with_event_time
from tallywake.streaming.late import tagging_late
from tallywake.streaming.match import interval_match_stream
from tallywake.streaming.pairs import pair_match_stream
from tallywake.streaming.refiring import refiring_counts, refiring_ranks
from tallywake.streaming.sinks import EachBatch, ranked, to_console, write_stream


def _when(df: DataFrame, condition: Column, delay: str | None) -> DataFrame:
    """The rows that meet the condition; all rows move the watermark."""
    return after_watermark(with_event_time(df, "ts", delay), "ts", condition)


def _viewed(behavior: DataFrame, viewed: str, delay: str | None) -> DataFrame:
    return _when(behavior, F.col("behavior") == viewed, delay)


def item_counts(behavior: DataFrame, viewed: str = "pv", delay: str | None = "0 seconds") -> DataFrame:
    """Views per item of the last hour, every 5 minutes; rank them with `sinks.ranked`."""
    return sliding_count_stream(_viewed(behavior, viewed, delay), ["item_id"], "ts", "1 hour", "5 minutes", None)


def page_counts(log: DataFrame, size: str = "10 minutes", slide: str = "5 seconds", delay: str | None = "10 seconds") -> DataFrame:
    """Requests per page of the last 10 minutes, every 5 seconds. With update mode, a delay longer by
    the allowed lateness and `sinks.reranked`, ranks follow every late row."""
    return sliding_count_stream(_when(log, is_page_request(), delay), ["url"], "ts", size, slide, None)


def page_ranks(log: DataFrame, n: int = 5, size: str = "10 minutes", slide: str = "5 seconds", delay: str | None = "10 seconds",
               lateness: str = "1 minute") -> DataFrame:
    """Most requested pages of the last 10 minutes, every 5 seconds: the ranks of a window when it ends, and again in
    each micro-batch with late requests of up to a minute. The newest micro-batch of a window has its last ranks."""
    counts = refiring_counts(_when(log, is_page_request(), delay), ["url"], "ts", size, slide, lateness)
    return refiring_ranks(counts, "url", n, lateness)


def late_requests(source: str, position: Sequence[str], state_folder: str, sink: EachBatch, size: str = "10 minutes",
                  slide: str = "5 seconds", delay: str = "10 seconds", lateness: str = "1 minute", chunk_rows: int = 1_000_000) -> EachBatch:
    """Requests whose windows were all closed when they arrived, from micro-batches of the log; many tasks work on a source."""
    # All rows move the watermark, also those that are no page requests.
    return tagging_late("ts", source, position, size, state_folder, lambda tagged, batch_id: sink(
        page_requests(tagged).where("is_late"), batch_id), slide, delay, lateness, chunk_rows)


def page_views(behavior: DataFrame, viewed: str = "pv", salts: int | None = None, delay: str | None = "0 seconds") -> DataFrame:
    views = _viewed(behavior, viewed, delay)
    if salts:
        return salted_count_stream(views, "ts", "1 hour", ["user_id"], salts, None)
    return tumbling_count_stream(views, "ts", "1 hour", delay=None).select("window_end", "cnt")


def unique_visitors(behavior: DataFrame, viewed: str = "pv", delay: str | None = "0 seconds") -> DataFrame:
    return distinct_count_stream(_viewed(behavior, viewed, delay), "ts", "1 hour", "user_id", None)


def ad_outcomes(clicks: DataFrame, seq: str = "seq", max_count: int = 20, reset: str = "never",
                delay: str | None = "0 seconds") -> DataFrame:
    return cap_outcomes_stream(clicks, ["user_id", "ad_id"], "ts", seq, max_count, delay, reset)


def ad_clicks(outcomes: DataFrame) -> DataFrame:
    """Clicks within the cap per province, of the last hour, every 5 seconds, in compact form."""
    kept = outcomes.where("outcome = 'pass'")
    return sliding_intervals_stream(kept, ["province"], "ts", "1 hour", "5 seconds", None)


def market_counts(behavior: DataFrame, dropped: str = "uninstall", ignore_case: bool = True,
                  delay: str | None = "0 seconds") -> DataFrame:
    kept = _when(behavior, not_equal("behavior", dropped, ignore_case), delay)
    return sliding_intervals_stream(kept, ["channel", "behavior"], "ts", "1 day", "5 seconds", None)


def login_bursts(logins: DataFrame, seq: str = "seq", fail: str = "fail", min_fails: int = 2,
                 within: str = "2 seconds", delay: str | None = "3 seconds") -> DataFrame:
    return failure_bursts_stream(logins, "user_id", "ts", seq, F.col("event_type") == fail, min_fails, within, delay)


def login_pairs(logins: DataFrame, seq: str = "seq", fail: str = "fail", within: str | None = "2 seconds",
                delay: str | None = "3 seconds") -> DataFrame:
    failed = F.col("event_type") == fail
    return consecutive_pattern_stream(logins, "user_id", "ts", seq, [failed] * 2, within, delay).withColumn("msg", F.lit(PAIR_WARNING))


def login_pattern(logins: DataFrame, seq: str = "seq", fail: str = "fail", within: str = "3 seconds",
                  delay: str | None = "3 seconds") -> DataFrame:
    failed = F.col("event_type") == fail
    return consecutive_pattern_stream(logins, "user_id", "ts", seq, [failed] * 3, within, delay).withColumn("msg", F.lit(PATTERN_WARNING))


def order_payments(orders: DataFrame, keys: Sequence[str] = ("order_id",), seq: str = "seq",
                   within: str = "15 minutes", delay: str | None = "0 seconds") -> DataFrame:
    kind = F.col("event_type")
    return followed_by_stream(orders, keys, "ts", seq, kind == "create", kind == "pay", within, delay)


def order_outcomes(orders: DataFrame, keys: Sequence[str] = ("order_id",), seq: str = "seq", limit: str = "15 minutes",
                   late_grace: str = "1 day", delay: str | None = "0 seconds", remember: str = "7 days") -> DataFrame:
    kind = F.col("event_type")
    return order_lifecycle_stream(orders, keys, "ts", seq, kind == "create", kind == "pay", limit, late_grace, delay,
                                  remember)


def payment_receipts(orders: DataFrame, receipts: DataFrame, keys: Sequence[str] = ("tx_id",),
                     before: str = "3 seconds", after: str = "5 seconds", delay: str | None = "0 seconds") -> DataFrame:
    return interval_match_stream(_pays(orders, delay), with_event_time(receipts, "ts", delay), list(keys), "ts", before, after, None)


def _pays(orders: DataFrame, delay: str | None) -> DataFrame:
    return _when(orders, F.col("event_type") == "pay", delay).drop("event_type")


def payment_receipt_pairs(orders: DataFrame, receipts: DataFrame, keys: Sequence[str] = ("tx_id",), seq: str = "seq",
                          before: str = "3 seconds", after: str = "5 seconds", delay: str | None = "0 seconds") -> DataFrame:
    """`payment_receipts` one to one, see operators.pairs."""
    return pair_match_stream(_pays(orders, delay), with_event_time(receipts, "ts", delay), list(keys), "ts", seq, before, after, None)


def reported(key: str, n: int, line: str, sink: EachBatch) -> EachBatch:
    """Rank each micro-batch and hand on one text block per window."""
    return ranked(key, n, lambda ranks, batch_id: sink(rank_report(ranks, key, line), batch_id))


def start_hot_items(lines: DataFrame, n: int = 3, sink: EachBatch | None = None) -> StreamingQuery:
    """From lines of a topic or folder to printed top-n reports."""
    counts = item_counts(decode_records(lines, USER_BEHAVIOR))
    return write_stream(counts, "hot-items", reported("item_id", n, ITEM_LINE, sink or to_console("hot-items")))


def start_hot_pages(log: DataFrame, n: int = 5, sink: EachBatch | None = None) -> StreamingQuery:
    """From access-log rows to top-n reports that follow late rows for a minute."""
    sink = sink or to_console("hot-pages")
    return write_stream(page_ranks(log, n), "hot-pages", lambda ranks, batch_id: sink(rank_report(ranks, "url", PAGE_LINE), batch_id))
