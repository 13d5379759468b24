"""Streams give what the batch operators give, for rows in any order inside the watermark's delay."""

from __future__ import annotations

import random
import tracemalloc
from collections import Counter
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywake.operators.caps import cap_outcomes
from tallywake.operators.counts import distinct_count, expand_intervals, sliding_count, tumbling_count
from tallywake.operators.late import tag_late
from tallywake.operators.match import interval_match
from tallywake.operators.orders import followed_by, order_lifecycle
from tallywake.operators.rank import top_n
from tallywake.plans import jobs, stream_jobs
from tallywake.streaming.counts import (distinct_count_stream, salted_count_stream, sliding_count_stream,
                                        sliding_intervals_stream, tumbling_count_stream, with_event_time)
from tallywake.streaming.detectors import (Cap, Lifecycle, cap_outcomes_stream, consecutive_pattern_stream, failure_bursts_stream,
                                           followed_by_stream, order_lifecycle_stream)
from tallywake.streaming.late import NewestSoFar, sorted_rows, tag_late_stream, tagging_late
from tallywake.streaming.match import interval_match_stream
from tallywake.streaming.sinks import by_outcome, ranked, reranked, to_folder, write_stream
from tests.rows import bursts, frame, in_a_row, random_logins, seconds

YEAR = 365 * 86_400.0
DELAY = 15.0


def shuffled(rows: list[tuple], seed: int = 0) -> list[tuple]:
    """Rows in time order, then moved about by less than the delay."""
    rng = random.Random(seed)
    return [r for _, r in sorted((r[-1] + rng.uniform(0, DELAY * 0.9), r) for r in rows)]


def arrive(spark, tmp_path, rows: list[tuple], schema: str, last: tuple, files: int = 3, name: str = "in"):
    """A stream of `files` files in turn, and one with a row far ahead that closes all windows. Also
    the rows as a table."""
    whole = frame(spark, rows, schema)
    step = -(-len(rows) // files)
    folder = str(tmp_path / name)
    for i in range(files):
        part = whole.where(F.col("seq").between(i * step, (i + 1) * step - 1))
        part.coalesce(1).write.mode("append").parquet(folder)
    frame(spark, [last], schema).withColumn("seq", F.lit(10**9)).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    return stream, whole


def finish(df, tmp_path, name="out", mode="append", sink=None, checkpoint=None):
    """Run to the end of the files; the rows that came out."""
    out = str(tmp_path / name)
    query = write_stream(df, name, sink or to_folder(out), mode, checkpoint or str(tmp_path / f"{name}-state"),
                         {"availableNow": True})
    assert query.awaitTermination(240)
    return df.sparkSession.read.parquet(out)


def rows_of(df, *columns) -> Counter:
    return Counter(tuple(r) for r in df.select(*columns).collect())


LOGIN = "user_id bigint, event_type string, t double"


def failed():
    return F.col("event_type") == "fail"


def login_stream(spark, tmp_path, seed=11, p_fail=0.8):
    rows = shuffled(random_logins(seed, 6, 25, 60, p_fail))
    return rows, *arrive(spark, tmp_path, rows, LOGIN, (77, "success", YEAR))


def spans(df) -> Counter:
    return Counter((r["user_id"], round(seconds(r["first_ts"]), 6), round(seconds(r["last_ts"]), 6)) for r in df.collect())


def test_bursts(spark, tmp_path):
    rows, stream, _ = login_stream(spark, tmp_path)
    out = finish(failure_bursts_stream(stream, "user_id", "ts", "seq", failed(), 2, "2 seconds", f"{DELAY} seconds"), tmp_path)
    assert spans(out) == bursts(rows, 2, 2.0) and out.count() > 5


@pytest.mark.parametrize("n,within", [(2, None), (3, 3.0)])
def test_failures_in_a_row(spark, tmp_path, n, within):
    rows, stream, _ = login_stream(spark, tmp_path)
    text = f"{int(within)} seconds" if within else None
    out = finish(consecutive_pattern_stream(stream, "user_id", "ts", "seq", [failed()] * n, text, f"{DELAY} seconds"), tmp_path)
    assert spans(out) == in_a_row(rows, n, within) and out.count() > 5


@pytest.mark.parametrize("reset", ["never", "daily"])
def test_cap(spark, tmp_path, reset):
    rng = random.Random(5)
    rows = shuffled([(rng.randint(1, 3), rng.randint(1, 2), rng.choice("pq"), 6380 + round(rng.uniform(0, 80), 2))
                     for _ in range(120)])  # midnight at UTC+8 is at 6400
    stream, whole = arrive(spark, tmp_path, rows, "user_id bigint, ad_id bigint, city string, t double", (9, 9, "z", YEAR))
    keys = ["user_id", "ad_id"]
    capped = cap_outcomes_stream(stream, keys, "ts", "seq", 5, f"{DELAY} seconds", reset)
    sides = {v: to_folder(str(tmp_path / v)) for v in ("pass", "blacklist")}
    query = write_stream(capped, f"cap-{reset}", by_outcome(sides, to_folder(str(tmp_path / "rest"))), "append", str(tmp_path / "state"), {"availableNow": True})
    assert query.awaitTermination(240)
    want = cap_outcomes(whole, keys, "ts", "seq", 5, reset)
    columns = ["user_id", "ad_id", "city", "t", "seq", "ts", "outcome"]
    for value in sides:
        got = rows_of(spark.read.parquet(str(tmp_path / value)).where("user_id < 9"), *columns)
        assert got == rows_of(want.where(F.col("outcome") == value), *columns) and got


ORDER = "order_id bigint, event_type string, t double"


def kind(value):
    return F.col("event_type") == value


def order_rows(spark, tmp_path):
    rng = random.Random(12)
    rows = [(o, k, round(rng.uniform(0, 80), 2)) for o in range(25) for k in rng.sample(["create", "pay", "other"], rng.randint(1, 3))]
    rows += [(100, "create", 1.0), (100, "create", 2.0), (100, "pay", 5.0), (101, "create", 1.0), (101, "pay", 11.0)]
    return arrive(spark, tmp_path, shuffled(rows), ORDER, (999, "create", YEAR))


def test_followed_by(spark, tmp_path):
    stream, whole = order_rows(spark, tmp_path)
    args = (["order_id"], "ts", "seq", kind("create"), kind("pay"), "10 seconds")
    out = finish(followed_by_stream(stream, *args, delay=f"{DELAY} seconds"), tmp_path)
    columns = ["order_id", "start_ts", "then_ts", "outcome", "timeout_ts"]
    assert rows_of(out, *columns) == rows_of(followed_by(whole, *args), *columns)


def test_lifecycle(spark, tmp_path):
    stream, whole = order_rows(spark, tmp_path)
    args = (kind("create"), kind("pay"), "10 seconds", "20 seconds")
    out = finish(order_lifecycle_stream(stream, ["order_id"], "ts", "seq", *args, delay=f"{DELAY} seconds"), tmp_path)
    last = out.groupBy("order_id").agg(F.max_by(F.struct("outcome"), "batch").alias("l")).select("order_id", "l.outcome")
    want = rows_of(order_lifecycle(whole, ["order_id"], "ts", *args), "order_id", "outcome")
    assert rows_of(last, "order_id", "outcome") == want
    assert {o for _, o in want} == {"paid", "paid_late", "paid_no_create", "unpaid"}


EVENTS = "k string, user_id bigint, t double"


def event_rows(spark, tmp_path, span=120.0, n=150):
    rng = random.Random(13)
    rows = shuffled([(rng.choice("aaab"), rng.randint(1, 8), round(rng.uniform(0, span), 2)) for _ in range(n)])
    return arrive(spark, tmp_path, rows, EVENTS, ("z", 0, YEAR))


def test_tumbling_salted_and_distinct(spark, tmp_path):
    stream, whole = event_rows(spark, tmp_path)
    delay = f"{DELAY} seconds"
    got = finish(tumbling_count_stream(stream, "ts", "10 seconds", ["k"], delay), tmp_path, "a")
    assert rows_of(got, "k", "window_end", "cnt") == rows_of(tumbling_count(whole, "ts", "10 seconds", ["k"]), "k", "window_end", "cnt")
    total = rows_of(tumbling_count(whole, "ts", "10 seconds"), "window_end", "cnt")
    assert rows_of(finish(salted_count_stream(stream, "ts", "10 seconds", ["user_id"], 4, delay), tmp_path, "b"), "window_end", "cnt") == total
    got = finish(distinct_count_stream(stream, "ts", "10 seconds", "user_id", delay), tmp_path, "c")
    assert rows_of(got, "window_end", "cnt") == rows_of(distinct_count(whole, "ts", "10 seconds", "user_id"), "window_end", "cnt")


def test_sliding_top_n(spark, tmp_path):
    stream, whole = event_rows(spark, tmp_path)
    counts = sliding_count_stream(stream, ["user_id"], "ts", "30 seconds", "10 seconds", f"{DELAY} seconds")
    got = finish(counts, tmp_path, sink=ranked("user_id", 3, to_folder(str(tmp_path / "out"))))
    columns = ["window_end", "user_id", "cnt", "row_num"]
    want = top_n(sliding_count(whole, ["user_id"], "ts", "30 seconds", "10 seconds"), "user_id", 3)
    assert rows_of(got, *columns) == rows_of(want, *columns)


def test_reranked_updates_end_at_the_final_ranks(spark, tmp_path):
    stream, whole = event_rows(spark, tmp_path)
    counts = sliding_count_stream(stream, ["user_id"], "ts", "30 seconds", "10 seconds", "75 seconds")
    sink = reranked("user_id", 3, str(tmp_path / "counts"), to_folder(str(tmp_path / "out")))
    got = finish(counts, tmp_path, mode="update", sink=sink)
    newest = got.groupBy("window_end").agg(F.max("batch").alias("batch")).join(got, ["window_end", "batch"]).where("user_id > 0")
    columns = ["window_end", "user_id", "cnt", "row_num"]
    want = top_n(sliding_count(whole, ["user_id"], "ts", "30 seconds", "10 seconds"), "user_id", 3)
    assert rows_of(newest, *columns) == rows_of(want, *columns)
    assert got.count() > newest.count()


def test_sliding_with_many_windows_a_row(spark, tmp_path):
    stream, whole = event_rows(spark, tmp_path, n=60)
    found = finish(sliding_intervals_stream(stream, ["k"], "ts", "1 hour", "1 second", f"{DELAY} seconds"), tmp_path)
    got = expand_intervals(found.where("k != 'z'"), ["k"], "1 second")
    assert rows_of(got, "k", "window_end", "cnt") == rows_of(
        sliding_count(whole, ["k"], "ts", "1 hour", "1 second"), "k", "window_end", "cnt")


def test_cap_then_sliding_count_in_one_query(spark, tmp_path):
    rng = random.Random(5)
    rows = shuffled([(rng.randint(1, 3), rng.choice("pq"), round(rng.uniform(0, 80), 2)) for _ in range(60)])
    stream, whole = arrive(spark, tmp_path, rows, "user_id bigint, province string, t double", (9, "z", YEAR))
    capped = cap_outcomes_stream(stream, ["user_id"], "ts", "seq", 9, f"{DELAY} seconds").where("outcome = 'pass'")
    got = finish(sliding_intervals_stream(capped, ["province"], "ts", "10 minutes", "5 seconds", None), tmp_path)
    kept = cap_outcomes(whole, ["user_id"], "ts", "seq", 9).where("outcome = 'pass'")
    want = sliding_count(kept, ["province"], "ts", "10 minutes", "5 seconds")
    columns = ["province", "window_end", "cnt"]
    assert rows_of(expand_intervals(got.where("province != 'z'"), ["province"], "5 seconds"), *columns) == rows_of(want, *columns)


def test_match(spark, tmp_path):
    rng = random.Random(14)
    left = shuffled([(rng.choice("abcdefg"), round(rng.uniform(0, 100), 1)) for _ in range(40)], 1)
    right = shuffled([(rng.choice("abcdefh"), round(rng.uniform(0, 100), 1)) for _ in range(40)], 2)
    l_stream, l_rows = arrive(spark, tmp_path, left, "tx string, t double", ("l", YEAR), name="l")
    r_stream, r_rows = arrive(spark, tmp_path, right, "tx string, t double", ("r", YEAR), name="r")
    columns = ["tx", "outcome", "l_seq", "r_seq"]
    got = finish(interval_match_stream(l_stream, r_stream, ["tx"], "ts", delay=f"{DELAY} seconds"), tmp_path)
    want = rows_of(interval_match(l_rows, r_rows, ["tx"], "ts", "seq"), *columns)
    assert rows_of(got.where("tx NOT IN ('l', 'r')"), *columns) == want
    assert {o for _, o, _, _ in want} == {"matched", "no_receipt", "no_pay"}


def test_late_rows(spark, tmp_path):
    rng = random.Random(15)
    rows = [(rng.choice("pq"), i, round(i * 2 + rng.uniform(-60, 60), 1)) for i in range(120)]
    stream, whole = arrive(spark, tmp_path, rows, "src string, pos bigint, t double", ("z", 10**6, YEAR))
    args = ("ts", "src", ["pos"], "20 seconds", "10 seconds", "10 seconds", "5 seconds")
    columns = ["src", "pos", "t", "watermark", "is_late"]
    got = finish(tag_late_stream(stream, *args), tmp_path)
    want = rows_of(tag_late(whole, *args), *columns)
    assert rows_of(got.where("src != 'z'"), *columns) == want
    assert {r[-1] for r in want} == {True, False}


def test_late_rows_of_a_source_in_many_tasks(spark, tmp_path):
    """Small stretches over several micro-batches: the newest time goes from one to the next, and old states go."""
    rng = random.Random(16)
    rows = [(rng.choice("pppq"), i, round(i * 2 + rng.uniform(-60, 60), 1)) for i in range(120)]
    stream, whole = arrive(spark, tmp_path, rows, "src string, pos bigint, t double", ("z", 10**6, YEAR), files=4)
    columns = ["src", "pos", "t", "watermark", "is_late"]
    sink = tagging_late("ts", "src", ["pos"], "20 seconds", str(tmp_path / "newest"), to_folder(str(tmp_path / "out")), "10 seconds",
                        "10 seconds", "5 seconds", chunk_rows=7)
    got = finish(stream, tmp_path, sink=sink)
    want = rows_of(tag_late(whole, "ts", "src", ["pos"], "20 seconds", "10 seconds", "10 seconds", "5 seconds"), *columns)
    assert rows_of(got.where("src != 'z'"), *columns) == want
    assert len([f for f in (tmp_path / "newest").iterdir() if f.name.startswith("batch=")]) == 2


def test_late_requests_of_a_source_are_many_tasks_work(spark, tmp_path):
    """Two micro-batches of a log with one source give what the batch form gives, without a function per row and by stretches of rows."""
    rng = random.Random(17)
    rows = [("p", rng.choice(["GET", "POST"]), rng.choice(["/a", "/b.css"]), i, round(i * 2 + rng.uniform(-60, 60), 1)) for i in range(120)]
    log = frame(spark, rows, "src string, method string, url string, pos bigint, t double")
    windows, found, plans = ("20 seconds", "10 seconds", "10 seconds", "5 seconds"), [], []

    def sink(late, batch_id):
        found.extend(late.collect())
        plans.append(late._jdf.queryExecution().executedPlan().toString())

    each = stream_jobs.late_requests("src", ["pos"], str(tmp_path / "newest"), sink, *windows, chunk_rows=7)
    each(log.where("pos < 50"), 0)
    each(log.where("pos >= 50"), 1)
    want = jobs.page_requests(tag_late(log, "ts", "src", ["pos"], *windows)).where("is_late").collect()
    assert want and sorted(r["pos"] for r in found) == sorted(r["pos"] for r in want)
    assert {(r["pos"], r["watermark"]) for r in found} == {(r["pos"], r["watermark"]) for r in want}
    assert all("Python" not in p and "TransformWithState" not in p and "hashpartitioning(src" in p and "chunk" in p for p in plans)


def test_sorting_the_rows_of_a_source_takes_little_memory():
    def rows(n):
        return ((f"url {i} of some length", i, (i * 7919) % n) for i in range(n))

    assert list(sorted_rows(rows(1_001), lambda r: r[-1:], 100)) == sorted(rows(1_001), key=lambda r: r[-1:])
    peaks = []
    for n in (60_001, 240_007):
        tracemalloc.start()
        newest = NewestSoFar(1, ["url", "us_newest"])
        newest.newest = Value()
        assert sum(1 for _ in newest.handleInputRows(("p",), rows(n), None)) == n
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    print(peaks)
    assert peaks[1] < 1.5 * peaks[0]


class Value:
    """A value state outside Spark."""

    held = None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value


def test_restart_goes_on_from_its_checkpoint(spark, tmp_path):
    """Two runs over a growing folder give what one run over all of it gives."""
    rows = shuffled(random_logins(21, 5, 25, 60, 0.8))
    whole = frame(spark, rows, LOGIN)
    folder, state = str(tmp_path / "in"), str(tmp_path / "state")
    half = len(rows) // 2

    def run():
        stream = spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        found = failure_bursts_stream(stream, "user_id", "ts", "seq", failed(), 2, "2 seconds", f"{DELAY} seconds")
        return finish(found, tmp_path, checkpoint=state)

    whole.where(F.col("seq") < half).coalesce(1).write.mode("append").parquet(folder)
    run()
    whole.where(F.col("seq") >= half).coalesce(1).write.mode("append").parquet(folder)
    frame(spark, [(77, "success", YEAR)], LOGIN).coalesce(1).write.mode("append").parquet(folder)
    assert spans(run()) == bursts(rows, 2, 2.0)


def test_rows_past_the_watermark_are_dropped(spark, tmp_path):
    """A row is late by the watermark of the micro-batch before its own."""
    rows = [("a", 1, 0.0), ("a", 1, 500.0), ("a", 1, 600.0), ("a", 1, 3.0)]
    stream, _ = arrive(spark, tmp_path, rows, EVENTS, ("z", 0, YEAR), files=4)
    counted = with_event_time(stream, "ts", "10 seconds").groupBy(F.window("ts", "10 seconds").alias("w")).count()
    assert sum(r["count"] for r in finish(counted, tmp_path).collect()) == 3


class ListStates:
    """The lists of one state, which count the calls that would leave the process."""

    def __init__(self):
        self.lists, self.calls, self.timers, self.watermark = {}, 0, [], 0

    def getListState(self, name, schema):
        def call(change):
            def done(values=()):
                self.calls += 1
                own = self.lists.setdefault(name, [])
                own[:] = change(own, list(values))
                return iter(list(own))
            return done

        return SimpleNamespace(get=call(lambda own, _: own), put=call(lambda _, new: new), appendList=call(lambda own, new: own + new),
                               clear=call(lambda own, _: []))

    def registerTimer(self, at):
        self.calls += 1
        self.timers.append(at)

    def getCurrentWatermarkInMs(self):
        return self.watermark


@pytest.mark.parametrize("make, rows, found", [
    (lambda: Cap(1), lambda k: [(k, 2_000, 1, 0, None, "b"), (k, 1_000, 0, 0, None, "a")], lambda k: [(k, "a", "pass"), (k, "b", "blacklist")]),
    (lambda: Lifecycle(1_000, 0, 10**9), lambda k: [(k, 1_500, 1, False, True), (k, 1_000, 0, True, False)], lambda k: [(k, 1_000, 1_500, "paid")]),
])
def test_keys_that_share_a_state_share_its_calls(make, rows, found):
    """A hundred keys, a null and two NaN (one key) among them, cost as few calls as one and stay apart."""
    keys = [*range(98), None, float("nan"), float("nan")]
    handle, detector = ListStates(), make()
    detector.names, detector.key_fields = ["key", "x", "y", "z"][:len(found(0)[0])], [T.StructField("key", T.LongType())]
    detector.memory_fields = T.StructType.fromDDL(detector.memory_schema).fields
    detector.init(handle)
    given = [(0, *row) for k in keys[:-1] for row in rows(k)]
    random.Random(1).shuffle(given)
    # One row of the key NaN is another object than the others.
    given = [(0, float("nan"), *r[2:]) if r[1] != r[1] else r for r in given]
    assert list(detector.handleInputRows((0,), iter(given), handle)) == []
    handle.watermark = 3
    out = list(detector.handleExpiredTimer((0,), handle, None))
    assert Counter(map(repr, map(tuple, out))) == Counter(repr(r) for k in keys[:-1] for r in found(k))
    assert handle.calls <= 10 and handle.timers[0] == 1
    handle.watermark = 4
    assert list(detector.handleInputRows((0,), iter([(0, 5, 3_500, 9, 0, None, "c")] if make().__class__ is Cap else []), handle)) == []
