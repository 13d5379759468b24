from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallywake.operators import counts
from tallywake.operators.bursts import failure_bursts
from tallywake.operators.caps import blacklist, cap_outcomes, click_cap
from tallywake.operators.consecutive import consecutive_pattern
from tallywake.operators.counts import (distinct_count, expand_intervals, salted_count, sliding_count,
                                        sliding_count_sql, sliding_intervals, tumbling_count)
from tallywake.operators.late import first_open_end, tag_late
from tallywake.operators.match import interval_match
from tallywake.operators.orders import followed_by, order_lifecycle
from tallywake.operators.rank import PAGE_LINE, rank_report, top_n, top_n_sql
from tests.rows import BASE, at, bursts, frame, in_a_row, random_logins, seconds, sliding

LOGIN = "user_id bigint, event_type string, t double"


def failed():
    return F.col("event_type") == "fail"


def spans(df) -> Counter:
    return Counter((r["user_id"], round(seconds(r["first_ts"]), 6), round(seconds(r["last_ts"]), 6))
                   for r in df.collect())


# ---- counts

def test_sliding_count_against_each_row_in_each_window(spark):
    rng = random.Random(3)
    rows = [(rng.choice("abbbbb"), round(rng.uniform(0, 400), 2)) for _ in range(300)] + [("a", 40.0), ("c", 0.0)]
    df = frame(spark, rows, "k string, t double")
    for size, slide in ((60, 5), (20, 20), (3600, 60)):
        want = sliding(rows, size, slide)
        got = {(r["k"], int(seconds(r["window_end"]))): r["cnt"]
               for r in sliding_count(df, ["k"], "ts", f"{size} seconds", f"{slide} seconds").collect()}
        assert got == want
        sql = sliding_count_sql(df, "k", "ts", f"{size} seconds", f"{slide} seconds")
        assert {(r["k"], int(seconds(r["window_end"]))): r["cnt"] for r in sql.collect()} == want


def test_sliding_day_by_five_seconds(spark):
    rows = [("a", 1.0), ("a", 2.0), ("a", 86_400.0 + 3), ("a", 3 * 86_400.0), ("b", 7.0)]
    df = frame(spark, rows, "k string, t double")
    stretches = sliding_intervals(df, ["k"], "ts", "1 day", "5 seconds")
    got = sorted((r["k"], seconds(r["from_end"]), seconds(r["to_end"]), r["cnt"]) for r in stretches.collect())
    day = 86_400
    assert got == [
        ("a", 5, day + 5, 2), ("a", day + 5, 2 * day + 5, 1), ("a", 3 * day + 5, 4 * day + 5, 1), ("b", 10, day + 10, 1)]
    assert expand_intervals(stretches, ["k"], "5 seconds").count() == 4 * day // 5
    want = sliding([(k, t) for k, t in rows], day, 5)
    assert sum(want.values()) == expand_intervals(stretches, ["k"], "5 seconds").agg(F.sum("cnt")).first()[0]


def test_window_must_be_a_multiple_of_the_slide(spark):
    with pytest.raises(ValueError):
        sliding_intervals(frame(spark, [("a", 1.0)], "k string, t double"), ["k"], "ts", "10 seconds", "3 seconds")


def test_tumbling_edges_and_empty_hours(spark):
    hour = 3600 - BASE % 3600  # the first full hour after BASE
    df = frame(spark, [(1, hour - 0.001), (1, float(hour)), (2, hour + 10.0), (2, hour + 3 * 3600.0)], "u bigint, t double")
    got = {int(seconds(r["window_end"])): r["cnt"] for r in tumbling_count(df, "ts", "1 hour").collect()}
    assert got == {hour: 1, hour + 3600: 2, hour + 4 * 3600: 1}
    salted = {int(seconds(r["window_end"])): r["cnt"] for r in salted_count(df, "ts", "1 hour", ["u"], 8).collect()}
    assert salted == got
    users = {int(seconds(r["window_end"])): r["cnt"] for r in distinct_count(df, "ts", "1 hour", "u").collect()}
    assert users == {hour: 1, hour + 3600: 2, hour + 4 * 3600: 1}


def test_sql_count_skips_null_keys(spark):
    df = frame(spark, [(None, 0.0), (4, 0.0)], "item_id bigint, t double")
    got = {(r["item_id"], r["cnt"]) for r in sliding_count_sql(df, "item_id", "ts", "10 seconds", "5 seconds").collect()}
    assert got == {(4, 1), (None, 0)}


# ---- ranking

def test_top_n_breaks_ties_by_key_and_reports(spark):
    df = spark.createDataFrame([("w", k, c) for k, c in ((3, 5), (1, 5), (2, 9), (4, 5))], "window string, item bigint, cnt bigint")
    df = df.withColumn("window_end", F.timestamp_seconds(F.lit(BASE)))
    top = top_n(df, "item", 3)
    assert [(r["item"], r["row_num"]) for r in top.orderBy("row_num").collect()] == [(2, 1), (1, 2), (3, 3)]
    assert sorted(map(tuple, top_n_sql(df.drop("window"), "item", 3).collect())) == sorted(
        map(tuple, top.select("item", "window_end", "cnt", "row_num").collect()))
    rule = "==================================\n"
    assert rank_report(top, "item").first()["report"] == (
        f"{rule}时间:2023-11-14 22:13:20.0\nNo1:商品ID=2浏览量=9\nNo2:商品ID=1浏览量=5\nNo3:商品ID=3浏览量=5\n{rule}")
    pages = rank_report(top, "item", PAGE_LINE).first()["report"]
    assert "No1:URL=2\t热度=9\n" in pages


# ---- click cap

def test_cap_and_blacklist(spark):
    rows = [(1, 7, float(i)) for i in range(25)] + [(2, 7, float(i)) for i in range(20)] + [(3, 7, float(i)) for i in range(21)]
    random.Random(1).shuffle(rows)
    out = cap_outcomes(frame(spark, rows, "user_id bigint, ad_id bigint, t double"), ["user_id", "ad_id"], "ts", "seq", 20)
    kept = Counter(r["user_id"] for r in click_cap(out).collect())
    assert kept == {1: 20, 2: 20, 3: 20}
    assert max(r["t"] for r in click_cap(out).collect()) == 19.0
    warned = {(r["user_id"], seconds(r["ts"])) for r in blacklist(out, ["user_id", "ad_id"], "ts").collect()}
    assert warned == {(1, 20.0), (3, 20.0)}


def test_cap_starts_afresh_at_local_midnight(spark):
    midnight = 16 * 3600 - BASE % 86_400 + 86_400  # 16:00 UTC is midnight at UTC+8
    rows = [(1, 7, midnight + d) for d in (-2.0, -1.0, 0.0, 1.0, 2.0)]
    df = frame(spark, rows, "user_id bigint, ad_id bigint, t double")
    daily = cap_outcomes(df, ["user_id", "ad_id"], "ts", "seq", 2, reset="daily")
    assert click_cap(daily).count() == 4
    assert [seconds(r["ts"]) - midnight for r in blacklist(daily, ["user_id", "ad_id"], "ts").collect()] == [2.0]
    assert click_cap(cap_outcomes(df, ["user_id", "ad_id"], "ts", "seq", 2)).count() == 2


def test_cap_is_limited_before_the_shuffle(spark, capsys):
    df = frame(spark, [(1, 7, 0.0)], "user_id bigint, ad_id bigint, t double")
    cap_outcomes(df, ["user_id", "ad_id"], "ts", "seq", 20).explain()
    plan = capsys.readouterr().out
    assert "WindowGroupLimit" in plan and plan.index("Exchange") < plan.rindex("WindowGroupLimit")


# ---- login failures

def test_bursts_cases(spark):
    rows = [
        (1, "fail", 0.0), (1, "fail", 2.0),                                              # ends included
        (2, "fail", 0.0), (2, "fail", 2.1),                                              # too far apart
        (3, "fail", 0.0), (3, "fail", 1.0), (3, "success", 2.0),                         # cancelled
        (4, "fail", 0.0), (4, "fail", 1.0), (4, "success", 2.1),                         # success too late to cancel
        *[(5, "fail", float(i)) for i in range(8)],                                      # several windows in a run
        (6, "fail", 0.0), (6, "success", 0.5), (6, "fail", 1.0), (6, "fail", 1.5),       # afresh after a success
        (7, "success", 0.0), (7, "fail", 1.0),
    ]
    got = spans(failure_bursts(frame(spark, rows, LOGIN), "user_id", "ts", "seq", failed()))
    assert got == Counter({(1, 0.0, 2.0): 1, (4, 0.0, 1.0): 1, (5, 0.0, 2.0): 1, (5, 3.0, 5.0): 1, (5, 6.0, 7.0): 1,
                           (6, 1.0, 1.5): 1})


@pytest.mark.parametrize("seed,p_fail,min_fails,chunk", [
    (1, 0.95, 2, "4 seconds"), (2, 1.0, 3, "5 seconds"), (3, 0.6, 2, "4 seconds"), (4, 0.9, 1, "7 seconds"),
    (5, 0.98, 4, None), (6, 0.8, 2, "4 seconds"), (7, 0.7, 2, "5 seconds")])
def test_bursts_over_many_chunks(spark, seed, p_fail, min_fails, chunk):
    """Runs much longer than a chunk, and one user with most of the rows."""
    rows = random_logins(seed, 120, 60, 60, p_fail) + [
        (999, k, t) for _, k, t in random_logins(seed + 50, 1, 1, 1, 1) for t in
        [round(random.Random(seed * 1000 + i).uniform(0, 90), 2) for i in range(400)]]
    got = spans(failure_bursts(frame(spark, rows, LOGIN), "user_id", "ts", "seq", failed(), min_fails, "2 seconds", chunk))
    assert got == bursts(rows, min_fails, 2.0)


@pytest.mark.parametrize("within", [2.0, 5.0, None])
def test_failures_in_a_row(spark, within):
    rows = random_logins(8, 30, 80, 120, 0.7)
    df = frame(spark, rows, LOGIN)
    text = f"{int(within)} seconds" if within else None
    for n in (2, 3, 4):
        for chunk in ("7 seconds", None):
            got = spans(consecutive_pattern(df, "user_id", "ts", "seq", [failed()] * n, text, chunk))
            assert got == in_a_row(rows, n, within), (n, chunk)


# ---- orders

ORDER = "order_id bigint, event_type string, t double"


def test_order_payment_times(spark):
    rows = [
        (1, "create", 0.0), (1, "pay", 899.0), (2, "create", 0.0), (2, "pay", 900.0), (3, "create", 5.0),
        (4, "create", 0.0), (4, "create", 100.0), (4, "pay", 950.0), (5, "pay", 3.0), (5, "create", 4.0),
        (6, "create", 0.0), (6, "other", 1.0), (6, "pay", 2.0), (6, "pay", 3.0), (7, "create", 0.0), (7, "pay", 90_000.0),
    ]
    random.Random(2).shuffle(rows)
    df = frame(spark, rows, ORDER)
    for chunk in (None, "1000 seconds"):
        got = followed_by(df, ["order_id"], "ts", "seq", F.col("event_type") == "create", F.col("event_type") == "pay",
                          chunk=chunk)
        seen = {(r["order_id"], seconds(r["start_ts"])): (r["outcome"], seconds(r["then_ts"] or r["timeout_ts"]))
                for r in got.collect()}
        assert seen == {
            (1, 0): ("paid", 899), (2, 0): ("timeout", 900), (3, 5): ("timeout", 905), (4, 0): ("timeout", 900),
            (4, 100): ("paid", 950), (5, 4): ("timeout", 904), (6, 0): ("paid", 2), (7, 0): ("timeout", 900)}
    got = order_lifecycle(df, ["order_id"], "ts", F.col("event_type") == "create", F.col("event_type") == "pay")
    assert {r["order_id"]: r["outcome"] for r in got.collect()} == {
        1: "paid", 2: "paid_late", 3: "unpaid", 4: "paid_late", 5: "paid_no_create", 6: "paid", 7: "unpaid"}


def test_next_payment_of_a_hot_order(spark):
    rng = random.Random(6)
    rows = [(rng.choice([1, 1, 1, 2]), rng.choice(["create", "pay", "other"]), round(rng.uniform(0, 900), 1)) for _ in range(500)]
    got = followed_by(frame(spark, rows, ORDER), ["order_id"], "ts", "seq", F.col("event_type") == "create",
                      F.col("event_type") == "pay", "10 seconds", "25 seconds")
    events = sorted((o, t, i, k) for i, (o, k, t) in enumerate(rows))
    want = Counter()
    for i, (o, t, _, k) in enumerate(events):
        if k == "create":
            pay = next((u for p, u, _, q in events[i + 1:] if p == o and q == "pay"), None)
            want[(o, t, pay if pay is not None and pay < t + 10 - 1e-9 else None)] += 1
    assert Counter((r["order_id"], round(seconds(r["start_ts"]), 6),
                    round(seconds(r["then_ts"]), 6) if r["then_ts"] else None) for r in got.collect()) == want


# ---- matching

def test_match_against_nested_loops(spark):
    """Spans that cross chunk borders, repeated keys, null keys and times, a key with most rows."""
    rng = random.Random(9)
    left = [(rng.choice(["x", "x", "x", "y", "z", None]), float(rng.randint(0, 200))) for _ in range(150)]
    right = [(rng.choice(["x", "x", "x", "y", "w", None]), float(rng.randint(0, 200))) for _ in range(150)] + [("x", None)]
    pays, receipts = frame(spark, left, "tx string, t double"), frame(spark, right, "tx string, t double")
    got = interval_match(pays.drop("t"), receipts.drop("t"), ["tx"], "ts", "seq", chunk="16 seconds")
    pairs = {(i, j) for i, (k, t) in enumerate(left) for j, (m, u) in enumerate(right)
             if k is not None and k == m and u is not None and t - 3 <= u <= t + 5}
    want = Counter([("matched", i, j) for i, j in pairs]
                   + [("no_receipt", i, None) for i in set(range(len(left))) - {i for i, _ in pairs}]
                   + [("no_pay", None, j) for j in set(range(len(right))) - {j for _, j in pairs}])
    assert Counter((r["outcome"], r["l_seq"], r["r_seq"]) for r in got.collect()) == want


def test_match_bounds_and_first(spark):
    pays = frame(spark, [("a", 10.0), ("b", 10.0), ("c", 10.0), ("d", 10.0), ("e", 10.0), ("e", 40.0)], "tx string, t double")
    receipts = frame(spark, [("a", 7.0), ("b", 15.0), ("c", 6.0), ("d", 16.0), ("e", 41.0)], "tx string, t double")
    got = interval_match(pays, receipts, ["tx"], "ts", "seq")
    assert Counter((r["tx"], r["outcome"]) for r in got.collect()) == Counter({
        ("a", "matched"): 1, ("b", "matched"): 1, ("c", "no_receipt"): 1, ("c", "no_pay"): 1, ("d", "no_receipt"): 1,
        ("d", "no_pay"): 1, ("e", "matched"): 1, ("e", "no_receipt"): 1})
    first = interval_match(pays, receipts, ["tx"], "ts", "seq", unique="first")
    assert Counter(r["outcome"] for r in first.where("tx = 'e'").collect()) == {"no_receipt": 1, "no_pay": 1}


def test_match_keeps_repeated_rows(spark):
    """Equal receipts by a chunk border and away from it, matched and lone, come out as often as they came."""
    pays = frame(spark, [("a", 15.0), ("b", 40.0)], "tx string, t double")
    times = [16.0, 16.0, 31.0, 31.0, 31.0, 24.0, 24.0]
    receipts = frame(spark, [("a", t) for t in times], "tx string, t double").withColumn("seq", F.lit(0))
    got = interval_match(pays, receipts, ["tx"], "ts", "seq", chunk="16 seconds")
    found = Counter((r["outcome"], r["r_t"]) for r in got.collect())
    assert found == {("matched", 16.0): 2, ("no_pay", 31.0): 3, ("no_pay", 24.0): 2, ("no_receipt", None): 1}


# ---- late rows

def test_late_rows_against_a_walk(spark):
    rng = random.Random(4)
    rows = [(rng.choice("ppq"), i, round(i * 2 + rng.uniform(-80, 80), 1)) for i in range(300)]
    df = frame(spark, rows, "src string, pos bigint, t double")
    tagged = tag_late(df, "ts", "src", ["pos"], "60 seconds", "20 seconds", "10 seconds", "5 seconds", chunk_rows=17)
    tagged = tagged.withColumn("open", first_open_end("20 seconds", "5 seconds"))
    newest, want, counts = {}, {}, Counter()
    for src, pos, t in rows:
        mark = newest[src] - 10 if src in newest else None
        ends = [e - BASE for e in range(int((t + BASE) // 20) * 20 + 20, int((t + BASE) // 20) * 20 + 61, 20)]
        open_ends = [e for e in ends if mark is None or e - 0.001 + 5 > mark + 1e-9]
        want[pos] = not open_ends
        for e in open_ends:
            counts[(src, e)] += 1
        newest[src] = max(newest.get(src, t), t)
    assert {r["pos"]: r["is_late"] for r in tagged.collect()} == want
    assert 0 < sum(want.values()) < 300
    on_time = tagged.where("NOT is_late")
    got = sliding_count(on_time, ["src"], "ts", "60 seconds", "20 seconds", first_end="open")
    assert {(r["src"], int(seconds(r["window_end"]))): r["cnt"] for r in got.collect()} == counts


def test_times_helper_agrees(spark):
    assert seconds(at(2.5)) == 2.5


def test_sliding_counts_over_many_chunks(spark, monkeypatch):
    """Chunks of a few panes, keys with gaps of whole chunks and a null key: the same stretches as in one chunk."""
    rng = random.Random(8)
    rows = [(rng.choice(["a", "a", "b", None]), round(rng.choice([0, 5000, 5100]) + rng.uniform(0, 400), 1)) for _ in range(300)]
    df = frame(spark, rows, "k string, t double")
    whole = Counter(tuple(r) for r in counts.sliding_intervals(df, ["k"], "ts", "1 minute", "10 seconds").collect())
    monkeypatch.setattr(counts, "CHUNK_PANES", 3)
    cut = Counter(tuple(r) for r in counts.sliding_intervals(df, ["k"], "ts", "1 minute", "10 seconds").collect())
    assert cut == whole and len({r[0] for r in whole}) == 3
    expanded = Counter(tuple(r) for r in counts.sliding_count(df, ["k"], "ts", "1 minute", "10 seconds").collect())
    w = F.window("ts", "1 minute", "10 seconds").alias("w")
    want = df.groupBy("k", w).agg(F.count(F.lit(1)).alias("cnt")).select("k", "w.end", "cnt")
    assert expanded == Counter(tuple(r) for r in want.collect())


def test_limits_beyond_what_spark_limits(spark):
    rows = spark.range(6000).select(
        (F.col("id") % 2).alias("k"), F.col("id").alias("seq"), F.timestamp_seconds((F.col("id") * 7919) % 3001).alias("ts"))
    got = cap_outcomes(rows, ["k"], "ts", "seq", 2500)
    nth = F.row_number().over(Window.partitionBy("k").orderBy("ts", "seq"))
    want = rows.withColumn("nth", nth).where("nth <= 2501")
    assert Counter(tuple(r) for r in got.select("k", "seq", "nth").collect()) == Counter(tuple(r) for r in want.select("k", "seq", "nth").collect())
    assert got.where("outcome = 'blacklist'").count() == 2
    counted = rows.select(F.col("seq").alias("item"), (F.col("seq") % 97).alias("cnt"), F.col("k").alias("window_end"))
    place = F.row_number().over(Window.partitionBy("window_end").orderBy(F.desc("cnt"), "item"))
    best = counted.withColumn("row_num", place).where("row_num <= 2000")
    assert Counter(tuple(r) for r in top_n(counted, "item", 2000).collect()) == Counter(tuple(r) for r in best.collect())
