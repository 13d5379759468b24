"""Small inputs written for the tests, and plain-Python readings of the rules to check against."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE = 1_700_000_000  # 2023-11-14 22:13:20 UTC


def at(second: float) -> datetime:
    return datetime.fromtimestamp(BASE, timezone.utc).replace(tzinfo=None) + timedelta(seconds=second)


def seconds(ts: datetime) -> float:
    return (ts - at(0)).total_seconds()


def frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Rows whose `t` column is seconds after BASE, with `ts` made from it and `seq` the line number."""
    rows = [(*r, i) for i, r in enumerate(rows)]
    df = spark.createDataFrame(rows, schema + ", seq bigint")
    return df.withColumn("ts", F.timestamp_micros((F.lit(BASE * 1_000_000) + F.round(F.col("t") * 1_000_000)).cast("bigint")))


def random_logins(seed: int, users: int, events: int, span: float, p_fail: float) -> list[tuple]:
    """(user_id, event_type, t) with fractions of a second, equal times and long runs of failures."""
    rng = random.Random(seed)
    rows = []
    for user in range(users):
        for _ in range(rng.randint(1, events)):
            t = rng.choice([round(rng.uniform(0, span), 1), float(rng.randint(0, int(span)))])
            rows.append((user, "fail" if rng.random() < p_fail else "success", t))
    rng.shuffle(rows)
    return rows


def by_user(rows: list[tuple]) -> dict[int, list[tuple]]:
    """Rows of each user as (t, seq, event_type) in order."""
    users = defaultdict(list)
    for seq, (user, kind, t) in enumerate(rows):
        users[user].append((t, seq, kind))
    return {u: sorted(r) for u, r in users.items()}


def bursts(rows: list[tuple], min_fails: int, within: float) -> Counter:
    """The burst rule, one event after another."""
    found = Counter()
    for user, events in by_user(rows).items():
        fails: list[float] = []
        for t, _, kind in [*events, (float("inf"), 0, "success")]:
            if fails and t > fails[0] + within + 1e-9:
                if len(fails) >= min_fails:
                    found[(user, fails[0], fails[-1])] += 1
                fails = []
            fails = [*fails, t] if kind == "fail" else []
    return found


def in_a_row(rows: list[tuple], n: int, within: float | None) -> Counter:
    found = Counter()
    for user, events in by_user(rows).items():
        for i in range(n - 1, len(events)):
            part = events[i - n + 1: i + 1]
            close = within is None or part[-1][0] - part[0][0] < within - 1e-9
            if close and all(kind == "fail" for _, _, kind in part):
                found[(user, part[0][0], part[-1][0])] += 1
    return found


def sliding(rows: list[tuple], size: int, slide: int) -> Counter:
    """Counts of (key, window end in seconds after BASE) for (key, t) rows."""
    counts = Counter()
    for key, t in rows:
        start = int((t + BASE) // slide) * slide
        while start > t + BASE - size:
            counts[(key, start + size - BASE)] += 1
            start -= slide
    return counts
