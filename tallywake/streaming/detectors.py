"""The keyed detectors on streams. Each gives what its batch operator gives, once the watermark has passed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywake.functions.durations import micros
from tallywake.operators.bursts import WARNING
from tallywake.streaming.in_order import InOrder, in_order


class Cap(InOrder):
    """Counts the rows of a key, or of its day: `ends` is when the day is over and nothing need be remembered."""

    memory_schema = "n bigint, day bigint, ends bigint"
    start = (0, 0, None)

    def __init__(self, max_count: int):
        self.max_count = max_count

    def step(self, memory, row):
        n, day, _ = memory
        if row[2] != day:
            n, day = 0, row[2]
        n += 1
        if n > self.max_count + 1:
            return (self.max_count + 1, day, row[3]), []
        return (n, day, row[3]), [(*row[4:], "pass" if n <= self.max_count else "blacklist")]

    def passed(self, memory, us):
        return (self.start if memory[2] is not None and us >= memory[2] else memory), []

    def wake(self, memory, us):
        return memory[2]


def cap_outcomes_stream(df: DataFrame, keys: Sequence[str], ts: str, seq: str, max_count: int, delay: str | None = "0 seconds",
                        reset: str = "never", zone: str = "Asia/Shanghai") -> DataFrame:
    """Batch form: operators.caps.cap_outcomes. `ts` keeps its watermark. With `reset='daily'` a key is forgotten at the end of
    each of its days."""
    day, ends = F.lit(0), F.lit(None)
    if reset == "daily":
        utc = F.col(ts).cast("timestamp_ntz")
        date = F.convert_timezone(F.lit("UTC"), F.lit(zone), utc).cast("date")
        day = F.unix_date(date)
        over = F.convert_timezone(F.lit(zone), F.lit("UTC"), F.date_add(date, 1).cast("timestamp_ntz"))
        ends = F.unix_micros(over.cast("timestamp"))
    elif reset != "never":
        raise ValueError(f"reset must be 'never' or 'daily', not {reset!r}")
    names = [c for c in df.columns if c not in keys and c != ts]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*names).schema.fields)
    seen = [day.cast("bigint").alias("_day"), ends.cast("bigint").alias("_ends"), *map(F.col, names)]
    return in_order(df, keys, ts, seq, delay, seen, Cap, max_count, results=f"{fields}, `{ts}` timestamp, outcome string", event_time=ts)


class Bursts(InOrder):
    memory_schema = "opened bigint, last bigint, n int"
    start = (None, None, 0)

    def __init__(self, min_fails: int, span: int):
        self.min_fails, self.span = min_fails, span

    def step(self, memory, row):
        us, failed = row[0], row[2]
        memory, results = self.passed(memory, us - 1)
        if not failed:
            return self.start, results
        opened, _, n = memory
        return (us if opened is None else opened, us, n + 1), results

    def passed(self, memory, us):
        opened, last, n = memory
        if opened is None or us < opened + self.span:
            return memory, []
        return self.start, [(opened, last)] if n >= self.min_fails else []

    def wake(self, memory, us):
        return None if memory[0] is None else memory[0] + self.span


def failure_bursts_stream(df: DataFrame, key: str, ts: str, seq: str, failed: Column, min_fails: int = 2,
                          within: str = "2 seconds", delay: str | None = "3 seconds") -> DataFrame:
    """Batch form: operators.bursts.failure_bursts."""
    found = in_order(df, [key], ts, seq, delay, [F.coalesce(failed, F.lit(False)).alias("_fail")], Bursts, min_fails,
                     micros(within), results="first_us bigint, last_us bigint")
    return found.select(key, F.timestamp_micros("first_us").alias("first_ts"),
                        F.timestamp_micros("last_us").alias("last_ts"), F.lit(WARNING).alias("msg"))


class Consecutive(InOrder):
    memory_schema = "times array<bigint>, marks array<bigint>"
    start = ([], [])

    def __init__(self, length: int, span: int | None):
        self.length, self.span = length, span

    def step(self, memory, row):
        times, marks = [*memory[0], row[0]][-self.length:], [*memory[1], row[2]][-self.length:]
        fits = len(times) == self.length and all(mark >> i & 1 for i, mark in enumerate(marks))
        if fits and (self.span is None or times[-1] - times[0] < self.span):
            return (times, marks), [(times[0], times[-1])]
        return (times, marks), []

    def passed(self, memory, us):
        # Rows that no later one can be near enough to.
        return (self.start if self.span is not None and memory[0] and us >= memory[0][-1] + self.span else memory), []

    def wake(self, memory, us):
        return memory[0][-1] + self.span if self.span is not None and memory[0] else None


def consecutive_pattern_stream(df: DataFrame, key: str, ts: str, seq: str, conditions: Sequence[Column],
                               within: str | None = None, delay: str | None = "3 seconds") -> DataFrame:
    """Batch form: operators.consecutive.consecutive_pattern."""
    marks = F.lit(0)
    for i, condition in enumerate(conditions):
        marks = marks + F.when(condition, 1 << i).otherwise(0)
    found = in_order(df, [key], ts, seq, delay, [marks.cast("bigint").alias("_marks")], Consecutive, len(conditions),
                     None if within is None else micros(within), results="first_us bigint, last_us bigint")
    return found.select(key, F.timestamp_micros("first_us").alias("first_ts"),
                        F.timestamp_micros("last_us").alias("last_ts"))


class FollowedBy(InOrder):
    memory_schema = "waiting array<bigint>"
    start = ([],)

    def __init__(self, span: int):
        self.span = span

    def step(self, memory, row):
        us, starts, follows = row[0], row[2], row[3]
        waiting, results = list(memory[0]), []
        if follows:
            results = [(s, us if us < s + self.span else None) for s in waiting]
            waiting = []
        if starts:
            waiting.append(us)
        return (waiting,), results

    def passed(self, memory, us):
        over = [s for s in memory[0] if s + self.span <= us]
        return ([s for s in memory[0] if s + self.span > us],), [(s, None) for s in over]

    def wake(self, memory, us):
        return min(memory[0]) + self.span if memory[0] else None


def followed_by_stream(df: DataFrame, keys: Sequence[str], ts: str, seq: str, start: Column, then: Column,
                       within: str = "15 minutes", delay: str | None = "0 seconds") -> DataFrame:
    """Batch form: operators.orders.followed_by."""
    span = micros(within)
    found = in_order(df, keys, ts, seq, delay, [start.alias("_start"), then.alias("_then")], FollowedBy, span,
                     results="start_us bigint, then_us bigint", only=start | then)
    paid = F.col("then_us").isNotNull()
    return found.select(
        *keys, F.timestamp_micros("start_us").alias("start_ts"), F.timestamp_micros("then_us").alias("then_ts"),
        F.when(paid, "paid").otherwise("timeout").alias("outcome"),
        F.when(~paid, F.timestamp_micros(F.col("start_us") + span)).alias("timeout_ts"))


class Lifecycle(InOrder):
    """Remembers the first create and pay, and the outcome last given ('' before any). The earliest of each is all that counts,
    so no row is held: a time ahead of the watermark is remembered and not yet looked at."""

    memory_schema = "created bigint, paid bigint, given string"
    start = (None, None, "")

    def __init__(self, limit: int, grace: int, remember: int):
        self.limit, self.grace, self.remember = limit, grace, remember

    def taken(self, memory, rows, us):
        created, paid, given = memory
        for row in rows:
            if row[2] and (created is None or row[0] < created):
                created = row[0]
            if row[3] and (paid is None or row[0] < paid):
                paid = row[0]
        # What the watermark has passed, and what is still ahead.
        seen = [t if t is not None and t <= us else None for t in (created, paid)]
        memory, results = self.passed((*seen, given), us)
        if seen != [None, None] and memory == self.start:
            return (*(t if t is not None and t > us else None for t in (created, paid)), ""), [], results
        return (created, paid, memory[2]), [], results

    def passed(self, memory, us):
        created, paid, given = memory
        if created is None and paid is None:
            return memory, []
        outcome = self._outcome(created, paid, us)
        results = [(created, paid, outcome)] if outcome and outcome != given else []
        return (self.start if us >= self._end(memory) else (created, paid, outcome or given)), results

    def wake(self, memory, us):
        created, paid = seen = [t if t is not None and t <= us else None for t in memory[:2]]
        times = [t for t in memory[:2] if t is not None and t > us]
        if created is not None and not memory[2]:
            times.append(created + self.limit)
        elif seen != [None, None]:
            times.append(self._end(seen))
        return min(times, default=None)

    def _end(self, memory) -> int:
        return min(t for t in memory[:2] if t is not None) + self.limit + self.grace + self.remember

    def _outcome(self, created, paid, us) -> str:
        if paid is None:
            return "unpaid" if us >= created + self.limit else ""
        if created is None or paid < created:
            return "paid_no_create"
        if paid < created + self.limit:
            return "paid"
        return "paid_late" if paid <= created + self.limit + self.grace else "unpaid"


def order_lifecycle_stream(df: DataFrame, keys: Sequence[str], ts: str, seq: str, created: Column, paid: Column,
                           limit: str = "15 minutes", late_grace: str = "1 day", delay: str | None = "0 seconds",
                           remember: str = "7 days") -> DataFrame:
    """Batch form: operators.orders.order_lifecycle. An order that is not paid in time gives `unpaid`
    then, and a second row if it is paid in the grace; the last row of an order is the batch result. An
    order is forgotten `remember` after its limit and grace; events later than that start it afresh."""
    found = in_order(df, keys, ts, seq, delay, [created.alias("_created"), paid.alias("_paid")], Lifecycle,
                     micros(limit), micros(late_grace), micros(remember), results="create_us bigint, pay_us bigint, outcome string",
                     only=created | paid)
    return found.select(*keys, F.timestamp_micros("create_us").alias("create_ts"),
                        F.timestamp_micros("pay_us").alias("pay_ts"), "outcome")
