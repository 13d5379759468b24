"""One-to-one pairing against a plain reading of its rule, in batch and as a stream; windows that fire again."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallywake.operators.counts import sliding_count
from tallywake.operators.pairs import pair_match
from tallywake.operators.rank import top_n
from tallywake.streaming.event_time import after_watermark, with_event_time
from tallywake.streaming.pairs import pair_match_stream
from tallywake.streaming.refiring import refiring_counts, refiring_ranks
from tallywake.streaming.sinks import to_folder, write_stream
from tests.rows import frame
from tests.test_streams import DELAY, EVENTS, YEAR, arrive, finish, rows_of, shuffled

TX = "tx string, t double"


def paired(left, right, before=3.0, after=5.0) -> Counter:
    """(key, left seq, right seq) of every pair and lone row; rows are (key, t), seq is their place."""
    rows = sorted([(t, 0, i, k) for i, (k, t) in enumerate(left)] + [(t, 1, i, k) for i, (k, t) in enumerate(right)])
    waiting, found = {}, Counter()

    def lone(key, side, seq):
        found[(key, seq, None) if side == 0 else (key, None, seq)] += 1

    for t, side, seq, key in rows:
        queue = waiting.setdefault(key, [])
        while queue and queue[0][0] + (after, before)[queue[0][1]] < t - 1e-9:
            lone(key, *queue.pop(0)[1:])
        if queue and queue[0][1] != side:
            other = queue.pop(0)[2]
            found[(key, seq, other) if side == 0 else (key, other, seq)] += 1
        else:
            queue.append((t, side, seq))
    for key, queue in waiting.items():
        for row in queue:
            lone(key, *row[1:])
    return found


def sides(seed, keys="aaaaab", n=120, span=150.0):
    rng = random.Random(seed)
    return [[(rng.choice(keys), round(rng.uniform(0, span), 1)) for _ in range(n)] for _ in range(2)]


@pytest.mark.parametrize("seed,chunk", [(1, None), (2, "12 seconds")])
def test_pairs_in_time_order(spark, seed, chunk):
    """Short chunks hand rows on many times: a key is one long queue over all of them."""
    left, right = sides(seed)
    got = pair_match(frame(spark, left, TX), frame(spark, right, TX), ["tx"], "ts", "seq", chunk=chunk)
    assert rows_of(got, "tx", "l_seq", "r_seq") == paired(left, right)
    kinds = {r["outcome"]: (r["l"], r["r"]) for r in got.groupBy("outcome").agg(F.count("l_seq").alias("l"), F.count("r_seq").alias("r")).collect()}
    assert set(kinds) == {"matched", "no_receipt", "no_pay"} and kinds["no_pay"][0] == 0 and kinds["no_receipt"][1] == 0


def test_a_row_early_on_moves_all_pairs_after_it(spark):
    """Rows that are never let off: what the first chunk hands on goes through every chunk."""
    left = [("a", float(i)) for i in range(24)]
    right = [("a", i + 4.5) for i in range(24)]
    got = pair_match(frame(spark, left, TX), frame(spark, right, TX), ["tx"], "ts", "seq", chunk="6 seconds")
    want = paired(left, right)
    assert rows_of(got, "tx", "l_seq", "r_seq") == want and want[("a", 0, 0)] == want[("a", 23, 23)] == 1


def test_equal_rows_null_keys_and_empty_sides(spark):
    schema = "tx string, v int, seq long, ts timestamp"
    rows = [("a", 1, 0, "2024-01-01 00:00:00"), ("a", 1, 0, "2024-01-01 00:00:00"), (None, 2, 1, "2024-01-01 00:00:00"), ("a", 3, 2, None)]
    left = spark.createDataFrame([], schema).unionByName(
        spark.createDataFrame(rows, "tx string, v int, seq long, ts string").withColumn("ts", F.col("ts").cast("timestamp")))
    right = left.where("tx = 'a' AND ts IS NOT NULL").limit(1)
    got = Counter((r["tx"], r["l_v"], r["r_v"], r["outcome"]) for r in pair_match(left, right, ["tx"], "ts", "seq").collect())
    assert got == {("a", 1, 1, "matched"): 1, ("a", 1, None, "no_receipt"): 1, (None, 2, None, "no_receipt"): 1, ("a", 3, None, "no_receipt"): 1}
    assert pair_match(left.limit(0), right.limit(0), ["tx"], "ts", "seq").count() == 0
    assert [r["outcome"] for r in pair_match(left.limit(0), right, ["tx"], "ts", "seq").collect()] == ["no_pay"]


def test_pairs_on_streams(spark, tmp_path):
    left, right = (shuffled(rows, i) for i, rows in enumerate(sides(4, "aab", 60, 100.0)))
    l_stream, l_rows = arrive(spark, tmp_path, left, TX, ("l", YEAR), name="l")
    r_stream, r_rows = arrive(spark, tmp_path, right, TX, ("r", YEAR), name="r")
    got = finish(pair_match_stream(l_stream, r_stream, ["tx"], "ts", "seq", delay=f"{DELAY} seconds"), tmp_path)
    columns = ["tx", "l_seq", "r_seq", "outcome"]
    want = rows_of(pair_match(l_rows, r_rows, ["tx"], "ts", "seq"), *columns)
    assert rows_of(got.where("tx NOT IN ('l', 'r')"), *columns) == want
    assert {r[-1] for r in want} == {"matched", "no_receipt", "no_pay"}


def steps(spark, tmp_path, batches: list[list[tuple]]):
    """A stream whose micro-batches hold just these rows."""
    folder = str(tmp_path / "steps")
    for rows in batches:
        frame(spark, rows, EVENTS).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(frame(spark, batches[0], EVENTS).schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_windows_fire_again_for_late_rows_only(spark, tmp_path):
    # At the start of the micro-batches the watermark is 0, 100, 101, 130: the third has a late row of a window that has
    # fired, and one whose windows are closed for good.
    stream = steps(spark, tmp_path, [[("a", 1, 91.0), ("b", 1, 95.0), ("a", 1, 100.0)], [("c", 1, 101.0)],
                                     [("a", 1, 92.0), ("a", 1, 20.0), ("a", 1, 130.0)], [("z", 0, YEAR)]])
    counts = refiring_counts(with_event_time(stream, "ts", "0 seconds"), ["k"], "ts", "20 seconds", "10 seconds", "30 seconds")
    query = write_stream(counts, "fire", to_folder(str(tmp_path / "out")), checkpoint=str(tmp_path / "state"), trigger={"availableNow": True})
    assert query.awaitTermination(240)
    rows = spark.read.parquet(str(tmp_path / "out")).where("k <> 'z'").withColumn("e", F.unix_seconds("window_end") - 1_700_000_000)
    got = Counter((r["k"], r["e"], r["cnt"], r["again"]) for r in rows.select("k", "e", "cnt", "again").collect())
    assert got == Counter([
        ("a", 100, 1, False), ("b", 100, 1, False), ("a", 100, 2, True), ("a", 110, 3, False), ("b", 110, 1, False), ("c", 110, 1, False),
        ("a", 120, 1, False), ("c", 120, 1, False), ("a", 140, 1, False), ("a", 150, 1, False)])
    # Nothing is kept of windows that can change no more: one value of the closing row is left.
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 4


def test_ranks_follow_late_rows_and_are_dropped(spark, tmp_path):
    """Late rows of the third micro-batch change ranks that the second has shown."""
    rng = random.Random(13)
    early = [("a", rng.randint(1, 8), round(rng.uniform(0, 120), 2)) for _ in range(80)] + [("a", 1, 120.0)]
    late = [("b", user, t) for user in (7, 7, 7, 8) for t in (88.0, 104.0)]
    stream = steps(spark, tmp_path, [early, [("a", 2, 121.0)], late, [("z", 0, YEAR)]])
    whole = frame(spark, [*early, ("a", 2, 121.0), *late], EVENTS)
    counts = refiring_counts(with_event_time(stream, "ts", "2 seconds"), ["user_id"], "ts", "30 seconds", "10 seconds", "60 seconds")
    ranks = refiring_ranks(counts.select("user_id", "window_end", "cnt"), "user_id", 3, "60 seconds", "1 minute")
    query = write_stream(ranks, "ranks", to_folder(str(tmp_path / "out")), checkpoint=str(tmp_path / "state"), trigger={"availableNow": True})
    assert query.awaitTermination(240)
    got = spark.read.parquet(str(tmp_path / "out")).where("user_id > 0")
    newest = got.groupBy("window_end").agg(F.max("batch").alias("batch")).join(got, ["window_end", "batch"])
    columns = ["window_end", "user_id", "cnt", "row_num"]
    want = top_n(sliding_count(whole, ["user_id"], "ts", "30 seconds", "10 seconds"), "user_id", 3)
    assert rows_of(newest, *columns) == rows_of(want, *columns)
    assert got.count() > newest.count()
    assert all(op["numRowsTotal"] <= 8 for op in query.lastProgress["stateOperators"])


def test_rows_that_are_not_counted_move_the_watermark(spark, tmp_path):
    """Windows close although no row of the wanted kind comes any more."""
    stream = steps(spark, tmp_path, [[("a", 1, 5.0)], [("b", 1, 500.0)], [("b", 1, 501.0)]])
    kept = after_watermark(with_event_time(stream, "ts", "0 seconds"), "ts", F.col("k") == "a")
    out = finish(kept.groupBy(F.window("ts", "10 seconds").alias("w")).count(), tmp_path)
    assert [r["count"] for r in out.collect()] == [1]
