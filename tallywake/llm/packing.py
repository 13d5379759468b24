"""Best-fit packing of token pieces by a configuration linear program.

The histogram of piece lengths (at most one row per length up to the capacity, whatever the corpus) goes to the driver.
All but the shortest pieces form classes of about equal volume, each as large as its longest. The covering program over configurations (ways to fill one sequence with classes) is solved by multiplicative weights: in each round a
knapsack over the weights prices the most valuable configuration, and the weights of the classes it covers fall. The weights
also give a lower bound on the program's value; rounds end when the solution is near it. The solution is rounded to
whole configurations; these take pieces of their classes, the longest first, and what is left, the short pieces included, goes
best-fit into the room that sequences still have. Pieces are then numbered within their length on Spark and take the
plan's slots.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tallywake.llm.common import shuffle_parts, stored
from tallywake.llm.tokens import crc, encoded

CAPACITY = 4096
# The shortest pieces, of these shares of the volume, only fill up; the others are in classes, rounded up to 1 / CELLS of the
# capacity.
FILLS, CLASSES, CELLS = (0.1, 0.0, 0.3), 64, 512
# The part of that share which sequences of the program leave free for them.
RESERVE = 0.75
# How near the solution comes to the lower bound, how fast weights fall, and the rounds this may take at most: a solution that
# is less near covers as well, and costs a few sequences.
GAP, STEP, ROUNDS = 0.03, 0.3, 1000
Config = tuple[tuple[int, int], ...]  # (length, how many), longest first


def pieces(docs: DataFrame, vocab: str, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text", end: int = 1,
           keep_ids: bool = True) -> DataFrame:
    """(key, piece, start, length, ids_crc32[, ids]) of every document. Null texts are empty; the end id is always there. Repeated
    rows are cut each, an empty table gives no piece."""
    rows = docs.select(F.col(key).alias(key), F.col(text).alias("text"))
    schema = StructType([StructField(key, rows.schema[key].dataType)])
    for name, kind in (("piece", "integer"), ("start", "long"), ("length", "long"), ("ids_crc32", "long"), ("ids", "binary")):
        if name != "ids" or keep_ids:
            schema.add(name, kind)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in encoded(batches, "text", vocab, end):
            cut = [(row, at, ids[at:at + capacity]) for row, ids in enumerate(found) for at in range(0, len(ids), capacity)]
            arrays = [batch.column(key).take(pa.array([c[0] for c in cut], pa.int64())), pa.array([c[1] // capacity for c in cut], pa.int32()),
                      pa.array([c[1] for c in cut], pa.int64()), pa.array([len(c[2]) for c in cut], pa.int64()),
                      pa.array([crc(c[2]) for c in cut], pa.int64())]
            if keep_ids:
                arrays.append(pa.array([c[2].tobytes() for c in cut], pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return rows.mapInArrow(step, schema)


def classes(histogram: dict[int, int], fill: float, most: int = CLASSES) -> list[list[int]]:
    """The lengths, longest first, in at most `most` + 1 classes of about equal volume. The shortest, which hold up to the share
    `fill` of the volume, are in none."""
    lengths = sorted((l for l, n in histogram.items() if n), reverse=True)
    whole = sum(l * histogram[l] for l in lengths)
    found: list[list[int]] = []
    volume, rest = float(whole), whole
    for length in lengths:
        if rest <= fill * whole:
            break
        if volume >= whole * (1 - fill) / most:
            found.append([])
            volume = 0.0
        found[-1].append(length)
        volume += length * histogram[length]
        rest -= length * histogram[length]
    return found


def _knapsack(sizes: np.ndarray, worth: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The value of the most valuable filling of the room, and how many of each class it takes; sizes rise."""
    best, take = np.zeros(room + 1), np.full(room + 1, -1)
    until = np.searchsorted(sizes, np.arange(room + 1), "right")
    for c in range(1, room + 1):
        best[c] = best[c - 1]
        if until[c]:
            totals = worth[:until[c]] + best[c - sizes[:until[c]]]
            at = int(np.argmax(totals))
            if totals[at] > best[c]:
                best[c], take[c] = totals[at], at
    found, c = np.zeros(len(sizes), np.int64), room
    while c > 0:
        if take[c] < 0:
            c -= 1
        else:
            found[take[c]] += 1
            c -= sizes[take[c]]
    return best[room], found


def solve(sizes: np.ndarray, demand: np.ndarray, room: int, gap: float = GAP, rounds: int = ROUNDS) -> tuple[dict[tuple, float], float]:
    """Configurations (how many of each class) with how often each is used, covering the demand, and a lower bound on
    how many any covering uses.

    In a round the priced configuration is used until its scarcest class would be covered once more; a class's weight falls
    by exp(-STEP x the share of its demand that is covered). Rounds end at `gap` from the bound.
    """
    weights = sizes / (demand * sizes).sum()
    covered, used, total, bound = np.zeros(len(sizes)), Counter(), 0.0, 0.0
    for _ in range(rounds):
        value, config = _knapsack(sizes, weights, room)
        # Worth so much at most, no sequence covers more than `value` of the whole demand's worth.
        bound = max(bound, (demand * weights).sum() / value)
        share = config / demand
        times = 1.0 / share.max()
        used[tuple(config.tolist())] += times
        total += times
        covered += times * share
        weights = weights * np.exp(-STEP * times * share)
        weights /= (demand * weights).sum()
        if covered.min() > 0 and total / covered.min() <= (1 + gap) * bound:
            break
    least = covered.min()
    return {config: times / (least or 1.0) for config, times in used.items()}, bound


def _whole(solution: dict[tuple, float], demand: np.ndarray) -> dict[tuple, int]:
    """The solution in whole numbers, within the demand: first what is whole of it, then once more where that fits."""
    left, found = demand.astype(np.int64).copy(), Counter()
    ordered = sorted(solution.items(), key=lambda c: (-c[1], c[0]))
    for extra in (False, True):
        for config, times in sorted(ordered, key=lambda c: int(c[1]) - c[1]) if extra else ordered:
            need = np.array(config)
            fits = int((left[need > 0] // need[need > 0]).min())
            whole = min(1 if extra else int(times), fits)
            if whole:
                found[config] += whole
                left -= whole * need
    return dict(found)


def _dealt(queue: list[list[int]], each: int, times: int) -> Iterator[tuple[tuple[int, ...], int]]:
    """`each` pieces for each of so many sequences from the head of a class's queue of [length, n]: (lengths, sequences)."""
    while times:
        length, n = queue[0]
        if n >= each:
            some = min(n // each, times)
            queue[0][1] -= some * each
            yield (length,) * each, some
        else:
            own: list[int] = []
            while len(own) < each:
                taken = min(queue[0][1], each - len(own))
                own += [queue[0][0]] * taken
                queue[0][1] -= taken
                if not queue[0][1]:
                    queue.pop(0)
            some = 1
            yield tuple(own), 1
        times -= some
        while queue and not queue[0][1]:
            queue.pop(0)


def program(histogram: dict[int, int], capacity: int, fill: float, gap: float = GAP, rounds: int = ROUNDS) -> Counter:
    """Configurations of lengths, how often each, that the rounded program uses: within the histogram, the pieces that fill up
    left out, and room for most of them in each sequence."""
    grouped = classes(histogram, fill)[::-1]
    if not grouped:
        return Counter()
    grid = max(1, capacity // CELLS)
    sizes = np.array([-(-max(c) // grid) for c in grouped], np.int64)
    demand = np.array([sum(histogram[l] for l in c) for c in grouped], np.float64)
    # Lengths are rounded up to the grid, so what fits there fits; those beyond its last cell go alone.
    cells = int(capacity * (1 - RESERVE * fill)) // grid
    fitting = sizes <= cells
    found: Counter = Counter({((l, 1),): histogram[l] for c, fits in zip(grouped, fitting) if not fits for l in c})
    if not fitting.any():
        return found
    sizes, demand = sizes[fitting], demand[fitting]
    queues = [[[l, histogram[l]] for l in c] for c, fits in zip(grouped, fitting) if fits]
    solution, _ = solve(sizes, demand, cells, gap, rounds)
    for config, times in _whole(solution, demand).items():
        runs = [list(_dealt(queues[i], n, times)) for i, n in enumerate(config) if n]
        # Sequences in which no class changes its lengths are alike.
        while times:
            some = min(run[0][1] for run in runs)
            found[tuple(sorted(Counter(l for run in runs for l in run[0][0]).items(), reverse=True))] += some
            for run in runs:
                run[0] = (run[0][0], run[0][1] - some)
                if not run[0][1]:
                    run.pop(0)
            times -= some
    return found


def plan(histogram: dict[int, int], capacity: int = CAPACITY, gap: float = GAP) -> list[tuple[Config, int]]:
    """Whole configurations, how often each, that hold exactly the histogram: the program's, topped up best-fit. Of the programs
    for several shares of pieces that fill up, the one that needs the fewest sequences."""
    plans = (topped_up(histogram, program(histogram, capacity, fill, gap), capacity) for fill in FILLS)
    return min(plans, key=lambda found: sum(n for _, n in found))


def topped_up(histogram: dict[int, int], planned: Counter, capacity: int) -> list[tuple[Config, int]]:
    """The planned configurations and the rest of the histogram, which goes best-fit into them and further ones."""
    left = Counter({l: n for l, n in histogram.items() if n})
    found: Counter = Counter()
    room: defaultdict[int, Counter] = defaultdict(Counter)
    sizes: list[int] = []

    def put(space: int, config: Counter, n: int) -> None:
        if space not in room:
            insort(sizes, space)
        room[space][tuple(sorted(config.items(), reverse=True))] += n

    for config, times in sorted(planned.items()):
        put(capacity - sum(l * n for l, n in config), Counter(dict(config)), times)
        left.subtract({l: n * times for l, n in config})
    # What is left, longest first, into the open sequences of least room that takes it, many alike at a time.
    for length in sorted(left, reverse=True):
        n = left[length]
        while n:
            at = bisect_left(sizes, length)
            if at == len(sizes):
                each = min(capacity // length, n)
                times = n // each
                put(capacity - each * length, Counter({length: each}), times)
                n -= each * times
                continue
            space = sizes[at]
            config, there = next(iter(room[space].items()))
            each = min(space // length, n)
            times = min(there, n // each)
            room[space][config] -= times
            if not room[space][config]:
                del room[space][config]
            if not room[space]:
                del room[space]
                sizes.pop(at)
            put(space - each * length, Counter(dict(config)) + Counter({length: each}), times)
            n -= each * times
    for configs in room.values():
        found.update(configs)
    return sorted(found.items())


def slots(planned: list[tuple[Config, int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: first slot number, first sequence, pieces a sequence and offset of each stretch of slots."""
    found: defaultdict[int, list] = defaultdict(list)
    taken, sequence = Counter(), 0
    for config, times in planned:
        offset = 0
        for length, n in config:
            found[length].append((taken[length], sequence, n, offset))
            taken[length] += n * times
            offset += n * length
        sequence += times
    return {length: tuple(np.array(c, np.int64) for c in zip(*rows)) for length, rows in found.items()}


def pack(docs: DataFrame, vocab: str, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text", end: int = 1,
         gap: float = GAP, keep_ids: bool = False) -> DataFrame:
    """(key, piece, start, length, ids_crc32, [ids,] sequence_id, offset) of every piece.

    Every piece is placed, offsets in a sequence have no gaps, no sequence exceeds the capacity. Rows that repeat are
    placed as often. An empty table gives none. The plan, which tasks get, is bounded by
    classes and lengths.
    """
    cut = stored(pieces(docs, vocab, capacity, key, text, end, keep_ids), "pieces")
    # Numbers within a length: counted by share of the rows first, so that no length is numbered in one task.
    shares = max(1, shuffle_parts(docs.sparkSession))
    dealt = cut.withColumn("_share", F.pmod(F.xxhash64(key, "piece", "ids_crc32"), F.lit(shares)))
    counts = dealt.groupBy("length", "_share").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_share")) - F.col("_n")
    bases = counts.select("length", "_share", before.alias("_before"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    place = docs.sparkSession.sparkContext.broadcast(slots(plan(histogram, capacity, gap)))
    within = F.row_number().over(Window.partitionBy("length", "_share").orderBy(key, "piece", "ids_crc32")) - 1
    ranked = dealt.withColumn("_at", within).join(bases, ["length", "_share"])

    # Only lengths and numbers go to Python, not the ids.
    @F.pandas_udf("sequence_id long, offset long")
    def placed(length: pd.Series, slot: pd.Series) -> pd.DataFrame:
        lengths, numbers = length.to_numpy(), slot.to_numpy()
        sequences, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for length in np.unique(lengths):
            rows = np.flatnonzero(lengths == length)
            first, sequence, each, offset = place.value[int(length)]
            at = np.searchsorted(first, numbers[rows], "right") - 1
            nth = numbers[rows] - first[at]
            sequences[rows] = sequence[at] + nth // each[at]
            offsets[rows] = offset[at] + nth % each[at] * length
        return pd.DataFrame({"sequence_id": sequences, "offset": offsets})

    return ranked.withColumn("_placed", placed("length", F.col("_before") + F.col("_at"))).select(*cut.columns, "_placed.*")
