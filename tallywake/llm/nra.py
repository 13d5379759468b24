"""Exact top-k search by inner product with no random access: sorted lists, score bounds, a stop, then the final scores.

Rows come in blocks. A block has a sorted list for every component, read in step from both ends: from the top for
queries whose weight is positive there, from the bottom for the others. What a list has not yet shown of a row is
between its last value read and its far end, which bounds the row's score from above and from below:

    upper = sum of weight x (value if read, else the last value read)
    lower = sum of weight x (value if read, else the far end of the list)

A row stays while its upper bound reaches the k-th lower bound known for the query, from this block and all blocks the
task had before. Reading stops when few rows are left, i.e. all others cannot qualify, and the scores of those left are
made exact. Bounds are whole numbers, so pruning is exact, ties included.

Queries are held by groups of bounded size and rows stream past them, so the work is cut into (group, slice) pieces: every
piece is a set of queries against a share of the rows, and pieces give k rows a query at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywake.llm.common import shuffle_parts, stored

SCALE = 1024
# Rows of a block, queries scored at a time, queries that a task holds.
BLOCK, BATCH, HELD = 4096, 256, 16384
# Shares of a list that are read before bounds are looked at, and the pairs of a query and a row bounded at a time.
DEPTHS = (0.3, 0.45, 0.6, 0.75, 0.9)
PAIRS = 1 << 15
# Pieces of work have so many rows at most.
SLICE = 1 << 20
# Whole numbers up to here are exact in float64.
EXACT = 2.0 ** 53


class Block:
    """Sorted lists over the rows of a matrix of whole numbers, and how far each has been read."""

    def __init__(self, rows: np.ndarray) -> None:
        self.rows = rows
        self.order = np.argsort(rows, axis=0, kind="stable")
        self.sorted = np.take_along_axis(rows, self.order, axis=0)
        self.rewind()

    def rewind(self) -> None:
        """Nothing read: every component lies between the ends of its list."""
        self.read = 0
        # Bounds of components for weights above zero (lists read from the top) and below zero (from the bottom).
        self.top_high, self.top_low = (np.broadcast_to(self.sorted[at], self.rows.shape).copy() for at in (-1, 0))
        self.bottom_high, self.bottom_low = self.top_low.copy(), self.top_high.copy()

    def read_to(self, depth: int) -> None:
        """Read every list on to `depth` entries from either end."""
        before, depth = self.read, min(depth, len(self.rows))
        if depth <= before:
            return
        falling, values = self.order[::-1], self.sorted[::-1]
        # The last value read bounds all that has not been read; what has been read is itself.
        np.minimum(self.top_high, values[depth - 1], out=self.top_high)
        np.maximum(self.bottom_high, self.sorted[depth - 1], out=self.bottom_high)
        np.put_along_axis(self.top_high, falling[:depth], values[:depth], axis=0)
        np.put_along_axis(self.bottom_high, self.order[:depth], self.sorted[:depth], axis=0)
        np.put_along_axis(self.top_low, falling[before:depth], values[before:depth], axis=0)
        np.put_along_axis(self.bottom_low, self.order[before:depth], self.sorted[before:depth], axis=0)
        self.read = depth

    def bounds(self, up: np.ndarray, down: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the scores of all rows (columns) for the positive and negative parts of queries."""
        return up @ self.top_low.T + down @ self.bottom_low.T, up @ self.top_high.T + down @ self.bottom_high.T

    def upper(self, up: np.ndarray, down: np.ndarray, query: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Upper bounds of single rows for single queries."""
        found = np.empty(len(query))
        for lo in range(0, len(query), PAIRS):
            q, r = query[lo:lo + PAIRS], row[lo:lo + PAIRS]
            found[lo:lo + PAIRS] = np.einsum("ij,ij->i", up[q], self.top_high[r]) + np.einsum("ij,ij->i", down[q], self.bottom_high[r])
        return found


def _fits(rows: np.ndarray, queries: np.ndarray) -> bool:
    """Whether all scores, and all sums on the way to them, are exact in float64."""
    return np.abs(rows).max(initial=0) * np.abs(queries).max(initial=0) * max(rows.shape[1], 1) < EXACT


def survivors(block: Block, queries: np.ndarray, floor: np.ndarray, k: int, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) pairs that may be among the k best: the others have an upper bound below the k-th lower bound.

    `floor`: scores that k rows elsewhere reach already; `own` (query, row): pairs that are no candidates.
    """
    n, alive = len(block.rows), np.ones((len(queries), len(block.rows)), bool)
    alive[own[:, 0], own[:, 1]] = False
    if not _fits(block.rows, queries):
        return np.nonzero(alive)
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    block.rewind()
    left = None
    for share in DEPTHS:
        block.read_to(max(k, int(n * share)))
        if left is None:
            lower, upper = block.bounds(up, down)
            if n > k:
                lower[~alive] = -np.inf
                floor = np.maximum(floor, np.partition(lower, n - k, axis=1)[:, n - k])
            alive &= upper >= floor[:, None]
            few = np.count_nonzero(alive)
            if few * 16 <= alive.size:
                left = np.nonzero(alive)
        else:
            stay = block.upper(up, down, *left) >= floor[left[0]]
            left = left[0][stay], left[1][stay]
            few = len(left[0])
        # No outsider qualifies any more; so few rows are sooner resolved than read on for.
        if few <= 2 * k * len(queries):
            break
    return np.nonzero(alive) if left is None else left


def _exact(rows: np.ndarray, queries: np.ndarray, query: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Final scores as int64; by Python's whole numbers where float64 could round."""
    if not _fits(rows, queries):
        return np.array([sum(int(a) * int(b) for a, b in zip(rows[r], queries[q])) for q, r in zip(query, row)], np.int64)
    found = np.empty(len(query), np.int64)
    for lo in range(0, len(query), PAIRS):
        found[lo:lo + PAIRS] = np.einsum("ij,ij->i", rows[row[lo:lo + PAIRS]], queries[query[lo:lo + PAIRS]])
    return found


class Best:
    """The k best rows of each query so far, by falling score, then id (none: last)."""

    def __init__(self, queries: int, k: int) -> None:
        self.k = k
        self.query, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.id, self.unnamed = np.zeros(0, np.int64), np.zeros(0, bool)
        self.floor = np.full(queries, -np.inf)

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray, unnamed: np.ndarray) -> None:
        cols = [np.concatenate(c) for c in ((self.query, query), (self.score, score), (self.id, ids), (self.unnamed, unnamed))]
        order = np.lexsort((cols[2], cols[3], -cols[1], cols[0]))
        cols = [c[order] for c in cols]
        starts = np.flatnonzero(np.r_[True, np.diff(cols[0]) != 0]) if len(order) else np.zeros(0, np.int64)
        place = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
        kept = place < self.k
        self.query, self.score, self.id, self.unnamed = (c[kept] for c in cols)
        full = place[kept] == self.k - 1
        self.floor[self.query[full]] = self.score[full]


def _matrix(column: pa.Array, dims: int, scale: int) -> np.ndarray:
    """Vectors of one length as floor(scale * x), x as double; whole numbers in float64."""
    return np.floor(column.flatten().to_numpy(zero_copy_only=False) * scale).reshape(len(column), dims)


def search(rows: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE,
           held: int = HELD) -> DataFrame:
    """(query_id, rank, <key>, score, dims): the k rows of largest inner product with each query, ties by least key.

    Both tables have `key` and `vector` (an array of numbers); components become floor(scale * x). A query's own row,
    i.e. one row of equal key and vector, is no candidate. Vectors that are null or hold a null or non-finite component
    take no part; only vectors of equal length meet. Queries that repeat as a whole count once, without a
    key not at all; rows that repeat are several candidates, without a key last among ties. Scores are exact and must fit a long. Fewer than k
    candidates: all of them. Empty tables: no rows.
    """
    spark, parts = rows.sparkSession, shuffle_parts(rows.sparkSession)

    def usable(df: DataFrame) -> DataFrame:
        own = df.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))
        whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        return own.where(F.col("v").isNotNull() & whole).withColumn("dims", F.size("v"))

    asked = stored(usable(queries).where("id IS NOT NULL").distinct(), "queries")
    # Groups of queries of bounded size, each against slices of the rows: of bounded size, and one for every task.
    groups = max(1, -(-asked.count() // held))
    slices = max(1, -(-parts // groups), -(-rows.count() // SLICE))
    group = F.pmod(F.xxhash64("id", "v", F.lit(1)), F.lit(groups)).cast("int")
    share = F.pmod(F.xxhash64("id", "v"), F.lit(slices)).cast("int")

    def numbers(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    tasks = asked.select("dims", "id", "v", group.alias("g"), numbers(slices).alias("s"), F.lit(0).alias("kind")).unionByName(
        usable(rows).select("dims", "id", "v", share.alias("s"), numbers(groups).alias("g"), F.lit(1).alias("kind")))
    piece = (F.col("g") * slices + F.col("s")).cast("int")
    dealt = tasks.withColumn("piece", piece).repartitionById(groups * slices, F.col("piece")).sortWithinPartitions("piece", "dims", "kind")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, asks, names, best, own, waiting = None, [], None, None, None, []

        def meet() -> None:
            nonlocal waiting, own
            if not waiting or best is None:
                waiting = []
                return
            ids = pa.concat_arrays([w[0] for w in waiting])
            matrix = np.concatenate([w[1] for w in waiting])
            waiting = []
            unnamed = ids.is_null().to_numpy(zero_copy_only=False)
            values = ids.fill_null(0).to_numpy()
            block = Block(matrix)
            for lo in range(0, len(asks), BATCH):
                some = asks[lo:lo + BATCH]
                # One row that equals the query in id and vector is its own.
                order = np.argsort(values, kind="stable")
                left, right = (np.searchsorted(values[order], names[lo:lo + BATCH], side) for side in ("left", "right"))
                skip = []
                for q in np.flatnonzero((right > left) & own[lo:lo + BATCH]):
                    same = [r for r in order[left[q]:right[q]] if not unnamed[r] and np.array_equal(matrix[r], some[q])]
                    if same:
                        skip.append((q, same[0]))
                        own[lo + q] = False
                query, row = survivors(block, some, best.floor[lo:lo + BATCH], best.k, np.array(skip, np.int64).reshape(-1, 2))
                best.add(query + lo, _exact(matrix, some, query, row), values[row], unnamed[row])

        def results() -> Iterator[pa.RecordBatch]:
            if best is not None and len(best.query):
                yield pa.RecordBatch.from_arrays([
                    pa.array(names[best.query]), pa.array(prints[best.query]), pa.array(np.full(len(best.query), at[1], np.int32)),
                    pa.array(best.score), pa.array(best.id, mask=best.unnamed)], ["query_id", "print", "dims", "score", "id"])

        prints = None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("piece", "dims", "kind")], axis=1)
            cuts = np.flatnonzero(np.r_[True, (np.diff(keys, axis=0) != 0).any(axis=1)]).tolist()
            for lo, hi in zip(cuts, [*cuts[1:], len(keys)]):
                piece, dims, kind = keys[lo].tolist()
                part = batch.slice(lo, hi - lo)
                if (piece, dims) != at:
                    meet()
                    yield from results()
                    at, asks, names, prints, best = (piece, dims), None, None, None, None
                matrix = _matrix(part.column("v"), dims, scale)
                if kind == 0:
                    asks = matrix if asks is None else np.concatenate([asks, matrix])
                    ids = part.column("id").to_numpy()
                    names = ids if names is None else np.concatenate([names, ids])
                    more = part.column("print").to_numpy()
                    prints = more if prints is None else np.concatenate([prints, more])
                    best, own = Best(len(asks), k), np.ones(len(asks), bool)
                elif best is not None:
                    for start in range(0, len(matrix), BLOCK):
                        waiting.append((part.column("id")[start:start + BLOCK], matrix[start:start + BLOCK]))
                        if sum(len(w[1]) for w in waiting) >= BLOCK:
                            meet()
        meet()
        yield from results()

    met = dealt.withColumn("print", F.xxhash64("id", "v")).select("piece", "dims", "kind", "id", "print", "v").mapInArrow(
        step, "query_id bigint, print bigint, dims int, score bigint, id bigint")
    order = Window.partitionBy("query_id", "print", "dims").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias(key), "score", "dims")
