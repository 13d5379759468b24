"""Prefix trie of conversations, by union-find over the common prefixes of sorted neighbours.

Every prefix of a conversation has a hash: the exclusive or, over its turns, of the hash of (place, turn), in two lanes of
64 bits. It can be taken up stretch by stretch, so no conversation is gathered in one place. Prefixes of two
conversations or more are the shared nodes; what a conversation has below its last shared prefix is a chain of its own
and needs no tree.

The shared part of each conversation is the list of its prefix hashes. Sorted by these lists, the members of a node are
neighbours. A task takes a range of the sorted conversations, joins neighbours by edges as deep as their common prefix,
and merges components in descending depth: the merge at a depth is the branching node there. What touches an end of the
range stays open. Open components form two falling chains of edges, so a range is contracted to at most two components a depth
and its outer lists; contracted ranges are then merged across their borders by the same step, a few at a time, until one
is left. Counts of a node that does not branch follow from those of the branching node below it with the same members.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywake.llm.common import shuffle_parts, stored

GROUP, HEADS = 20, 4  # conversations that share a head; heads have fewer turns than this
STRETCH = 4096  # turns of a conversation that are numbered together
FAN = 32  # contracted ranges that one task merges


def numbered(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, rank, a, b, words): turns in their order (null first; ties by digest), from 1, with a digest of 128 bits.

    Turns are dealt by range of (conversation, turn), so a conversation of any length spreads over tasks; each
    task numbers its own and the counts of the tasks before are added.
    """
    said, by = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    words = F.regexp_count(said, F.lit(r"[^ \t-\r]+")).cast("bigint")
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("conv"), F.col(turn).alias("turn"), F.xxhash64(by, said).alias("a"),
        F.xxhash64(F.lit(1), said, F.lit(2), by).alias("b"), words.alias("words"))
    parts = shuffle_parts(turns.sparkSession)
    dealt = rows.repartitionByRange(parts, "conv", "turn", "a", "b").sortWithinPartitions("conv", "turn", "a", "b")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, count = None, 0
        for batch in batches:
            convs = batch.column("conv").to_numpy()
            if not len(convs):
                continue
            starts = np.flatnonzero(np.r_[True, np.diff(convs) != 0])
            place = np.arange(len(convs)) - np.repeat(starts, np.diff(np.r_[starts, len(convs)])) + 1
            if convs[0] == last:
                place[:starts[1] if len(starts) > 1 else len(convs)] += count
            last, count = convs[-1], int(place[-1])
            yield pa.RecordBatch.from_arrays([batch.column("conv"), pa.array(place), *(batch.column(c) for c in ("a", "b", "words"))],
                                             ["conv", "rank", "a", "b", "words"])

    local = dealt.mapInArrow(step, "conv bigint, rank bigint, a bigint, b bigint, words bigint")
    known = stored(local.withColumn("part", F.spark_partition_id()), "turns")
    ends = known.groupBy("conv", "part").agg(F.max("rank").alias("n"))
    # Only conversations that go on in another range need more than their own numbers.
    over = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = ends.withColumn("before", F.sum("n").over(over)).where("before IS NOT NULL").select("conv", "part", "before")
    return known.join(before, ["conv", "part"], "left").select(
        "conv", (F.col("rank") + F.coalesce("before", F.lit(0))).alias("rank"), "a", "b", "words")


def head_size(conv: Column, heads: int = HEADS) -> Column:
    return F.pmod(F.crc32(conv.cast("string").cast("binary")), F.lit(heads)).cast("int")


def rebuilt(turns: DataFrame, group: int = GROUP, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """(conv, pos, a, b, words) and (conv, size) of the conversations whose first h turns are those of the first of
    their group (all if it has fewer), followed by their own after the first h; h by the checksum of the number."""
    leader = F.col("conv") - F.col("conv") % group
    given = turns.where((F.col("rank") < heads) & (F.col("conv") % group == 0))
    lists = given.groupBy(F.col("conv").alias("leader")).agg(F.array_sort(F.collect_list(F.struct("rank", "a", "b", "words"))).alias("head"))
    convs = turns.groupBy("conv").agg(F.max("rank").alias("own")).withColumn("h", head_size(F.col("conv"), heads))
    convs = convs.withColumn("leader", leader).join(lists, "leader", "left")
    head = F.slice(F.coalesce("head", F.array().cast(lists.schema["head"].dataType)), F.lit(1), F.col("h"))
    convs = stored(convs.select("conv", "own", "h", head.alias("head")), "conversations")
    opening = convs.select("conv", F.explode("head").alias("t")).select("conv", F.col("t.rank").alias("pos"), "t.a", "t.b", "t.words")
    short = convs.where(F.size("head") < F.col("h")).select("conv", (F.col("h") - F.size("head")).alias("short"))
    rest = turns.where(F.col("rank") > head_size(F.col("conv"), heads)).join(short, "conv", "left").select(
        "conv", (F.col("rank") - F.coalesce("short", F.lit(0))).alias("pos"), "a", "b", "words")
    size = F.size("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    return opening.unionByName(rest), convs.select("conv", size.cast("bigint").alias("size"))


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv, pos, x, y, px, py, words, total) of turns (conv, pos, a, b, words): the hash of the prefix that ends there and of
    the one before, the words of the turn and of the prefix. Long conversations are taken up by stretches."""
    lanes = turns.select("conv", "pos", F.xxhash64("pos", "a", "b").alias("u"), F.xxhash64("b", "pos", "a").alias("v"), "words",
                         F.floor((F.col("pos") - 1) / STRETCH).alias("stretch"))
    own = Window.partitionBy("conv", "stretch").orderBy("pos")
    local = lanes.select("conv", "pos", "stretch", "u", "v", "words", F.bit_xor("u").over(own).alias("x"), F.bit_xor("v").over(own).alias("y"),
                         F.sum("words").over(own).alias("total"))
    ends = lanes.groupBy("conv", "stretch").agg(F.bit_xor("u").alias("ux"), F.bit_xor("v").alias("vx"), F.sum("words").alias("sum"))
    over = Window.partitionBy("conv").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    before = ends.select("conv", "stretch", F.bit_xor("ux").over(over).alias("bx"), F.bit_xor("vx").over(over).alias("by"),
                         F.sum("sum").over(over).alias("bt")).where("stretch > 0")
    met = local.join(before, ["conv", "stretch"], "left")
    none = F.lit(0).cast("bigint")
    x, y = F.col("x").bitwiseXOR(F.coalesce("bx", none)), F.col("y").bitwiseXOR(F.coalesce("by", none))
    return met.select("conv", "pos", x.alias("x"), y.alias("y"), x.bitwiseXOR(F.col("u")).alias("px"), y.bitwiseXOR(F.col("v")).alias("py"),
                      "words", (F.col("total") + F.coalesce("bt", none)).alias("total"))


@dataclass
class Part:
    """Neighbouring conversations that are one component, as members of the node at `depth`: the least, their number, the
    leaves and what is saved below that node, and the words down to it. A lone conversation is at its own end."""

    least: int
    n: int
    leaves: int
    below: int
    depth: int
    words: int

    def finished(self) -> tuple[int, int, int, int]:
        """(least, n, leaves, saved): leaves of the members, and what all nodes on and below their way would save if
        no others came by; a node takes off what its ancestors have."""
        return self.least, self.n, max(self.leaves, 1), self.below + (self.n - 1) * self.words

    def at(self, depth: int, words: int) -> tuple[int, int]:
        """Leaves and savings below the node of that depth, which is this one's or an ancestor."""
        if self.depth == depth:
            return self.leaves, self.below
        return max(self.leaves, 1), self.below + (self.n - 1) * (self.words - words)


Edge = tuple[int, int]  # how deep the common prefix of two neighbours is, and the words down to it


def merge(parts: list[Part], edges: list[Edge], closed: bool) -> tuple[list[tuple[int, int, int, int]], list[Part], list[Edge]]:
    """Union-find over the edges between neighbours, deepest first: finished nodes, then the open components and edges.

    Unless `closed`, the first and last part may go on beyond the range at any depth. An edge next to one that is still open
    and deeper has to wait, too; next to an open one of its own depth it is merged, as both are of one node.
    """
    n = len(parts)
    up = list(range(n))
    end = -1 if closed else 1 << 62
    # Depth of the open edge to the left and right of a component.
    left, right = [-1] * n, [-1] * n
    left[0], right[-1] = end, end

    def find(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    parts, finished, waiting = list(parts), [], []
    for e in sorted(range(n - 1), key=lambda e: (-edges[e][0], e)):
        depth, words = edges[e]
        i, j = find(e), find(e + 1)
        if left[i] > depth or right[j] > depth:
            right[i] = left[j] = depth
            waiting.append(e)
            continue
        a, b = parts[i], parts[j]
        finished += [part.finished() for part in (a, b) if part.n > 1 and part.depth > depth]
        (leaves, below), (more, further) = a.at(depth, words), b.at(depth, words)
        parts[i] = Part(min(a.least, b.least), a.n + b.n, leaves + more, below + further, depth, words)
        up[j], right[i] = i, right[j]
    if closed and parts[find(0)].n > 1:
        finished.append(parts[find(0)].finished())
    waiting.sort()
    return finished, [parts[find(i)] for i in [0, *(e + 1 for e in waiting)]], [edges[e] for e in waiting]


def common(a: np.ndarray, b: np.ndarray) -> Edge:
    """The edge between two neighbours, from their lists of (depth, two lanes, words) of the nodes on the way."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    same = (int(differ[0]) if len(differ) else n) // 4
    return (int(a[4 * same - 4]), int(a[4 * same - 1])) if same else (0, 0)


OPEN = ("bin bigint, seq bigint, least bigint, n bigint, leaves bigint, below bigint, depth bigint, words bigint, "
        "edge_depth bigint, edge_words bigint, first array<bigint>, last array<bigint>, done boolean")
NAMES = [c.split()[0] for c in OPEN.split(", ")]


def _merged(rows: DataFrame, closed: bool) -> DataFrame:
    """Finished nodes (`done`) and contracted bins of rows that come in order, each bin as a whole; a task keeps a batch
    and what is open of the bin."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, edges, first, last = None, [], [], None, None

        def record(found: list[tuple], done: bool) -> pa.RecordBatch:
            columns = list(zip(*found)) or [()] * 12
            kinds = [pa.int64()] * 10 + [pa.list_(pa.int64())] * 2
            return pa.RecordBatch.from_arrays(
                [*(pa.array(c, k) for c, k in zip(columns, kinds)), pa.array([done] * len(found), pa.bool_())], NAMES)

        def nodes(finished: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
            return record([(at, 0, least, n, leaves, saved, 0, 0, None, None, None, None) for least, n, leaves, saved in finished], True)

        def ended() -> Iterator[pa.RecordBatch]:
            nonlocal parts, edges
            if at is None:
                return
            finished, parts, edges = merge(parts, edges, closed)
            yield nodes(finished)
            if not closed:
                ways, top = [*edges, (None, None)], len(parts) - 1
                yield record([(at, i, p.least, p.n, p.leaves, p.below, p.depth, p.words, *ways[i], first if i == 0 else None,
                               last if i == top else None) for i, p in enumerate(parts)], False)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in NAMES[:10]]
            heads, tails = batch.column("first"), batch.column("last")
            for row, values in enumerate(zip(*columns)):
                if values[0] != at:
                    yield from ended()
                    at, parts, edges, first, last = values[0], [], [], None, None
                own = heads[row].values.to_numpy() if heads[row].is_valid else None
                if parts and len(edges) < len(parts):
                    edges.append(common(last, own))
                if first is None:
                    first = own
                parts.append(Part(*values[2:8]))
                if values[8] is not None:
                    edges.append(values[8:10])
                elif tails[row].is_valid:
                    last = tails[row].values.to_numpy()
            if at is not None and len(parts) > 1:
                whole = len(edges) == len(parts)  # the last row's edge leads to the next batch
                ahead = [edges.pop()] if whole else []
                finished, parts, edges = merge(parts, edges, False)
                edges += ahead
                yield nodes(finished)
        yield from ended()

    return rows.select(*NAMES[:12]).mapInArrow(step, OPEN)


def member_sets(paths: DataFrame) -> DataFrame:
    """(least, n, leaves, saved) of every set of two or more conversations that are the members of a node.

    `paths` has (conv, size, way): the list of (depth, two lanes, words) of the nodes on a conversation's way at which
    members part, its last shared one included.
    """
    parts = shuffle_parts(paths.sparkSession)
    dealt = paths.repartitionByRange(parts, "way", "conv").sortWithinPartitions("way", "conv")
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    rows = dealt.select(
        F.spark_partition_id().cast("bigint").alias("bin"), none.alias("seq"), F.col("conv").alias("least"), one.alias("n"), none.alias("leaves"),
        none.alias("below"), F.col("size").alias("depth"), none.alias("words"), F.lit(None).cast("bigint").alias("edge_depth"),
        F.lit(None).cast("bigint").alias("edge_words"), F.col("way").alias("first"), F.col("way").alias("last"))
    found, bins = [stored(_merged(rows, False), "contracted")], parts
    while True:
        bins = -(-bins // FAN)
        fewer = found[-1].where("NOT done").withColumn("group", F.floor(F.col("bin") / FAN))
        dealt = fewer.repartition(bins, "group").sortWithinPartitions("group", "bin", "seq").withColumn("bin", F.col("group"))
        found.append(stored(_merged(dealt, bins == 1), "contracted"))
        if bins == 1:
            break
    nodes = found[0]
    for other in found[1:]:
        nodes = nodes.unionByName(other)
    return nodes.where("done").select("least", "n", "leaves", F.col("below").alias("saved"))


def ends_hashes(ended: DataFrame, key: list[str]) -> DataFrame:
    """`key` and ends_sha256 of the conversations (conv) of each key: their numbers in order, joined by commas.

    Lone ones need no shuffle of their own. The numbers of a key with more pass one task in order (a checksum of this kind
    has no other way), which keeps its state only, never the numbers.
    """
    parts = ended.repartition(shuffle_parts(ended.sparkSession), *key).sortWithinPartitions(*key, "conv")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None

        def record(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*[(*k, h) for k, h in found]))
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:-1]), pa.array(columns[-1], pa.string())], [*key, "ends_sha256"])

        for batch in batches:
            found = []
            keys = np.stack([batch.column(c).to_numpy() for c in key], axis=1)
            starts = np.flatnonzero(np.r_[True, (np.diff(keys, axis=0) != 0).any(axis=1)]).tolist() if len(keys) else []
            convs = batch.column("conv").to_pylist()
            for lo, hi in zip(starts, [*starts[1:], len(keys)]):
                own, numbers = tuple(keys[lo].tolist()), ",".join(map(str, convs[lo:hi])).encode()
                if own == at:
                    state.update(b"," + numbers)
                else:
                    if at is not None:
                        found.append((at, state.hexdigest()))
                    at, state = own, hashlib.sha256(numbers)
            if found:
                yield record(found)
        if at is not None:
            yield record([(at, state.hexdigest())])

    return parts.select(*key, "conv").mapInArrow(step, ", ".join(f"{c} bigint" for c in key) + ", ends_sha256 string")


def trie(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
         group: int = GROUP, heads: int = HEADS) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations, the empty one included.

    conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256. Turns go by
    `turn` (null first), equal ones by digest; rows that repeat are turns of their own. A null role or text is empty, rows
    without a conversation are left out, a conversation whose turns all go stays, with no turn. An empty table has no node.
    Other columns are not read. Prefixes are told apart by 128-bit hashes.
    """
    known = numbered(turns, conv, turn, role, text)
    said, sizes = rebuilt(stored(known, "ranked"), group, heads)
    convs = stored(sizes, "sizes")
    n_all, least_all = convs.agg(F.count(F.lit(1)), F.min("conv")).first()
    rows = stored(prefixes(said), "prefixes")
    key = ["pos", "x", "y"]
    met = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("least"), *[F.first(c).alias(c) for c in ("px", "py", "words", "total")])
    root = convs.agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("least")).selectExpr(
        "0L AS pos", "0L AS x", "0L AS y", "n", "least", "NULL AS px", "NULL AS py", "0L AS words", "0L AS total")
    shared = stored(met.where("n > 1").unionByName(root.where("n > 1")), "shared")
    kids = shared.where("pos > 0").groupBy((F.col("pos") - 1).alias("pos"), F.col("px").alias("x"), F.col("py").alias("y")).agg(
        F.count(F.lit(1)).alias("kids"), F.max("n").alias("most"))
    nodes = stored(shared.join(kids, key, "left"), "nodes")
    # A node all of whose members go on to one child does not part them.
    parting = nodes.where("(most IS NULL OR most < n) AND pos > 0").select(*key, "least", "total")
    way = F.array_sort(F.collect_list(F.struct("pos", "x", "y", "total", "least")))
    ways = rows.select("conv", *key).join(parting, key).groupBy("conv").agg(way.alias("way"))
    last = F.element_at("way", -1)
    none = F.lit(0).cast("bigint")
    tails = convs.join(ways, "conv", "left").select(
        "conv", "size", F.flatten(F.transform(F.coalesce("way", F.array().cast(ways.schema["way"].dataType)), lambda e: F.array(
            e["pos"], e["x"], e["y"], e["total"]))).alias("way"),
        F.coalesce(last["pos"], F.lit(0 if n_all > 1 else -1).cast("bigint")).alias("shared"), F.coalesce(last["x"], none).alias("x"),
        F.coalesce(last["y"], none).alias("y"), F.coalesce(last["least"], F.lit(least_all).cast("bigint")).alias("tail"))
    tails = stored(tails, "ways")
    own_hash, no_hash = F.sha2(F.col("conv").cast("string"), 256), F.sha2(F.lit(""), 256)

    def zero(n: int) -> Column:
        return F.lit(n).cast("bigint")

    # Below its last shared prefix a conversation is alone.
    start = convs.where(F.lit(n_all == 1)).select("conv", zero(0).alias("pos"))
    alone = rows.select("conv", "pos").unionByName(start).join(tails.select("conv", "size", "shared", "tail"), "conv").where("pos > shared").select(
        F.col("conv").alias("conv_id"), F.col("pos").alias("depth"),
        F.when(F.col("pos") == 0, None).when(F.col("pos") - 1 > F.col("shared"), F.col("conv")).otherwise(F.col("tail")).alias("parent_conv_id"),
        zero(1).alias("n_convs"), (F.col("pos") < F.col("size")).cast("bigint").alias("n_children"), zero(1).alias("n_leaves"),
        zero(0).alias("saved_tokens"), F.when(F.col("pos") == F.col("size"), own_hash).otherwise(no_hash).alias("ends_sha256"))
    if n_all < 2:
        return alone
    at_tail = [F.col("shared").alias("pos"), "x", "y"]
    lone = tails.where("size > shared").select(*at_tail).groupBy(*key).agg(F.count(F.lit(1)).alias("lone"))
    hashes = ends_hashes(tails.where("size = shared").select(*at_tail, "conv"), key)
    sets = stored(member_sets(tails.select("conv", "size", "way")), "member-sets")
    parents = shared.select((F.col("pos") + 1).alias("pos"), F.col("x").alias("px"), F.col("y").alias("py"), F.col("least").alias("parent"))
    found = nodes.join(lone, key, "left").join(hashes, key, "left").join(parents, ["pos", "px", "py"], "left").join(sets, ["least", "n"])
    saved = F.col("saved") - (F.col("n") - 1) * (F.col("total") - F.col("words"))
    return alone.unionByName(found.select(
        F.col("least").alias("conv_id"), F.col("pos").alias("depth"), F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        (F.coalesce("kids", none) + F.coalesce("lone", none)).alias("n_children"), F.col("leaves").alias("n_leaves"),
        saved.alias("saved_tokens"), F.coalesce("ends_sha256", no_hash).alias("ends_sha256")))
