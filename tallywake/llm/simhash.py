"""Near duplicates by SimHash: fingerprints, links at few differing bits, connected groups.

A fingerprint of 64 bits is cut into so few segments that one of them differs by at most one bit between any two
linked fingerprints: with d bits allowed, d // 2 + 1 segments. A segment with one of its bits blanked is a variant;
two segments within one bit share a variant. Equal variants are joined, and the full distance decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tallywake.llm.common import column_bytes, shuffle_parts, stored, words_of
from tallywake.llm.components import components

BITS = 64
# Members of a variant that one task compares at a time.
BLOCK = 2048


def fingerprint(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """Bit b is 1 if it is set in over half the XXH64 values of the word shingles. No words: 0."""
    words = words_of(text)
    if not words:
        return 0
    runs = [b" ".join(words)] if len(words) < shingle else map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = np.fromiter((xxhash.xxh64_intdigest(r, seed) for r in runs), np.uint64)
    votes = np.zeros(BITS, np.int64)
    for part in np.array_split(hashes, len(hashes) // 65536 + 1):
        votes += np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes)).view(">u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = 3, keep: list[str] | None = None) -> DataFrame:
    """The columns of `keep` (all but the text, unless given) and `fingerprint`, 64 bits as a long."""
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    source = docs.select(*[F.col(c) for c in keep], F.col(text).alias("_text"))
    schema = StructType([*docs.select(*keep).schema.fields, StructField("fingerprint", LongType())])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in column_bytes(batch, "_text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found)], [*keep, "fingerprint"])

    return source.mapInArrow(step, schema)


def variants(prints: DataFrame, distance: int = 3) -> DataFrame:
    """(fingerprint, variant) of every segment with each of its bits blanked."""
    segments = distance // 2 + 1
    edges = [BITS * s // segments for s in range(segments + 1)]
    keys = []
    for s in range(segments):
        low, width = edges[s], edges[s + 1] - edges[s]
        for bit in range(low, low + width):
            mask = (((1 << width) - 1) << low) & ~(1 << bit)
            signed = mask - (1 << BITS) if mask >> (BITS - 1) else mask
            # Which bit is blank (6 bits) and the rest of the segment, hashed to one long; `links` checks the distance.
            keys.append(F.xxhash64(F.lit(bit), F.col("fingerprint").bitwiseAND(F.lit(signed))))
    return prints.select("fingerprint", F.explode(F.array(*keys)).alias("variant"))


def _spanning(members: np.ndarray, distance: int) -> list[np.ndarray]:
    """Links that connect what all links within the members connect, one less than members at most."""
    found, left = [], np.unique(members)
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            at = front.pop()
            near = np.bitwise_count(left ^ at) <= distance
            front += list(left[near])
            found.append(np.stack([np.full(near.sum(), at), left[near]], axis=1))
            left = left[~near]
    return found


def _links_of_groups(keys: np.ndarray, members: np.ndarray, distance: int) -> np.ndarray:
    """Links within each run of equal keys; runs of two, nearly all of them, go at once."""
    starts = np.r_[0, np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1]
    sizes = np.diff(np.r_[starts, len(keys)])
    two = starts[sizes == 2]
    pairs = np.stack([members[two], members[two + 1]], axis=1)
    found = [pairs[np.bitwise_count(pairs[:, 0] ^ pairs[:, 1]) <= distance]]
    for lo, n in zip(starts[sizes > 2], sizes[sizes > 2]):
        found += _spanning(members[lo:lo + n], distance)
    return np.unique(np.concatenate(found), axis=0)


def links(prints: DataFrame, distance: int = 3, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between distinct fingerprints that connect the same groups as all pairs within `distance`.

    `prints` holds each fingerprint once. A variant's members are compared in blocks: with n blocks every pair of
    blocks is a piece of work, so no variant is gathered whole, and a piece gives less links than it has members.
    """
    keyed = variants(prints, distance)
    # Spark sizes the variants as if they were as many as the fingerprints, so what meets them is never left to its size checks.
    sizes = keyed.groupBy("variant").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").hint("merge")
    shared = keyed.join(sizes, "variant").withColumn("_blocks", F.ceil(F.col("_n") / block).cast("int"))
    shared = shared.withColumn("_own", F.pmod(F.xxhash64("fingerprint"), F.col("_blocks")).cast("int"))
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("_blocks") - 1),
        lambda other: F.least(other, F.col("_own")) * F.col("_blocks") + F.greatest(other, F.col("_own")))
    tasks = shared.select("variant", F.explode(pairs).alias("pair"), "fingerprint")
    dealt = tasks.repartition(shuffle_parts(prints.sparkSession), "variant", "pair").sortWithinPartitions("variant", "pair")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 3), np.int64)  # the last group of a batch may go on in the next
        for batch in batches:
            rows = np.concatenate([held, np.stack([np.asarray(c, np.int64) for c in batch.columns], axis=1)])
            cuts = np.flatnonzero((np.diff(rows[:, :2], axis=0) != 0).any(axis=1))
            ready = cuts[-1] + 1 if len(cuts) else 0
            held = rows[ready:]
            if ready:
                yield record(_links_of_groups(rows[:ready, :2], rows[:ready, 2].astype(np.uint64), distance))
        if len(held):
            yield record(_links_of_groups(held[:, :2], held[:, 2].astype(np.uint64), distance))

    def record(found: np.ndarray) -> pa.RecordBatch:
        ends = found.astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    return dealt.mapInArrow(step, "a bigint, b bigint").distinct()


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    A component holds all documents reachable by links of `distance` or fewer differing bits; component_id is its
    smallest doc_id. Texts without words, null included, have fingerprint 0 and link like any other. A null doc_id
    is a member but never names a component (null if there is no other); repeated rows come out as often.
    """
    rows = stored(with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", shingle), "prints")
    distinct = stored(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "distinct-prints")
    roots = components(links(distinct.select("fingerprint"), distance))
    # All of these grow with the documents, and a file may be far smaller than its rows in memory: no broadcast at any size.
    rooted = distinct.join(roots.hint("merge"), distinct.fingerprint == roots.node, "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(rooted.join(named.hint("merge"), "root").select("fingerprint", "component_id"), "components")
    return rows.join(named.hint("merge"), "fingerprint").select("doc_id", "fingerprint", "component_id")


def hex_digits(fingerprint: str = "fingerprint"):
    return F.lpad(F.lower(F.hex(F.col(fingerprint))), 16, "0")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """The row of the smallest doc_id of each group of near duplicates, with all its columns.

    Of several rows with that id one stays (the least hash of the text). Rows with a null id all stay.
    """
    found = groups(docs, doc_id, text, shingle, distance)
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias("_kept")).distinct()
    # The row as one struct, so that no column of it can clash with the names used here.
    whole = docs.select(F.col(doc_id).alias("_id"), F.xxhash64(text).alias("_print"), F.struct(*docs.columns).alias("_row"))
    named = whole.join(kept.hint("merge"), F.col("_id") == F.col("_kept")).groupBy("_kept").agg(F.min_by("_row", "_print").alias("_row"))
    return named.select("_row.*").unionByName(docs.where(F.col(doc_id).isNull()))
